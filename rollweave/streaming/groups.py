"""K1, K5, K6: prompt groups put together from a stream of samples.

One stateful operator holds the samples of unfinished prompts and nothing else, by prompt or by part of the prompts. A finished prompt leaves at
once; only a mark stays until the watermark has passed its last sample, so that repeats of a sample are known
as such. A row whose time the watermark has passed is not dropped but sent on as ``late``: the operator
compares times itself, on a column that Spark does not know as event time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rollweave.streaming.jobs import read_batches, write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTCOME = "prompt_id long, sample int, reward double, payload string, outcome string"
OUTCOME_ROW = Row(*[f.split()[0] for f in OUTCOME.split(", ")])


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session with its own settings, so that a job's state needs change no other query's session."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxBytesPerBatch"):
        value = spark.conf.get(key, None)
        if value is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # A state store per partition and batch: follow the cores that are there.
    cores = 2 * spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)))
    return own


class GroupCollector(StatefulProcessor):
    """State of a prompt: its samples while it is open, then a mark; ``n`` samples finish it.

    With ``wait_ms`` an open prompt leaves as ``incomplete`` when the watermark is that far past its last
    sample. Rows without prompt_id only move the watermark. Every call of the state is a message to the JVM,
    so a prompt's samples are one value, and nothing is written that stays as it is; the clock of an open
    prompt that waits for nothing stays, as the samples hold their own time.
    """

    def __init__(self, n: int, wait_ms: int | None):
        self.n, self.wait_ms = n, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getValueState("samples", "sample array<int>, reward array<double>, payload array<string>, latest long")
        self.clock = handle.getValueState("clock", "latest long, due long, done boolean")

    def _set_timer(self, due: int | None, old: int | None) -> None:
        if due != old:
            if old is not None:
                self.handle.deleteTimer(old)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Read to the end in any case: what is left would come as a group of its own.
        rows = list(rows)
        if key[0] is None:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        timely = []
        for r in rows:
            if r.ts_ms is not None and r.ts_ms < watermark:
                yield OUTCOME_ROW(key[0], r.sample, _number(r.reward), r.payload, "late")
            else:
                timely.append(r)
        if not timely:
            return
        was = self.clock.get()
        latest, due, done = was or (0, None, False)
        held, before = self._held() if was and not done else ({}, latest)
        latest = max([latest, before, *(r.ts_ms for r in timely if r.ts_ms is not None)])
        if done:
            due_now = latest + 1
        else:
            fresh = {}
            for r in timely:
                if r.sample not in held:
                    fresh.setdefault(int(r.sample), (_number(r.reward), r.payload))
            if len(held) + len(fresh) >= self.n:
                yield from _outcome(key[0], held | fresh, "complete")
                if held:
                    self.samples.clear()
                # A repeat can be no newer than the last sample; behind the watermark it is late.
                done, due_now = True, latest + 1
            else:
                if fresh or latest > before:
                    found = held | fresh
                    self.samples.update((list(found), *map(list, zip(*found.values())), latest))
                due_now = None if self.wait_ms is None else latest + self.wait_ms
        self._set_timer(due_now, due)
        if was is None or (due_now, done) != was[1:]:
            self.clock.update((latest, due_now, done))

    def _held(self) -> tuple[dict, int]:
        """The samples of an open prompt and the time of the last one."""
        samples, rewards, payloads, latest = self.samples.get()
        return dict(zip(samples, zip(rewards, payloads))), latest

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.clock.get()[2]:
            yield from _outcome(key[0], self._held()[0], "incomplete")
            self.samples.clear()
        self.clock.clear()

    def close(self) -> None:
        pass


def _number(reward: float | None) -> float | None:
    return None if reward is None or reward != reward else reward


def _outcome(prompt_id: int, found: dict, outcome: str) -> Iterator[Row]:
    for sample in sorted(found):
        yield OUTCOME_ROW(prompt_id, sample, *found[sample], outcome)


class PartCollector(StatefulProcessor):
    """What ``GroupCollector`` does, for all prompts of a part at once.

    A call of the state is a message to the JVM and an answer for each key is an Arrow batch, so a prompt as a key
    costs milliseconds. Here both come once for a part and micro-batch: the samples of its open prompts are
    one table, the marks of its finished ones another, and one timer stands for the first that is due.
    """

    def __init__(self, n: int, wait_ms: int | None):
        self.n, self.wait_ms = n, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "rows binary")
        self.marks = handle.getValueState("marks", "rows binary")
        self.due = handle.getValueState("due", "due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows), ignore_index=True)
        # Rows without prompt_id only move the watermark.
        if key[0] < 0:
            return
        late = rows["ts_ms"] < timerValues.getCurrentWatermarkInMs()
        if late.any():
            yield _outcomes(rows[late], "late")
        rows = rows[~late]
        if rows.empty:
            return
        if rows["sample"].isna().any():
            raise ValueError("a row has a prompt but no sample")
        # Whole numbers and no gaps, as in the state.
        rows = rows.assign(latest=rows["ts_ms"].fillna(0).astype("int64").clip(lower=0))[list(OPEN.names)]
        marks, held = _load(self.marks, MARKS), _load(self.open, OPEN)
        again = rows["prompt_id"].isin(marks["prompt_id"])
        if again.any():
            marks = pd.concat([marks, rows.loc[again, ["prompt_id", "latest"]]]).groupby("prompt_id", as_index=False)["latest"].max()
        found = pd.concat([held, rows[~again]], ignore_index=True) if len(held) else rows[~again]
        found = found.assign(latest=found.groupby("prompt_id")["latest"].transform("max"))
        # A sample that is held, or came first, stays.
        found = found.drop_duplicates(["prompt_id", "sample"])
        full = found.groupby("prompt_id")["sample"].transform("size") >= self.n
        if full.any():
            yield _outcomes(found[full].sort_values(["prompt_id", "sample"]), "complete")
            done = found.loc[full, ["prompt_id", "latest"]].drop_duplicates("prompt_id")
            marks = pd.concat([marks, done], ignore_index=True) if len(marks) else done
        self._keep(found[~full], marks, self.due.get())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        marks, held = _load(self.marks, MARKS), _load(self.open, OPEN)
        if self.wait_ms is not None:
            over = held["latest"] + self.wait_ms < watermark
            if over.any():
                yield _outcomes(held[over].sort_values(["prompt_id", "sample"]), "incomplete")
            held = held[~over]
        # The timer that has come leaves by itself.
        self.due.clear()
        self._keep(held, marks[marks["latest"] + 1 >= watermark], None)

    def _keep(self, held: pd.DataFrame, marks: pd.DataFrame, old: tuple | None) -> None:
        _store(self.open, held, OPEN)
        _store(self.marks, marks, MARKS)
        dues = [int(marks["latest"].min()) + 1] if len(marks) else []
        if self.wait_ms is not None and len(held):
            dues.append(int(held["latest"].min()) + self.wait_ms)
        due = (min(dues),) if dues else None
        if due == (old and tuple(old)):
            return
        if old is not None:
            self.handle.deleteTimer(old[0])
        if due is None:
            self.due.clear()
        else:
            self.handle.registerTimer(due[0])
            self.due.update(due)

    def close(self) -> None:
        pass


MARKS = pa.schema({"prompt_id": pa.int64(), "latest": pa.int64()})
OPEN = pa.schema({"prompt_id": pa.int64(), "sample": pa.int32(), "reward": pa.float64(), "payload": pa.string(), "latest": pa.int64()})


def _load(state, schema: pa.Schema) -> pd.DataFrame:
    value = state.get()
    return (pa.ipc.open_stream(bytes(value[0])).read_all() if value else schema.empty_table()).to_pandas()


def _store(state, rows: pd.DataFrame, schema: pa.Schema) -> None:
    if rows.empty:
        state.clear()
        return
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.Table.from_pandas(rows, schema, preserve_index=False))
    state.update((sink.getvalue().to_pybytes(),))


def _outcomes(rows: pd.DataFrame, outcome: str) -> pd.DataFrame:
    return rows[["prompt_id", "sample", "reward", "payload"]].assign(outcome=outcome)


def group_outcomes(rollouts: DataFrame, n: int, delay: str, wait: str | None = None, payload: tuple[str, ...] = (), parts: int | None = None) -> DataFrame:
    """Rows of prompts with their outcome: ``complete``, ``incomplete`` (only with ``wait``) or ``late``.

    Input columns: prompt_id, sample, reward, ts, and those of ``payload``, which travel as JSON. With ``parts``
    the state is one for each part of the prompts instead of each prompt, with the same rows; a part should
    hold some thousands of open prompts, and the number stays with the checkpoint.
    """
    wait_ms = None if wait is None else int(pd.Timedelta(wait).total_seconds() * 1000)
    timed = rollouts.withWatermark("ts", delay).select(
        F.col("prompt_id").cast("long").alias("prompt_id"),
        F.col("sample").cast("int").alias("sample"),
        F.col("reward").cast("double").alias("reward"),
        (F.to_json(F.struct(*payload)) if payload else F.lit(None).cast("string")).alias("payload"),
        F.unix_millis("ts").alias("ts_ms"),
    )
    if parts is not None:
        part = F.when(F.col("prompt_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("prompt_id"), F.lit(parts)).cast("int"))
        # A null would make the ids of its Arrow batch floats.
        timed = timed.withColumns({"part": part, "prompt_id": F.coalesce("prompt_id", F.lit(0).cast("long"))})
        return timed.groupBy("part").transformWithStateInPandas(PartCollector(n, wait_ms), OUTCOME, "append", "eventTime")
    return timed.groupBy("prompt_id").transformWithState(GroupCollector(n, wait_ms), OUTCOME, "append", "eventTime")


def collect_outcomes(table: str) -> Callable[[DataFrame, int], None]:
    """Groups and late rows as two tables, one partition for each micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        write_batch(batch.where("outcome <> 'late'"), f"{table}/groups", batch_id)
        write_batch(batch.where("outcome = 'late'"), f"{table}/late", batch_id)
        batch.unpersist()

    return handle


def groups(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all groups; ``group_no`` tells the groups of one prompt apart."""
    return read_batches(spark, f"{table}/groups", OUTCOME).withColumn("group_no", F.col("batch_id").cast("long")).drop("batch_id")


def late_rows(spark: SparkSession, table: str) -> DataFrame:
    return read_batches(spark, f"{table}/late", OUTCOME).drop("batch_id")


def end_of_input(spark: SparkSession, schema: str, last: str, delay: str, wait: str | None = None) -> DataFrame:
    """One row without prompt that moves the watermark past every timer, so that open groups come out.

    ``last`` is the time of the newest row; append the row to the input when no more will come.
    """
    far = pd.Timestamp(last) + pd.Timedelta(delay) + pd.Timedelta(wait or "0s") + pd.Timedelta("1s")
    names = [f.split()[0] for f in schema.split(", ")]
    row = spark.range(1).select(*[(F.lit(str(far)) if c == "ts" else F.lit(None)).cast(t).alias(c) for c, t in (f.split(" ", 1) for f in schema.split(", "))])
    return row.select(*names)
