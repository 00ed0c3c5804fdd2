"""K3: running totals and the last ``n`` records, kept as partial states that add up.

Records are dealt over ``parts`` keys. Each part keeps its totals and its own last ``n`` records, ordered by
(time, id); the last ``n`` of the whole are among them. Nothing depends on the order of arrival, and no task
sees all records.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rollweave.streaming.jobs import read_batches, write_batch

RECORD = ["ts_us", "id", "prompt_tokens", "response_tokens", "step_time", "batch_time"]
RECORD_SCHEMA = "ts_us long, id long, prompt_tokens long, response_tokens long, step_time double, batch_time double"
TOTALS = ["total_prompt_tokens", "total_response_tokens", "records"]
SNAPSHOT = f"part int, total_prompt_tokens long, total_response_tokens long, records long, recent array<struct<{RECORD_SCHEMA.replace(' long', ':long').replace(' double', ':double')}>>"


class RecentRecords(StatefulProcessor):
    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", RECORD_SCHEMA)
        self.totals = handle.getValueState("totals", "prompt long, response long, records long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = pd.concat(list(rows))
        prompt, response, records = self.totals.get() if self.totals.exists() else (0, 0, 0)
        held = pd.DataFrame([tuple(r) for r in self.ring.get()], columns=RECORD)
        recent = pd.concat([held, frames[RECORD]]) if len(held) else frames[RECORD]
        recent = recent.sort_values(["ts_us", "id"]).tail(self.n)
        kept = [(int(a), int(b), int(c), int(d), float(e), float(f)) for a, b, c, d, e, f in recent.itertuples(index=False)]
        self.ring.put(kept)
        told = (prompt + int(frames["prompt_tokens"].sum()), response + int(frames["response_tokens"].sum()), records + len(frames))
        self.totals.update(told)
        yield pd.DataFrame({"part": [key[0]], **{c: [v] for c, v in zip(TOTALS, told)}, "recent": [[dict(zip(RECORD, r)) for r in kept]]})

    def close(self) -> None:
        pass


def stream_recent(events: DataFrame, n: int, parts: int = 8) -> DataFrame:
    """A snapshot of each part that got records; input columns: ts, id and the four measures."""
    timed = events.select(
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.unix_micros("ts").alias("ts_us"), *RECORD[1:]
    )
    return timed.groupBy("part").transformWithStateInPandas(RecentRecords(n), SNAPSHOT, "update", "none")


def collect_snapshots(table: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: write_batch(batch, table, batch_id)


def recent_totals(spark: SparkSession, table: str, n: int, upto: int | None = None) -> DataFrame:
    """One row: totals since the start, and rates and mean times over the last ``n`` records; 0 on no records.

    ``upto`` gives the state after that batch.
    """
    told = read_batches(spark, table, SNAPSHOT, None if upto is None else upto + 1)
    latest = told.groupBy("part").agg(F.max_by(F.struct(*TOTALS, "recent"), "batch_id").alias("x")).select("x.*")
    return latest.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS],
        # At most parts * n records, both parameters.
        F.flatten(F.collect_list("recent")).alias("recent"),
    ).select(*TOTALS, *_rates(F.slice(F.reverse(F.array_sort("recent")), 1, n)))


def batch_recent_totals(events: DataFrame, n: int) -> DataFrame:
    """The same over a table that is all there."""
    records = events.select(F.unix_micros("ts").alias("ts_us"), *RECORD[1:])
    totals = records.agg(
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias(TOTALS[0]), F.coalesce(F.sum("response_tokens"), F.lit(0)).alias(TOTALS[1]), F.count("*").alias(TOTALS[2])
    )
    last = records.orderBy(F.desc("ts_us"), F.desc("id")).limit(n).agg(F.collect_list(F.struct(*RECORD)).alias("recent"))
    return totals.crossJoin(F.broadcast(last)).select(*TOTALS, *_rates(F.reverse(F.array_sort("recent"))))


def _rates(recent) -> list:
    """Newest first. The span is from the oldest record to the newest; a single record counts as one second."""
    total = lambda name: F.aggregate(recent, F.lit(0).cast("double"), lambda s, r: s + r[name])
    size = F.size(recent)
    span = (F.get(recent, F.lit(0))["ts_us"] - F.get(recent, size - 1)["ts_us"]) / 1e6
    span = F.when(size == 1, F.lit(1.0)).otherwise(span)
    rate = lambda name: F.coalesce(F.when(span > 0, total(name) / span), F.lit(0.0))
    mean = lambda name: F.when(size > 0, total(name) / size).otherwise(0.0)
    return [
        rate("prompt_tokens").alias("prompt_tokens_per_second"),
        rate("response_tokens").alias("response_tokens_per_second"),
        mean("step_time").alias("avg_step_time"),
        mean("batch_time").alias("avg_batch_time"),
        size.cast("long").alias("sample_count"),
    ]
