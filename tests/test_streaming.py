"""Streaming jobs: order of arrival, state that ends, late rows, steps that are published whole, totals at each drop."""

from __future__ import annotations

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rollweave.plans import registry, streaming_queries
from rollweave.session import scratch_path
from rollweave.streaming import jobs, throughput
from rollweave.streaming.groups import ROCKSDB, GroupCollector, PartCollector, collect_outcomes, end_of_input, group_outcomes, groups, late_rows, streaming_session
from rollweave.streaming.training import TrainingSteps, manifests, next_step, published

SCHEMA = "prompt_id long, sample int, reward double, ts timestamp"
START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def own(spark):
    return streaming_session(spark, 2)


def at(second: float) -> datetime.datetime:
    return START + datetime.timedelta(seconds=second)


def play(own, drops, n=2, delay="10 seconds", wait=None, handle=None, schema=SCHEMA, payload=(), root=None):
    """Feed the drops one after the other; returns the folder of the job."""
    root = root or scratch_path(own, "play")
    for drop in drops:
        (own.createDataFrame(drop, schema) if isinstance(drop, list) else drop).write.mode("append").parquet(f"{root}/in")
        stream = jobs.read_stream(own, f"{root}/in", schema)
        jobs.run(group_outcomes(stream, n, delay, wait, payload), f"{root}/checkpoint", handle or collect_outcomes(f"{root}/out"))
    return root


def found(own, root):
    return sorted(tuple(r) for r in groups(own, f"{root}/out").select("prompt_id", "sample", "reward", "outcome").collect())


def test_order_of_arrival_does_not_matter(own):
    rows = [(p, s, float(10 * p + s), at(p + s)) for p in range(4) for s in range(2)]
    one = play(own, [rows])
    other = play(own, [rows[::-3], [r for r in rows if r not in rows[::-3]][::-1], rows[:2]])
    assert found(own, one) == found(own, other) == sorted((p, s, r, "complete") for p, s, r, _ in rows)


def test_finished_prompts_leave_the_state(own):
    assert own.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    root = play(own, [[(1, 0, 0.0, at(0)), (1, 1, 1.0, at(1)), (2, 0, 0.0, at(2))], [(3, 0, 0.0, at(100))], [(3, 1, 1.0, at(101))]])
    for name in ("samples", "clock"):
        state = own.read.format("statestore").option("path", f"{root}/checkpoint").option("stateVarName", name).load()
        # Prompt 2 is open, prompt 3 has just finished: its mark lasts until the watermark has passed it.
        assert {r.key.prompt_id for r in state.collect()} == ({2} if name == "samples" else {2, 3})
    play(own, [[(None, None, None, at(500))]], root=root)
    state = own.read.format("statestore").option("path", f"{root}/checkpoint").option("stateVarName", "clock").load()
    assert {r.key.prompt_id for r in state.collect()} == {2}


def test_late_rows_repeats_and_the_end_of_input(own):
    drops = [
        [(1, 0, 0.0, at(0)), (1, 0, 5.0, at(0)), (2, 0, 0.0, at(1))],
        [(9, 0, 0.0, at(60)), (9, 1, 1.0, at(60))],
        # The watermark is at 50: two rows are late, the third repeats a sample of a finished prompt.
        [(1, 1, 1.0, at(3)), (2, 1, 1.0, at(4)), (9, 1, 7.0, at(60)), (8, 0, 2.0, at(61))],
    ]
    root = play(own, [*drops, end_of_input(own, SCHEMA, str(at(61)), "10 seconds", "20 seconds")], wait="20 seconds")
    assert found(own, root) == [(1, 0, 0.0, "incomplete"), (2, 0, 0.0, "incomplete"), (8, 0, 2.0, "incomplete"), (9, 0, 0.0, "complete"), (9, 1, 1.0, "complete")]
    assert sorted((r.prompt_id, r.sample) for r in late_rows(own, f"{root}/out").collect()) == [(1, 1), (2, 1)]


class Calls:
    """State of one prompt that writes down each call, as each is a message to the JVM."""

    def __init__(self, log, name):
        self.log, self.name, self.value = log, name, None

    def __getattr__(self, call):
        def done(*value):
            self.log.append(f"{self.name}.{call}")
            if call in ("update", "clear"):
                self.value = value[0] if value else None
            return self.value

        return done


def test_a_prompt_takes_few_calls_of_the_state():
    log = []
    handle = Calls(log, "timer")
    handle.getValueState = handle.getMapState = lambda name, *_: Calls(log, name)
    collector = GroupCollector(3, None)
    collector.init(handle)
    before = type("Times", (), {"getCurrentWatermarkInMs": lambda self: 10})()

    def seen(*rows):
        log.clear()
        rows = [Row(prompt_id=1, sample=s, reward=r, payload=None, ts_ms=at) for s, r, at in rows]
        return [(r.sample, r.reward, r.outcome) for r in collector.handleInputRows((1,), iter(rows), before)], list(log)

    assert seen((2, 2.0, 12), (0, float("nan"), 11), (9, 9.0, 9)) == ([(9, 9.0, "late")], ["clock.get", "samples.update", "clock.update"])
    # A repeat that is no newer changes nothing, and an older state keeps its own sample.
    assert seen((2, 7.0, 11)) == ([], ["clock.get", "samples.get"])
    assert seen((1, 1.0, 30), (2, 7.0, 40)) == (
        [(0, None, "complete"), (1, 1.0, "complete"), (2, 2.0, "complete")],
        ["clock.get", "samples.get", "samples.clear", "timer.registerTimer", "clock.update"],
    )
    assert seen((1, 5.0, 20)) == ([], ["clock.get"])


def test_parts_give_the_rows_of_single_prompts(own):
    far = 1 << 60
    drops = [
        [(far + 1, 0, 0.0, at(0)), (far + 1, 0, 0.0, at(0)), (2, 0, float("nan"), at(1)), (None, None, None, at(2)), (5, 1, 1.0, None), (6, 0, 0.0, at(0)), (6, 0, 0.0, at(100))],
        [(9, 0, 0.0, at(60)), (9, 1, 1.0, at(60)), (9, 2, 2.0, at(59)), (far, 0, 2.0, at(58))],
        [(far + 1, 1, 1.0, at(3)), (2, 1, 1.0, at(4)), (9, 1, 7.0, at(95)), (8, 0, 2.0, at(91)), (far, 1, 3.0, at(91)), (5, 0, None, at(91)), (6, 1, 1.0, at(92))],
        [(9, 0, 3.0, at(106)), (8, 0, 9.0, at(200)), (None, 1, 1.0, at(200)), (7, 0, 1.0, at(2))],
    ]
    seen = []
    for parts in (None, 3):
        root = scratch_path(own, "parts")
        for drop in [*drops, end_of_input(own, SCHEMA, str(at(200)), "10 seconds", "20 seconds")]:
            (own.createDataFrame(drop, SCHEMA) if isinstance(drop, list) else drop).write.mode("append").parquet(f"{root}/in")
            stream = group_outcomes(jobs.read_stream(own, f"{root}/in", SCHEMA), 2, "10 seconds", "20 seconds", ("sample",), parts)
            jobs.run(stream, f"{root}/checkpoint", collect_outcomes(f"{root}/out"))
        rows = groups(own, f"{root}/out").unionByName(late_rows(own, f"{root}/out").withColumn("group_no", F.lit(0).cast("long")))
        seen.append(sorted(str(tuple(r)) for r in rows.collect()))
        if parts:
            for name in ("open", "marks"):
                # The end of the input has freed all of it.
                assert own.read.format("statestore").option("path", f"{root}/checkpoint").option("stateVarName", name).load().isEmpty()
    assert seen[0] == seen[1]
    assert all(any(kind in r for r in seen[0]) for kind in ("complete", "incomplete", "late"))


def test_a_part_takes_the_same_calls_however_many_prompts():
    log = []
    handle = Calls(log, "timer")
    handle.getValueState = lambda name, *_: Calls(log, name)
    collector = PartCollector(2, None)
    collector.init(handle)
    before = type("Times", (), {"getCurrentWatermarkInMs": lambda self: 10})()

    def seen(sample, prompts):
        log.clear()
        frames = [pd.DataFrame({"prompt_id": p, "sample": sample, "reward": 1.0, "payload": None, "ts_ms": 20}) for p in np.array_split(np.arange(prompts), 3)]
        return sum(len(f) for f in collector.handleInputRows((0,), iter(frames), before)), list(log)

    assert seen(0, 500) == (0, ["marks.get", "open.get", "due.get", "open.update", "marks.clear"])
    assert seen(1, 400) == (800, ["marks.get", "open.get", "due.get", "open.update", "marks.update", "timer.registerTimer", "due.update"])
    assert seen(0, 400)[0] == 0
    with pytest.raises(ValueError, match="no sample"):
        seen(None, 3)


def test_drops_use_all_cores(spark):
    handle = lambda _: lambda batch, batch_id: seen.add(int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows, seen = spark.createDataFrame([(1, 0), (2, 1)], "id long, drop_no int"), set()
    streaming_queries._feed(registry.Tables(spark, "none"), "cores", handle, lambda s: s.where(F.col("id") > 0), "id long, drop_no int", rows=rows)
    assert seen == {spark.sparkContext.defaultParallelism}


STEP_SCHEMA = "prompt_id long, sample int, reward double, query array<int>, response array<int>, mask array<int>, logprobs array<double>, finish_reason string, ts timestamp"
PAYLOAD = ("query", "response", "mask", "logprobs", "finish_reason")


def samples(prompts):
    return [(p, s, float((p * s) % 3), [1, 2], [5] * (1 + (p + s) % 4), [1] * (1 + (p + s) % 4), [0.5] * (1 + (p + s) % 4), "stop", at(p)) for p in prompts for s in range(3)]


def tables(own, table):
    order = {"rows": ["position", "sample"], "packs": ["step", "pack_no"], "metrics": ["step"]}
    return {name: [str(r) for r in published(own, table, name).orderBy(*order[name]).collect()] for name in order}


def test_steps_are_published_whole_or_not_at_all(own):
    drops = [samples(range(3)), samples(range(3, 9)), samples(range(9, 12))]
    settings = dict(size=4, samples=3, max_score=2.0, pack_length=12, mode="centered")
    root = scratch_path(own, "steps")
    play(own, drops, n=3, delay="1000 days", handle=TrainingSteps(f"{root}/out", **settings), schema=STEP_SCHEMA, payload=PAYLOAD, root=root)
    want = tables(own, f"{root}/out")
    assert next_step(own, f"{root}/out") == 3 and len(want["metrics"]) == 3
    for broken in ("packs", "metrics", "manifest"):
        root, seen = scratch_path(own, "steps"), []

        class Dying(TrainingSteps):
            def write(self, name, df, batch_id):
                self.die(name)
                super().write(name, df, batch_id)

            def commit(self, manifest, batch_id):
                if manifest.first().next_step > 0:
                    self.die("manifest")
                super().commit(manifest, batch_id)

            def die(self, name):
                if name == broken and not seen:
                    seen.append(name)
                    raise RuntimeError("the job is killed")

        handle = Dying(f"{root}/out", **settings)
        play(own, drops[:1], n=3, delay="1000 days", handle=handle, schema=STEP_SCHEMA, payload=PAYLOAD, root=root)
        with pytest.raises(Exception, match="the job is killed"):
            play(own, drops[1:2], n=3, delay="1000 days", handle=handle, schema=STEP_SCHEMA, payload=PAYLOAD, root=root)
        # What was written before the job died is not shown.
        assert tables_empty(own, f"{root}/out")
        jobs.run(group_outcomes(jobs.read_stream(own, f"{root}/in", STEP_SCHEMA), 3, "1000 days", None, PAYLOAD), f"{root}/checkpoint", handle)
        play(own, drops[2:], n=3, delay="1000 days", handle=handle, schema=STEP_SCHEMA, payload=PAYLOAD, root=root)
        assert seen == [broken] and tables(own, f"{root}/out") == want


def tables_empty(own, table):
    return next_step(own, table) == 0 and all(published(own, table, name).isEmpty() for name in ("rows", "packs", "metrics"))


def test_open_steps_keep_the_batches_they_need(own):
    root = scratch_path(own, "steps")
    handle = TrainingSteps(f"{root}/out", size=5, samples=3, max_score=2.0, pack_length=12)
    play(own, [samples(range(2 * k, 2 * k + 2)) for k in range(4)], n=3, delay="1000 days", handle=handle, schema=STEP_SCHEMA, payload=PAYLOAD, root=root)
    told = sorted((r.batch_id, r.places, r.next_step, r.oldest) for r in manifests(own, f"{root}/out").collect())
    assert [x[1:3] for x in told if x[1] in (2, 4, 6, 8)][-1] == (8, 1)
    positions = [r.position for r in published(own, f"{root}/out", "rows").select("position").distinct().collect()]
    assert max(positions) < 5


def test_recent_totals_at_each_drop(own):
    schema = "id long, ts timestamp, prompt_tokens long, response_tokens long, step_time double, batch_time double"
    rows = [(k, at((k * 37) % 50), k, 2 * k, k / 4, k / 8) for k in range(60)]
    root, seen = scratch_path(own, "recent"), []
    empty = throughput.recent_totals(own, f"{root}/out", 7).first()
    assert (empty.records, empty.prompt_tokens_per_second, empty.sample_count) == (0, 0.0, 0)
    for drop in (rows[40:], rows[:1], rows[1:40]):
        seen += drop
        own.createDataFrame(drop, schema).write.mode("append").parquet(f"{root}/in")
        stream = throughput.stream_recent(jobs.read_stream(own, f"{root}/in", schema), 7, parts=3)
        jobs.run(stream, f"{root}/checkpoint", throughput.collect_snapshots(f"{root}/out"), "update")
        want = throughput.batch_recent_totals(own.createDataFrame(seen, schema), 7).first()
        assert throughput.recent_totals(own, f"{root}/out", 7).first() == want
    assert throughput.batch_recent_totals(own.createDataFrame(rows[:1], schema), 7).first().sample_count == 1
