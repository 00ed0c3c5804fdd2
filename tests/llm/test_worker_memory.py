"""What a Python worker keeps between the tasks of the pipeline's steps."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrame, GroupedData

import corpus_pipeline
from rollweave.llm import fasttokens, kernel
from rollweave.session import ARROW_BYTES
from tests.llm.cases import awkward

ROOT = "/root/testdata/sf0.001"


def resident() -> float:
    with open("/proc/self/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) / 1024


@pytest.mark.skipif(kernel._trim is None, reason="another C library")
@pytest.mark.parametrize("grouped", [False, True])
def test_freed_memory_goes_back(grouped):
    pins = []

    def churn(batches):
        held = [bytes(100_000) for _ in range(2000)]
        pins.append(bytes(1000))  # above what is freed, so the heap cannot shrink by itself
        return [len(held)]

    kernel.give_back()
    before = resident()
    assert list((kernel.lean_group if grouped else kernel.lean)(churn)(None)) == [2000]
    assert resident() - before < 60


def test_other_steps_drop_remembered_pieces():
    kept = dict(fasttokens._encoders)
    try:
        fasttokens._encoders["made up", True] = None
        assert list(kernel.lean(iter, forget=False)([1, 2])) == [1, 2]
        assert ("made up", True) in fasttokens._encoders
        assert list(kernel.lean(iter)([1, 2])) == [1, 2]
        assert not fasttokens._encoders
    finally:
        fasttokens._encoders.update(kept)


def test_tasks_that_fail_or_end_early_give_back(monkeypatch):
    calls = []
    monkeypatch.setattr(kernel, "give_back", lambda forget=True: calls.append(forget))
    with pytest.raises(ZeroDivisionError):
        list(kernel.lean(lambda batches: (1 // x for x in batches))([1, 0]))
    early = kernel.lean(iter)([1, 2])
    next(early)
    early.close()
    assert calls == [True, True]


@pytest.mark.parametrize("k", range(4))
def test_every_step_in_python_gives_back(spark, k, monkeypatch):
    used = []
    for kind, name in ((type(spark.range(0)), "mapInArrow"), (GroupedData, "applyInArrow")):
        for owner in {kind, *(c for c in kind.__subclasses__())}:
            own = getattr(owner, name)
            monkeypatch.setattr(owner, name, lambda self, func, *a, own=own, **b: used.append(func) or own(self, func, *a, **b))
    out = corpus_pipeline.STAGES[k][1](spark, awkward(spark), ROOT)
    assert isinstance(out, DataFrame)
    out.collect()
    assert used and all(f.__code__ in (kernel.lean(len).__code__, kernel.lean_group(len).__code__) for f in used)


@pytest.mark.parametrize("k", range(5))
def test_batches_are_bounded_in_each_stage(spark, k):
    key, size = ARROW_BYTES
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        corpus_pipeline.STAGES[k][1](spark, awkward(spark), ROOT)
        assert spark.conf.get(key) == size
        spark.conf.set(key, "1000000")
        corpus_pipeline.STAGES[k][1](spark, awkward(spark), ROOT).collect()
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.set(key, before)
