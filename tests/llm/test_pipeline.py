"""Each pipeline stage on its own input, and the whole run against its parts."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from rollweave.llm import queries
from tests.llm.cases import SCHEMA, awkward, sentence, with_clashes
from tests.llm.test_operators import reached, shingles

ROOT = "/root/testdata/sf0.001"


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_awkward_tables(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (awkward(spark), with_clashes(awkward(spark)), spark.createDataFrame([], SCHEMA)):
        out = stage(spark, docs, ROOT)
        if k < 4:
            assert out.columns == docs.columns
        out.collect()


def test_quality_stage_keeps_what_the_rules_keep(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{ROOT}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.SQL['op10_quality_rules']}) WHERE kept").fetchall()}
    out = corpus_pipeline.quality(spark, queries.documents(spark, ROOT), ROOT).collect()
    assert {r.doc_id for r in out} == kept
    assert all(r.n_chars == len(r.text) for r in out)


def test_one_document_of_each_group_stays(spark):
    docs = queries.documents(spark, ROOT)
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    least = reached(pairs, sets)
    out = corpus_pipeline.near_duplicates(spark, docs, ROOT).collect()
    assert sorted(r.doc_id for r in out) == sorted(d for d in sets if least[d] == d)


def test_planted_passages_go_and_clean_documents_stay(spark, tmp_path):
    spark.createDataFrame([(1, sentence(40, 24))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(k, sentence(700 + k, 60) + (" " + sentence(40, 24) if k < 5 else ""), "en", "a", 0) for k in range(30)], SCHEMA)
    out = corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == list(range(5, 30))


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, ROOT)
    docs = queries.documents(spark, ROOT)
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, ROOT)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    want = corpus_pipeline.packed(spark, docs, ROOT)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in docs.collect()}
