"""Null and repeated doc_ids: what op5, op7, op9 and the pipeline's stages keep, against brute force."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from rollweave.llm import jaccard, linededup, quality, tiling
from tests.llm.cases import SCHEMA, changed, sentence

PASSAGE = sentence(40, 24)
BASE, LINE = sentence(1, 60), sentence(2, 14)
TEXTS = [
    (1, BASE),
    (1, BASE),
    (1, sentence(20, 30)),
    (2, changed(BASE, 30)),
    (None, BASE),
    (None, BASE),
    (None, sentence(21, 30) + "\n" + LINE),
    (None, sentence(22, 30) + "\n" + sentence(23, 12)),
    (None, sentence(24, 30) + "\n" + LINE),
    (7, sentence(25, 30) + " " + PASSAGE),
    (7, sentence(26, 30)),
    (None, sentence(27, 30) + " " + PASSAGE),
    (None, sentence(28, 30)),
    (None, ""),
    (None, None),
    (3, None),
    (3, " \n"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(d, t, "en", "a", None if t is None else len(t)) for d, t in TEXTS], SCHEMA)


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_one_of_each_component_stays(spark, rows):
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if (w := (t or "").lower().split()) else frozenset() for _, t in TEXTS]
    link = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    group = list(range(len(TEXTS)))
    for _ in TEXTS:
        group = [min(group[j] for j in range(len(TEXTS)) if j == i or link(sets[i], sets[j])) for i in range(len(TEXTS))]
    want = Counter()
    for g in set(group):
        own = [i for i in range(len(TEXTS)) if group[i] == g]
        if not sets[own[0]]:
            want.update(TEXTS[i] for i in own)
        else:
            want[min((TEXTS[i] for i in own), key=lambda r: (r[0] is None, r[0] or 0))] += 1
    out = corpus_pipeline.near_duplicates(spark, rows, "")
    assert out.columns == rows.columns and kept(out) == want
    assert {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(rows).collect() if r.n_shingles == 56} == {(1, 1), (2, 1), (None, 1)}


def test_rows_are_judged_by_their_own_text(spark, rows, tmp_path):
    items = [(1, PASSAGE), (2, "the river"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.decontaminated(spark, rows, str(tmp_path))
    assert kept(out) == Counter(r for r in TEXTS if PASSAGE not in (r[1] or ""))
    benchmark = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    found = tiling.contaminated_documents(rows, benchmark)
    hashes = {r.text: r.h for r in rows.selectExpr("text", "xxhash64(text) as h").collect()}
    assert Counter((r.doc_id, r.text_hash, r.item_id) for r in found.collect()) == Counter((d, hashes[t], 1) for d, t in TEXTS if PASSAGE in (t or ""))
    assert [(r.item_id, r.n_words) for r in tiling.short_items(benchmark).collect()] == [(2, 2)]
    # Every text with these words goes if so short an item may give a verdict.
    own = spark.createDataFrame([(1, "by the river stone")], "doc_id long, text string")
    assert tiling.contaminated_documents(own, benchmark, min_words=1).count() == 1


def test_lines_of_rows_without_an_id_are_their_own(spark, rows):
    """By doc_id, then by the text's hash; an equal earlier line goes, and equal rows are one document."""
    hashes = {r.text: r.h for r in rows.selectExpr("text", "xxhash64(text) as h").collect()}
    order = sorted({(2**63 - 1 if d is None else d, hashes[t], t) for d, t in TEXTS if t is not None})
    words, drop = [], set()
    for doc, _, text in order:
        for k, line in enumerate(text.split("\n")):
            own = line.lower().split()
            if len(own) < 5:
                continue
            if any(own == w or min(len(own), len(w)) >= 10 and linededup.within_one(w, own) for w in words):
                drop.add((doc, text, k))
            words.append(own)
    want = Counter()
    for d, t in TEXTS:
        doc = 2**63 - 1 if d is None else d
        want[d, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (doc, t, k) not in drop)] += 1
    assert kept(linededup.line_dedup(rows)) == want
    out = corpus_pipeline.lines(spark, rows, "")
    left = lambda d, t: "".join(x for k, x in enumerate(t.split("\n")) if (2**63 - 1 if d is None else d, t, k) not in drop)
    assert sum(kept(out).values()) == len(TEXTS) - sum(1 for d, t in TEXTS if t and t.strip() and not left(d, t).strip())


def test_quality_rows_are_judged_alike(spark, rows):
    out = corpus_pipeline.quality(spark, rows, "")
    assert kept(out) == Counter(r for r in TEXTS if len((r[1] or "").split()) >= 20)


def test_a_line_in_one_per_cent_of_a_hot_host_is_boilerplate(spark):
    line = "subscribe to our newsletter now and never miss a story"
    texts = [(k, sentence(3000 + k, 25) + ("\n" + line if k % 100 == 0 else ""), "en", "hot", 0) for k in range(3000)]
    got = quality.quality_rules(spark.createDataFrame(texts, SCHEMA)).collect()
    assert {r.doc_id for r in got if r.lost_words} == set(range(0, 3000, 100)) and all(r.kept for r in got)
    assert {r.lost_words for r in got if r.doc_id % 100 == 0} == {len(line.split())}
    few = spark.createDataFrame(texts[:1900], SCHEMA)
    assert not [r for r in quality.quality_rules(few).collect() if r.lost_words]
