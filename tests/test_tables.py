"""Order by any key, packs from data alone, tables that appear whole, steps that are found again, JSON in one pass."""

from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from rollweave.functions.judgements import extract_json
from rollweave.operators import mixing, packing
from rollweave.operators.ordering import numbered, ranged, row_index, running_by_key, value_rank
from rollweave.plans import transforms
from rollweave.session import scratch_path
from rollweave.sources import files
from rollweave.sources.publish import names_in, publish, published_table, read_record


# --- order ---------------------------------------------------------------------------------


def test_null_and_text_keys_keep_their_rows(spark):
    rows = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("B", 4), (None, 5)], "k string, n long")
    got = {r.n: r["index"] for r in row_index(rows, ["k", "n"], start=10).collect()}
    assert got == {2: 10, 5: 11, 4: 12, 3: 13, 1: 14}
    totals = {r.n: r.total for r in running_by_key(rows, ["k", "n"], total=F.col("n")).collect()}
    assert totals == {2: 2, 5: 7, 4: 11, 3: 14, 1: 15}
    assert sorted(r["rank"] for r in value_rank(rows, "n", "k").collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("kind", ["string", "date", "binary", "decimal(12,3)", "struct<a:int,b:string>"])
def test_ranges_follow_the_key_of_any_type(spark, kind):
    number = (F.col("id") * 7919) % 1009
    key = {
        "string": F.lpad(number.cast("string"), 5, "0"),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), number.cast("int")),
        "binary": F.lpad(number.cast("string"), 5, "0").cast("binary"),
        "decimal(12,3)": number.cast("decimal(12,3)"),
        "struct<a:int,b:string>": F.struct((number % 3).cast("int").alias("a"), F.lpad(number.cast("string"), 5, "0").alias("b")),
    }[kind]
    rows = spark.range(1000, numPartitions=7).select(key.alias("k"), "id")
    parts = ranged(rows, ["k"], rows=64)
    assert parts.select("__part").distinct().count() > 5
    got = [r.k for r in numbered(parts).orderBy("index").collect()]
    assert got == [r.k for r in rows.orderBy("k").collect()]


def test_one_key_fills_many_ranges(spark):
    rows = spark.range(5000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    parts = ranged(rows, ["k"], rows=200)
    sizes = [r["count"] for r in parts.groupBy("__part").count().collect()]
    assert max(sizes) < 800 and sum(sizes) == 5000
    assert sorted(r["index"] for r in numbered(parts).collect()) == list(range(5000))


# --- packs ---------------------------------------------------------------------------------


def test_packs_do_not_follow_the_session(spark):
    rows = spark.range(400).select(F.concat(F.lit("doc-"), F.col("id")).alias("key"), (F.col("id") * 37 % 50 + 1).alias("n"))
    setting, seen = "spark.sql.shuffle.partitions", set()
    before = spark.conf.get(setting)
    try:
        for partitions in ("4", "16", "64"):
            spark.conf.set(setting, partitions)
            packs = packing.pack_batches(rows, "key", [F.col("n")], 100, 8, 1)
            seen.add(tuple(sorted((r.batch, tuple(r.members)) for r in packs.collect())))
    finally:
        spark.conf.set(setting, before)
    assert len(seen) == 1


def test_packs_take_text_keys(spark):
    """The ids that provenance gives are text."""
    rows = spark.range(30).select(
        F.concat_ws("_", F.lit("set"), "id").alias("id"), F.array(F.lit(1)).alias("query"), F.array_repeat(F.lit(5), (F.col("id") % 4 + 1).cast("int")).alias("response")
    )
    rows = rows.withColumns({"mask": F.transform("response", lambda x: F.lit(1)), "logprobs": F.transform("response", lambda x: F.lit(0.5))})
    packs = packing.pack_sequences(rows, "id", 12, 0).collect()
    assert sorted(i for r in packs for i in r.ids) == sorted(r.id for r in rows.collect())
    assert [i for r in sorted(packs, key=lambda r: r.pack_no) for i in r.ids] == sorted(r.id for r in rows.collect())
    assert all(sum(r.packed_seq_lens) <= 12 for r in packs)


# --- tables that appear whole ----------------------------------------------------------------


def test_a_build_that_died_is_no_obstacle(spark):
    root, rows = scratch_path(spark, "cache"), spark.range(5)

    def dies():
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        mixing.materialise(spark, root, {"a": 1}, dies)
    # A folder that a dead writer left behind.
    rows.write.parquet(f"{root}/{mixing.config_hash({'a': 1})}-left")
    assert mixing.materialise(spark, root, {"a": 1}, lambda: rows).count() == 5
    assert mixing.materialise(spark, root, {"a": 1}, dies).count() == 5
    assert mixing.materialise(spark, root, {"a": 2}, lambda: rows.limit(2)).count() == 2
    assert mixing.materialise(spark, root, {"a": 1}, lambda: rows.limit(1), skip_cache=True).count() == 1


def test_two_writers_of_one_table(spark):
    root = scratch_path(spark, "cache")

    def slow():
        # The other job is done before this one publishes.
        mixing.materialise(spark, root, {"a": 1}, lambda: spark.range(7))
        return spark.range(7)

    assert mixing.materialise(spark, root, {"a": 1}, slow).count() == 7
    assert published_table(spark, root, mixing.config_hash({"a": 1})).count() == 7
    publish(spark, f"{root}/x.json", {"n": 1})
    publish(spark, f"{root}/x.json", {"n": 1})
    assert read_record(spark, f"{root}/x.json") == {"n": 1} and read_record(spark, f"{root}/y.json") is None
    assert not [n for n in names_in(spark, root) if n.endswith(".draft")]


def test_a_changed_step_reruns_itself_and_what_follows(spark):
    runs = []

    def adds(df, tok, key, n):
        runs.append(n)
        return df.withColumn("x", F.col("x") + n)

    transforms.register_transform("adds", adds, "map")
    transforms.register_transform("below", lambda df, tok, most: F.col("x") < most, "filter")
    rows, root = spark.range(6).withColumn("x", F.col("id")), scratch_path(spark, "steps")

    def run(first, second, most, source=None):
        del runs[:]
        out, ran = transforms.run_cached_transforms(rows, ["adds", "adds", "below"], [{"n": first}, {"n": second}, {"most": most}], None, "id", root, source or {"t": 1}, ["id", "x"])
        return sorted(r.x for r in out.collect()), ran, list(runs)

    assert run(1, 10, 15) == ([11, 12, 13, 14], ["adds", "adds", "below"], [1, 10])
    assert run(1, 10, 15) == ([11, 12, 13, 14], [], [])
    assert run(1, 10, 13) == ([11, 12], ["below"], [])
    assert run(1, 20, 23) == ([21, 22], ["adds", "below"], [20])
    assert run(1, 10, 15, {"t": 2}) == ([11, 12, 13, 14], ["adds", "adds", "below"], [1, 10])


def test_an_append_is_there_once(spark, monkeypatch):
    path, schema = scratch_path(spark, "rollouts"), "key string, n long"
    part = lambda a, b: spark.range(a, b).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("key"), F.col("id").alias("n"))
    assert files.append_rollouts(part(0, 25), path, "key", "run", 0, 10) == 25
    assert files.append_rollouts(part(0, 25), path, "key", "run", 0, 10) == 25
    with monkeypatch.context() as broken:
        broken.setattr(files, "publish", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            files.append_rollouts(part(25, 40), path, "key", "run", 1, 10)
    assert files.total_rollouts(spark, path, "run") == 25
    assert files.append_rollouts(part(25, 40), path, "key", "run", 1, 10) == 40
    assert files.append_rollouts(part(0, 3), path, "key", "other", 0, 10) == 3
    back = files.read_rollouts(spark, path, "run", schema).collect()
    assert sorted((r.n, r.shard) for r in back) == [(k, k // 10) for k in range(40)]
    assert files.read_rollouts(spark, path, "none", schema).count() == 0


# --- JSON in one pass ------------------------------------------------------------------------


def by_trying(text):
    """Every opening brace in turn, as it is and with doubled braces made single."""
    end = text.rfind("}") + 1
    start = text.find("{")
    while end and start != -1 and start < end:
        for candidate in (text[start:end], text[start:end].replace("{{", "{").replace("}}", "}")):
            try:
                return json.loads(candidate)
            except json.JSONDecodeError:
                pass
        start = text.find("{", start + 1)
    return None


def test_extracted_json_is_that_of_trying_every_brace(spark):
    draw = random.Random(7)
    parts = ["{", "}", "{{", "}}", '"a"', ":", "1", ",", " ", '"x}"', '"{\\""', "\\", '"', "[", "]", '"b": {"c": 2}', "é\n", '{"k": "v"}', '{{"k": 3}}']
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(3000)]
    texts += ['say "hi {"a": "}"} x', '{"a": "{{", "b": 1}', 'x {{{"a": {"b": 1}}}} y', '{"a":1}{"b":2}', "", "{", "}", '\\{"a": 1}']
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    got = {r.i: r.j for r in rows.select("i", extract_json("t").alias("j")).collect()}
    for i, text in enumerate(texts):
        want = by_trying(text)
        assert (None if got[i] is None else json.loads(got[i])) == want, text


def test_many_braces_take_little_time(spark):
    rows = spark.createDataFrame([("{ " * 100_000 + '{"a": 1}',)], "t string")
    rows.select(extract_json("t")).collect()
    start = time.time()
    assert json.loads(rows.select(extract_json("t").alias("j")).first().j) == {"a": 1}
    assert time.time() - start < 5
