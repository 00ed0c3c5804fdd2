"""C: mixing, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import mixing as x
from rollweave.operators.messages import align_columns
from rollweave.operators.ordering import hash_rank, md5_key
from rollweave.plans.inputs import messages, preference_pairs
from rollweave.plans.registry import check
from rollweave.plans.sqltext import MSGS, PAIRS

AMOUNTS = {"src0": 7, "src1": 0.5, "src2": 2.3, "src3": 100000, "src4": 1.0, "src5": 1}


def _ranked(extra: str = "") -> str:
    return f"""r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(concat(42, ':', doc_id)), doc_id) AS rk,
      count(*) OVER (PARTITION BY source) AS n FROM documents {extra})"""


@check(
    "mixer_warnings",
    "C1",
    "SELECT source, 20 * count(*) AS n FROM documents GROUP BY source HAVING source IN ('src0', 'src2') AND 20 * count(*) > 100",
)
def mixer_warnings(t):
    """Source sizes counted twenty-fold, so that the warning size is passed at every scale."""
    amounts = x.parse_mixer(["src0", "7", "src1", "0.5", "src2", "10", "src3", "11"])
    sizes = t.documents.groupBy("source").agg((20 * F.count("*")).alias("n"))
    return x.suspicious_counts(sizes, amounts)


@check(
    "resized_sources",
    "C2",
    f"""WITH {_ranked()}, a AS (SELECT *, CASE source WHEN 'src0' THEN 7 WHEN 'src1' THEN CAST(floor(0.5 * n) AS BIGINT) WHEN 'src2' THEN CAST(floor(2.3::DOUBLE * n) AS BIGINT)
      WHEN 'src3' THEN 3 * n + 2 WHEN 'src4' THEN n WHEN 'src5' THEN 1 END AS target FROM r),
    c AS (SELECT *, target // n + CASE WHEN rk <= target % n THEN 1 ELSE 0 END AS copies FROM a WHERE target IS NOT NULL)
    SELECT doc_id, source, CAST(u.i AS INTEGER) AS copy, target > n AS is_upsampled FROM c, LATERAL (SELECT unnest(range(1, copies + 1)) AS i) u""",
)
def resized_sources(t):
    docs = t.documents.select("doc_id", "source")
    n = docs.where("source = 'src3'").count()
    amounts = {**AMOUNTS, "src3": 3 * n + 2}
    return x.resize(docs, amounts, "doc_id").select("doc_id", "source", F.col("copy").cast("int").alias("copy"), "is_upsampled")


SPLIT_SQL = "CASE WHEN substr(md5(concat('split', ':', doc_id)), 1, 1) < 'c' THEN 'train' ELSE 'test' END"


@check(
    "mixed_fractions",
    "C3",
    f"""WITH d AS (SELECT doc_id, source, {SPLIT_SQL} AS split FROM documents WHERE source IN ('src0', 'src1', 'src2')),
    r AS (SELECT *, row_number() OVER (PARTITION BY source, split ORDER BY md5(concat(42, ':', doc_id)), doc_id) AS rk, count(*) OVER (PARTITION BY source, split) AS n FROM d)
    SELECT doc_id, source, split FROM r WHERE split = 'test' OR rk <= floor(CASE source WHEN 'src0' THEN 0.5 WHEN 'src1' THEN 0.3 ELSE 0.2 END::DOUBLE * n)""",
)
def mixed_fractions(t):
    split = F.when(F.substring(md5_key("split", "doc_id"), 1, 1) < "c", F.lit("train")).otherwise(F.lit("test"))
    docs = t.documents.select("doc_id", "source", split.alias("split"))
    return x.mix(docs, {"src0": 0.5, "src1": 0.3, "src2": 0.2}, "doc_id", split="split")


@check(
    "mixed_counts",
    "C3",
    f"""WITH {_ranked()} SELECT doc_id, source FROM r WHERE rk <= CASE source WHEN 'src0' THEN 3 WHEN 'src1' THEN 1 WHEN 'src2' THEN 5 END""",
)
def mixed_counts(t):
    return x.mix(t.documents.select("doc_id", "source"), {"src0": 3, "src1": 1, "src2": 5}, "doc_id")


@check(
    "combined_roles",
    "C4",
    """WITH k AS (SELECT conv_id * 100 + turn AS id, role, text FROM conversations),
    r AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY md5(concat(42, ':', id)), id) AS rk, count(*) OVER (PARTITION BY role) AS n FROM k)
    SELECT id, role FROM r WHERE rk <= CASE role WHEN 'user' THEN 9 WHEN 'assistant' THEN floor(0.4::DOUBLE * n) ELSE n END""",
)
def combined_roles(t):
    turns = t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "role")
    return x.combine(turns, {"user": 9, "assistant": 0.4, "system": 1}, "id", source="role")


@check(
    "bag_union",
    "C5",
    "SELECT doc_id, text, 0 AS part FROM documents UNION ALL SELECT item_id, text, 1 FROM benchmark UNION ALL SELECT doc_id, text, 2 FROM documents WHERE lang = 'en'",
)
def bag_union(t):
    docs = t.documents.withColumn("part", F.lit(0))
    bench = t.benchmark.withColumnRenamed("item_id", "doc_id").withColumn("part", F.lit(1))
    return x.concat(docs, bench, t.documents.where("lang = 'en'").withColumn("part", F.lit(2)))


@check(
    "shuffled_positions",
    "C6",
    "SELECT doc_id, row_number() OVER (ORDER BY md5(concat(42, ':', doc_id)), doc_id) AS rank FROM documents",
)
def shuffled_positions(t):
    return hash_rank(t.documents.select("doc_id"), "doc_id", 42)


@check(
    "shuffled_table",
    "C6",
    "SELECT doc_id, md5(concat(7, ':', doc_id)) AS digest FROM documents",
)
def shuffled_table(t):
    return x.shuffle(t.documents.select("doc_id", md5_key(7, "doc_id").alias("digest")), "doc_id", 7)


@check(
    "row_slices",
    "C7",
    """WITH i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index, row_number() OVER (ORDER BY md5(concat(42, ':', doc_id)), doc_id) AS rk FROM documents)
    SELECT doc_id, 'head' AS kind FROM i WHERE index < 25 UNION ALL SELECT doc_id, 'slice' FROM i WHERE index >= 40 AND index < 90
    UNION ALL SELECT doc_id, 'preview' FROM i WHERE rk <= 3""",
)
def row_slices(t):
    docs = t.documents.select("doc_id")
    kind = lambda df, k: df.select("doc_id", F.lit(k).alias("kind"))
    head = kind(x.limit_rows(docs, "doc_id", 25), "head")
    return head.unionByName(kind(x.slice_rows(docs, "doc_id", 40, 90), "slice")).unionByName(kind(x.preview(docs, "doc_id"), "preview"))


@check(
    "named_sources",
    "C8",
    "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3', 'src5', 'src7', 'src9')",
)
def named_sources(t):
    return x.filter_sources(t.documents.select("doc_id", "source"), [f"src{i}" for i in range(1, 10, 2)])


@check(
    "epoch_permutation",
    "C9",
    """SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat(44, ':', o_orderkey)), o_orderkey) - 1 AS position, '2_' || o_orderkey AS prompt_id
    FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def epoch_permutation(t):
    orders = t.orders.select("o_orderkey")
    return x.epoch_order(orders, "o_orderkey", 42, 2, t.orders.where("o_orderstatus = 'F'"))


@check(
    "worker_batches",
    "C10",
    """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat(42, ':', o_orderkey)), o_orderkey) - 1 AS position, (SELECT count(*) FROM orders) AS n FROM orders),
    q AS (SELECT o_orderkey, position, false AS is_padding, 'drop' AS mode FROM p WHERE position < n - n % 64
      UNION ALL SELECT o_orderkey, position, false, 'pad' FROM p UNION ALL SELECT o_orderkey, position + n, true, 'pad' FROM p WHERE position < (64 - n % 64) % 64)
    SELECT o_orderkey, position, is_padding, mode, position // 64 AS batch, CAST(position % 64 % 8 AS INTEGER) AS worker, CAST(position % 64 // 8 AS INTEGER) AS slot FROM q""",
)
def worker_batches(t):
    order = hash_rank(t.orders.select("o_orderkey"), "o_orderkey", 42, out="position").withColumn("position", F.col("position") - 1)
    drop = x.shard_batches(order, "position", 64, 8).withColumn("mode", F.lit("drop"))
    return drop.unionByName(x.shard_batches(order, "position", 64, 8, drop_last=False).withColumn("mode", F.lit("pad")))


@check(
    "mixing_statistics",
    "C11",
    """WITH s AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE n_chars < 1000) AS kept FROM documents WHERE source IN ('src0', 'src1') GROUP BY source),
    r AS (SELECT source AS dataset_source, n AS original_size, CASE source WHEN 'src0' THEN 2 ELSE 1 END AS f, n, kept FROM s)
    SELECT dataset_source, f::DOUBLE AS requested, original_size, f * n AS initial_instances, f * kept AS final_instances, f * (n - kept) AS instances_filtered,
      f > 1 AS is_upsampled, f::DOUBLE AS upsampling_factor FROM r""",
)
def mixing_statistics(t):
    docs = t.documents.select("doc_id", "n_chars", F.col("source").alias("dataset_source"))
    sized = x.resize(docs, {"src0": 2.0, "src1": 1.0}, "doc_id", source="dataset_source").drop("is_upsampled", "copy")
    requested = docs.where("dataset_source in ('src0', 'src1')").groupBy("dataset_source").agg(F.count("*").alias("original_size"))
    requested = requested.withColumn("requested", F.when(F.col("dataset_source") == "src0", 2.0).otherwise(1.0))
    return x.mix_statistics(sized, sized.where("n_chars < 1000"), requested)


@check(
    "filter_report",
    "C12",
    """SELECT source AS split, count(*) AS before, count(*) FILTER (WHERE n_chars < 1000) AS after, count(*) FILTER (WHERE n_chars >= 1000) AS filtered,
    round(count(*) FILTER (WHERE n_chars >= 1000) * 100.0 / count(*), 6)::DOUBLE AS percent FROM documents GROUP BY source""",
)
def filter_report(t):
    docs = t.documents.select("n_chars", F.col("source").alias("split"))
    return x.filter_report(docs, docs.where("n_chars < 1000")).withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@check("materialised_table", "C13 C14", "SELECT doc_id, source FROM documents WHERE lang = 'en'")
def materialised_table(t):
    config = {"name": "documents", "lang": "en", "limit": None}
    root = t.scratch("cache")
    build = lambda: t.documents.select("doc_id", "source", "lang").where("lang = 'en'").drop("lang")
    x.materialise(t.spark, root, config, build)
    again = x.materialise(t.spark, root, config, lambda: 1 / 0)
    return x.require_rows(again)


STRING_KEY = "lang || ':' || lpad((doc_id * 7919 % 100003)::VARCHAR, 6, '0')"


def _string_keyed(t):
    """Documents under a text key; a tenth has none."""
    key = F.concat("lang", F.lit(":"), F.lpad((F.col("doc_id") * 7919 % 100003).cast("string"), 6, "0"))
    return t.documents.select("doc_id", "source", F.when(F.col("doc_id") % 10 != 3, key).alias("key"))


@check(
    "string_row_index",
    "A7 B6 C7",
    f"""SELECT doc_id, key, row_number() OVER (ORDER BY key NULLS FIRST, doc_id) - 1 AS "index" FROM (SELECT doc_id, CASE WHEN doc_id % 10 <> 3 THEN {STRING_KEY} END AS key FROM documents)""",
)
def string_row_index(t):
    """Row numbers by a composite key whose first part is text and may be null; ranges of a hundred rows."""
    from rollweave.operators import ordering

    parts = ordering.ranged(_string_keyed(t).drop("source"), ["key", "doc_id"], rows=100)
    return ordering.numbered(parts)


@check(
    "string_slices",
    "C7",
    f"""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY key NULLS FIRST, source, doc_id) - 1 AS i
      FROM (SELECT doc_id, source, CASE WHEN doc_id % 10 <> 3 THEN {STRING_KEY} END AS key FROM documents)), (SELECT count(*) AS n FROM documents)
    WHERE i >= n // 20 AND i < n - n // 3""",
)
def string_slices(t):
    rows, n = _string_keyed(t), t.documents.count()
    return x.slice_rows(rows, ["key", "source", "doc_id"], n // 20, n - n // 3).select("doc_id", "source")


@check(
    "preference_mix",
    "H11",
    f"""WITH {PAIRS}, r AS (SELECT *, row_number() OVER (ORDER BY md5(concat(42, ':', conv_id)), conv_id) AS rk, count(*) OVER () AS n FROM pairs)
    SELECT conv_id::VARCHAR AS id, 'chats' AS source, 'model-a' AS chosen_model, NULL::VARCHAR AS rejected_model, len(prompt) + 1 AS turns FROM r WHERE rk <= floor(0.6::DOUBLE * n)""",
)
def preference_mix(t):
    pairs = preference_pairs(t).select(
        F.col("conv_id").cast("string").alias("id"), "chosen", "rejected", F.lit("model-a").alias("chosen_model"), F.lit("chats").alias("source")
    )
    head = x.mix(pairs, {"chats": 0.6}, "id")
    kept = align_columns(head, ["chosen", "rejected", "chosen_model", "rejected_model", "source"], need=["chosen", "rejected"])
    return kept.select("id", "source", "chosen_model", F.col("rejected_model").cast("string"), F.size("chosen").alias("turns"))


@check(
    "message_mix",
    "H11",
    f"""WITH {MSGS}, r AS (SELECT *, row_number() OVER (ORDER BY md5(concat(42, ':', conv_id)), conv_id) AS rk FROM msgs)
    SELECT conv_id::VARCHAR AS id, 'chats' AS source, len(messages) AS turns FROM r WHERE rk <= 12""",
)
def message_mix(t):
    msgs = messages(t).select(F.col("conv_id").cast("string").alias("id"), "messages", F.lit("chats").alias("source"))
    return align_columns(x.mix(msgs, {"chats": 12}, "id"), ["messages", "source"]).select("id", "source", F.size("messages").alias("turns"))
