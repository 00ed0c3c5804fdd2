"""A: sources and sinks, each written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators.evaluation import flatten_metrics
from rollweave.operators.ordering import md5_key
from rollweave.plans.inputs import messages
from rollweave.plans.registry import check
from rollweave.plans.sqltext import MSGS
from rollweave.sources import files


@check("jsonl_round_trip", "A1 A5", "SELECT conv_id, turn, role, text FROM conversations")
def jsonl_round_trip(t):
    path = t.scratch("jsonl")
    files.write_jsonl(t.conversations, path)
    return files.read_jsonl(t.spark, path, "conv_id long, turn long, role string, text string")


@check("parquet_scan", "A2", "SELECT doc_id, lang, source, n_chars FROM documents")
def parquet_scan(t):
    return files.read_parquet(t.spark, f"{t.root}/documents.parquet").select("doc_id", "lang", "source", "n_chars")


@check(
    "named_split",
    "A3",
    "SELECT doc_id, source FROM documents WHERE substr(md5(concat(7, ':', doc_id)), 1, 1) < '8'",
)
def named_split(t):
    root = t.scratch("named")
    split = F.when(F.substring(md5_key(7, "doc_id"), 1, 1) < "8", F.lit("train")).otherwise(F.lit("test"))
    revisions = F.explode(F.array(F.lit("main"), F.lit("older"))).alias("revision")
    table = t.documents.select("doc_id", "source", split.alias("split"), revisions)
    table.write.partitionBy("revision", "split").parquet(f"{root}/corpus")
    return files.read_named(t.spark, root, "corpus", "train", "main")


@check(
    "metrics_files",
    "A4 J1",
    """
    WITH runs AS (SELECT 100 * (1 + doc_id % 3) AS step, avg(quality) AS q, avg(toxic) AS x, count(*) AS n FROM labels GROUP BY 1)
    SELECT 'code-checkpoint-' || step AS checkpoint, CAST(step AS INTEGER) AS step, u.benchmark, 'pass@1' AS mode, u.metric,
           round(u.value, 9) AS value
    FROM runs, LATERAL (VALUES ('quality', 'score', q), ('quality', 'num_entries', CAST(n AS DOUBLE)),
                               ('toxicity', 'score', x)) AS u(benchmark, metric, value)
    """,
)
def metrics_files(t):
    root = t.scratch("metrics")
    runs = t.labels.groupBy((100 * (1 + F.col("doc_id") % 3)).alias("step")).agg(
        F.avg("quality").alias("q"), F.avg("toxic").alias("x"), F.count("*").cast("double").alias("n")
    )
    body = F.struct(
        F.struct(F.struct(F.col("q").alias("score"), F.col("n").alias("num_entries")).alias("pass@1")).alias("quality"),
        F.struct(F.struct(F.col("x").alias("score")).alias("pass@1")).alias("toxicity"),
    )
    named = runs.select(F.concat(F.lit("code-checkpoint-"), "step").alias("run"), F.to_json(body).alias("value"))
    named.repartition("run").write.partitionBy("run").text(root)
    raw = files.read_metrics_json(t.spark, f"{root}/*/part-*")
    return flatten_metrics(raw).withColumn("value", F.round("value", 9))


@check(
    "dataset_with_sidecars",
    "A6",
    "SELECT doc_id, source, n_chars, 1000000 AS seed_setting, (SELECT count(*) FROM documents) AS recorded FROM documents",
)
def dataset_with_sidecars(t):
    folder = t.scratch("dataset")
    data = t.documents.select("doc_id", "source", "n_chars")
    files.write_dataset(data, folder, {"seed": 1000000}, data.agg(F.count("*").alias("rows")))
    config = t.spark.read.schema("seed long").json(f"{folder}/config.json").select(F.col("seed").alias("seed_setting"))
    stats = t.spark.read.schema("rows long").json(f"{folder}/dataset_statistics.json").select(F.col("rows").alias("recorded"))
    return files.read_dataset(t.spark, folder).crossJoin(F.broadcast(config.limit(1))).crossJoin(F.broadcast(stats.limit(1)))


@check(
    "rollout_shards",
    "A7",
    """
    WITH first_drop AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events WHERE event_type = 'click'),
    rest AS (SELECT event_id, (SELECT count(*) FROM first_drop) + row_number() OVER (ORDER BY event_id) - 1 AS i
             FROM events WHERE event_type <> 'click')
    SELECT i // 1000 AS shard, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi
    FROM (SELECT * FROM first_drop UNION ALL SELECT * FROM rest) GROUP BY 1
    """,
)
def rollout_shards(t):
    path = t.scratch("rollouts")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    first, rest = rows.where("event_type = 'click'"), rows.where("event_type <> 'click'")
    # Each step is appended twice, as a job does that is run again.
    for step, part in ((0, first), (0, first), (1, rest), (1, rest), (0, first)):
        files.append_rollouts(part, path, "event_id", "run", step, 1000)
    back = files.read_rollouts(t.spark, path, "run", "event_id long, user_id long, event_type string, value double")
    return back.groupBy("shard").agg(
        F.count("*").alias("n"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi")
    )


@check(
    "csv_appends",
    "A8",
    "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 4) AS total FROM lineitem GROUP BY 1",
)
def csv_appends(t):
    path = t.scratch("csv")
    rows = t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    files.append_csv(rows.where("l_quantity < 25"), path)
    files.append_csv(rows.where("l_quantity >= 25"), path)
    back = t.spark.read.schema("l_orderkey long, l_returnflag string, l_quantity double").csv(path, header=True)
    return back.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("total"))


@check(
    "batch_requests",
    "A9",
    f"""
    WITH {MSGS}
    SELECT CAST(conv_id AS VARCHAR) AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url,
           len(messages) AS n_messages, messages[1].content AS first_content,
           CASE WHEN conv_id % 2 = 0 THEN messages[-1].content || '!' END AS content
    FROM msgs
    """,
)
def batch_requests(t):
    msgs = messages(t)
    requests = files.build_batch_requests(msgs, "conv_id", "messages", "judge-model", "/v1/chat/completions")
    choice = F.struct(F.struct(F.lit("assistant").alias("role"), F.concat(F.element_at("messages", -1)["content"], F.lit("!")).alias("content")).alias("message"))
    line = F.struct(
        F.col("conv_id").cast("string").alias("custom_id"),
        F.struct(F.lit(200).alias("status_code"), F.struct(F.array(choice).alias("choices")).alias("body")).alias("response"),
    )
    results = msgs.where("conv_id % 2 = 0").select(F.to_json(line).alias("value"))
    joined = files.parse_batch_results(requests, results)
    body = F.from_json("body", "struct<model:string,messages:array<struct<role:string,content:string>>>")["messages"]
    return joined.select(
        "custom_id", "method", "url", F.size(body).alias("n_messages"), F.get(body, 0)["content"].alias("first_content"), "content"
    )
