"""Readers and writers."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollweave.operators.ordering import row_index
from rollweave.sources.publish import names_in, publish, read_record

ROLLOUT_SHARD_ROWS = 10_000


def _train_only(split: str) -> None:
    if split != "train":
        raise ValueError("only the train split is supported for files given by path")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None, split: str = "train") -> DataFrame:
    """A1: JSON lines; give the schema on large inputs, inference costs one extra pass."""
    _train_only(split)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """A2."""
    _train_only(split)
    return spark.read.parquet(path)


def read_named(spark: SparkSession, root: str, name: str, split: str, revision: str = "main") -> DataFrame:
    """A3: a named table, by catalog first and by ``root/name`` else.

    The revision and the split are partition columns, so both prune at the scan.  A folder
    written per split (``name/split``) is read as it is.
    """
    if spark.catalog.tableExists(name):
        table = spark.table(name)
    else:
        table = _read_tree(spark, f"{root}/{name}")
        if table is None:
            return spark.read.parquet(f"{root}/{name}/{split}")
    for column, value in (("revision", revision), ("split", split)):
        if column in table.columns:
            table = table.where(F.col(column) == value).drop(column)
    return table


def _read_tree(spark: SparkSession, path: str) -> DataFrame | None:
    """A partitioned table, or nothing when the folder is a plain folder of splits."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    children = [s.getPath().getName() for s in files.listStatus(fs_path)]
    return spark.read.parquet(path) if any("=" in c or c.endswith(".parquet") for c in children) else None


def read_metrics_json(spark: SparkSession, glob: str) -> DataFrame:
    """A4: nested evaluation files → (checkpoint, step, metrics); the name comes from the path."""
    metrics = "map<string,map<string,map<string,double>>>"
    raw = spark.read.text(glob, wholetext=True)
    checkpoint = F.regexp_extract(F.input_file_name(), r"/([^/=]*=)?([^/=]*checkpoint-\d+)/", 2)
    return raw.select(
        checkpoint.alias("checkpoint"),
        F.regexp_extract(checkpoint, r"-(\d+)$", 1).cast("int").alias("step"),
        F.from_json("value", metrics).alias("metrics"),
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A5: one JSON object per row; nulls stay as nulls."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_dataset(df: DataFrame, folder: str, config: dict, statistics: DataFrame) -> None:
    """Columnar table with a configuration and a statistics sidecar."""
    df.write.mode("errorifexists").parquet(f"{folder}/data")
    spark = df.sparkSession
    spark.range(1).select(F.lit(json.dumps(config, sort_keys=True)).alias("value")).coalesce(1).write.text(f"{folder}/config.json")
    statistics.coalesce(1).write.json(f"{folder}/dataset_statistics.json")


def read_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/data")


def append_rollouts(df: DataFrame, path: str, key: str | list[str], run: str, step: int, shard_rows: int = ROLLOUT_SHARD_ROWS) -> int:
    """Append the rows of one step of a run as JSON lines, in shards numbered from the run's total of rows.

    The append is a record, keyed by (run, step), that names its folder and holds the total behind it; it is
    published last. A step that is there already is left as it is, so a retried append adds nothing, and one
    that died adds nothing either. One writer for each run. Returns the total.
    """
    spark = df.sparkSession
    record = read_record(spark, _append_record(path, run, step))
    if record is None:
        offset = total_rollouts(spark, path, run)
        folder = f"data/{run}/{step}-{uuid.uuid4().hex}"
        shard_rollouts(df, key, offset, shard_rows).repartition("shard").write.partitionBy("shard").json(f"{path}/{folder}")
        rows = spark.read.schema("shard long").json(f"{path}/{folder}").count()
        record = {"folder": folder, "offset": offset, "rows": rows, "total": offset + rows}
        publish(spark, _append_record(path, run, step), record)
    return record["total"]


def _append_record(path: str, run: str, step: int) -> str:
    return f"{path}/appends/{run}/{step:012d}.json"


def appends(spark: SparkSession, path: str, run: str) -> list[dict]:
    """The records of a run's appends in the order of their rows."""
    folder = f"{path}/appends/{run}"
    return sorted((read_record(spark, f"{folder}/{name}") for name in names_in(spark, folder)), key=lambda r: (r["total"], r["offset"]))


def total_rollouts(spark: SparkSession, path: str, run: str) -> int:
    """Rows appended to a run so far."""
    return max((r["total"] for r in appends(spark, path, run)), default=0)


def read_rollouts(spark: SparkSession, path: str, run: str, schema: str) -> DataFrame:
    """The rows of all appends of a run with their ``shard``."""
    folders = [f"{path}/{r['folder']}" for r in appends(spark, path, run) if r["rows"]]
    reader = spark.read.schema(f"{schema}, shard long")
    parts = [reader.option("basePath", folder).json(folder) for folder in folders]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"{schema}, shard long")


def shard_rollouts(df: DataFrame, key: str | list[str], offset: int = 0, shard_rows: int = ROLLOUT_SHARD_ROWS) -> DataFrame:
    indexed = row_index(df, key, start=offset, out="__i")
    return indexed.withColumn("shard", F.floor(F.col("__i") / shard_rows).cast("long")).drop("__i")


def write_run_metadata(spark: SparkSession, path: str, run_name: str, commit: str, model: str) -> None:
    """The separate record of a run, with its UTC time."""
    stamp = datetime.now(timezone.utc).isoformat()
    row = {"run_name": run_name, "git_commit": commit, "model_name": model, "timestamp": stamp}
    spark.createDataFrame([row]).coalesce(1).write.mode("append").json(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows as CSV with exactly one header per file."""
    df.write.option("header", True).mode("append").csv(path)


def build_batch_requests(df: DataFrame, custom_id: str, messages: str, model: str, url: str, method: str = "POST") -> DataFrame:
    """Request rows; sending them is not part of this library."""
    body = F.struct(F.lit(model).alias("model"), F.col(messages).alias("messages"))
    return df.select(
        F.col(custom_id).cast("string").alias("custom_id"),
        F.lit(method).alias("method"),
        F.lit(url).alias("url"),
        F.to_json(body).alias("body"),
    )


RESULT_SCHEMA = (
    "struct<custom_id:string,response:struct<status_code:int,body:struct<"
    "choices:array<struct<message:struct<role:string,content:string>>>>>>"
)


def batch_result_content(line: Column) -> Column:
    """First choice of one result line."""
    parsed = F.from_json(line, RESULT_SCHEMA)
    return F.get(parsed.getField("response").getField("body").getField("choices"), 0).getField("message").getField("content")


def parse_batch_results(requests: DataFrame, results: DataFrame, line: str = "value") -> DataFrame:
    """Results joined back to their requests by ``custom_id``."""
    parsed = results.select(
        F.from_json(line, RESULT_SCHEMA).getField("custom_id").alias("custom_id"),
        batch_result_content(F.col(line)).alias("content"),
    )
    return requests.join(parsed, "custom_id", "left")
