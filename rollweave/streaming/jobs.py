"""Structured Streaming jobs (K3-K5) and what all jobs share; groups (K1, K6), training steps (K2) and
running totals (K3) have modules of their own.

All sinks are written per micro-batch under ``batch_id=N`` and replaced when a batch is run
again, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


# --- sinks ---------------------------------------------------------------------------------


def write_batch(df: DataFrame, table: str, batch_id: int) -> None:
    """Replace the partition of one micro-batch."""
    df.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")


def read_batches(spark: SparkSession, table: str, schema: str, before: int | None = None) -> DataFrame:
    """The rows of all (or the earlier) micro-batches; nothing before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"{schema}, batch_id int")
    rows = spark.read.schema(f"{schema}, batch_id int").parquet(table)
    return rows if before is None else rows.where(F.col("batch_id") < before)


def start(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append"):
    """Run over all data that is there now, then stop; a later start resumes (K5)."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    return writer.trigger(availableNow=True).start()


def run(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    start(df, checkpoint, handle, mode).awaitTermination()


def collect_batches(table: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: write_batch(batch, table, batch_id)


def stream_throughput(events: DataFrame, window: str, slide: str, delay: str = "1 hour") -> DataFrame:
    """K3: tokens and samples per sliding window with tokens per second and mean times.

    Input columns: ts, tokens, step_time, batch_time.
    """
    grouped = events.withWatermark("ts", delay).groupBy(F.window("ts", window, slide)).agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("samples"), F.avg("step_time").alias("avg_step_time"), F.avg("batch_time").alias("avg_batch_time")
    )
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return grouped.withColumn("tokens_per_second", F.when(seconds > 0, F.col("tokens") / seconds).otherwise(0.0))


def recent_throughput(events: DataFrame, n: int, order: str = "ts", ties: tuple[str, ...] = ()) -> DataFrame:
    """K3, exact form: over the last ``n`` records, 0 on an empty input; ``ties`` and the tokens order equal times."""
    last = events.orderBy(F.desc(order), *[F.desc(c) for c in ties], F.desc("tokens")).limit(n)
    span = F.max(F.col(order).cast("double")) - F.min(F.col(order).cast("double"))
    return last.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.count("*").alias("samples"),
        F.coalesce(F.when(span > 0, F.sum("tokens") / span), F.lit(0.0)).alias("tokens_per_second"),
    )


def stream_exclusions(table: str, max_score: float, pass_rate: float) -> Callable[[DataFrame, int], None]:
    """K4: prompts of a batch of complete groups that are solved join the exclusion table."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        means = batch.where("outcome = 'complete'").groupBy("prompt_id").agg(F.avg("reward").alias("m"))
        write_batch(means.where(F.col("m") / max_score >= pass_rate).select("prompt_id"), table, batch_id)

    return handle


def excluded_prompts(spark: SparkSession, table: str) -> DataFrame:
    """K4: the exclusion list for the next epoch."""
    return read_batches(spark, table, "prompt_id long").select("prompt_id").distinct()
