"""K2: training steps prepared inside the stream, all tables of a step published together.

A micro-batch of complete groups is numbered in prompt order after all earlier ones and cut into steps of
``size`` places. When the places of a step are taken, its rows get their advantages (G23), its packs (F1)
and its metrics (E7, G30, G31). Everything a batch makes lies in folders of its own; the manifest is written
last and names the steps, the place reached and the oldest batch that an open step still needs. Readers
follow manifests only, so a batch that is cut off shows nothing, and its replay replaces what it left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.operators.analytics import step_metrics
from rollweave.operators.filters import classify_groups
from rollweave.operators.ordering import running_by_key
from rollweave.operators.packing import broadcast_advantages, pack_sequences
from rollweave.operators.rewards import group_advantages
from rollweave.streaming.jobs import read_batches, write_batch

PAYLOAD = "query array<int>, response array<int>, mask array<int>, logprobs array<double>, finish_reason string"
PENDING = f"prompt_id long, sample int, reward double, {PAYLOAD}, kind string, position long, step long"
MANIFEST = "places long, first_step long, next_step long, oldest long"
TABLES = ("rows", "packs", "metrics")


@dataclass(frozen=True)
class TrainingSteps:
    """The handler of a stream of complete groups (``groups.group_outcomes``); see the module.

    Groups without spread take a place and leave no rows; with ``active_sampling`` they take none, so that
    later groups fill the step. ``min_packs`` is the number of workers that packs are dealt to.
    """

    table: str
    size: int
    samples: int
    max_score: float
    pack_length: int
    pad_id: int = 0
    min_packs: int = 1
    mode: str = "standard"
    active_sampling: bool = False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = manifests(spark, self.table).where(F.col("batch_id") < batch_id)
        state = earlier.agg(F.max("places").alias("places"), F.max("next_step").alias("step"), F.max_by("oldest", "batch_id").alias("oldest")).first()
        places, step, oldest = state.places or 0, state.step or 0, batch_id if state.oldest is None else state.oldest
        # Once: the batch behind this frame is a stateful plan.
        batch = batch.persist()
        rows = batch.where("outcome = 'complete'").select("prompt_id", "sample", "reward", F.from_json("payload", PAYLOAD).alias("p")).select("prompt_id", "sample", "reward", "p.*")
        write_batch(self._placed(rows, places), f"{self.table}/pending", batch_id)
        batch.unpersist()
        pending = read_batches(spark, f"{self.table}/pending", PENDING).where(F.col("batch_id").between(oldest, batch_id))
        taken = pending.where(F.col("batch_id") == batch_id).select("prompt_id", "kind").distinct()
        total = places + (taken.where("kind = 'kept'") if self.active_sampling else taken).count()
        done = total // self.size
        if done > step:
            self._publish(pending.where(F.col("step").between(step, done - 1)).drop("batch_id"), batch_id)
            oldest = batch_id
        manifest = spark.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in zip(("places", "first_step", "next_step", "oldest"), (total, step, done, oldest))])
        self.commit(manifest, batch_id)

    def _placed(self, rows: DataFrame, start: int) -> DataFrame:
        kinds = classify_groups(rows, "prompt_id", "reward", self.max_score).select("prompt_id", "kind")
        takes = F.lit(1) if not self.active_sampling else (F.col("kind") == "kept").cast("int")
        placed = running_by_key(kinds.withColumn("__takes", takes), "prompt_id", position=F.col("__takes"))
        position = (F.col("position") - F.col("__takes") + start).cast("long")
        numbered = placed.withColumn("position", position).withColumn("step", F.floor(F.col("position") / self.size).cast("long"))
        return rows.join(numbered.drop("__takes"), "prompt_id").select(*[f.split()[0] for f in PENDING.split(", ")])

    def _publish(self, rows: DataFrame, batch_id: int) -> None:
        kept = group_advantages(rows.where("kind = 'kept'"), "prompt_id", "reward", self.mode).withColumn("length", F.size("response"))
        self.write("rows", kept.drop("group_mean", "group_std"), batch_id)
        spark = rows.sparkSession
        kept = spark.read.parquet(f"{self.table}/rows/batch_id={batch_id}")
        keyed = kept.withColumn("__key", F.struct("position", "sample"))
        packs = pack_sequences(keyed, "__key", self.pack_length, self.pad_id, min_packs=self.min_packs, by="step")
        ordinals = packs.select("step", F.explode(F.arrays_zip("__keys", "samples")).alias("x")).select("step", F.col("x.samples").alias("sample"), F.col("x.__keys.position").alias("position"), F.col("x.__keys.sample").alias("__sample"))
        advantages = ordinals.join(kept.select("position", F.col("sample").alias("__sample"), "advantage"), ["position", "__sample"]).select("step", "sample", "advantage")
        self.write("packs", broadcast_advantages(packs, advantages, ("step", "pack_no"), by="step").withColumnRenamed("__keys", "members"), batch_id)
        packs = spark.read.parquet(f"{self.table}/packs/batch_id={batch_id}")
        self.write("metrics", self._metrics(rows, kept, packs), batch_id)

    def _metrics(self, rows: DataFrame, kept: DataFrame, packs: DataFrame) -> DataFrame:
        """G30 and G31; a step of which nothing is kept has its counts alone."""
        groups = rows.groupBy("step", "prompt_id").agg(F.first("kind").alias("kind"))
        counts = groups.groupBy("step").agg(
            F.count_if(F.col("kind") == "kept").alias("total_prompts"),
            F.count_if(F.col("kind") != "kept").alias("filtered_prompts"),
            *[F.count_if(F.col("kind") == k).alias(f"filtered_prompts_{k}") for k in ("zero", "solved", "nonzero")],
        )
        sized = kept.withColumns({"prompt_tokens": F.size("query"), "response_tokens": F.size("response"), "generation_time": F.lit(0.0)})
        measured = step_metrics(sized, "step", self.max_score, self.samples, self.size, score="reward").drop("tokens_per_second")
        packed = packs.groupBy("step").agg(F.count("*").alias("packs"))
        ratio = F.col("packs") / F.col("__n")
        sizes = kept.groupBy("step").agg(F.count("*").alias("__n"))
        return counts.join(measured, "step", "left").join(packed, "step", "left").join(sizes, "step", "left").withColumn("packed_ratio", ratio).drop("__n")

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        write_batch(df, f"{self.table}/{name}", batch_id)

    def commit(self, manifest: DataFrame, batch_id: int) -> None:
        """One file, moved into place as a whole: from then on the batch's steps are there."""
        write_batch(manifest.coalesce(1), f"{self.table}/manifest", batch_id)


def manifests(spark: SparkSession, table: str) -> DataFrame:
    return read_batches(spark, f"{table}/manifest", MANIFEST)


def published(spark: SparkSession, table: str, name: str) -> DataFrame:
    """The rows of one of ``TABLES`` over all steps whose batch has a manifest."""
    if name not in TABLES:
        raise ValueError(f"no such table of a step: {name}")
    told = manifests(spark, table).where("next_step > first_step").select("batch_id")
    if told.isEmpty():
        return spark.createDataFrame([], "step long")
    return spark.read.option("basePath", f"{table}/{name}").parquet(*[f"{table}/{name}/batch_id={r.batch_id}" for r in told.collect()]).drop("batch_id")


def next_step(spark: SparkSession, table: str) -> int:
    """K5: the first step that is not published yet."""
    return manifests(spark, table).agg(F.max("next_step").alias("n")).first().n or 0
