"""Evaluation reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_metrics(df: DataFrame, metrics: str = "metrics") -> DataFrame:
    """Benchmark → mode → metric map to long rows."""
    keep = [c for c in df.columns if c != metrics]
    by_benchmark = df.select(*keep, F.explode(metrics).alias("benchmark", "modes"))
    by_mode = by_benchmark.select(*keep, "benchmark", F.explode("modes").alias("mode", "values"))
    return by_mode.select(*keep, "benchmark", "mode", F.explode("values").alias("metric", "value"))


def checkpoint_table(df: DataFrame, rows: list[str], step: str, value: str, steps: list | None = None) -> DataFrame:
    """Metric rows, one column per checkpoint in step order.

    The checkpoints of a run are few; give them to save the pass that finds them.
    """
    return df.groupBy(*rows).pivot(step, steps).agg(F.first(value))


def delta_vs_baseline(df: DataFrame, rows: list[str], step: str, value: str, baseline) -> DataFrame:
    """Signed difference to the baseline, two decimals; null where either side is missing."""
    base = df.where(F.col(step) == baseline).select(*rows, F.col(value).alias("baseline"))
    joined = df.where(F.col(step) != baseline).join(base, rows, "left")
    return joined.withColumn("delta", F.round(F.col(value) - F.col("baseline"), 2))


def instruction_accuracy(verdicts: DataFrame, prompt: str, columns: list[str]) -> DataFrame:
    """Prompt level (all constraints hold) and instruction level per verdict column.

    The average score is the mean of all those values.
    """
    n = F.count("*").alias("n")
    per_prompt = verdicts.groupBy(prompt).agg(n, *[x for c in columns for x in (F.every(c).alias(f"all_{c}"), F.count_if(F.col(c)).alias(f"sum_{c}"))])
    names = [f"{level}_{c}_accuracy" for c in columns for level in ("prompt", "instruction")]
    levels = [x for c in columns for x in (F.avg(F.col(f"all_{c}").cast("double")), F.sum(f"sum_{c}") / F.sum("n"))]
    rates = per_prompt.agg(F.count("*").alias("num_prompts"), F.sum("n").alias("num_instructions"), *[x.alias(c) for c, x in zip(names, levels)])
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return rates.withColumn("average_score", total / len(names))


def best_checkpoint(df: DataFrame, rows: list[str], step: str, value: str) -> DataFrame:
    """The best checkpoint per metric, the earliest on ties."""
    top = F.max(F.struct(F.col(value).alias("v"), (-F.col(step)).alias("s")))
    return df.groupBy(*rows).agg(top.alias("__t")).select(*rows, (-F.col("__t.s")).alias("best_step"), F.col("__t.v").alias("best_value"))


def no_answer_rate(df: DataFrame, answer: str, correct: str, by: list[str] = ()) -> DataFrame:
    """Share of rows without an answer next to the share of correct ones."""
    return df.groupBy(*by).agg(
        F.count("*").alias("num_entries"),
        F.avg(F.col(answer).isNull().cast("double")).alias("no_answer"),
        F.avg(F.coalesce(F.col(correct), F.lit(False)).cast("double")).alias("correct"),
    )
