"""Rollout analytics (G26-G38): conditional aggregates, ratios and running totals.

Statistics stay map-side combinable; histograms come as (value, count) rows, so a step of
any size is never gathered into one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators.messages import as_column
from rollweave.operators.ordering import running_by_key
from rollweave.operators.rewards import masked_mean


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


# --- G26, G27 ------------------------------------------------------------------------------


def token_weighted_metrics(df: DataFrame, tokens: str, metrics: list[str], equal_when_empty: bool = True, variance_of: str | None = None, by: list[str] = ()) -> DataFrame:
    """Token-weighted means; without tokens equal weights, or 0 in the statistics form.

    The weighted variance is E[x²] - E[x]² on the same weights, so one pass is enough.
    """
    total = F.sum(tokens)
    empty = (lambda m: F.avg(m)) if equal_when_empty else (lambda m: F.lit(0.0))
    mean = lambda x, m: F.when(total > 0, F.sum(x * F.col(tokens)) / total).otherwise(empty(m))
    aggregates = [mean(F.col(m), m).alias(m) for m in metrics]
    if variance_of:
        x = F.col(variance_of)
        first, second = F.sum(x * F.col(tokens)) / total, F.sum(x * x * F.col(tokens)) / total
        aggregates.append(F.when(total > 0, F.greatest(second - first * first, F.lit(0.0))).otherwise(0.0).alias(f"{variance_of}_var"))
    return df.groupBy(*by).agg(*aggregates, total.alias("token_count"))


def group_token_counts(df: DataFrame, position: str, tokens: str, k: int) -> DataFrame:
    """Token sums of consecutive groups of ``k`` micro-batches, keyed by their first one."""
    return df.groupBy((F.floor(F.col(position) / k) * k).cast("long").alias("group_start")).agg(F.sum(tokens).alias("tokens"))


# --- G28, G29 ------------------------------------------------------------------------------

NEUTRAL = 1.0


def clean_logprobs(logprobs: str | Column, mask: str | Column, fill: float = NEUTRAL) -> Column:
    """The fill value outside the response and in place of NaN."""
    return F.zip_with(as_column(logprobs), as_column(mask), lambda p, m: F.when((m == 0) | F.isnan(p), F.lit(fill)).otherwise(p))


def logprob_drift(df: DataFrame, new: str, old: str, reference: str, mask: str, cap: float) -> DataFrame:
    """Masked means of four divergence estimators and of truncated importance weights.

    ``d`` is new - reference clamped to ±40, the ratio exp(new - old); the weights are
    exp(clamp(new - old, ±10)) cut at ``cap``, 1 outside the response.
    """
    bounded = lambda x, limit: F.greatest(F.least(x, F.lit(limit)), F.lit(-limit))
    difference = F.zip_with(new, reference, lambda a, b: bounded(a - b, 40.0))
    ratio = F.zip_with(new, old, lambda a, b: F.exp(a - b))
    shift = F.zip_with(F.zip_with(new, old, lambda a, b: bounded(a - b, 10.0)), mask, lambda x, m: F.when(m != 0, x).otherwise(0.0))
    staged = df.withColumns({"__d": difference, "__r": ratio, "__w": F.transform(shift, F.exp), "__m": F.col(mask).cast("array<double>")})
    estimators = {
        "divergence_linear": F.col("__d"),
        "divergence_square": F.transform("__d", lambda d: d * d / 2),
        "divergence_exponential": F.transform("__d", lambda d: F.expm1(-d) + d),
        "divergence_weighted": F.zip_with("__d", "__r", lambda d, r: r * d),
        "importance_weight": F.transform("__w", lambda w: F.least(w, F.lit(cap))),
        "clip_fraction": F.transform("__w", lambda w: F.when(w > cap, 1.0).otherwise(0.0)),
    }
    return staged.withColumns({n: masked_mean(c, "__m") for n, c in estimators.items()}).drop("__d", "__r", "__w", "__m")


def sequence_logprob(logprobs: str | Column, labels: str | Column, average: bool = False, ignored: int = -100) -> Column:
    """Sum or mean of the logprobs of labelled tokens, labels shifted by one."""
    p, y = as_column(logprobs), as_column(labels)
    mask = F.transform(F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))), lambda x: F.when(x != ignored, 1.0).otherwise(0.0))
    kept = F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), mask, lambda a, m: a * m)
    total = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x)
    return total / F.aggregate(mask, F.lit(0.0), lambda acc, x: acc + x) if average else total


def packed_sequence_logprobs(logprobs: str | Column, labels: str | Column, bounds: str | Column, average: bool = False, ignored: int = -100) -> Column:
    """G29, packed: one value per segment.

    Segments are position ranges of the shifted arrays, so each is a slice; a mean over an
    empty segment divides by 1.
    """
    p, y, cu = as_column(logprobs), as_column(labels), as_column(bounds)
    mask = F.transform(F.slice(y, 2, F.size(y) - 1), lambda x: F.when(x != ignored, 1.0).otherwise(0.0))
    kept = F.zip_with(F.slice(p, 1, F.size(p) - 1), mask, lambda a, m: a * m)
    moved = F.transform(cu, lambda x, i: F.when(i == 0, F.lit(0)).otherwise(x - 1))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    def segment(k: Column) -> Column:
        begin, size = F.get(moved, k), F.get(moved, k + 1) - F.get(moved, k)
        sums = total(F.slice(kept, begin + 1, size))
        return sums / F.greatest(total(F.slice(mask, begin + 1, size)), F.lit(1.0)) if average else sums

    return F.transform(F.sequence(F.lit(0), F.size(cu) - 2), segment)


# --- G30, G31, G34 -------------------------------------------------------------------------


def batch_statistics(groups: DataFrame, step: str) -> DataFrame:
    """G30 over one row per prompt group: ``kind`` (E7), ``percent_solved``, ``excluded``, lengths."""
    kept = F.col("kind") == "kept"
    return groups.groupBy(step).agg(
        F.count_if(~kept).alias("filtered_prompts"),
        *[F.count_if(F.col("kind") == k).alias(f"filtered_prompts_{k}") for k in ("zero", "solved", "nonzero")],
        F.coalesce(F.avg(F.when(kept, F.col("percent_solved"))), F.lit(0.0)).alias("percent_solved_mean"),
        F.count_if(F.col("excluded")).alias("no_resampled_prompts"),
        F.count_if(kept).alias("total_prompts"),
        F.sum(F.when(kept, F.col("prompt_tokens"))).alias("prompt_tokens"),
        F.sum(F.when(kept, F.col("response_tokens"))).alias("response_tokens"),
    )


def histogram(df: DataFrame, by: str, value: str) -> DataFrame:
    """Exact histogram as (value, count) rows."""
    return df.groupBy(by, value).agg(F.count("*").alias("n"))


def step_metrics(df: DataFrame, step: str, max_score: float, samples: int, prompts: int, score: str = "score", length: str = "length") -> DataFrame:
    """One pass of conditional aggregates per step.

    "Unsolved" means score == 0 for the lengths but score < maximum for the ratio.
    """
    s, n = F.col(score), F.count("*")
    mean_or_zero = lambda condition: F.coalesce(F.avg(F.when(condition, F.col(length))), F.lit(0.0))
    return df.groupBy(step).agg(
        F.avg(s).alias("scores"),
        (n / F.lit(samples * prompts)).alias("real_batch_size_ratio"),
        (F.count_if(s < max_score) / n).alias("unsolved_batch_size_ratio"),
        (n / F.lit(samples)).alias("reward_groups"),
        F.avg(length).alias("sequence_lengths"),
        F.min(length).alias("sequence_lengths_min"),
        F.max(length).alias("sequence_lengths_max"),
        mean_or_zero(s == 0).alias("sequence_lengths_unsolved"),
        mean_or_zero(s == max_score).alias("sequence_lengths_solved"),
        (F.count_if(F.col("finish_reason") == "stop") / n).alias("stop_rate"),
        F.avg("advantage").alias("advantages_mean"),
        F.min("advantage").alias("advantages_min"),
        F.max("advantage").alias("advantages_max"),
        safe_ratio(F.sum(F.col("prompt_tokens") + F.col("response_tokens")), F.max("generation_time")).alias("tokens_per_second"),
    )


def packed_ratio(packs: DataFrame, samples: DataFrame, step: str) -> DataFrame:
    """Packs per response of a step."""
    return (
        samples.groupBy(step).agg(F.count("*").alias("__n"))
        .join(packs.groupBy(step).agg(F.count("*").alias("__p")), step, "left")
        .select(step, (F.coalesce("__p", F.lit(0)) / F.col("__n")).alias("packed_ratio"))
    )


def evaluation_summary(df: DataFrame, score: str = "score", length: str = "length") -> DataFrame:
    """Score, lengths, stop rate and throughput of an evaluation."""
    return df.agg(
        F.avg(score).alias("scores"),
        F.avg(length).alias("sequence_lengths"),
        F.min(length).alias("sequence_lengths_min"),
        F.max(length).alias("sequence_lengths_max"),
        (F.count_if(F.col("finish_reason") == "stop") / F.count("*")).alias("stop_rate"),
        safe_ratio(F.sum(F.col("prompt_tokens") + F.col("response_tokens")), F.max("generation_time")).alias("tokens_per_second"),
    )


def sample_table(df: DataFrame, pad: str = "<pad>") -> DataFrame:
    """The rows to look at; a missing tool list reads ``all``."""
    tools = F.coalesce(F.col("active_tools").cast("string"), F.lit("all"))
    return df.select("prompt", F.replace("response", F.lit(pad), F.lit("")).alias("response"), "score", "ground_truth", tools.alias("active_tools"))


# --- G32, G33 ------------------------------------------------------------------------------


def tool_statistics(calls: DataFrame, rollouts: int | DataFrame, configured: list[str] = ()) -> DataFrame:
    """Calls per rollout, failure rate and mean runtime per tool; ``aggregate`` by rollup."""
    if isinstance(rollouts, int):
        total = calls.sparkSession.range(1).select(F.lit(rollouts).cast("long").alias("__rollouts"))
    else:
        total = rollouts.agg(F.count("*").alias("__rollouts"))
    stats = calls.rollup("tool_name").agg(
        F.count("*").alias("calls"), F.count_if(~F.col("success")).alias("failures"), F.sum("runtime").alias("seconds"), F.grouping("tool_name").alias("__all")
    )
    named = stats.select(F.when(F.col("__all") == 1, F.lit("aggregate")).otherwise(F.col("tool_name")).alias("tool_name"), "calls", "failures", "seconds")
    if configured:
        setup = calls.sparkSession.createDataFrame([(n,) for n in configured], "tool_name string")
        idle = setup.join(named, "tool_name", "left_anti").select("tool_name", F.lit(0).alias("calls"), F.lit(0).alias("failures"), F.lit(0.0).alias("seconds"))
        named = named.unionByName(idle)
    calls_made = F.col("calls")
    return named.crossJoin(F.broadcast(total)).select(
        "tool_name",
        safe_ratio(calls_made, F.col("__rollouts")).alias("avg_calls_per_rollout"),
        safe_ratio(F.col("failures"), calls_made).alias("failure_rate"),
        safe_ratio(F.coalesce("seconds", F.lit(0.0)), calls_made).alias("avg_runtime"),
    )


def _numbers(values: Column) -> Column:
    """Numeric entries of a map of variants; booleans count as 0 and 1, texts that look like numbers do not count."""

    def number(_: Column, v: Column) -> Column:
        kind = F.schema_of_variant(v)
        return F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).when(
            (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"), F.try_variant_get(v, "$", "double")
        )

    return F.map_filter(F.transform_values(values, number), lambda _, v: v.isNotNull())


def env_metrics(df: DataFrame, info: str) -> DataFrame:
    """Mean of every numeric key per environment.

    ``info`` is JSON text: flat with ``env_name`` (else ``unknown``), or nested per environment
    under ``env_metrics``.
    """
    flat = F.from_json(info, "map<string,variant>")
    nested = F.from_json(F.get_json_object(info, "$.env_metrics"), "map<string,map<string,variant>>")
    name = F.coalesce(F.try_variant_get(flat["env_name"], "$", "string"), F.lit("unknown"))
    single = F.create_map(name, _numbers(F.map_filter(flat, lambda k, _: k != "env_name")))
    nested = F.transform_values(nested, lambda _, v: _numbers(v))
    by_env = df.select(F.explode(F.coalesce(nested, single)).alias("env", "values"))
    return by_env.select("env", F.explode("values").alias("key", "value")).groupBy("env", "key").agg(F.avg("value").alias("mean"))


# --- G35, G36 ------------------------------------------------------------------------------


def run_summary(batches: DataFrame, total_time: float | None = None) -> DataFrame:
    """Totals and averages over batches with generation and sync seconds and new tokens."""
    generation, sync = F.sum("generation_time"), F.sum("weight_sync_time")
    whole = F.lit(float(total_time)) if total_time is not None else generation + sync
    return batches.agg(
        F.count("*").alias("total_batches"),
        generation.alias("total_generation_time"),
        sync.alias("total_weight_sync_time"),
        F.sum("num_new_tokens").alias("total_tokens"),
        safe_ratio(F.sum("num_new_tokens"), generation).alias("avg_tokens_per_second"),
        F.avg("generation_time").alias("avg_generation_time"),
        F.avg("weight_sync_time").alias("avg_weight_sync_time"),
        (100 * safe_ratio(generation, whole)).alias("generation_time_percentage"),
        (100 * safe_ratio(sync, whole)).alias("weight_sync_time_percentage"),
    )


def reason_counts(df: DataFrame, reason: str = "finish_reason") -> DataFrame:
    """Finish-reason histogram."""
    return df.groupBy(reason).agg(F.count("*").alias("n"))


PERCENTILES = (25, 50, 75, 90, 95, 99)


def length_percentiles(df: DataFrame, length: str, exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """Exact linear-interpolated percentiles, or the sketch for very large inputs.

    The exact form counts distinct lengths first, so its state is bounded by how many
    different lengths occur, not by the number of rows.
    """
    levels = F.array(*[F.lit(p / 100) for p in PERCENTILES])
    if exact:
        counted = df.groupBy(length).agg(F.count("*").alias("__n"))
        values = counted.agg(F.percentile(F.col(length), levels, F.col("__n")).alias("v"))
    else:
        values = df.agg(F.percentile_approx(length, levels, accuracy).cast("array<double>").alias("v"))
    return values.select(*[F.get("v", F.lit(i)).alias(f"p{p}") for i, p in enumerate(PERCENTILES)])


# --- G37, G38 ------------------------------------------------------------------------------


def token_accounting(batches: DataFrame, step: str, period: int) -> DataFrame:
    """Running totals per step with the totals of the logging period it falls in."""
    names = ["tokens", "tokens_with_padding", "trainable_tokens"]
    totals = running_by_key(batches, step, __steps=F.lit(1), **{f"total_{n}": F.col(n) for n in names})
    window = F.floor((F.col("__steps") - 1) / period).cast("long")
    numbered = totals.withColumn("log_period", window)
    per_period = numbered.groupBy("log_period").agg(*[F.sum(n).alias(f"{n}_this_period") for n in ("tokens", "trainable_tokens")])
    averaged = {f"avg_{n}_per_batch": F.col(f"total_{n}") / F.col("__steps") for n in names}
    return numbered.join(per_period, "log_period").withColumns(averaged).drop("__steps")


def step_performance(steps: DataFrame, step: str, ranks: int = 1) -> DataFrame:
    """Per-step and cumulative throughput with loading and overhead shares."""
    totals = running_by_key(steps, step, total_tokens=F.col("tokens"), __elapsed=F.col("training_time"))
    wall = F.col("wall_clock")
    per_second = safe_ratio(F.col("tokens"), F.col("training_time"))
    return totals.withColumns(
        {
            "tokens_per_second": per_second,
            "tokens_per_second_avg": safe_ratio(F.col("total_tokens"), F.col("__elapsed")),
            "tokens_per_second_per_rank": per_second / ranks,
            "avg_sequence_length": safe_ratio(F.col("tokens"), F.col("sequences")),
            "data_loading_pct": 100 * safe_ratio(F.col("loading_time"), wall),
            "step_overhead_pct": 100 * safe_ratio(wall - F.col("step_time"), wall),
        }
    ).drop("__elapsed")
