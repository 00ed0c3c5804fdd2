"""Reward scoring over rollouts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions.verifiers import Sample, Verifier, format_reward
from rollweave.operators.messages import as_column, first_match
from rollweave.operators.ordering import attach


def join_rollouts(prompts: DataFrame, results: DataFrame, key: str, samples: int | None = None) -> DataFrame:
    """G1: samples matched to their prompt by index, in any order.

    With ``samples`` given a prompt with another number of samples is an error; the counts
    are aggregated map-side and joined to the prompts, so a hot prompt stays spread out.
    """
    guarded = prompts
    if samples is not None:
        counts = results.groupBy(key).agg(F.count("*").alias("__n"))
        wrong = F.raise_error(F.concat(F.lit("wrong number of samples for prompt "), F.col(key).cast("string")))
        checked = F.when(F.col("__n") == samples, F.col("__n")).otherwise(wrong.cast("long"))
        guarded = prompts.join(counts, key).withColumn("__n", checked).where("__n is not null").drop("__n")
    return results.join(guarded, key)


def verifier_scores(df: DataFrame, verifiers: dict[str, Verifier], prediction: str, ground_truth: str = "ground_truth", dataset: str = "dataset", tokens: str | None = None, mult: float = 10.0, config: dict | None = None) -> DataFrame:
    """Weighted score of every (verifier, ground truth) pair of a response, in place.

    The pairs are scored inside the row, so the text is neither copied nor shuffled.  Unknown
    verifiers are left out.  Adds ``scores array<struct<name,value>>``.  Rules ``by_row`` are scored as columns
    first, and each pair takes the next of its rule's scores.
    """
    n_tokens = F.col(tokens) if tokens else F.size(F.split(prediction, r"\s+"))
    uneven = F.raise_error(F.lit("ground truth and dataset list lengths do not match"))
    zipped = F.arrays_zip(F.col(ground_truth).alias("truth"), F.col(dataset).alias("verifier"))
    pairs = F.when(F.size(ground_truth) == F.size(dataset), zipped).otherwise(uneven.cast("array<struct<truth:string,verifier:string>>"))

    wanted = F.filter(pairs, lambda p: F.lower(p["verifier"]).isin(list(verifiers)))
    called_by = lambda key: lambda p: F.lower(p["verifier"]) == key
    whole = {key: f"__scores_{i}" for i, key in enumerate(k for k, v in verifiers.items() if v.by_row)}
    for key, column in whole.items():
        labels = F.transform(F.filter(wanted, called_by(key)), lambda p: p["truth"])
        df = df.withColumn(column, verifiers[key].score(Sample(F.col(prediction), labels, n_tokens, config or {})))

    def value(pair: Column, at: Column, key: str, v: Verifier) -> Column:
        if not v.by_row:
            own = v.score(Sample(F.col(prediction), pair["truth"], n_tokens, config or {}))
        else:
            before = F.filter(F.slice(wanted, F.lit(1), at), called_by(key))
            own = F.get(F.col(whole[key]), F.size(before))
        return own.cast("double") * (mult * v.weight)

    def score(pair: Column, at: Column) -> Column:
        called = F.lower(pair["verifier"])
        number = first_match([(called == key, value(pair, at, key, v)) for key, v in verifiers.items()], F.lit(None).cast("double"))
        name = first_match([(called == key, F.lit(v.name)) for key, v in verifiers.items()], F.lit(None).cast("string"))
        return F.struct(name.alias("name"), number.alias("value"))

    return df.withColumn("scores", F.transform(wanted, score)).drop(*whole.values())


def _sum(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s["value"])


def score_rewards(df: DataFrame, verifiers: dict[str, Verifier], prediction: str, **options) -> DataFrame:
    """``reward`` per response and ``per_verifier`` sums by name."""
    scored = verifier_scores(df, verifiers, prediction, **options)
    names = F.array_distinct(F.transform("scores", lambda s: s["name"]))
    sums = F.transform(names, lambda n: F.struct(n.alias("name"), _sum(F.filter("scores", lambda s: s["name"] == n)).alias("value")))
    return scored.withColumns({"reward": _sum(F.col("scores")), "per_verifier": F.map_from_entries(sums)}).drop("scores")


def code_scores(outcomes: DataFrame, sample: str, passed: str, runtime: str, threshold: float = 0.0, penalty: bool = False, limit: float = 1.0) -> DataFrame:
    """Pass rate of recorded test outcomes; below the threshold 0; slow passes count less."""
    rate = F.avg(F.col(passed).cast("double"))
    slow = F.avg(F.col(passed).cast("double") * (limit - F.col(runtime)) / limit)
    stats = outcomes.groupBy(sample).agg(rate.alias("pass_rate"), slow.alias("penalised"))
    kept = F.when(F.col("pass_rate") < threshold, F.lit(0.0)).otherwise(F.col("pass_rate"))
    score = F.when(kept > 0, F.col("penalised")).otherwise(kept) if penalty else kept
    return stats.select(sample, "pass_rate", score.alias("score"))


AGGREGATORS = {
    "last": lambda rewards: F.coalesce(F.try_element_at(rewards, F.lit(-1)), F.lit(0.0)),
    "sum": lambda rewards: F.aggregate(rewards, F.lit(0.0), lambda acc, r: acc + r),
}


def aggregate_turn_rewards(turns: str | Column, verifier_score: str | Column | None, how: str = "last") -> Column:
    """The verifier score joins the last turn, then ``last`` or ``sum``."""
    turns = as_column(turns)
    if verifier_score is not None:
        extra = as_column(verifier_score)
        grown = F.concat(F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0))), F.array(F.element_at(turns, -1) + extra))
        turns = F.when(F.size(turns) > 0, grown).otherwise(F.array(extra))
    return AGGREGATORS[how](turns)


def combine_rewards(
    df: DataFrame,
    prediction: str,
    verifiable: str = "reward",
    turns: str | None = None,
    how: str = "last",
    use_format: bool = False,
    format_scale: float = 1.0,
    additive_format: bool = False,
    only_good: bool = False,
    non_stop_penalty: float | None = None,
) -> DataFrame:
    """The final ``score``: output gate, format reward, penalty for unfinished answers last."""
    raw = aggregate_turn_rewards(F.coalesce(F.col(turns), F.array().cast("array<double>")) if turns else F.array().cast("array<double>"), verifiable, how)
    form = format_reward(prediction, format_scale) if use_format else F.lit(0.0)
    if use_format and additive_format:
        rewarded = raw + form
    elif use_format:
        rewarded = F.when(form == 1, raw).otherwise(F.lit(0.0))
    else:
        rewarded = raw
    if only_good:
        good = (F.length("tool_output") > 0) & F.col("tool_called") & ~F.col("timeout") & (F.coalesce(F.length("tool_error"), F.lit(0)) == 0)
        rewarded = F.when(good, rewarded).otherwise(form)
    if non_stop_penalty is not None:
        rewarded = F.when(F.col("finish_reason") == "stop", rewarded).otherwise(F.lit(float(non_stop_penalty)))
    return df.withColumns({"format_score": form, "score": rewarded})


def reward_metrics(df: DataFrame, reward: str = "reward", per_verifier: str = "per_verifier") -> DataFrame:
    """Mean and positive rate overall (``verifiable``) and per verifier."""
    measures = [F.avg("value").alias("mean_reward"), F.avg((F.col("value") > 0).cast("double")).alias("correct_rate")]
    named = F.explode(F.concat(F.array(F.struct(F.lit("verifiable").alias("key"), F.col(reward).alias("value"))), F.map_entries(per_verifier)))
    return df.select(named.alias("e")).select(F.col("e.key").alias("verifier"), "e.value").groupBy("verifier").agg(*measures)


def merge_metrics(df: DataFrame, step: str = "step", metric: str = "metric") -> DataFrame:
    """Numbers average, texts keep the last; array metrics are one row per value already
    (``position`` tells their order), so joining them needs no gathering."""
    return df.groupBy(metric).agg(
        F.avg("number").alias("mean"), F.max_by("text", F.when(F.col("text").isNotNull(), F.col(step))).alias("last_text"), F.count("*").alias("records")
    )


def group_advantages(df: DataFrame, prompt: str, reward: str, mode: str = "standard") -> DataFrame:
    """Reward against its prompt group; population deviation.

    Aggregate map-side and join back: no window, so no task has to hold a hot prompt.
    """
    if mode not in ("standard", "centered"):
        raise ValueError(f"invalid advantage normalisation: {mode}")
    stats = df.groupBy(prompt).agg(F.avg(reward).alias("group_mean"), F.stddev_pop(reward).alias("group_std"))
    centred = F.col(reward) - F.col("group_mean")
    value = centred / (F.col("group_std") + 1e-8) if mode == "standard" else centred
    return attach(df, stats, [prompt]).withColumn("advantage", value)


def gae(gamma: float, lam: float, packed: bool = False):
    """Reverse recursion of advantages and returns over the arrays of a row.

    Every step needs the one after it, so this runs as an Arrow-batched function, linear in
    the array length; the packed form resets at ends and at query tokens.
    """

    @F.pandas_udf("struct<advantages:array<double>,returns:array<double>>")
    def recurse(values: pd.Series, rewards: pd.Series, dones: pd.Series, masks: pd.Series) -> pd.DataFrame:
        rows = []
        for v, r, d, m in zip(values, rewards, dones, masks):
            last, upcoming, out = 0.0, 0.0, [0.0] * len(v)
            for t in range(len(v) - 1, -1, -1):
                keep = (1.0 - min(max(d[t], 0), 1)) * min(max(m[t], 0), 1) if packed else 1.0
                last = r[t] + gamma * upcoming * keep - v[t] + gamma * lam * last * keep
                out[t] = last
                upcoming = v[t]
            rows.append((out, [a + b for a, b in zip(out, v)]))
        return pd.DataFrame(rows, columns=["advantages", "returns"])

    return recurse


def masked_mean(values: str | Column, mask: str | Column, denominator: float | None = None) -> Column:
    """Mean under the mask, 0 when the mask is empty."""
    values, mask = as_column(values), as_column(mask)
    total = F.aggregate(F.zip_with(values, mask, lambda v, m: v * m), F.lit(0.0), lambda acc, x: acc + x)
    count = F.aggregate(mask, F.lit(0.0), lambda acc, m: acc + m) if denominator is None else F.lit(float(denominator))
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))
