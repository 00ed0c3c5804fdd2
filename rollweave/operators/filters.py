"""Row and group filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators.messages import as_column
from rollweave.operators.ordering import attach
from rollweave.operators.tokens import IGNORED, tokens_of


def within(ids: str | Column, limit: int | None) -> Column:
    return F.lit(True) if limit is None else F.size(as_column(ids)) <= limit


def has_labels(labels: str | Column) -> Column:
    return F.exists(as_column(labels), lambda x: x != IGNORED)


def sft_ok(max_prompt: int | None = None, max_total: int | None = None, need_labels: bool = True) -> Column:
    """E1 (and E3, first version): lengths within limits and at least one trainable label."""
    prompt = within("input_ids_prompt", max_prompt)
    total = within("input_ids", max_total)
    return prompt & total & (has_labels("labels") if need_labels else F.lit(True))


def filter_sft(df: DataFrame, max_prompt: int | None = None, max_total: int | None = None, need_labels: bool = True) -> DataFrame:
    return df.where(sft_ok(max_prompt, max_total, need_labels))


def preference_ok(max_prompt: int | None = None, max_total: int | None = None) -> Column:
    """Every limit that is set must hold."""
    return within("input_ids_prompt", max_prompt) & within("chosen_input_ids", max_total) & within("rejected_input_ids", max_total)


def preference_trainable() -> Column:
    return has_labels("chosen_labels") & has_labels("rejected_labels")


def filter_preference(df: DataFrame, max_prompt: int | None = None, max_total: int | None = None) -> DataFrame:
    return df.where(preference_ok(max_prompt, max_total))


def filter_rlvr(df: DataFrame, max_prompt: int | None = None) -> DataFrame:
    """E3, second version: prompt length only; no limit keeps all."""
    return df.where(within("input_ids_prompt", max_prompt))


def filter_long_prompts(df: DataFrame, max_tokens: int = 4096, messages: str = "messages") -> DataFrame:
    """Token length of the last message."""
    return df.where(F.size(tokens_of(F.element_at(messages, -1)["content"])) <= max_tokens)


def completion_groups(df: DataFrame, prompt: str, text: str) -> DataFrame:
    """Per prompt: rows and whether all completions are equal; min = max needs no distinct set."""
    digest = F.md5(F.col(text))
    return df.groupBy(prompt).agg(F.count("*").alias("n"), (F.min(digest) == F.max(digest)).alias("identical"))


def filter_identical_completions(df: DataFrame, prompt: str, text: str) -> DataFrame:
    """E5: drop prompts whose completions are all equal."""
    same = completion_groups(df, prompt, text).where("identical")
    return df.join(same.select(prompt), prompt, "left_anti")


# Substrings that make a program unsafe to run.
UNSAFE_PARTS = (
    "threading",
    "multiprocess",
    "multiprocessing",
    "import os",
    "from os",
    "shutil",
    "import torch",
    "from torch",
    "import sklearn",
    "from sklearn",
)


def is_unsafe(code: str | Column, parts: tuple[str, ...] = UNSAFE_PARTS) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(as_column(code), F.lit(p)) for p in parts])


def filter_unsafe_programs(df: DataFrame, code: str, parts: tuple[str, ...] = UNSAFE_PARTS) -> DataFrame:
    """E6."""
    return df.where(~is_unsafe(code, parts))


def classify_groups(df: DataFrame, prompt: str, reward: str, max_score: float) -> DataFrame:
    """Zero-spread groups as ``zero``, ``solved`` or ``nonzero``; others as ``kept``.

    The spread is tested by min = max, which is exact.
    """
    bounds = df.groupBy(prompt).agg(F.min(reward).alias("lo"), F.max(reward).alias("hi"), F.count("*").alias("n"))
    kind = (
        F.when(F.col("lo") != F.col("hi"), F.lit("kept"))
        .when(F.col("lo") == 0, F.lit("zero"))
        .when(F.col("lo") == max_score, F.lit("solved"))
        .otherwise(F.lit("nonzero"))
    )
    return bounds.select(prompt, "n", kind.alias("kind"))


def filter_zero_variance_groups(df: DataFrame, prompt: str, reward: str, max_score: float) -> DataFrame:
    """Rows of groups whose rewards differ."""
    kept = classify_groups(df, prompt, reward, max_score).where("kind = 'kept'")
    return df.join(kept.select(prompt), prompt, "left_semi")


def solved_prompts(df: DataFrame, prompt: str, reward: str, max_score: float, pass_rate: float) -> DataFrame:
    """Prompts whose mean reward share reaches the pass rate."""
    means = df.groupBy(prompt).agg(F.avg(reward).alias("mean_reward"))
    return means.where(F.col("mean_reward") / max_score >= pass_rate).select(prompt)


def exclude_solved(df: DataFrame, scores: DataFrame, prompt: str, reward: str, max_score: float, pass_rate: float) -> DataFrame:
    """Prompts that are not solved yet."""
    return df.join(solved_prompts(scores, prompt, reward, max_score, pass_rate), prompt, "left_anti")


def filter_truncated(df: DataFrame, reason: str = "finish_reason") -> DataFrame:
    """Rows that ended by themselves."""
    return df.where(F.col(reason) == "stop")


def retention(df: DataFrame, reason: str = "finish_reason") -> DataFrame:
    """Kept rows and retention rate."""
    kept = F.count_if(F.col(reason) == "stop")
    return df.agg(kept.alias("kept"), F.count("*").alias("total"), (kept / F.count("*")).alias("rate"))


def patch_empty_stop(df: DataFrame, eos_id: int, reason: str = "finish_reason", ids: str = "response_tokens", mask: str = "mask", logprobs: str = "logprobs") -> DataFrame:
    """A stopped but empty response becomes one end token with mask 1 and logprob NaN."""
    empty = (F.col(reason) == "stop") & (F.size(ids) == 0)
    fill = {ids: F.array(F.lit(eos_id)), mask: F.array(F.lit(1)), logprobs: F.array(F.lit(float("nan")))}
    return df.withColumns({c: F.when(empty, v).otherwise(F.col(c)) for c, v in fill.items()})


def group_stats(df: DataFrame, prompt: str, **measures: Column) -> DataFrame:
    """Statistics of a group next to each of its rows: aggregate map-side, then join back."""
    stats = df.groupBy(prompt).agg(*[m.alias(n) for n, m in measures.items()])
    return attach(df, stats, [prompt])
