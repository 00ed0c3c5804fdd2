"""Rejection sampling and preference data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions.prompts import COMPARISON, fill
from rollweave.operators.messages import completion_of, flatten_prompt, message, prompt_of, strip_space
from rollweave.operators.ordering import attach, md5_key, md5_mod


def explode_completions(df: DataFrame, prompt: str, completions: str = "completions", messages: str = "messages") -> DataFrame:
    """H1: one row per completion; ``cand`` starts at 1, 0 is kept for the reference."""
    rows = df.select(
        prompt,
        F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0))).alias("__p"),
        completion_of(messages)["content"].alias("reference_completion"),
        F.posexplode(completions).alias("__i", "model_completion"),
    )
    grown = F.concat("__p", F.array(message("assistant", "model_completion")))
    return rows.select(prompt, (F.col("__i") + 1).alias("cand"), grown.alias("messages"), "model_completion", "reference_completion")


def inject_reference(df: DataFrame, prompt: str) -> DataFrame:
    """H2: the reference completion as candidate 0; candidate 1 of each prompt carries it."""
    first = df.where("cand = 1")
    body = F.concat(prompt_of("messages"), F.array(message("assistant", "reference_completion")))
    reference = first.withColumns({"cand": F.lit(0).cast(dict(df.dtypes)["cand"]), "messages": body, "model_completion": F.col("reference_completion")})
    return df.unionByName(reference)


def score_candidates(df: DataFrame, scores: DataFrame, prompt: str, keep_reference: bool = False) -> DataFrame:
    """H3: score map per candidate and the reference's score map; one entry per model.

    The number of models is part of the run configuration, so the maps stay small.
    """
    maps = scores.groupBy(prompt, "cand").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", "score")))).alias("score"))
    reference = maps.where("cand = 0").select(prompt, F.col("score").alias("reference_completion_score"))
    joined = df.join(maps, [prompt, "cand"]).join(reference, prompt, "left")
    return joined if keep_reference else joined.where("cand <> 0")


def best_worst(scores: DataFrame, prompt: str, model: str = "model") -> DataFrame:
    """H4: first best and first worst candidate per prompt and model, as combinable aggregates."""
    return scores.groupBy(prompt, model).agg(
        F.max(F.struct("score", (-F.col("cand")).alias("n"))).alias("__b"), F.min(F.struct("score", "cand")).alias("__w")
    ).select(prompt, model, (-F.col("__b.n")).alias("best"), F.col("__w.cand").alias("worst"))


def _vote(picks: Column, prompt: Column, seed: int | str) -> Column:
    distinct = F.array_distinct(picks)
    counted = F.transform(distinct, lambda p, i: F.struct(F.size(F.filter(picks, lambda q: q == p)).alias("n"), (-i).alias("first"), p.alias("p")))
    draw = F.get(picks, md5_mod(md5_key(seed, prompt), 1 << 20) % F.size(picks))
    return F.when(F.size(distinct) == F.size(picks), draw).otherwise(F.array_max(counted)["p"])


def majority_vote(picks: DataFrame, prompt: str, models: list[str], seed: int | str = 42) -> DataFrame:
    """H5: most common pick, first seen wins ties; a model drawn by digest when all disagree."""
    order = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    votes = picks.groupBy(prompt).agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "best", "worst"))).alias("__v"))
    column = lambda name: F.transform("__v", lambda v: v[name])
    return votes.select(prompt, *[_vote(column(n), F.col(prompt), f"{seed}-{n}").alias(n) for n in ("best", "worst")])


def preference_table(candidates: DataFrame, votes: DataFrame, prompt: str) -> DataFrame:
    """H6: chosen and rejected per prompt; both must share the prompt messages."""
    picked = candidates.join(votes, prompt).where((F.col("cand") == F.col("best")) | (F.col("cand") == F.col("worst")))
    pick = lambda c, side: F.max(F.when(F.col("cand") == F.col(side), F.struct(c))).getField(c)
    digest = F.md5(flatten_prompt(prompt_of("messages")))
    rows = picked.groupBy(prompt).agg(
        F.first(F.when(F.col("cand") == F.col("best"), F.col("messages")), ignorenulls=True).alias("chosen"),
        F.first(F.when(F.col("cand") == F.col("worst"), F.col("messages")), ignorenulls=True).alias("rejected"),
        pick("reference_completion", "worst").alias("reference_completion"),
        F.first(F.when(F.col("cand") == F.col("best"), F.col("score")), ignorenulls=True).alias("chosen_score"),
        F.first(F.when(F.col("cand") == F.col("worst"), F.col("score")), ignorenulls=True).alias("rejected_score"),
        F.first("reference_completion_score", ignorenulls=True).alias("reference_completion_score"),
        (F.min(digest) == F.max(digest)).alias("__same"),
    )
    uneven = F.raise_error(F.lit("chosen and rejected do not share their prompt")).cast("boolean")
    return rows.where(F.when(F.col("__same"), True).otherwise(uneven)).drop("__same")


def scored_candidates(candidates: DataFrame) -> DataFrame:
    """H7: the full candidate table as the second output; write it with ``write_jsonl``."""
    return candidates


def oversized_prompts(df: DataFrame, prompt: str, num_completions: int) -> DataFrame:
    """H8: prompts with more candidates than they can have, and how many."""
    counts = df.groupBy(prompt).agg(F.count("*").alias("candidates"))
    return counts.where(F.col("candidates") > num_completions + 1)


def pairwise_comparisons(df: DataFrame, prompt: str, num_completions: int, skip_oversized: bool = False) -> DataFrame:
    """H8: all unordered candidate pairs of a prompt, the reference among them.

    A prompt has at most ``num_completions`` candidates plus the reference, by how they are
    generated; a larger group is an error, or with ``skip_oversized`` has no pairs
    (``oversized_prompts`` lists it), never a truncated or quadratic one.  Prompts are counted
    before any is gathered, so no task holds a larger group.  Pairs are made inside the gathered
    row, so there is no self join.
    """
    counts = df.groupBy(prompt).agg(F.count("*").alias("__n"))
    if skip_oversized:
        counts = counts.where(F.col("__n") <= num_completions + 1)
    else:
        too_many = F.raise_error(F.lit("more candidates than completions per prompt")).cast("long")
        counts = counts.withColumn("__n", F.when(F.col("__n") <= num_completions + 1, F.col("__n")).otherwise(too_many))
    fitting = counts.where("__n > 1").select(prompt)
    checked = df.join(fitting, prompt, "left_semi").groupBy(prompt).agg(F.collect_list(F.struct("cand", "messages")).alias("__c"))
    ordered = F.array_sort("__c", lambda a, b: (a["cand"] - b["cand"]).cast("int"))
    items = checked.select(prompt, ordered.alias("__c"))
    pairs = F.flatten(
        F.transform("__c", lambda a, i: F.transform(F.slice("__c", i + 2, F.size("__c")), lambda b: F.struct(a.alias("first"), b.alias("second"))))
    )
    return items.select(prompt, F.explode(pairs).alias("p")).select(
        prompt,
        F.col("p.first.cand").alias("cand_a"),
        F.col("p.second.cand").alias("cand_b"),
        F.col("p.first.messages").alias("messages_a"),
        F.col("p.second.messages").alias("messages_b"),
    )


def comparison_prompts(pairs: DataFrame, prompt: str, seed: int | str = 42, criteria: str = "") -> DataFrame:
    """H9: the comparison text with the two responses in a seeded order."""
    flip = md5_mod(md5_key(seed, prompt, "cand_a", "cand_b"), 2) == 1
    a, b = completion_of("messages_a")["content"], completion_of("messages_b")["content"]
    text = fill(
        criteria + COMPARISON, "{{", "}}",
        task=flatten_prompt(prompt_of("messages_a")), response0=F.when(flip, b).otherwise(a), response1=F.when(flip, a).otherwise(b),
    )
    return pairs.withColumns({"flipped": flip, "comparison_prompt": text})


def apply_comparisons(judged: DataFrame, judgement: str = "judgement") -> DataFrame:
    """H9: parse the judgement and put the preferred side first.

    The order was drawn, so a preferred "1" names the first side when flipped.  (The original
    condition for swapping back can never hold; this is the intended swap.)
    """
    text = F.col(judgement)
    comparison = strip_space(F.substring_index(F.get(F.split(text, "Comparison:"), 1), "Preferred:", 1))
    preferred = strip_space(F.get(F.split(text, "Preferred:"), 1))
    second = (preferred == "1") != F.col("flipped")
    pick = lambda yes, no: F.when(second, F.col(yes)).otherwise(F.col(no))
    parsed = judged.where(comparison.isNotNull() & preferred.isNotNull())
    return parsed.withColumns({"comparison": comparison, "preferred": preferred, "chosen": pick("messages_b", "messages_a"), "rejected": pick("messages_a", "messages_b")})


def reward_model_report(df: DataFrame, chosen: str, rejected: str, batch: str | None = None) -> DataFrame:
    """Accuracy, logistic loss, mean rewards and margin; over rows, or the mean of batch means."""
    margin = F.col(chosen) - F.col(rejected)
    loss = F.when(margin > 0, F.log1p(F.exp(-margin))).otherwise(-margin + F.log1p(F.exp(margin)))
    measures = {
        "accuracy": F.avg((margin > 0).cast("double")),
        "loss": F.avg(loss),
        "chosen_rewards": F.avg(chosen),
        "rejected_rewards": F.avg(rejected),
        "reward_margin": F.avg(margin),
    }
    rows = df.groupBy(*([batch] if batch else [])).agg(*[m.alias(n) for n, m in measures.items()])
    return rows.agg(*[F.avg(n).alias(n) for n in measures]) if batch else rows


def reference_scores(candidates: DataFrame, prompt: str) -> DataFrame:
    """H3: the reference's score next to every candidate of its prompt."""
    reference = candidates.where("cand = 0").select(prompt, F.col("score").alias("reference_score"))
    return attach(candidates, reference, [prompt])
