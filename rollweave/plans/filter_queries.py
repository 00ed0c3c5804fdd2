"""E: filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import filters as f
from rollweave.operators import tokens as k
from rollweave.plans.inputs import messages, preference_pairs, rollouts, tokenizer
from rollweave.plans.registry import check
from rollweave.plans.sqltext import PAIRS, ROLLOUTS, VOCAB, MSGS, tagged, tokens
from rollweave.plans.token_queries import CHOSEN_SQL, PROMPT_SQL, REJECTED_SQL

LENGTHS = f"""{MSGS}, n AS (SELECT conv_id, len({tokens(tagged('messages', False))}) AS total, len({tokens(tagged('prompt', True))}) AS prompt
    FROM (SELECT conv_id, messages, {PROMPT_SQL} AS prompt FROM msgs))"""


@check("sft_filter", "E1", f"WITH {LENGTHS} SELECT conv_id FROM n WHERE total <= 300 AND prompt <= 250 AND total > prompt")
def sft_filter(t):
    rows = k.tokenize_sft_masked(messages(t), tokenizer(t), "conv_id")
    return f.filter_sft(rows, 250, 300).select("conv_id")


@check(
    "preference_filter",
    "E2",
    f"""WITH {PAIRS}, n AS (SELECT conv_id, len({tokens(tagged('prompt', True))}) AS p, len({tokens(tagged('chosen', False))}) AS c, len({tokens(tagged('rejected', False))}) AS r
      FROM (SELECT conv_id, prompt, {CHOSEN_SQL} AS chosen, {REJECTED_SQL} AS rejected FROM pairs))
    SELECT conv_id FROM n WHERE p <= 260 AND c <= 320 AND r <= 320""",
)
def preference_filter(t):
    rows = k.tokenize_preference(preference_pairs(t).select("conv_id", "chosen", "rejected"), tokenizer(t), "conv_id", "plain")
    return f.filter_preference(rows, 260, 320).select("conv_id")


@check(
    "verifiable_filter",
    "E3",
    f"WITH {LENGTHS} SELECT conv_id, 'short' AS kind FROM n WHERE prompt <= 150 UNION ALL SELECT conv_id, 'all' FROM n UNION ALL SELECT conv_id, 'first' FROM n WHERE total <= 300 AND prompt <= 250",
)
def verifiable_filter(t):
    rows = k.tokenize_sft(messages(t), tokenizer(t), "conv_id")
    kind = lambda df, name: df.select("conv_id", F.lit(name).alias("kind"))
    out = kind(f.filter_rlvr(rows, 150), "short").unionByName(kind(f.filter_rlvr(rows), "all"))
    return out.unionByName(kind(f.filter_sft(rows, 250, 300), "first"))


@check("long_prompts", "E4", f"WITH {MSGS} SELECT conv_id FROM msgs WHERE len({tokens('messages[-1].content')}) <= 40")
def long_prompts(t):
    return f.filter_long_prompts(messages(t), 40).select("conv_id")


@check(
    "identical_completions",
    "E5",
    """WITH c AS (SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN 'same' ELSE text END AS text FROM conversations)
    SELECT conv_id, turn FROM c WHERE conv_id IN (SELECT conv_id FROM c GROUP BY conv_id HAVING count(DISTINCT text) > 1)""",
)
def identical_completions(t):
    rows = t.conversations.withColumn("text", F.when(F.col("conv_id") % 4 == 0, F.lit("same")).otherwise(F.col("text")))
    return f.filter_identical_completions(rows, "conv_id", "text").select("conv_id", "turn")


@check(
    "unsafe_programs",
    "E6",
    """SELECT doc_id FROM (SELECT doc_id, CASE doc_id % 11 WHEN 3 THEN 'import os' || text WHEN 5 THEN text || ' use multiprocessing' ELSE text END AS t FROM documents)
    WHERE NOT regexp_matches(t, 'threading|multiprocess|import os|from os|shutil|import torch|from torch|import sklearn|from sklearn')""",
)
def unsafe_programs(t):
    code = F.when(F.col("doc_id") % 11 == 3, F.concat(F.lit("import os"), "text")).when(F.col("doc_id") % 11 == 5, F.concat("text", F.lit(" use multiprocessing")))
    rows = t.documents.select("doc_id", code.otherwise(F.col("text")).alias("t"))
    return f.filter_unsafe_programs(rows, "t").select("doc_id")


@check(
    "zero_variance_groups",
    "E7",
    """WITH g AS (SELECT l_orderkey AS prompt_id, count(*) AS n, count(DISTINCT l_quantity) AS k, min(l_quantity) AS q FROM lineitem GROUP BY 1)
    SELECT prompt_id, n, CASE WHEN k > 1 THEN 'kept' WHEN q = 0 THEN 'zero' WHEN q = 50 THEN 'solved' ELSE 'nonzero' END AS kind FROM g""",
)
def zero_variance_groups(t):
    return f.classify_groups(t.lineitem.withColumnRenamed("l_orderkey", "prompt_id"), "prompt_id", "l_quantity", 50.0)


@check(
    "varied_rollouts",
    "E7",
    f"WITH {ROLLOUTS} SELECT prompt_id, sample, reward FROM rollouts WHERE prompt_id IN (SELECT prompt_id FROM rollouts GROUP BY 1 HAVING stddev_pop(reward) > 1e-9)",
)
def varied_rollouts(t):
    return f.filter_zero_variance_groups(rollouts(t), "prompt_id", "reward", 50.0).select("prompt_id", "sample", "reward")


@check(
    "unsolved_prompts",
    "E8",
    "SELECT o_orderkey AS prompt_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING avg(l_quantity) / 50.0 >= 0.6)",
)
def unsolved_prompts(t):
    prompts = t.orders.select(F.col("o_orderkey").alias("prompt_id"))
    return f.exclude_solved(prompts, t.lineitem.withColumnRenamed("l_orderkey", "prompt_id"), "prompt_id", "l_quantity", 50.0, 0.6)


@check("retention", "E9", "SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS kept, count(*) AS total, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 9) AS rate FROM orders")
def retention(t):
    reason = F.when(F.col("o_orderstatus") == "F", F.lit("stop")).otherwise(F.lit("length"))
    return f.retention(t.orders.select(reason.alias("finish_reason"))).withColumn("rate", F.round("rate", 9))


@check("finished_rows", "E9", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def finished_rows(t):
    reason = F.when(F.col("o_orderstatus") == "F", F.lit("stop")).otherwise(F.lit("length"))
    return f.filter_truncated(t.orders.withColumn("finish_reason", reason)).select("o_orderkey")


@check(
    "patched_empty_stops",
    "E10",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '1' WHEN doc_id % 4 = 2 THEN '' ELSE doc_id::VARCHAR END AS tokens, CASE WHEN doc_id % 4 = 2 THEN 0 ELSE 1 END AS masked, doc_id % 4 = 0 AS is_nan FROM documents""",
)
def patched_empty_stops(t):
    i = F.col("doc_id")
    rows = t.documents.select(
        "doc_id",
        F.when(i % 4 < 2, F.lit("stop")).otherwise(F.lit("length")).alias("finish_reason"),
        F.when(i % 2 == 0, F.array().cast("array<int>")).otherwise(F.array(i.cast("int"))).alias("response_tokens"),
        F.when(i % 2 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1))).alias("mask"),
        F.when(i % 2 == 0, F.array().cast("array<double>")).otherwise(F.array(F.lit(-0.5))).alias("logprobs"),
    )
    out = f.patch_empty_stop(rows, 1)
    nan = F.coalesce(F.isnan(F.get("logprobs", F.lit(0))), F.lit(False))
    return out.select("doc_id", F.array_join(F.col("response_tokens").cast("array<string>"), " ").alias("tokens"), F.size("mask").alias("masked"), nan.alias("is_nan"))
