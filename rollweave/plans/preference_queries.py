"""H: rejection sampling and preference data."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rollweave.functions.prompts import COMPARISON
from rollweave.operators import preferences as h
from rollweave.plans.inputs import flat, messages
from rollweave.plans.registry import check
from rollweave.plans.sqltext import MSGS
from rollweave.plans.sqltext import flat as sql_flat

# Completions of a conversation are its assistant turns; the reference is the last message.
CANDS = (
    MSGS + ", c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS cand, text AS body FROM conversations WHERE role = 'assistant'), "
    "base AS (SELECT c.conv_id, c.cand, c.body, m.messages[1:len(m.messages) - 1] AS prompt, m.messages[-1].content AS reference FROM c JOIN msgs m USING (conv_id)), "
    "cands AS (SELECT conv_id, cand, prompt, body, reference FROM base UNION ALL SELECT conv_id, 0, prompt, reference, reference FROM base WHERE cand = 1)"
)


def _completions(t):
    bodies = F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: m["content"])
    return h.explode_completions(messages(t).withColumn("completions", bodies), "conv_id")


@check(
    "exploded_completions",
    "H1",
    f"WITH {CANDS} SELECT conv_id, cand, {sql_flat('prompt')} || E'\\nassistant: ' || body AS text, body AS model_completion, reference AS reference_completion FROM cands WHERE cand > 0 AND len(prompt) > 0",
)
def exploded_completions(t):
    return _completions(t).select("conv_id", "cand", flat("messages").alias("text"), "model_completion", "reference_completion")


@check(
    "injected_reference",
    "H2",
    f"WITH {CANDS} SELECT conv_id, cand, {sql_flat('prompt')} || E'\\nassistant: ' || body AS text, body AS model_completion FROM cands",
)
def injected_reference(t):
    return h.inject_reference(_completions(t), "conv_id").select("conv_id", "cand", flat("messages").alias("text"), "model_completion")


# Scores: (order, line number) as candidate, the last digit of the supplier as model.
MODELS = ["m0", "m1", "m2"]
SCORES = """sc AS (SELECT l_orderkey AS prompt_id, l_linenumber - 1 AS cand, 'm' || (l_suppkey % 3) AS model, max(l_quantity) AS score FROM lineitem GROUP BY 1, 2, 3)"""


def _scores(t):
    model = F.concat(F.lit("m"), (F.col("l_suppkey") % 3).cast("string"))
    return t.lineitem.groupBy(F.col("l_orderkey").alias("prompt_id"), (F.col("l_linenumber") - 1).alias("cand"), model.alias("model")).agg(F.max("l_quantity").alias("score"))


@check(
    "scored_candidate_maps",
    "H3 H7",
    f"""WITH {SCORES}, m AS (SELECT prompt_id, cand, string_agg(model || '=' || score::BIGINT, ',' ORDER BY model) AS scores FROM sc GROUP BY 1, 2)
    SELECT a.prompt_id, a.cand, a.scores, r.scores AS reference FROM m a LEFT JOIN m r ON r.prompt_id = a.prompt_id AND r.cand = 0 WHERE a.cand <> 0""",
)
def scored_candidate_maps(t):
    scores = _scores(t)
    rows = h.score_candidates(scores.select("prompt_id", "cand").distinct(), scores, "prompt_id")
    text = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("long").cast("string"))), ",")
    return h.scored_candidates(rows).select("prompt_id", "cand", text("score").alias("scores"), text("reference_completion_score").alias("reference"))


@check(
    "reference_scores",
    "H3",
    """SELECT l_orderkey AS prompt_id, l_linenumber - 1 AS cand, max(l_quantity) AS score, first_value(CASE WHEN l_linenumber = 1 THEN max(l_quantity) END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS reference_score FROM lineitem GROUP BY 1, 2, l_linenumber""",
)
def reference_scores(t):
    scored = t.lineitem.groupBy(F.col("l_orderkey").alias("prompt_id"), (F.col("l_linenumber") - 1).alias("cand")).agg(F.max("l_quantity").alias("score"))
    return h.reference_scores(scored, "prompt_id")


@check(
    "best_and_worst",
    "H4",
    f"WITH {SCORES} SELECT prompt_id, model, first(cand ORDER BY score DESC, cand) AS best, first(cand ORDER BY score, cand) AS worst FROM sc GROUP BY 1, 2",
)
def best_and_worst(t):
    return h.best_worst(_scores(t), "prompt_id")


def _vote_sql(side: str) -> str:
    return f"""(SELECT prompt_id, CASE WHEN count(DISTINCT {side}) = count(*) THEN list({side} ORDER BY model)[(('0x' || substr(md5(concat('42-{side}', ':', prompt_id)), 1, 7))::BIGINT % 1048576) % count(*) + 1]
      ELSE (SELECT v.pick FROM (SELECT {side} AS pick, count(*) AS n, min(model) AS seen FROM bw b WHERE b.prompt_id = bw.prompt_id GROUP BY 1) v ORDER BY n DESC, seen LIMIT 1) END AS {side} FROM bw GROUP BY prompt_id)"""


@check(
    "majority_votes",
    "H5",
    f"""WITH {SCORES}, bw AS (SELECT prompt_id, model, first(cand ORDER BY score DESC, cand) AS best, first(cand ORDER BY score, cand) AS worst FROM sc GROUP BY 1, 2)
    SELECT prompt_id, best, worst FROM {_vote_sql('best')} JOIN {_vote_sql('worst')} USING (prompt_id)""",
)
def majority_votes(t):
    return h.majority_vote(h.best_worst(_scores(t), "prompt_id"), "prompt_id", MODELS)


@check(
    "preference_table",
    "H6",
    f"""WITH {CANDS}, s AS (SELECT *, length(body) AS score FROM cands), p AS (SELECT conv_id, first(cand ORDER BY score DESC, cand) AS best, first(cand ORDER BY score, cand) AS worst FROM s WHERE cand > 0 GROUP BY 1)
    SELECT conv_id, b.body AS chosen, w.body AS rejected, w.reference AS reference_completion, b.score::DOUBLE AS chosen_score, w.score::DOUBLE AS rejected_score, length(b.reference)::DOUBLE AS reference_score
    FROM p JOIN s b USING (conv_id) JOIN s w USING (conv_id) WHERE b.cand = best AND w.cand = worst""",
)
def preference_table(t):
    cands = h.inject_reference(_completions(t), "conv_id")
    scores = cands.select("conv_id", "cand", F.lit("m").alias("model"), F.length("model_completion").cast("double").alias("score"))
    scored = h.score_candidates(cands, scores, "conv_id")
    votes = h.majority_vote(h.best_worst(scores.where("cand > 0"), "conv_id"), "conv_id", ["m"])
    table = h.preference_table(scored, votes, "conv_id")
    last = lambda c: F.element_at(c, -1)["content"]
    return table.select(
        "conv_id",
        last("chosen").alias("chosen"),
        last("rejected").alias("rejected"),
        "reference_completion",
        F.col("chosen_score")["m"].alias("chosen_score"),
        F.col("rejected_score")["m"].alias("rejected_score"),
        F.col("reference_completion_score")["m"].alias("reference_score"),
    )


PAIRED = f"WITH {CANDS}, p AS (SELECT a.conv_id, a.cand AS cand_a, b.cand AS cand_b, a.prompt, a.body AS x, b.body AS y FROM cands a JOIN cands b ON a.conv_id = b.conv_id AND a.cand < b.cand)"


@check("candidate_pairs", "H8", f"{PAIRED} SELECT conv_id, cand_a, cand_b, x AS body_a, y AS body_b FROM p")
def candidate_pairs(t):
    pairs = h.pairwise_comparisons(h.inject_reference(_completions(t), "conv_id"), "conv_id", 4)
    last = lambda c: F.element_at(c, -1)["content"]
    return pairs.select("conv_id", "cand_a", "cand_b", last("messages_a").alias("body_a"), last("messages_b").alias("body_b"))


FLIP = "(('0x' || substr(md5(concat('42', ':', conv_id, ':', cand_a, ':', cand_b)), 1, 7))::BIGINT % 2) = 1"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@check(
    "comparisons",
    "H9",
    f"""{PAIRED}, f AS (SELECT *, {FLIP} AS flipped FROM p), g AS (SELECT *, CASE WHEN length(CASE WHEN flipped THEN y ELSE x END) >= length(CASE WHEN flipped THEN x ELSE y END) THEN '0' ELSE '1' END AS preferred FROM f)
    SELECT conv_id, cand_a, cand_b, flipped, preferred, 'longer is better' AS comparison, replace(replace(replace({_quoted(COMPARISON)}, '{{{{task}}}}', {sql_flat('prompt')}), '{{{{response0}}}}', CASE WHEN flipped THEN y ELSE x END), '{{{{response1}}}}', CASE WHEN flipped THEN x ELSE y END) AS prompt,
      CASE WHEN (preferred = '1') <> flipped THEN y ELSE x END AS chosen, CASE WHEN (preferred = '1') <> flipped THEN x ELSE y END AS rejected FROM g""",
)
def comparisons(t):
    pairs = h.pairwise_comparisons(h.inject_reference(_completions(t), "conv_id"), "conv_id", 4)
    asked = h.comparison_prompts(pairs, "conv_id")
    last = lambda c: F.element_at(c, -1)["content"]
    a, b = F.length(last("messages_a")), F.length(last("messages_b"))
    first_longer = F.when(F.col("flipped"), b >= a).otherwise(a >= b)
    judged = asked.withColumn("judgement", F.concat(F.lit("Comparison: longer is better\nPreferred: "), F.when(first_longer, "0").otherwise("1")))
    out = h.apply_comparisons(judged)
    return out.select("conv_id", "cand_a", "cand_b", "flipped", "preferred", "comparison", F.col("comparison_prompt").alias("prompt"), last("chosen").alias("chosen"), last("rejected").alias("rejected"))


REPORT = """count(*) FILTER (WHERE a > b) / count(*) AS accuracy, avg(CASE WHEN a > b THEN ln(1 + exp(b - a)) ELSE b - a + ln(1 + exp(a - b)) END) AS loss, avg(a) AS chosen_rewards, avg(b) AS rejected_rewards, avg(a - b) AS reward_margin"""


@check(
    "reward_model_report",
    "H10",
    f"""WITH p AS (SELECT l_quantity AS a, l_tax * 500 AS b, l_orderkey % 50 AS k FROM lineitem), r AS (SELECT 'rows' AS kind, {REPORT} FROM p UNION ALL SELECT 'batches', avg(accuracy), avg(loss), avg(chosen_rewards), avg(rejected_rewards), avg(reward_margin) FROM (SELECT k, {REPORT} FROM p GROUP BY k))
    SELECT kind, round(accuracy, 6) AS accuracy, round(loss, 6) AS loss, round(chosen_rewards, 6) AS chosen_rewards, round(rejected_rewards, 6) AS rejected_rewards, round(reward_margin, 6) AS reward_margin FROM r""",
)
def reward_model_report(t):
    pairs = t.lineitem.select(F.col("l_quantity").alias("a"), (F.col("l_tax") * 500).alias("b"), (F.col("l_orderkey") % 50).alias("k"))
    rows = h.reward_model_report(pairs, "a", "b").withColumn("kind", F.lit("rows"))
    both = rows.unionByName(h.reward_model_report(pairs, "a", "b", "k").withColumn("kind", F.lit("batches")))
    return both.select("kind", *[F.round(c, 6).alias(c) for c in both.columns if c != "kind"])
