"""Verifiers, reward combination, group statistics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from rollweave.functions import latex
from rollweave.functions import verifiers as v
from rollweave.operators import rewards as g
from rollweave.plans.inputs import rollouts
from rollweave.plans.registry import check
from rollweave.plans.sqltext import ROLLOUTS, strip

PUNCT = r"[!-/:-@\[-`{-~]"


def norm(text: str) -> str:
    """Twin of the answer normalisation, by words instead of boundaries."""
    return rf"array_to_string(list_filter(string_split_regex(regexp_replace(lower({text}), '{PUNCT}', '', 'g'), '\s+'), lambda w: w NOT IN ('', 'a', 'an', 'the')), ' ')"


@check(
    "joined_rollouts",
    "G1",
    f"""WITH {ROLLOUTS} SELECT prompt_id, sample, reward, o_orderstatus AS verifier, o_totalprice AS truth FROM rollouts JOIN orders ON o_orderkey = prompt_id""",
)
def joined_rollouts(t):
    prompts = t.orders.select(F.col("o_orderkey").alias("prompt_id"), F.col("o_orderstatus").alias("verifier"), F.col("o_totalprice").alias("truth"))
    return g.join_rollouts(prompts, rollouts(t).select("prompt_id", "sample", "reward"), "prompt_id")


@check(
    "guarded_rollouts",
    "G1",
    """SELECT conv_id, turn FROM conversations JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) USING (conv_id) WHERE n = 4""",
)
def guarded_rollouts(t):
    four = t.conversations.groupBy("conv_id").agg(F.count("*").alias("n")).where("n = 4").select("conv_id")
    results = t.conversations.select("conv_id", "turn").join(four, "conv_id", "left_semi")
    return g.join_rollouts(four, results, "conv_id", samples=4)


def _answers(t):
    """Documents as predictions of several verifiers at once; truths agree for part of them."""
    i = F.col("doc_id")
    k = i % 3
    quality = F.coalesce("quality", F.lit(2)).cast("string")
    last = F.when(i % 2 == 0, quality).otherwise(F.lit("1"))
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id",
        "source",
        F.concat("text", F.lit(" so 9 The answer is: The  Ca-t"), k.cast("string"), F.lit(" 1,23"), last).alias("prediction"),
        F.array(F.concat(F.lit("123"), k.cast("string")), F.concat(F.lit("a cat"), quality, F.lit(" 123"), last), F.lit("x"), F.lit("")).alias("ground_truth"),
        F.array(F.lit("GSM8K"), F.lit("flan"), F.lit("unknown"), F.lit("passthrough")).alias("dataset"),
    )


ANSWERS = r"""p AS (SELECT doc_id, source, coalesce(quality, 2) AS q, doc_id % 3 AS k FROM documents LEFT JOIN labels USING (doc_id)),
    s AS (SELECT *, 10.0 * CASE WHEN doc_id % 2 = 0 THEN CASE WHEN q = k THEN 1 ELSE 0 END ELSE CASE WHEN k = 1 THEN 1 ELSE 0 END END AS gsm, 10.0 * CASE WHEN q = k THEN 1 ELSE 0 END AS flan FROM p)"""


@check(
    "scored_rewards",
    "G2 G3 G17",
    f"""WITH {ANSWERS} SELECT doc_id, gsm::DOUBLE AS gsm8k, flan::DOUBLE AS flan, 0.0::DOUBLE AS passthrough, (gsm + flan)::DOUBLE AS reward FROM s""",
)
def scored_rewards(t):
    out = g.score_rewards(_answers(t), v.build_verifiers(names=["gsm8k", "flan", "math", "passthrough"]), "prediction")
    return out.select("doc_id", *[F.col("per_verifier")[n].alias(n) for n in ("gsm8k", "flan", "passthrough")], "reward")


@check(
    "reward_metrics",
    "G21",
    f"""WITH {ANSWERS}, l AS (SELECT 'verifiable' AS verifier, gsm + flan AS x FROM s UNION ALL SELECT 'gsm8k', gsm FROM s UNION ALL SELECT 'flan', flan FROM s UNION ALL SELECT 'passthrough', 0 FROM s)
    SELECT verifier, round(avg(x), 9)::DOUBLE AS mean_reward, round(avg(CASE WHEN x > 0 THEN 1.0 ELSE 0 END), 9)::DOUBLE AS correct_rate FROM l GROUP BY 1""",
)
def reward_metrics(t):
    out = g.reward_metrics(g.score_rewards(_answers(t), v.build_verifiers(names=["gsm8k", "flan", "math", "passthrough"]), "prediction"))
    return out.select("verifier", F.round("mean_reward", 9).alias("mean_reward"), F.round("correct_rate", 9).alias("correct_rate"))


@check(
    "remapped_verifier",
    "G3",
    f"""SELECT doc_id, (CASE WHEN {norm("text || ' yes'")} = {norm("CASE WHEN doc_id % 2 = 0 THEN 'The ' || text || ' YES!' ELSE 'no' END")} THEN 1.0 ELSE 0.0 END)::DOUBLE AS reward FROM documents""",
)
def remapped_verifier(t):
    truth = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("The "), "text", F.lit(" YES!"))).otherwise(F.lit("no"))
    rows = t.documents.select("doc_id", F.concat("text", F.lit(" yes")).alias("p"), F.array(truth).alias("ground_truth"), F.array(F.lit("mine")).alias("dataset"))
    return g.score_rewards(rows, v.build_verifiers("mine=puzzle", ["puzzle", "string_f1"]), "p", mult=1.0).select("doc_id", "reward")


@check(
    "custom_verifiers",
    "L2 G2",
    """SELECT doc_id, round(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 2.0 * starts_with(text, substr(text, 1, doc_id % 5))::INT END
        + CASE WHEN doc_id % 3 = 1 THEN 0 ELSE 0.5 * (least(length(text) / 500.0, 1.0) + least(length(text) / 5000.0, 1.0)) END, 6)::DOUBLE AS reward FROM documents""",
)
def custom_verifiers(t):
    """Two rules of the caller's: an expression with weight 2, and a ``pandas_udf`` with weight a half, called for two labels."""

    @F.pandas_udf("array<double>")
    def share_of(texts: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([[min(len(text) / float(m), 1.0) for m in limits] for text, limits in zip(texts, most)])

    v.register_verifier("opens_with", lambda s: F.startswith(s.prediction, s.label).cast("double"), 2.0)
    v.register_verifier("Long_Enough", lambda s: share_of(s.prediction, s.label), 0.5, by_row=True)
    none = F.array().cast("array<string>")
    first, second = F.col("doc_id") % 3 != 0, F.col("doc_id") % 3 != 1
    either = lambda wide, opens: F.concat(
        F.when(second, F.array(wide[0])).otherwise(none), F.when(first, F.array(opens)).otherwise(none), F.when(second, F.array(wide[1])).otherwise(none)
    )
    truth = either((F.lit("500"), F.lit("5000")), F.substr("text", F.lit(1), (F.col("doc_id") % 5).cast("int")))
    names = either((F.lit("long_enough"), F.lit("LONG_ENOUGH")), F.lit("opens_with"))
    rows = t.documents.select("doc_id", "text", truth.alias("ground_truth"), names.alias("dataset"))
    scored = g.score_rewards(rows, v.build_verifiers(names=["opens_with", "long_enough"]), "text", mult=1.0)
    return scored.select("doc_id", F.round("reward", 6).alias("reward"))


def _score(rows, rule, prediction, label, tokens=None, **config):
    sample = v.Sample(F.col(prediction), F.col(label), F.col(tokens) if tokens else F.lit(0), config)
    return rule(sample)


@check(
    "last_number",
    "G4",
    r"""WITH p AS (SELECT doc_id, text || CASE doc_id % 6 WHEN 0 THEN ' it is -3' WHEN 1 THEN ' is +7.' WHEN 2 THEN ' so -3.5!' WHEN 3 THEN ' 1,234,567' WHEN 4 THEN ' \boxed{-3}' ELSE ' x.5' END AS p,
      CASE doc_id % 6 WHEN 0 THEN '-3' WHEN 1 THEN '+7' WHEN 2 THEN '-3.5' WHEN 3 THEN '1234567' WHEN 4 THEN '3' ELSE '.5' END AS l FROM documents)
    SELECT doc_id, CASE WHEN coalesce(list_last(regexp_extract_all(regexp_replace(p, '([0-9]),([0-9])', '\1\2', 'g'), '[-+]?(?:[0-9]*\.[0-9]+|[0-9]+)')), p) = l THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM p""",
)
def last_number(t):
    i = F.col("doc_id") % 6
    tails = [" it is -3", " is +7.", " so -3.5!", " 1,234,567", " \\boxed{-3}", " x.5"]
    labels = ["-3", "+7", "-3.5", "1234567", "3", ".5"]
    pick = lambda options: F.element_at(F.array(*[F.lit(o) for o in options]), (i + 1).cast("int"))
    rows = t.documents.select("doc_id", F.concat("text", pick(tails)).alias("p"), pick(labels).alias("l"))
    return rows.select("doc_id", _score(rows, v.gsm8k, "p", "l").alias("score"))


MATH_CASES = [
    (" so \\boxed{\\frac{1}{2}} done", "0.5", 1.0, 0.0),
    (" \\boxed{1} then \\boxed{x^{2}+1}", "x^{2} + 1", 1.0, 0.0),
    (" Final Answer: The final answer is $42$. I hope it is correct.", "42", 1.0, 1.0),
    (" we get $3$ and so $7$ end", "7", 1.0, 0.0),
    (" \\boxed 9 $ tail", "9", 1.0, 0.0),
    (" Final Answer: The final answer is $\\frac12$. I hope it is correct.", "1/2", 1.0, 1.0),
    (" \\boxed{\\sqrt2}", "\\sqrt{2}", 1.0, 0.0),
    (" \\boxed{5\\%}", "6", 0.0, 0.0),
    (" \\fbox{5}", "5", 0.0, 0.0),
]


def _math_sql() -> str:
    rows = ", ".join(f"({i}, {strict}, {full})" for i, (_, _, full, strict) in enumerate(MATH_CASES))
    return f"WITH c(k, strict, full_score) AS (VALUES {rows}) SELECT doc_id, full_score::DOUBLE AS math, strict::DOUBLE AS strict_math FROM documents JOIN c ON k = doc_id % {len(MATH_CASES)}"


@check("latex_answers", "G5 G6", _math_sql())
def latex_answers(t):
    i = (F.col("doc_id") % len(MATH_CASES) + 1).cast("int")
    pick = lambda j: F.element_at(F.array(*[F.lit(c[j]) for c in MATH_CASES]), i)
    rows = t.documents.select("doc_id", F.concat(F.translate("text", "$=", ""), pick(0)).alias("p"), pick(1).alias("l"))
    return rows.select("doc_id", _score(rows, v.math, "p", "l").alias("math"), _score(rows, v.strict_math, "p", "l").alias("strict_math"))


CANON = [
    ("\\frac{1}{2}", "\\frac{1}{2}"), ("\\frac 1 2", "\\frac{1}{2}"), ("  \\frac{1}{2}  ", "\\frac{1}{2}"), ("\\left(\\frac{1}{2}\\right)", "(\\frac{1}{2})"),
    ("50\\%", "50"), ("0.5", "\\frac{1}{2}"), ("\\tfrac{3}{4}", "\\frac{3}{4}"), ("\\sqrt2", "\\sqrt{2}"), ("1 + 2", "1+2"), ("k = 7", "7"), (".25", "0.25"),
    ("3/4", "\\frac{3}{4}"), ("5\\text{ cm}", "5"), ("\\frac12x", "\\frac{1}{2}x"),
]


@check(
    "latex_canonical_forms",
    "G5",
    f"WITH c(k, want) AS (VALUES {', '.join(f'({i}, $${w}$$)' for i, (_, w) in enumerate(CANON))}) SELECT doc_id, want AS canonical FROM documents JOIN c ON k = doc_id % {len(CANON)}",
)
def latex_canonical_forms(t):
    raw = F.element_at(F.array(*[F.lit(r) for r, _ in CANON]), (F.col("doc_id") % len(CANON) + 1).cast("int"))
    return t.documents.select("doc_id", latex.canonical(raw).alias("canonical"))


@check(
    "text_matchers",
    "G7 G8 G9",
    f"""WITH p AS (SELECT doc_id, text, doc_id % 2 = 0 AS same FROM documents)
    SELECT doc_id, CASE WHEN same OR {norm('text')} = 'no' THEN 1.0 ELSE 0.0 END::DOUBLE AS flan, CASE WHEN same AND doc_id % 3 <> 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS string_matcher, CASE WHEN same THEN 1.0 ELSE 0.0 END::DOUBLE AS puzzle FROM p""",
)
def text_matchers(t):
    same = F.col("doc_id") % 2 == 0
    rows = t.documents.select(
        "doc_id",
        F.concat(F.lit("hm The answer is: x The answer is: The "), "text", F.lit(" !")).alias("f"),
        F.concat(F.when(F.col("doc_id") % 3 != 0, F.lit("<answer>no</answer>")).otherwise(F.lit("")), F.lit("<answer> a "), "text", F.when(F.col("doc_id") % 3 != 0, F.lit("</answer> z")).otherwise(F.lit(""))).alias("m"),
        F.concat(F.lit("<|assistant|>go</think> <answer>"), "text", F.lit("</answer>")).alias("z"),
        F.when(same, F.col("text")).otherwise(F.lit("no")).alias("l"),
    )
    return rows.select(
        "doc_id", _score(rows, v.flan, "f", "l").alias("flan"), _score(rows, v.string_matcher, "m", "l").alias("string_matcher"), _score(rows, v.puzzle, "z", "l").alias("puzzle")
    )


F1_SQL = f"""m AS MATERIALIZED (SELECT count(*) AS m FROM benchmark), k AS MATERIALIZED (SELECT doc_id, text AS p, doc_id % m AS item_id FROM documents, m),
    b AS MATERIALIZED (SELECT k.doc_id, k.p, bb.text AS l FROM k JOIN benchmark bb USING (item_id)),
    w AS MATERIALIZED (SELECT doc_id, string_split({norm('p')}, ' ') AS pw, string_split({norm('l')}, ' ') AS lw FROM b),
    pc AS MATERIALIZED (SELECT doc_id, x AS tok, count(*) AS n FROM (SELECT doc_id, unnest(pw) AS x FROM w) WHERE x <> '' GROUP BY 1, 2), lc AS MATERIALIZED (SELECT doc_id, x AS tok, count(*) AS n FROM (SELECT doc_id, unnest(lw) AS x FROM w) WHERE x <> '' GROUP BY 1, 2),
    c AS (SELECT doc_id, sum(least(pc.n, lc.n)) AS same FROM pc JOIN lc USING (doc_id, tok) GROUP BY 1), np AS (SELECT doc_id, sum(n) AS n FROM pc GROUP BY 1), nl AS (SELECT doc_id, sum(n) AS n FROM lc GROUP BY 1),
    f AS (SELECT w.doc_id, coalesce(2.0 * (same / np.n) * (same / nl.n) / (same / np.n + same / nl.n), 0) AS f1 FROM w LEFT JOIN c USING (doc_id) LEFT JOIN np USING (doc_id) LEFT JOIN nl USING (doc_id))"""


def _against_benchmark(t):
    """Each document next to one benchmark item; the item table is small by its own purpose, but is not broadcast by hint."""
    items = t.benchmark.select("item_id", F.col("text").alias("l"))
    count = t.benchmark.agg(F.count("*").alias("n"))
    docs = t.documents.select("doc_id", F.col("text").alias("p")).crossJoin(F.broadcast(count)).withColumn("item_id", F.col("doc_id") % F.col("n"))
    return docs.join(items, "item_id").select("doc_id", "p", "l")


@check("token_f1", "G10", f"WITH {F1_SQL} SELECT doc_id, round(f1, 9)::DOUBLE AS score FROM f")
def token_f1(t):
    rows = _against_benchmark(t)
    return rows.select("doc_id", F.round(_score(rows, v.string_f1, "p", "l"), 9).alias("score"))


@check(
    "finish_tag_f1",
    "G11",
    f"""WITH {F1_SQL} SELECT doc_id, round(CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE CASE WHEN f1 = 0 THEN 0.1 ELSE f1 END END, 9)::DOUBLE AS score FROM f""",
)
def finish_tag_f1(t):
    i = F.col("doc_id") % 4
    rows = _against_benchmark(t)
    tagged = F.when(i == 0, F.col("p")).when(i == 1, F.lit("x<finish></finish>")).when(i == 2, F.concat("p", F.lit("</finish> y"))).otherwise(F.concat(F.lit("<finish>"), "p", F.lit("</finish>")))
    rows = rows.select("doc_id", tagged.alias("t"), F.when(i == 3, F.to_json(F.array("l", F.lit("zzz")))).otherwise(F.col("l")).alias("labels"))
    return rows.select("doc_id", F.round(_score(rows, v.re_search_f1, "t", "labels"), 9).alias("score"))


@check("finish_tag_match", "G12", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM documents")
def finish_tag_match(t):
    i = F.col("doc_id") % 3
    text = F.regexp_replace("text", r"[\"\\\[]", " ")
    rows = t.documents.select(
        "doc_id",
        F.when(i == 2, text).otherwise(F.concat(F.lit("a <FINISH> The "), text, F.lit(" </finish> <finish>no</finish>"))).alias("p"),
        F.when(i == 0, F.to_json(F.array(F.lit("other"), text))).otherwise(F.lit('["zzz"]')).alias("l"),
    )
    return rows.select("doc_id", _score(rows, v.re_search, "p", "l").alias("score"))


@check(
    "length_scores",
    "G13",
    """SELECT doc_id, round(1 - abs(n_chars - 1000) / 4000.0, 9)::DOUBLE AS max_length, round(CASE WHEN n_chars < 1000 THEN 1 ELSE 1 - (n_chars - 1000) / 4000.0 END, 9)::DOUBLE AS up_to FROM documents""",
)
def length_scores(t):
    rows = t.documents.select("doc_id", "n_chars", F.lit("1000").alias("l"))
    score = lambda rule: F.round(_score(rows, rule, "l", "l", "n_chars", max_length=4000), 9)
    return rows.select("doc_id", score(v.max_length).alias("max_length"), score(v.up_to_max_length).alias("up_to"))


@check(
    "recorded_test_outcomes",
    "G16",
    """WITH o AS (SELECT l_orderkey AS sample_id, l_quantity >= 20 AS passed, l_tax AS rt FROM lineitem), a AS (SELECT sample_id, avg(CASE WHEN passed THEN 1.0 ELSE 0 END) AS r, avg(CASE WHEN passed THEN (0.1 - rt) / 0.1 ELSE 0 END) AS s FROM o GROUP BY 1)
    SELECT sample_id, round(r, 9)::DOUBLE AS pass_rate, round(CASE WHEN r < 0.5 THEN 0 ELSE r END, 9)::DOUBLE AS score, round(CASE WHEN r < 0.5 THEN 0 ELSE s END, 9)::DOUBLE AS penalised FROM a""",
)
def recorded_test_outcomes(t):
    outcomes = t.lineitem.select(F.col("l_orderkey").alias("sample_id"), (F.col("l_quantity") >= 20).alias("passed"), F.col("l_tax").alias("rt"))
    plain = g.code_scores(outcomes, "sample_id", "passed", "rt", 0.5)
    slow = g.code_scores(outcomes, "sample_id", "passed", "rt", 0.5, penalty=True, limit=0.1).select("sample_id", F.round("score", 9).alias("penalised"))
    return plain.select("sample_id", F.round("pass_rate", 9).alias("pass_rate"), F.round("score", 9).alias("score")).join(slow, "sample_id")


@check(
    "turn_rewards",
    "G18",
    f"""WITH {ROLLOUTS}, a AS (SELECT prompt_id, list(reward ORDER BY sample) AS r FROM rollouts GROUP BY 1)
    SELECT prompt_id, r[-1] + 5 AS last, round(list_sum(r) + 5, 6) AS sum, 7.0::DOUBLE AS alone FROM a""",
)
def turn_rewards(t):
    arrays = rollouts(t).groupBy("prompt_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("sample", "reward"))), lambda s: s["reward"]).alias("r"))
    none = F.array().cast("array<double>")
    return arrays.select(
        "prompt_id",
        g.aggregate_turn_rewards("r", F.lit(5.0), "last").alias("last"),
        F.round(g.aggregate_turn_rewards("r", F.lit(5.0), "sum"), 6).alias("sum"),
        g.aggregate_turn_rewards(none, F.lit(7.0), "last").alias("alone"),
    )


@check(
    "format_rewards",
    "G19",
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 2.0 ELSE 0.0 END::DOUBLE AS score FROM documents",
)
def format_rewards(t):
    i = F.col("doc_id") % 3
    text = F.when(i == 0, F.concat("text", F.lit("</think>\n <answer>\n"), "text", F.lit("</answer> z"))).when(i == 1, F.concat(F.lit("<answer>x</answer></think>"), "text")).otherwise(F.col("text"))
    return t.documents.select("doc_id", v.format_reward(text, 2.0).alias("score"))


@check(
    "combined_rewards",
    "G20",
    """WITH e AS (SELECT event_id, value AS r, event_id % 2 = 0 AS formed, user_id % 3 = 0 AS called, event_type <> 'error' AS fine, CASE WHEN event_type = 'view' THEN 'length' ELSE 'stop' END AS reason FROM events)
    SELECT event_id, CASE WHEN reason <> 'stop' THEN -10 WHEN called AND fine THEN CASE WHEN formed THEN r ELSE 0 END ELSE CASE WHEN formed THEN 1 ELSE 0 END END::DOUBLE AS gated, round(r + CASE WHEN formed THEN 1 ELSE 0 END, 6)::DOUBLE AS added, r AS plain FROM e""",
)
def combined_rewards(t):
    rows = t.events.select(
        "event_id",
        F.col("value").alias("reward"),
        F.when(F.col("event_id") % 2 == 0, F.lit("x</think><answer>y</answer>")).otherwise(F.lit("none")).alias("p"),
        (F.col("user_id") % 3 == 0).alias("tool_called"),
        F.lit("out").alias("tool_output"),
        F.lit(False).alias("timeout"),
        F.when(F.col("event_type") == "error", F.lit("bad")).alias("tool_error"),
        F.when(F.col("event_type") == "view", F.lit("length")).otherwise(F.lit("stop")).alias("finish_reason"),
    )
    gated = g.combine_rewards(rows, "p", use_format=True, only_good=True, non_stop_penalty=-10.0).withColumnRenamed("score", "gated").drop("format_score")
    added = g.combine_rewards(gated, "p", use_format=True, additive_format=True).withColumn("added", F.round("score", 6)).drop("score", "format_score")
    return g.combine_rewards(added, "p").select("event_id", "gated", "added", F.col("score").alias("plain"))


@check(
    "merged_metrics",
    "G22",
    """SELECT event_type AS metric, round(avg(value), 6) AS mean, arg_max(props, event_id) AS last_text, count(*) AS records FROM events GROUP BY 1""",
)
def merged_metrics(t):
    rows = t.events.select(F.col("event_id").alias("step"), F.col("event_type").alias("metric"), F.col("value").alias("number"), F.col("props").alias("text"))
    return g.merge_metrics(rows).withColumn("mean", F.round("mean", 6))


@check(
    "group_advantages",
    "G23",
    f"""WITH {ROLLOUTS}, s AS (SELECT *, avg(reward) OVER w AS m, stddev_pop(reward) OVER w AS sd FROM rollouts WINDOW w AS (PARTITION BY prompt_id))
    SELECT prompt_id, sample, round((reward - m) / (sd + 1e-8), 5) AS standard, round(reward - m, 6) AS centered FROM s""",
)
def group_advantages(t):
    rows = rollouts(t).select("prompt_id", "sample", "reward")
    out = g.group_advantages(rows, "prompt_id", "reward").withColumn("standard", F.round("advantage", 5))
    return out.select("prompt_id", "sample", "standard", F.round(F.col("reward") - F.col("group_mean"), 6).alias("centered"))


@check(
    "advantage_recursion",
    "G24",
    f"""WITH RECURSIVE {ROLLOUTS}, a AS (SELECT prompt_id, sample, d AS v, reward / 50.0 AS r, CASE WHEN line = 3 THEN 1 ELSE 0 END AS done, CASE WHEN flag = 'A' THEN 0 ELSE 1 END AS m, count(*) OVER (PARTITION BY prompt_id) AS n FROM rollouts),
    rec AS (SELECT prompt_id, sample, v, r - v AS plain, r - v AS packed FROM a WHERE sample = n - 1
      UNION ALL SELECT a.prompt_id, a.sample, a.v, a.r + 0.9 * rec.v - a.v + 0.9 * 0.8 * rec.plain, a.r + 0.9 * rec.v * (1 - a.done) * a.m - a.v + 0.9 * 0.8 * rec.packed * (1 - a.done) * a.m
      FROM rec JOIN a ON a.prompt_id = rec.prompt_id AND a.sample = rec.sample - 1)
    SELECT prompt_id, sample, round(plain, 6) AS plain, round(packed, 6) AS packed, round(packed + v, 6) AS returns FROM rec""",
)
def advantage_recursion(t):
    item = F.struct("sample", F.col("d").alias("v"), (F.col("reward") / 50.0).alias("r"), F.when(F.col("line") == 3, 1).otherwise(0).alias("done"), F.when(F.col("flag") == "A", 0).otherwise(1).alias("m"))
    arrays = rollouts(t).groupBy("prompt_id").agg(F.sort_array(F.collect_list(item)).alias("x"))
    cols = [F.col(f"x.{k}") for k in ("v", "r", "done", "m")]
    both = arrays.select("prompt_id", "x", g.gae(0.9, 0.8)(*cols).alias("p"), g.gae(0.9, 0.8, packed=True)(*cols).alias("q"))
    parts = F.arrays_zip(F.col("p.advantages").alias("plain"), F.col("q.advantages").alias("packed"), F.col("q.returns").alias("returns"))
    return both.select("prompt_id", F.posexplode(parts).alias("sample", "z")).select("prompt_id", "sample", *[F.round(f"z.{c}", 6).alias(c) for c in ("plain", "packed", "returns")])


@check(
    "masked_means",
    "G25",
    """WITH m AS (SELECT vec_id, list_transform(embedding, lambda x, i: {'x': x::DOUBLE, 'm': CASE WHEN vec_id % 5 <> 0 AND (i - 1) % 3 = 0 THEN 1 ELSE 0 END}) AS z FROM embeddings)
    SELECT vec_id, round(coalesce(list_sum(list_transform(z, lambda q: q.x * q.m)) / nullif(list_sum(list_transform(z, lambda q: q.m)), 0), 0), 6) AS mean, round(list_sum(list_transform(z, lambda q: q.x * q.m)) / 10, 6) AS over_ten FROM m""",
)
def masked_means(t):
    mask = F.transform("embedding", lambda x, i: F.when((F.col("vec_id") % 5 != 0) & (i % 3 == 0), 1.0).otherwise(0.0))
    rows = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), mask.alias("m"))
    return rows.select("vec_id", F.round(g.masked_mean("x", "m"), 6).alias("mean"), F.round(g.masked_mean("x", "m", 10.0), 6).alias("over_ten"))
