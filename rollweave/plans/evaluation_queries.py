"""J: evaluation reporting."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import evaluation as e
from rollweave.plans.registry import check

YEARS = (1995, 1996, 1997)
CHECKPOINTS = "o AS (SELECT o_orderpriority AS metric, year(o_orderdate) AS step, round(avg(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2)"


def _checkpoints(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("metric"), F.year("o_orderdate").alias("step")).agg(F.round(F.avg("o_totalprice"), 2).alias("value"))


@check(
    "checkpoint_table",
    "J2",
    f"WITH {CHECKPOINTS} SELECT metric, " + ", ".join(f'max(value) FILTER (WHERE step = {y}) AS "{y}"' for y in YEARS) + " FROM o GROUP BY 1",
)
def checkpoint_table(t):
    return e.checkpoint_table(_checkpoints(t), ["metric"], "step", "value", list(YEARS))


@check(
    "baseline_deltas",
    "J3",
    f"WITH {CHECKPOINTS} SELECT a.metric, a.step::INTEGER AS step, a.value, b.value AS baseline, round(a.value - b.value, 2) AS delta FROM o a LEFT JOIN o b ON a.metric = b.metric AND b.step = 1995 WHERE a.step <> 1995",
)
def baseline_deltas(t):
    return e.delta_vs_baseline(_checkpoints(t), ["metric"], "step", "value", 1995)


@check(
    "instruction_accuracy",
    "J4",
    """WITH v AS (SELECT doc_id % 100 AS prompt_id, n_chars > 300 AS strict, n_chars > 100 AS loose FROM documents), p AS (SELECT prompt_id, bool_and(strict) AS s, bool_and(loose) AS l FROM v GROUP BY 1),
    r AS (SELECT (SELECT count(*) FROM p) AS num_prompts, (SELECT count(*) FROM v) AS num_instructions, (SELECT avg(s::INT) FROM p) AS a, (SELECT avg(strict::INT) FROM v) AS b, (SELECT avg(l::INT) FROM p) AS c, (SELECT avg(loose::INT) FROM v) AS d)
    SELECT num_prompts, num_instructions, round(a, 6) AS prompt_strict_accuracy, round(b, 6) AS instruction_strict_accuracy, round(c, 6) AS prompt_loose_accuracy, round(d, 6) AS instruction_loose_accuracy, round((a + b + c + d) / 4, 6) AS average_score FROM r""",
)
def instruction_accuracy(t):
    verdicts = t.documents.select((F.col("doc_id") % 100).alias("prompt_id"), (F.col("n_chars") > 300).alias("strict"), (F.col("n_chars") > 100).alias("loose"))
    out = e.instruction_accuracy(verdicts, "prompt_id", ["strict", "loose"])
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


@check("best_checkpoint", "J5", f"WITH {CHECKPOINTS} SELECT metric, first(step ORDER BY value DESC, step)::INTEGER AS best_step, max(value) AS best_value FROM o GROUP BY 1")
def best_checkpoint(t):
    return e.best_checkpoint(_checkpoints(t), ["metric"], "step", "value")


@check(
    "no_answer_rate",
    "J6",
    r"""WITH a AS (SELECT source, regexp_extract_all(text, '\d+')[1] AS answer, n_chars FROM documents)
    SELECT source, count(*) AS num_entries, round(avg(CASE WHEN answer IS NULL THEN 1.0 ELSE 0 END), 6)::DOUBLE AS no_answer, round(avg(CASE WHEN length(answer) = 1 THEN 1.0 ELSE 0 END), 6)::DOUBLE AS correct FROM a GROUP BY 1""",
)
def no_answer_rate(t):
    answer = F.get(F.regexp_extract_all("text", F.lit(r"\d+"), F.lit(0)), 0)
    rows = t.documents.select("source", answer.alias("answer")).withColumn("correct", F.length("answer") == 1)
    out = e.no_answer_rate(rows, "answer", "correct", ["source"])
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])
