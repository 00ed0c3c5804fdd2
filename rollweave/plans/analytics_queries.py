"""Rollout analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import analytics as a
from rollweave.operators.filters import classify_groups
from rollweave.operators.rewards import group_advantages
from rollweave.plans.inputs import rollouts
from rollweave.plans.registry import check
from rollweave.plans.sqltext import ROLLOUTS


def _rounded(df, digits: int = 6, keep: tuple = ()):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


@check(
    "token_weighted_metrics",
    "G26",
    """SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS l_discount, round(sum(l_tax * l_quantity) / sum(l_quantity), 6) AS l_tax,
      round(sum(l_quantity * l_tax * l_tax) / sum(l_quantity) - (sum(l_tax * l_quantity) / sum(l_quantity)) ** 2, 6) AS l_tax_var, sum(l_quantity) AS token_count FROM lineitem GROUP BY 1""",
)
def token_weighted_metrics(t):
    return _rounded(a.token_weighted_metrics(t.lineitem, "l_quantity", ["l_discount", "l_tax"], variance_of="l_tax", by=["l_returnflag"]))


@check("group_token_counts", "G27", "SELECT (o_orderkey // 8 * 8)::BIGINT AS group_start, round(sum(o_totalprice), 2) AS tokens FROM orders GROUP BY 1")
def group_token_counts(t):
    return _rounded(a.group_token_counts(t.orders, "o_orderkey", "o_totalprice", 8), 2)


VECS = """v AS (SELECT a.vec_id, a.embedding AS n, b.embedding AS o FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
    z AS (SELECT vec_id, n[i]::DOUBLE * 30 AS n, o[i]::DOUBLE AS o, CASE WHEN i % 3 = 0 THEN 0 ELSE 1 END AS m, i FROM v, range(1, 65) r(i))"""


def _vectors(t):
    nxt = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").cast("array<double>").alias("old"))
    new = F.transform("embedding", lambda x: x.cast("double") * 30)
    mask = F.transform("embedding", lambda x, i: F.when((i + 1) % 3 == 0, 0).otherwise(1))
    return t.embeddings.select("vec_id", new.alias("new"), mask.alias("mask")).join(nxt, "vec_id")


@check(
    "logprob_drift",
    "G28",
    f"""WITH {VECS}, d AS (SELECT *, n - o AS d, exp(n - o) AS r, exp(greatest(-10, least(10, n - o))) AS w FROM z WHERE m = 1)
    SELECT vec_id, round(avg(d), 5) AS divergence_linear, round(avg(d * d / 2), 5) AS divergence_square, round(avg(exp(-d) - 1 + d) / 1000, 5) AS divergence_exponential, round(avg(r * d) / 1000, 5) AS divergence_weighted,
      round(avg(least(w, 2.0)), 5) AS importance_weight, round(avg(CASE WHEN w > 2 THEN 1.0 ELSE 0 END), 5)::DOUBLE AS clip_fraction FROM d GROUP BY 1""",
)
def logprob_drift(t):
    out = a.logprob_drift(_vectors(t), "new", "old", "old", "mask", 2.0).drop("new", "old", "mask")
    scaled = out.withColumns({c: F.col(c) / 1000 for c in ("divergence_exponential", "divergence_weighted")})
    return _rounded(scaled, 5)


@check("clean_logprobs", "G28", f"WITH {VECS} SELECT vec_id, round(sum(CASE WHEN m = 0 OR i = 5 THEN 1.0 ELSE n END), 5) AS total FROM z GROUP BY 1")
def clean_logprobs(t):
    holed = F.transform("new", lambda x, i: F.when(i == 4, F.lit(float("nan"))).otherwise(x))
    cleaned = a.clean_logprobs(holed, "mask")
    return _vectors(t).select("vec_id", F.round(F.aggregate(cleaned, F.lit(0.0), lambda acc, x: acc + x), 5).alias("total"))


@check(
    "sequence_logprobs",
    "G29",
    f"""WITH {VECS}, s AS (SELECT vec_id, i, n, (i + 1) % 3 <> 0 AS loss, CASE WHEN i < 10 THEN 0 WHEN i < 20 THEN 1 ELSE 2 END AS seg FROM z WHERE i <= 63)
    SELECT vec_id, round(sum(CASE WHEN loss THEN n ELSE 0 END), 5) AS total, round(avg(n) FILTER (WHERE loss), 5) AS mean,
      round(sum(CASE WHEN loss AND seg = 0 THEN n ELSE 0 END), 5) AS s0, round(avg(n) FILTER (WHERE loss AND seg = 1), 5) AS m1, round(sum(CASE WHEN loss AND seg = 2 THEN n ELSE 0 END), 5) AS s2 FROM s GROUP BY 1""",
)
def sequence_logprobs(t):
    labels = F.transform("mask", lambda m: F.when(m == 0, F.lit(-100)).otherwise(F.lit(1)))
    rows = _vectors(t).select("vec_id", "new", labels.alias("labels"), F.array(F.lit(0), F.lit(10), F.lit(20), F.lit(64)).alias("cu"))
    sums = a.packed_sequence_logprobs("new", "labels", "cu")
    means = a.packed_sequence_logprobs("new", "labels", "cu", average=True)
    out = rows.select(
        "vec_id",
        a.sequence_logprob("new", "labels").alias("total"),
        a.sequence_logprob("new", "labels", average=True).alias("mean"),
        F.get(sums, F.lit(0)).alias("s0"),
        F.get(means, F.lit(1)).alias("m1"),
        F.get(sums, F.lit(2)).alias("s2"),
    )
    return _rounded(out, 5)


STEP = "prompt_id % 8"


@check(
    "batch_statistics",
    "G30",
    """WITH g AS (SELECT l_orderkey % 8 AS step, l_orderkey, count(DISTINCT l_quantity) AS k, min(l_quantity) AS q, avg(l_quantity) / 50 AS p, count(*) AS n, sum(l_linenumber) AS r FROM lineitem GROUP BY 1, 2)
    SELECT step, count(*) FILTER (WHERE k = 1) AS filtered_prompts, count(*) FILTER (WHERE k = 1 AND q = 0) AS filtered_prompts_zero, count(*) FILTER (WHERE k = 1 AND q = 50) AS filtered_prompts_solved,
      count(*) FILTER (WHERE k = 1 AND q NOT IN (0, 50)) AS filtered_prompts_nonzero, round(avg(p) FILTER (WHERE k > 1), 6) AS percent_solved_mean, count(*) FILTER (WHERE p >= 0.6) AS no_resampled_prompts,
      count(*) FILTER (WHERE k > 1) AS total_prompts, sum(n) FILTER (WHERE k > 1)::BIGINT AS prompt_tokens, sum(r) FILTER (WHERE k > 1)::BIGINT AS response_tokens FROM g GROUP BY 1""",
)
def batch_statistics(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("prompt_id"), "l_quantity", "l_linenumber")
    kinds = classify_groups(rows, "prompt_id", "l_quantity", 50.0).drop("n")
    sums = rows.groupBy("prompt_id").agg(
        (F.avg("l_quantity") / 50).alias("percent_solved"), F.count("*").alias("prompt_tokens"), F.sum("l_linenumber").alias("response_tokens")
    )
    groups = kinds.join(sums, "prompt_id").withColumns({"step": F.col("prompt_id") % 8, "excluded": F.col("percent_solved") >= 0.6})
    return _rounded(a.batch_statistics(groups, "step"))


@check("score_histogram", "G30 G31", "SELECT l_orderkey % 8 AS step, l_quantity AS score, count(*) AS n FROM lineitem GROUP BY 1, 2")
def score_histogram(t):
    return a.histogram(t.lineitem.select((F.col("l_orderkey") % 8).alias("step"), F.col("l_quantity").alias("score")), "step", "score")


@check(
    "step_metrics",
    "G31",
    f"""WITH {ROLLOUTS}, s AS (SELECT {STEP} AS step, CASE WHEN reward < 10 THEN 0 ELSE reward END AS score, tokens AS length, flag, reward - avg(reward) OVER (PARTITION BY prompt_id) AS adv, line, t FROM rollouts)
    SELECT step, round(avg(score), 6) AS scores, round(count(*) / 4000.0, 6)::DOUBLE AS real_batch_size_ratio, round(count(*) FILTER (WHERE score < 50) / count(*), 6) AS unsolved_batch_size_ratio, round(count(*) / 4.0, 6)::DOUBLE AS reward_groups,
      round(avg(length), 4) AS sequence_lengths, min(length) AS sequence_lengths_min, max(length) AS sequence_lengths_max, round(avg(length) FILTER (WHERE score = 0), 4) AS sequence_lengths_unsolved, round(avg(length) FILTER (WHERE score = 50), 4) AS sequence_lengths_solved,
      round(count(*) FILTER (WHERE flag = 'R') / count(*), 6) AS stop_rate, abs(round(avg(adv), 4)) AS advantages_mean, round(min(adv), 4) AS advantages_min, round(max(adv), 4) AS advantages_max, round(sum(line + line) / max(t + 1), 4) AS tokens_per_second FROM s GROUP BY 1""",
)
def step_metrics(t):
    rows = rollouts(t).drop("sample")
    rows = group_advantages(rows, "prompt_id", "reward", "centered").select(
        (F.col("prompt_id") % 8).alias("step"),
        F.when(F.col("reward") < 10, 0.0).otherwise(F.col("reward")).alias("score"),
        F.col("tokens").alias("length"),
        F.when(F.col("flag") == "R", F.lit("stop")).otherwise(F.lit("length")).alias("finish_reason"),
        "advantage",
        F.col("line").alias("prompt_tokens"),
        F.col("line").alias("response_tokens"),
        (F.col("t") + 1).alias("generation_time"),
    )
    out = a.step_metrics(rows, "step", 50.0, 4, 1000)
    fine = ("scores", "real_batch_size_ratio", "unsolved_batch_size_ratio", "reward_groups", "stop_rate")
    digits = lambda c: 6 if c in fine else 4
    out = out.select(*[F.round(c, digits(c)).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])
    return out.withColumn("advantages_mean", F.abs("advantages_mean"))


@check(
    "packed_ratio",
    "G31",
    "SELECT l_orderkey % 8 AS step, round(count(DISTINCT l_orderkey) / count(*), 6) AS packed_ratio FROM lineitem GROUP BY 1",
)
def packed_ratio(t):
    samples = t.lineitem.select((F.col("l_orderkey") % 8).alias("step"), "l_orderkey")
    return _rounded(a.packed_ratio(samples.dropDuplicates(["step", "l_orderkey"]), samples, "step"))


@check(
    "tool_statistics",
    "G32",
    """WITH n AS (SELECT count(DISTINCT user_id) AS n FROM events), g AS (SELECT coalesce(event_type, 'aggregate') AS tool_name, count(*) AS c, count(*) FILTER (WHERE value < 10) AS f, sum(value) AS s FROM events GROUP BY ROLLUP (event_type))
    SELECT tool_name, round(c / n, 6) AS avg_calls_per_rollout, round(f / c, 6) AS failure_rate, round(s / c, 6) AS avg_runtime FROM g, n UNION ALL SELECT 'search', 0, 0, 0""",
)
def tool_statistics(t):
    calls = t.events.select(F.col("event_type").alias("tool_name"), (F.col("value") >= 10).alias("success"), F.col("value").alias("runtime"))
    return _rounded(a.tool_statistics(calls, t.events.select("user_id").distinct(), ["search", "click"]))


@check(
    "env_metrics",
    "G33",
    """WITH e AS (SELECT event_id % 4 AS c, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
    l AS (SELECT 'unknown' AS env, 'k' AS key, k AS v FROM e WHERE c = 0 UNION ALL SELECT event_type, 'k', k FROM e WHERE c = 1 UNION ALL SELECT event_type, 'half', k / 2 FROM e WHERE c = 1
      UNION ALL SELECT event_type, unnest(['done', 'acc[0', 'r.s']), unnest([1, k, 2]) FROM e WHERE c = 1
      UNION ALL SELECT event_type, 'k', k FROM e WHERE c = 2 UNION ALL SELECT 'other', 'one', 1 FROM e WHERE c = 2)
    SELECT env, key, round(avg(v), 6) AS mean FROM l GROUP BY 1, 2""",
)
def env_metrics(t):
    k = F.get_json_object("props", "$.k").cast("int")
    c = F.col("event_id") % 4
    info = (
        F.when(c == 0, F.col("props"))
        .when(c == 1, F.format_string('{"env_name": "%s", "k": %d, "half": %.1f, "note": "x", "label": "12", "done": true, "acc[0": %d, "r.s": 2, "rxs": "2"}', "event_type", k, k / 2, k))
        .when(c == 2, F.format_string('{"env_metrics": {"%s": {"k": %d}, "other": {"one": 1}}}', "event_type", k))
        .otherwise(F.lit("{}"))
    )
    return _rounded(a.env_metrics(t.events.select(info.alias("info")), "info"))


@check(
    "evaluation_summary",
    "G34",
    """SELECT round(avg(o_totalprice), 4) AS scores, avg(length(o_orderpriority)) AS sequence_lengths, min(length(o_orderpriority))::INTEGER AS sequence_lengths_min, max(length(o_orderpriority))::INTEGER AS sequence_lengths_max,
      round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS stop_rate, round(sum(o_custkey + 2) / 4.0, 4)::DOUBLE AS tokens_per_second FROM orders""",
)
def evaluation_summary(t):
    rows = t.orders.select(
        F.col("o_totalprice").alias("score"),
        F.length("o_orderpriority").alias("length"),
        F.when(F.col("o_orderstatus") == "F", F.lit("stop")).otherwise(F.lit("length")).alias("finish_reason"),
        F.col("o_custkey").alias("prompt_tokens"),
        F.lit(2).alias("response_tokens"),
        F.lit(4.0).alias("generation_time"),
    )
    out = a.evaluation_summary(rows)
    return out.withColumns({"scores": F.round("scores", 4), "stop_rate": F.round("stop_rate", 6), "tokens_per_second": F.round("tokens_per_second", 4)})


@check(
    "sample_rows",
    "G34",
    "SELECT o_orderkey AS prompt, o_orderpriority AS response, o_totalprice AS score, o_orderstatus AS ground_truth, CASE WHEN o_orderstatus = 'F' THEN '[a, b]' ELSE 'all' END AS active_tools FROM orders",
)
def sample_rows(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("prompt"),
        F.concat(F.lit("<pad>"), "o_orderpriority", F.lit("<pad>")).alias("response"),
        F.col("o_totalprice").alias("score"),
        F.col("o_orderstatus").alias("ground_truth"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("a"), F.lit("b"))).alias("active_tools"),
    )
    return a.sample_table(rows)


@check(
    "run_summary",
    "G35",
    """WITH b AS (SELECT l_orderkey % 50 AS b, sum(l_quantity) AS g, sum(l_tax) AS w, sum(l_linenumber) AS n FROM lineitem GROUP BY 1)
    SELECT count(*) AS total_batches, round(sum(g), 3) AS total_generation_time, round(sum(w), 3) AS total_weight_sync_time, sum(n)::BIGINT AS total_tokens, round(sum(n) / sum(g), 6) AS avg_tokens_per_second,
      round(avg(g), 4) AS avg_generation_time, round(avg(w), 4) AS avg_weight_sync_time, round(100 * sum(g) / (sum(g) + sum(w)), 4) AS generation_time_percentage, round(100 * sum(w) / (sum(g) + sum(w)), 4) AS weight_sync_time_percentage FROM b""",
)
def run_summary(t):
    batches = t.lineitem.groupBy((F.col("l_orderkey") % 50).alias("b")).agg(
        F.sum("l_quantity").alias("generation_time"), F.sum("l_tax").alias("weight_sync_time"), F.sum("l_linenumber").alias("num_new_tokens")
    )
    out = a.run_summary(batches)
    digits = {"total_generation_time": 3, "total_weight_sync_time": 3, "avg_tokens_per_second": 6}
    return out.select(*[F.round(c, digits.get(c, 4)).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


@check("finish_reasons", "G35", "SELECT o_orderstatus AS finish_reason, count(*) AS n FROM orders GROUP BY 1")
def finish_reasons(t):
    return a.reason_counts(t.orders.withColumnRenamed("o_orderstatus", "finish_reason"))


@check(
    "length_percentiles",
    "G36",
    "SELECT " + ", ".join(f"round(quantile_cont(n_chars, {p / 100}), 6) AS p{p}" for p in a.PERCENTILES) + " FROM documents",
)
def length_percentiles(t):
    return _rounded(a.length_percentiles(t.documents, "n_chars"))


@check(
    "token_accounting",
    "G37",
    """WITH b AS (SELECT conv_id AS step, sum(length(text))::BIGINT AS n, sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS tr, (max(length(text)) * count(*))::BIGINT AS pad FROM conversations GROUP BY 1),
    r AS (SELECT step, n, tr, pad, row_number() OVER w AS rn, sum(n) OVER w AS sn, sum(tr) OVER w AS st, sum(pad) OVER w AS sp FROM b WINDOW w AS (ORDER BY step))
    SELECT step, (rn - 1) // 7 AS log_period, sn::BIGINT AS total_tokens, sp::BIGINT AS total_tokens_with_padding, st::BIGINT AS total_trainable_tokens, sum(n) OVER p::BIGINT AS tokens_this_period, sum(tr) OVER p::BIGINT AS trainable_tokens_this_period,
      round(sn / rn, 6) AS avg_tokens_per_batch, round(sp / rn, 6) AS avg_tokens_with_padding_per_batch, round(st / rn, 6) AS avg_trainable_tokens_per_batch FROM r WINDOW p AS (PARTITION BY (rn - 1) // 7)""",
)
def token_accounting(t):
    size = F.length("text")
    batches = t.conversations.groupBy(F.col("conv_id").alias("step")).agg(
        F.sum(size).alias("tokens"), F.sum(F.when(F.col("role") == "assistant", size).otherwise(0)).alias("trainable_tokens"), (F.max(size) * F.count("*")).alias("tokens_with_padding")
    )
    return _rounded(a.token_accounting(batches, "step", 7).drop("tokens", "trainable_tokens", "tokens_with_padding"))


@check(
    "step_performance",
    "G38",
    """WITH s AS (SELECT event_id AS step, user_id AS n, value + 1 AS tt, value / 4 AS lt, value / 2 AS st, value AS wc FROM events), r AS (SELECT *, sum(n) OVER w AS sn, sum(tt) OVER w AS stt FROM s WINDOW w AS (ORDER BY step))
    SELECT step, sn::BIGINT AS total_tokens, round(n / tt, 6) AS tokens_per_second, round(sn / stt, 5) AS tokens_per_second_avg, round(n / tt / 4, 6) AS tokens_per_second_per_rank, round(n / 2, 6) AS avg_sequence_length,
      CASE WHEN wc = 0 THEN 0 ELSE round(100 * lt / wc, 6) END AS data_loading_pct, CASE WHEN wc = 0 THEN 0 ELSE round(100 * (wc - st) / wc, 6) END AS step_overhead_pct FROM r""",
)
def step_performance(t):
    v = F.col("value")
    steps = t.events.select(
        F.col("event_id").alias("step"), F.col("user_id").alias("tokens"), F.lit(2).alias("sequences"), (v + 1).alias("training_time"), (v / 4).alias("loading_time"), (v / 2).alias("step_time"), v.alias("wall_clock")
    )
    out = a.step_performance(steps, "step", 4).drop("tokens", "sequences", "training_time", "loading_time", "step_time", "wall_clock")
    return _rounded(out.withColumn("tokens_per_second_avg", F.round("tokens_per_second_avg", 5)))
