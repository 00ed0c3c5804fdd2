"""K: streaming jobs, fed by appended drops of the events table and run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import mixing
from rollweave.operators.ordering import md5_key, md5_mod
from rollweave.plans.packing_queries import _next_fit as next_fit_sql
from rollweave.plans.registry import check
from rollweave.streaming import jobs, throughput
from rollweave.streaming.groups import collect_outcomes, end_of_input, group_outcomes, groups, late_rows, streaming_session
from rollweave.streaming.training import TrainingSteps, published

SCHEMA = (
    "prompt_id long, sample int, reward double, query array<int>, response array<int>, mask array<int>, logprobs array<double>, "
    "finish_reason string, ts timestamp, drop_no int"
)
PAYLOAD = ("query", "response", "mask", "logprobs", "finish_reason")
DROPS = 3
#: Nothing is late.
NEVER = "1000 days"
#: Parts of the prompts that share a state.
PARTS = 512


def _arrivals(t):
    """All events as samples of four-sample prompts; a tenth arrives a second time, in the last drop."""
    prompt = F.floor(F.col("event_id") / 4).cast("int")
    response = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 11).cast("int")), lambda i: ((F.col("user_id") + i) % 50 + 4).cast("int"))
    rows = t.events.select(
        prompt.cast("long").alias("prompt_id"),
        (F.col("event_id") % 4).cast("int").alias("sample"),
        F.when(prompt % 7 == 0, F.lit(5.0)).otherwise(F.col("value")).alias("reward"),
        F.sequence(F.lit(1), 3 + prompt % 3).alias("query"),
        response.alias("response"),
        F.transform(response, lambda x: F.lit(1)).alias("mask"),
        F.transform(response, lambda x: -x / F.lit(10.0)).alias("logprobs"),
        F.when(F.col("event_type") == "error", "length").otherwise("stop").alias("finish_reason"),
        F.col("ts").cast("timestamp").alias("ts"),
        md5_mod(md5_key("drop", "event_id"), DROPS).alias("drop_no"),
    )
    again = rows.where(md5_mod(md5_key("again", F.col("prompt_id") * 4 + F.col("sample")), 10) == 0).withColumn("drop_no", F.lit(DROPS - 1))
    return rows.unionByName(again)


def _feed(t, name: str, handle_of, transform, schema: str = SCHEMA, mode: str = "append", rows=None, last=None):
    """Append one drop after the other and run the job to its end each time, always resuming; ``last`` are rows that end the input."""
    root = t.scratch(name)
    spark = streaming_session(t.spark, t.spark.sparkContext.defaultParallelism)
    arrivals = _arrivals(t) if rows is None else rows
    for drop in range(DROPS + (last is not None)):
        (arrivals.where(F.col("drop_no") == drop) if drop < DROPS else last).write.mode("append").parquet(f"{root}/in")
        jobs.run(transform(jobs.read_stream(spark, f"{root}/in", schema)), f"{root}/checkpoint", handle_of(f"{root}/out"), mode)
    return f"{root}/out"


def _complete(s):
    return group_outcomes(s, 4, NEVER, payload=PAYLOAD, parts=PARTS)


ARRIVED = """e AS (SELECT event_id // 4 AS prompt_id, (event_id % 4)::INTEGER AS sample, CASE WHEN (event_id // 4) % 7 = 0 THEN 5.0 ELSE value END AS reward,
      3 + (event_id // 4) % 3 AS n_query, event_id % 11 + 1 AS n_response, event_type <> 'error' AS stopped,
      ('0x' || substr(md5(concat('drop', ':', event_id)), 1, 7))::BIGINT % 3 AS drop_no FROM events),
    full_groups AS (SELECT prompt_id, max(drop_no) AS done, min(reward) = max(reward) AS flat, avg(reward) AS mean, min(reward) AS low FROM e GROUP BY 1 HAVING count(*) = 4)"""


@check("stream_groups", "K1 K5", f"WITH {ARRIVED} SELECT prompt_id, sample, reward, 'complete' AS outcome FROM e JOIN full_groups USING (prompt_id)")
def stream_groups(t):
    out = _feed(t, "groups", collect_outcomes, lambda s: group_outcomes(s, 4, NEVER, parts=PARTS))
    return groups(t.spark, out).drop("payload", "group_no")


def _steps_sql(counted: str) -> str:
    return f"""WITH {ARRIVED}, pl AS (SELECT *, row_number() OVER (ORDER BY done, prompt_id) - 1 AS position FROM full_groups WHERE {counted}), n AS (SELECT count(*) AS n FROM pl)
    SELECT prompt_id, sample, reward, 'kept' AS kind, position, position // 8 AS step FROM e JOIN pl USING (prompt_id), n WHERE NOT flat AND (position // 8 + 1) * 8 <= n"""


def _steps(t, name: str, active: bool = False, **settings) -> str:
    prepare = lambda table: TrainingSteps(table, 8, 4, 5.0, settings.get("pack_length", 64), active_sampling=active, min_packs=settings.get("min_packs", 1))
    return _feed(t, name, prepare, _complete)


STEP_ROWS = ["prompt_id", "sample", "reward", "kind", "position", "step"]


@check("stream_step_batches", "K2", _steps_sql("true"))
def stream_step_batches(t):
    return published(t.spark, _steps(t, "steps"), "rows").select(*STEP_ROWS)


@check("stream_step_batches_active", "K2", _steps_sql("NOT flat"))
def stream_step_batches_active(t):
    return published(t.spark, _steps(t, "steps-active", active=True), "rows").select(*STEP_ROWS)


MEASURES = ["scores", "real_batch_size_ratio", "unsolved_batch_size_ratio", "stop_rate", "sequence_lengths", "sequence_lengths_solved", "advantages_max", "packed_ratio"]
COUNTS = ["total_prompts", "filtered_prompts", "filtered_prompts_zero", "filtered_prompts_solved", "filtered_prompts_nonzero", "packs"]


@check(
    "stream_training_steps",
    "K2 E7 G23 F1 G31",
    f"""WITH RECURSIVE {ARRIVED}, placed AS (SELECT *, row_number() OVER (ORDER BY done, prompt_id) - 1 AS position FROM full_groups),
    steps AS (SELECT *, position // 8 AS step FROM placed WHERE (position // 8 + 1) * 8 <= (SELECT count(*) FROM placed)),
    kept AS (SELECT s.step, s.position, e.*, (reward - avg(reward) OVER g) / (stddev_pop(reward) OVER g + 1e-8) AS advantage
      FROM e JOIN steps s USING (prompt_id) WHERE NOT flat WINDOW g AS (PARTITION BY e.prompt_id)),
    sized AS (SELECT step AS shard, position * 4 + sample AS o, n_query + n_response AS n, sum(n_query + n_response) OVER (PARTITION BY step) AS total FROM kept),
    {next_fit_sql('sized', ['n'], 'least(n.total // 3, 64)')},
    packs AS (SELECT k.step, p.pack_no::BIGINT AS pack_no, string_agg(k.position || ':' || k.sample, ' ' ORDER BY p.o) AS members,
        sum(n_query + n_response)::BIGINT AS tokens, round(sum(advantage * n_response), 3)::DOUBLE + 0.0 AS advantage
      FROM packed p JOIN kept k ON k.step = p.shard AND k.position * 4 + k.sample = p.o GROUP BY 1, 2),
    measured AS (SELECT step, avg(reward) AS scores, count(*) / 32.0 AS real_batch_size_ratio, count(*) FILTER (reward < 5) / count(*) AS unsolved_batch_size_ratio,
        count(*) FILTER (stopped) / count(*) AS stop_rate, avg(n_response) AS sequence_lengths, coalesce(avg(n_response) FILTER (reward = 5), 0) AS sequence_lengths_solved,
        max(advantage) AS advantages_max, (SELECT count(*) FROM packs p WHERE p.step = kept.step) / count(*) AS packed_ratio FROM kept GROUP BY step),
    counted AS (SELECT step, count(*) FILTER (NOT flat) AS total_prompts, count(*) FILTER (flat) AS filtered_prompts, count(*) FILTER (flat AND low = 0) AS filtered_prompts_zero,
        count(*) FILTER (flat AND low = 5) AS filtered_prompts_solved, count(*) FILTER (flat AND low NOT IN (0, 5)) AS filtered_prompts_nonzero FROM steps GROUP BY step)
    SELECT p.*, {', '.join(f'round(m.{c}, 7)::DOUBLE AS {c}' for c in MEASURES)}, c.* EXCLUDE (step), count(*) OVER (PARTITION BY p.step) AS packs
    FROM packs p JOIN measured m USING (step) JOIN counted c USING (step)""",
)
def stream_training_steps(t):
    """The packs of every step with the step's metrics; three packs at least for each step."""
    table = _steps(t, "training", min_packs=3)
    packs = published(t.spark, table, "packs").select(
        "step",
        "pack_no",
        F.array_join(F.transform("members", lambda m: F.concat_ws(":", m["position"].cast("string"), m["sample"].cast("string"))), " ").alias("members"),
        F.size("tokens").cast("long").alias("tokens"),
        # No negative zero.
        (F.round(F.aggregate("advantages", F.lit(0.0), lambda s, x: s + x), 3) + 0.0).alias("advantage"),
    )
    metrics = published(t.spark, table, "metrics").select("step", *[F.round(c, 7).alias(c) for c in MEASURES], *COUNTS)
    return packs.join(metrics, "step")


@check(
    "stream_throughput",
    "K3",
    """WITH w AS (SELECT time_bucket(INTERVAL 15 MINUTES, ts) - u.k * INTERVAL 15 MINUTES AS s, user_id, value FROM events, LATERAL (SELECT unnest(range(0, 2)) AS k) u)
    SELECT epoch(s)::BIGINT AS started, sum(user_id)::BIGINT AS tokens, count(*) AS samples, round(avg(value), 6) AS avg_step_time, round(sum(user_id) / 1800.0, 6)::DOUBLE AS tokens_per_second FROM w GROUP BY 1""",
)
def stream_throughput(t):
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("tokens"), F.col("value").alias("step_time"), F.col("value").alias("batch_time"), md5_mod(md5_key("drop", "event_id"), DROPS).alias("drop_no"))
    schema = "ts timestamp, tokens long, step_time double, batch_time double, drop_no int"
    window = lambda s: jobs.stream_throughput(s, "30 minutes", "15 minutes", "60 days")
    flat = lambda s: window(s).select(F.unix_timestamp("window.start").alias("started"), "tokens", "samples", "avg_step_time", "tokens_per_second")
    out = _feed(t, "throughput", jobs.collect_batches, flat, schema, "update", rows)
    updates = jobs.read_batches(t.spark, out, "started long, tokens long, samples long, avg_step_time double, tokens_per_second double")
    last = updates.groupBy("started").agg(F.max_by(F.struct("tokens", "samples", "avg_step_time", "tokens_per_second"), "batch_id").alias("x"))
    return last.select("started", "x.tokens", "x.samples", F.round("x.avg_step_time", 6).alias("avg_step_time"), F.round("x.tokens_per_second", 6).alias("tokens_per_second"))


@check(
    "recent_throughput",
    "K3",
    """WITH l AS (SELECT user_id, epoch_us(ts) / 1e6 AS s FROM events ORDER BY ts DESC, event_id DESC LIMIT 500) SELECT sum(user_id)::BIGINT AS tokens, count(*) AS samples, round(sum(user_id) / (max(s) - min(s)), 4) AS tokens_per_second FROM l""",
)
def recent_throughput(t):
    out = jobs.recent_throughput(t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("tokens")), 500, ties=("event_id",))
    return out.withColumn("tokens_per_second", F.round("tokens_per_second", 4))


@check(
    "stream_exclusions",
    "K4",
    f"""WITH {ARRIVED}, p AS (SELECT DISTINCT event_id // 4 AS prompt_id FROM events)
    SELECT prompt_id, row_number() OVER (ORDER BY md5(concat(43, ':', prompt_id)), prompt_id) - 1 AS position, '1_' || prompt_id AS prompt_key FROM p WHERE prompt_id NOT IN (SELECT prompt_id FROM full_groups WHERE mean / 50 >= 0.4)""",
)
def stream_exclusions(t):
    out = _feed(t, "exclusions", lambda table: jobs.stream_exclusions(table, 50.0, 0.4), lambda s: group_outcomes(s, 4, NEVER, parts=PARTS))
    solved = jobs.excluded_prompts(t.spark, out)
    prompts = t.events.select(F.floor(F.col("event_id") / 4).cast("long").alias("key")).distinct()
    order = mixing.epoch_order(prompts, "key", 42, 1, solved.withColumnRenamed("prompt_id", "key"))
    return order.select(F.col("key").alias("prompt_id"), "position", F.col("prompt_id").alias("prompt_key"))


@check(
    "stream_recent_totals",
    "K3",
    """WITH r AS (SELECT epoch_us(ts) AS u, event_id, user_id AS p, event_id % 100 AS g, value FROM events), l AS (SELECT * FROM r ORDER BY u DESC, event_id DESC LIMIT 100)
    SELECT t.*, round(sum(p) / ((max(u) - min(u)) / 1e6), 6) AS prompt_tokens_per_second, round(sum(g) / ((max(u) - min(u)) / 1e6), 6) AS response_tokens_per_second,
      round(avg(value), 6) AS avg_step_time, round(avg(value / 2), 6) AS avg_batch_time, count(*) AS sample_count
    FROM l, (SELECT sum(p)::BIGINT AS total_prompt_tokens, sum(g)::BIGINT AS total_response_tokens, count(*) AS records FROM r) t GROUP BY ALL""",
)
def stream_recent_totals(t):
    """Totals of all records and rates over the last hundred, kept by the stream in eight parts."""
    rows = token_records(t).withColumn("drop_no", md5_mod(md5_key("drop", "id"), DROPS))
    schema = "id long, ts timestamp, prompt_tokens long, response_tokens long, step_time double, batch_time double, drop_no int"
    out = _feed(t, "recent", throughput.collect_snapshots, lambda s: throughput.stream_recent(s, 100), schema, "update", rows)
    totals = throughput.recent_totals(t.spark, out, 100)
    return totals.withColumns({c: F.round(c, 6) for c in totals.columns if "_per_" in c or c.startswith("avg")})


def token_records(t):
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("long").alias("prompt_tokens"),
        (F.col("event_id") % 100).alias("response_tokens"),
        F.col("value").alias("step_time"),
        (F.col("value") / 2).alias("batch_time"),
    )


@check(
    "late_groups",
    "K6",
    f"""WITH bounds AS (SELECT min(epoch(ts)) AS lo, max(epoch(ts)) AS hi FROM events),
    e AS (SELECT event_id // 4 AS prompt_id, event_id % 4 AS sample, epoch_ms(ts) AS ts, floor((epoch(ts) - lo) / (hi - lo + 1) * {DROPS})::INTEGER AS own,
        ('0x' || substr(md5(concat('behind', ':', event_id)), 1, 7))::BIGINT % 20 = 0 AS behind, ('0x' || substr(md5(concat('again', ':', event_id)), 1, 7))::BIGINT % 10 = 0 AS again FROM events, bounds),
    arrived AS (SELECT prompt_id, sample, ts, CASE WHEN behind THEN {DROPS - 1} ELSE own END AS drop_no FROM e UNION ALL SELECT prompt_id, sample, ts, {DROPS - 1} FROM e WHERE again),
    marks AS (SELECT d.drop_no, coalesce(max(a.ts) - 3600000, 0) AS mark FROM (SELECT unnest(range(0, {DROPS})) AS drop_no) d LEFT JOIN arrived a ON a.drop_no < d.drop_no GROUP BY 1),
    timed AS (SELECT a.*, m.mark, a.ts < m.mark AS late FROM arrived a JOIN marks m USING (drop_no)),
    held AS (SELECT prompt_id, drop_no, any_value(mark) AS mark, max(ts) AS latest FROM timed WHERE NOT late GROUP BY 1, 2),
    spells AS (SELECT prompt_id, drop_no, sum(CASE WHEN before + 7200000 <= mark THEN 1 ELSE 0 END) OVER (PARTITION BY prompt_id ORDER BY drop_no) AS spell
      FROM (SELECT *, lag(latest) OVER (PARTITION BY prompt_id ORDER BY drop_no) AS before FROM held)),
    outcomes AS (SELECT prompt_id, spell, count(DISTINCT sample) AS n FROM timed JOIN spells USING (prompt_id, drop_no) WHERE NOT late GROUP BY 1, 2)
    SELECT CASE WHEN n = 4 THEN 'complete' ELSE 'incomplete' END AS outcome, count(*) AS groups, sum(n)::BIGINT AS rows FROM outcomes GROUP BY 1
    UNION ALL SELECT 'late', count(DISTINCT prompt_id), count(*) FROM timed WHERE late""",
)
def late_groups(t):
    """Drops in time order, but for a twentieth of the rows and all repeats, which come at the end: groups that
    never fill up come out incomplete once the watermark passes, rows behind it are late, and the end of the
    input frees what is still open."""
    seconds = F.col("ts").cast("timestamp").cast("double")
    bounds = t.events.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi"))
    part = F.floor((F.col("ts").cast("double") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1) * DROPS).cast("int")
    own = _arrivals(t).dropDuplicates(["prompt_id", "sample"]).crossJoin(F.broadcast(bounds)).withColumn("drop_no", part).drop("lo", "hi")
    number = F.col("prompt_id") * 4 + F.col("sample")
    own = own.withColumn("drop_no", F.when(md5_mod(md5_key("behind", number), 20) == 0, F.lit(DROPS - 1)).otherwise(F.col("drop_no")))
    again = own.where(md5_mod(md5_key("again", F.col("prompt_id") * 4 + F.col("sample")), 10) == 0).withColumn("drop_no", F.lit(DROPS - 1))
    newest = t.events.agg(F.max(F.col("ts").cast("timestamp")).cast("string")).first()[0]
    end = end_of_input(t.spark, SCHEMA, newest, "1 hour", "2 hours")
    out = _feed(t, "late", collect_outcomes, lambda s: group_outcomes(s, 4, "1 hour", wait="2 hours", parts=PARTS), rows=own.unionByName(again), last=end)
    found = groups(t.spark, out).unionByName(late_rows(t.spark, out).withColumn("group_no", F.lit(0).cast("long")))
    distinct = F.countDistinct("prompt_id", "group_no")
    return found.groupBy("outcome").agg(distinct.alias("groups"), F.count("*").alias("rows"))
