r"""I: judge and rubric data."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.functions import judgements as j
from rollweave.functions.prompts import GENERATION_TEMPLATES, JSON_ANSWER, JUDGE_TEMPLATES, fill, skill_template
from rollweave.operators import judging as i
from rollweave.plans.inputs import flat, messages
from rollweave.plans.registry import check
from rollweave.plans.sqltext import MSGS, strip
from rollweave.plans.sqltext import flat as sql_flat


def _pick(column: str, options: list[str]):
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.col(column) % len(options) + 1).cast("int"))


def _cases(options: list) -> str:
    return f"(VALUES {', '.join(f'({n}, {v})' for n, v in enumerate(options))})"


SCORE_TEXTS = [(" 4/5 or 3", 0.8), (" 85% sure", 0.85), (" is 7.5", 7.5), (" yes", 1.0), (" zzz: fail", 0.0), (" .5", 0.5)]


@check("parsed_scores", "I1", f"SELECT doc_id, score::DOUBLE AS score FROM documents JOIN {_cases([s for _, s in SCORE_TEXTS])} c(k, score) ON k = doc_id % {len(SCORE_TEXTS)}")
def parsed_scores(t):
    """Letters of the document are masked, so that only the appended words decide."""
    text = F.concat(F.regexp_replace("text", r"[\p{L}\p{N}%/.]", "x"), _pick("doc_id", [s for s, _ in SCORE_TEXTS]))
    return t.documents.select("doc_id", j.parse_score(text).alias("score"))


@check(
    "raw_scores",
    "I1",
    r"""WITH p AS (SELECT doc_id, text AS t FROM documents), x AS (SELECT doc_id, t, regexp_extract_all(t, '(\d+)/(\d+)', 1)[1] AS a, regexp_extract_all(t, '(\d+)/(\d+)', 2)[1] AS b, regexp_extract_all(t, '(\d+\.?\d*|\.\d+)%', 1)[1] AS p, regexp_extract_all(t, '(\d+\.?\d*|\.\d+)', 1)[1] AS n FROM p)
    SELECT doc_id, round(coalesce(a::DOUBLE / nullif(b::DOUBLE, 0), p::DOUBLE / 100, n::DOUBLE, CASE WHEN regexp_matches(lower(t), 'yes|correct|good|true|pass') THEN 1 ELSE 0 END), 6)::DOUBLE AS score FROM x""",
)
def raw_scores(t):
    return t.documents.select("doc_id", F.round(j.parse_score("text"), 6).alias("score"))


@check("final_decisions", "I2", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM documents")
def final_decisions(t):
    text = F.concat("text", _pick("doc_id", [" Final Decision: YES", " final decision: no", " none"]))
    return t.documents.select("doc_id", j.parse_decision(text).alias("score"))


JSON_TEXTS = [
    ('```json\n{"REASONING": "fine", "SCORE": "7"}\n```', "fine", 7.0),
    ('{"REASONING": "a \\d b", "SCORE": 3.5}', "a \\d b", 3.5),
    ('so {"SCORE" : "9" and more', 'so {"SCORE" : "9" and more', 9.0),
    ("nothing", "nothing", 0.0),
    ('{"REASONING": "two\nlines", "SCORE": "8.25"}', "two\nlines", 8.25),
    ('{"REASONING": "no score"}', "no score", 0.0),
]


@check(
    "json_scores",
    "I3",
    "WITH c(k, reasoning, score) AS (VALUES "
    + ", ".join(f"({n}, $${r}$$, {s}::DOUBLE)" for n, (_, r, s) in enumerate(JSON_TEXTS))
    + f"""), r AS (SELECT doc_id, reasoning, score FROM documents JOIN c ON k = doc_id % {2 * len(JSON_TEXTS)}
      UNION ALL SELECT doc_id, text, (doc_id % 11)::DOUBLE FROM documents WHERE doc_id % {2 * len(JSON_TEXTS)} >= {len(JSON_TEXTS)})
    SELECT doc_id, md5(reasoning) AS reasoning_md5, score, score / 10.0 AS tenth FROM r""",
)
def json_scores(t):
    """Half of the answers take every odd form in turn, the other half hold whole documents as their reasoning."""
    k = F.col("doc_id") % (2 * len(JSON_TEXTS))
    whole = F.concat(F.lit("```json\n"), F.to_json(F.struct(F.col("text").alias("REASONING"), (F.col("doc_id") % 11).cast("string").alias("SCORE"))), F.lit("\n```"))
    rows = t.documents.select("doc_id", F.when(k < len(JSON_TEXTS), _pick("doc_id", [x for x, _, _ in JSON_TEXTS])).otherwise(whole).alias("t"))
    out = rows.select("doc_id", j.parse_json_score("t").alias("p"), j.parse_json_score("t", 10.0)["score"].alias("tenth"))
    return out.select("doc_id", F.md5(F.col("p.reasoning").cast("binary")).alias("reasoning_md5"), "p.score", "tenth")


@check(
    "total_scores",
    "I4",
    "SELECT source, round(avg(CASE WHEN coalesce(quality, 0) = 1 THEN doc_id % 10 ELSE -1 END), 6)::DOUBLE AS score FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)
def total_scores(t):
    text = F.when(F.col("quality") == 1, F.concat("text", F.lit("\nTotal score:  "), (F.col("doc_id") % 10).cast("string"))).otherwise(F.lit("none"))
    rows = t.documents.join(t.labels, "doc_id", "left").select("source", j.parse_total_score(text).alias("s"))
    return rows.groupBy("source").agg(F.round(F.avg("s"), 6).alias("score"))


@check(
    "extracted_json",
    "I5",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN (doc_id * 2)::VARCHAR WHEN 2 THEN NULL ELSE 'in' END AS value,
      CASE doc_id % 4 WHEN 0 THEN length(coalesce(text, '')) WHEN 3 THEN length(coalesce(text, '')) END AS n_reasoning FROM documents""",
)
def extracted_json(t):
    """Answers around whole documents: text before the object, text inside its strings, doubled braces, none."""
    body = F.coalesce("text", F.lit(""))
    quoted = F.regexp_extract(F.to_json(F.struct(body.alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    number = F.col("doc_id").cast("string")
    text = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(body, F.lit(' {bad {"score": '), number, F.lit(', "reasoning": '), quoted, F.lit("} end")))
        .when(F.col("doc_id") % 4 == 1, F.concat(body, F.lit(' {{"score": '), (F.col("doc_id") * 2).cast("string"), F.lit("}} b")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.translate(body, "{}", ""), F.lit(" no object }")))
        .otherwise(F.concat(F.lit('{"score": "in", "more": {"score": 1}, "reasoning": '), quoted, F.lit("}")))
    )
    found = j.extract_json(text)
    return t.documents.select("doc_id", found.alias("x")).select(
        "doc_id", F.get_json_object("x", "$.score").alias("value"), F.length(F.get_json_object("x", "$.reasoning")).cast("long").alias("n_reasoning")
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LAST = "CASE WHEN messages[-1].role = 'assistant' THEN messages[-1].content ELSE 'none' END"


def _template_sql() -> str:
    parts = [
        f"SELECT conv_id, '{n}' AS template, replace(replace(replace({_quoted(text)}, '{{output}}', {strip('out')}), '{{label}}', conv_id::VARCHAR), '{{input}}', q) AS prompt FROM x"
        for n, text in JUDGE_TEMPLATES.items()
    ]
    return f"WITH {MSGS}, x AS (SELECT conv_id, messages[1].content AS q, {LAST} AS out FROM msgs) " + " UNION ALL ".join(parts)


@check("judge_prompts", "I6", _template_sql())
def judge_prompts(t):
    last = F.element_at("messages", -1)
    body = F.when(last["role"] == "assistant", last["content"]).otherwise(F.lit("none"))
    rows = messages(t).select(
        "conv_id", F.get("messages", F.lit(0))["content"].alias("q"), F.concat(F.lit("x</think><answer> "), body, F.lit(" </answer>")).alias("p"), F.col("conv_id").cast("string").alias("l")
    )
    for name in JUDGE_TEMPLATES:
        rows = i.judge_prompts(rows, name, "q", "p", "l", out=f"t_{name}")
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("template"), F.col(f"t_{n}").alias("prompt")) for n in JUDGE_TEMPLATES]))
    return rows.select("conv_id", stacked.alias("s")).select("conv_id", "s.*")


@check(
    "skill_prompts",
    "I6",
    f"""WITH {MSGS} SELECT conv_id, replace(CASE WHEN conv_id % 2 = 0 THEN {_quoted(GENERATION_TEMPLATES['chat'])} ELSE {_quoted(GENERATION_TEMPLATES['summarization'])} END, '{{prompt}}', {sql_flat('messages')}) AS prompt FROM msgs""",
)
def skill_prompts(t):
    text = lambda skill: fill(skill_template(GENERATION_TEMPLATES, skill), prompt=flat("messages"))
    return messages(t).select("conv_id", F.when(F.col("conv_id") % 2 == 0, text("chat")).otherwise(text("unknown skill")).alias("prompt"))


def _judgement_sql() -> str:
    """Each skill's parts, stated here: what precedes the first slot, the headings and the end."""
    ends = {
        "summarization": ("Original Text", "Summary", "Comparison:", "Preferred Summary:"),
        "code_generation": ("Problem", "Code", "Code Analysis:", "Preferred Code:"),
        "safety": ("Scenario", "Response", "Safety Analysis:", "Preferred Response:"),
    }
    two = " ".join(
        f"WHEN '{skill}' THEN concat('### {a}:', chr(10), q, chr(10), chr(10), '### {b} A:', chr(10), r1, chr(10), chr(10), '### {b} B:', chr(10), r2, chr(10), chr(10), '{c}', chr(10), '{d}', chr(10))"
        for skill, (a, b, c, d) in ends.items()
    )
    skill = "CASE conv_id % 5 WHEN 0 THEN 'chat' WHEN 1 THEN 'summarization' WHEN 2 THEN 'code_generation' WHEN 3 THEN 'safety' ELSE 'no such skill' END"
    return f"""WITH {MSGS}, x AS (SELECT conv_id, {skill} AS skill, messages[1].content AS q, messages[2].content AS r1, messages[-1].content || '{{prompt}}' AS r2 FROM msgs WHERE len(messages) >= 2)
    SELECT conv_id, skill, CASE CASE WHEN skill = 'no such skill' THEN 'summarization' ELSE skill END
      WHEN 'chat' THEN concat('### Prompt:', chr(10), q, chr(10), chr(10), '### Response:', chr(10), r1, chr(10), chr(10), '### Evaluation Criteria:') {two} END AS body FROM x"""


@check("judgement_prompts", "I6 H5", _judgement_sql())
def judgement_prompts(t):
    """The part of each prompt that holds text of the row; the words before it are fixed."""
    names = F.array(*[F.lit(x) for x in ("chat", "summarization", "code_generation", "safety", "no such skill")])
    rows = messages(t).where(F.size("messages") >= 2).select(
        "conv_id",
        F.element_at(names, (F.col("conv_id") % 5 + 1).cast("int")).alias("skill"),
        F.get("messages", F.lit(0))["content"].alias("q"),
        F.array(F.get("messages", F.lit(1))["content"], F.concat(F.element_at("messages", -1)["content"], F.lit("{prompt}"))).alias("responses"),
    )
    text = i.judgement_prompts(rows, "skill", "q", "responses").withColumn("p", F.col("judgement_prompt"))
    body = F.regexp_extract("p", r"(?s)(### .*)\z", 1)
    own = F.when(F.col("skill") == "chat", F.concat(F.substring_index(body, "### Evaluation Criteria:", 1), F.lit("### Evaluation Criteria:"))).otherwise(body)
    return text.select("conv_id", "skill", own.alias("body"))


WORDS = r"regexp_extract_all({0}, '\S+')"


@check(
    "context_fit",
    "I7",
    rf"""WITH {MSGS}, o AS (SELECT conv_id, u.i, messages[u.i] AS m FROM msgs, LATERAL (SELECT unnest(range(1, len(messages) + 1)) AS i) u),
    w AS (SELECT conv_id, i, m.role AS role, m.content AS content, {WORDS.format('m.content')} AS ws FROM o), s AS (SELECT conv_id, coalesce(sum(len(ws) + 4) FILTER (WHERE role = 'system'), 0) AS st, sum(len(ws) + CASE WHEN role = 'system' THEN 4 ELSE 3 END) AS total FROM w GROUP BY 1),
    r AS (SELECT w.*, st, 200 - st AS room, st + sum(CASE WHEN role = 'system' THEN 0 ELSE len(ws) + 3 END) OVER (PARTITION BY w.conv_id ORDER BY i) AS used FROM w JOIN s USING (conv_id)),
    f AS (SELECT conv_id, min(i) FILTER (WHERE role <> 'system' AND used > room) AS cut FROM r GROUP BY 1),
    k AS (SELECT r.conv_id, i, role, CASE WHEN role <> 'system' AND i = cut THEN array_to_string(ws[1:(room - (used - len(ws) - 3) - 3)::INTEGER], ' ') ELSE content END AS content
      FROM r JOIN f USING (conv_id) WHERE role = 'system' OR (room > 0 AND (cut IS NULL OR i < cut OR (i = cut AND room - (used - len(ws) - 3) - 3 > 0)))),
    n AS (SELECT conv_id, max(room) AS room FROM r GROUP BY 1), z AS (SELECT conv_id, list({{'role': role, 'content': content}} ORDER BY role <> 'system', i) AS ms FROM k GROUP BY 1)
    SELECT s.conv_id, total::INTEGER AS tokens, total + 50 + 100 > 300 AS over, coalesce({sql_flat("ms")} || CASE WHEN room > 0 AND ms[-1].role = 'user' THEN chr(10) || {_quoted(JSON_ANSWER)} ELSE '' END, '') AS text
    FROM s LEFT JOIN z USING (conv_id) JOIN n USING (conv_id)""",
)
def context_fit(t):
    return messages(t).select(
        "conv_id", i.message_tokens("messages").alias("tokens"), i.exceeds_context("messages", 300, 50).alias("over"), flat(i.fit_messages("messages", 350, 50)).alias("text")
    )


@check(
    "slot_fit",
    "I7",
    rf"""SELECT doc_id, CASE WHEN len({WORDS.format('text')}) > 42 THEN array_to_string({WORDS.format('text')}[1:42], ' ') ELSE text END AS text, '' AS none FROM documents""",
)
def slot_fit(t):
    return t.documents.select("doc_id", i.fit_slot("text", "judge this text: {output} now please", 200, 53).alias("text"), i.fit_slot("text", "a {output}", 100, 50).alias("none"))


MODELS = ["ns/gpt-4o", "gpt-4o-standard", "o3", "mystery"]


@check(
    "judge_costs",
    "I8",
    """SELECT p_name AS part, round(sum(l_quantity * CASE l_suppkey % 4 WHEN 0 THEN 2.5e-6 WHEN 1 THEN 2.5e-6 WHEN 2 THEN 1e-5 ELSE 0 END + l_linenumber * CASE l_suppkey % 4 WHEN 0 THEN 1e-6 WHEN 1 THEN 1e-6 WHEN 2 THEN 4e-5 ELSE 0 END), 9) AS cost FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def judge_costs(t):
    usage = t.lineitem.select("l_partkey", _pick("l_suppkey", MODELS).alias("model"), F.col("l_quantity").alias("prompt_tokens"), F.col("l_linenumber").alias("completion_tokens"))
    costs = i.judge_cost(usage).groupBy("l_partkey").agg(F.sum("cost").alias("c"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return costs.join(parts, "l_partkey").groupBy(F.col("p_name").alias("part")).agg(F.round(F.sum("c"), 9).alias("cost"))


@check(
    "rubric_scores",
    "I9",
    """WITH r AS (SELECT l_orderkey AS response_id, l_linenumber % 3 AS s, CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_linestatus = 'O' THEN -1 ELSE 2 END AS w FROM lineitem)
    SELECT response_id, round(CASE WHEN sum(abs(w)) = 0 THEN 0 ELSE sum(s / 2.0 * w) / sum(abs(w)) END, 6)::DOUBLE AS score FROM r GROUP BY 1""",
)
def rubric_scores(t):
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("response_id"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.lit("d")).alias("description"),
        F.when(F.col("l_linestatus") == "O", -1.0).otherwise(2.0).alias("weight"),
        (F.col("l_linenumber") % 3).cast("double").alias("score"),
    )
    return i.rubric_scores(rows, "response_id").withColumn("score", F.round("score", 6))


@check(
    "rubric_metrics",
    "I10",
    """WITH r AS (SELECT l_tax * CASE WHEN l_linestatus = 'O' THEN -1 ELSE 2 END AS v, l_returnflag = 'A' AS e FROM lineitem)
    SELECT round(avg(v) FILTER (WHERE e), 6) AS avg_evolving_reward, round(stddev_pop(v) FILTER (WHERE e), 6) AS std_evolving_reward, round(avg(v) FILTER (WHERE NOT e), 6) AS avg_persistent_reward, round(stddev_pop(v) FILTER (WHERE NOT e), 6) AS std_persistent_reward FROM r""",
)
def rubric_metrics(t):
    rows = t.lineitem.select(
        F.col("l_tax").alias("score"),
        F.when(F.col("l_linestatus") == "O", -1.0).otherwise(2.0).alias("weight"),
        F.when(F.col("l_returnflag") == "A", F.lit("evolving")).when(F.col("l_returnflag") == "N", F.lit("persistent")).alias("kind"),
    )
    out = i.rubric_metrics(rows)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def _truths(t):
    """A query per language and length class; the key of the question and of the text vary."""
    query = F.concat("lang", F.lit("-"), (F.col("n_chars") % 40).cast("string"))
    even = F.col("doc_id") % 2 == 0
    truth = F.when(
        even, F.format_string('{"query": "%s", "rubrics": [{"title": "t%d", "description": "d", "weight": 2}, {"title": "u", "rubric_item": "e"}]}', query, "doc_id")
    ).otherwise(F.format_string('{"Question": "%s", "rubrics": [{"title": "v%d", "Ingredient": "f", "weight": -1}]}', query, "doc_id"))
    return t.documents.select("doc_id", truth.alias("ground_truth"), query.alias("query"))


BUFFER = """d AS (SELECT doc_id, lang || '-' || (n_chars % 40) AS query FROM documents), f AS (SELECT query, min(doc_id) AS doc_id FROM d GROUP BY 1),
    buf AS (SELECT query, 't' || doc_id AS title, 'd' AS description, 2.0::DOUBLE AS weight, 'persistent' AS kind, 'persistent' AS state FROM f WHERE doc_id % 2 = 0
      UNION ALL SELECT query, 'u', 'e', 1.0, 'persistent', 'persistent' FROM f WHERE doc_id % 2 = 0 UNION ALL SELECT query, 'v' || doc_id, 'f', -1.0, 'persistent', 'persistent' FROM f WHERE doc_id % 2 = 1)"""


@check("rubric_buffer", "I11", f"WITH {BUFFER} SELECT * FROM buf")
def rubric_buffer(t):
    return i.init_rubric_buffer(_truths(t), "doc_id")


def _new(t):
    """Generated rubrics for every third query row; a fifth of them failed to parse."""
    item = lambda name, d: F.struct(F.concat(F.lit(name), F.col("doc_id").cast("string")).alias("title"), F.lit(d).alias("description"))
    failed = F.col("doc_id") % 5 == 0
    return _truths(t).where("doc_id % 3 = 0").select(
        "query", "doc_id", F.when(~failed, F.array(item("p", "good"), item("q", "fine"))).alias("positive"), F.when(~failed, F.array(item("n", "poor"))).alias("negative")
    )


MERGED = f"""{BUFFER}, g AS (SELECT query, min(doc_id) AS doc_id FROM d WHERE doc_id % 3 = 0 AND doc_id % 5 <> 0 GROUP BY 1),
    merged AS (SELECT * FROM buf UNION ALL SELECT g.query, u.n || g.doc_id, u.d, u.w, 'evolving', 'active' FROM g, LATERAL (VALUES ('p', 'good', 1.0::DOUBLE), ('q', 'fine', 1.0), ('n', 'poor', -1.0)) AS u(n, d, w))"""


@check("merged_rubrics", "I12", f"WITH {MERGED} SELECT * FROM merged")
def merged_rubrics(t):
    return i.effective_rubrics(i.merge_rubrics(i.init_rubric_buffer(_truths(t), "doc_id"), _new(t), "doc_id"))


@check(
    "rubric_merge_report",
    "I10 I12",
    f"""WITH {MERGED}, a AS (SELECT query, count(*) FILTER (WHERE state = 'active') AS n FROM merged GROUP BY 1), n AS (SELECT * FROM d WHERE doc_id % 3 = 0)
    SELECT (SELECT round(avg(CASE WHEN doc_id % 5 <> 0 THEN 1.0 ELSE 0 END), 6)::DOUBLE FROM n) AS valid_rate, (SELECT count(*) FILTER (WHERE doc_id % 5 = 0) * 4 FROM n) AS skipped, 3.0::DOUBLE AS avg_new_rubrics,
      (SELECT round(avg(n), 6) FROM a) AS avg_active_rubrics, (SELECT round(count(*) / count(DISTINCT query), 6) FROM n) AS num_new_rubrics, (SELECT round(avg(n), 6) FROM a) AS num_active_rubrics""",
)
def rubric_merge_report(t):
    new = _new(t)
    buffer = i.merge_rubrics(i.init_rubric_buffer(_truths(t), "doc_id"), new, "doc_id")
    out = i.merge_report(buffer, new, 4).crossJoin(i.rubric_counts(new, buffer))
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


@check(
    "pruned_rubrics",
    "I13",
    f"""WITH l AS (SELECT l_suppkey % 20 AS query, l_partkey % 15 AS title, stddev_pop(l_quantity) AS sd FROM lineitem GROUP BY 1, 2),
    st AS (SELECT query, title, CASE WHEN title % 4 = 0 THEN 0 ELSE round(sd, 4) END AS sd FROM l WHERE title % 5 <> 3), x AS (SELECT l.query, l.title, st.sd FROM l LEFT JOIN st USING (query, title)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN sd > 0 THEN sd END DESC NULLS LAST, title::VARCHAR) AS rn, count(*) FILTER (WHERE sd IS NULL OR sd > 0) OVER (PARTITION BY query) AS live FROM x)
    SELECT query::VARCHAR AS query, title::VARCHAR AS title, CASE WHEN sd = 0 OR (sd > 0 AND live > 4 AND rn > 4) THEN 'inactive' ELSE 'active' END AS state FROM r""",
)
def pruned_rubrics(t):
    text = lambda c, n: (F.col(c) % n).cast("string")
    grouped = t.lineitem.groupBy(text("l_suppkey", 20).alias("query"), text("l_partkey", 15).alias("title")).agg(F.stddev_pop("l_quantity").alias("sd"))
    n = F.col("title").cast("int")
    stats = grouped.where(n % 5 != 3).select("query", "title", F.when(n % 4 == 0, 0.0).otherwise(F.round("sd", 4)).alias("std"))
    return i.prune_rubrics(grouped.select("query", "title", F.lit("active").alias("state")), stats, 4)


@check(
    "sampled_answers",
    "I14",
    rf"""WITH w AS (SELECT doc_id, source, len({WORDS.format('text')}) AS n FROM documents), r AS (SELECT *, row_number() OVER p AS rk, sum(n) OVER p AS total FROM w WINDOW p AS (PARTITION BY source ORDER BY md5(concat(42, ':', doc_id)), doc_id)),
    s AS (SELECT source, min(rk) FILTER (WHERE rk > 2 AND total > 900) AS stop FROM r GROUP BY 1) SELECT doc_id, r.source FROM r JOIN s ON r.source = s.source WHERE stop IS NULL OR rk < stop""",
)
def sampled_answers(t):
    return i.sample_answers(t.documents.select("doc_id", "source", "text"), "doc_id", "text", 900, ["source"]).select("doc_id", "source")


@check("cached_generations", "I15", "SELECT doc_id, n_chars, (doc_id % 2 + 7)::INTEGER AS training_step FROM documents")
def cached_generations(t):
    path = t.scratch("generations")
    for step in (7, 8):
        i.cache_generation(t.documents.where(F.col("doc_id") % 2 == step - 7).select("doc_id", "n_chars"), path, step)
    return t.spark.read.schema("doc_id long, n_chars long, training_step int").json(path)
