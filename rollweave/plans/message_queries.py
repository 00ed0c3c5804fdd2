r"""B: schema normalisation and message construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.functions import text as rules
from rollweave.operators import messages as m
from rollweave.plans.inputs import flat, messages
from rollweave.plans.registry import check
from rollweave.plans.sqltext import MSGS, strip
from rollweave.plans.sqltext import flat as sql_flat


@check("turns_to_messages", "B1 B13", f"WITH {MSGS} SELECT conv_id, len(messages) AS n, {sql_flat('messages')} AS text FROM msgs")
def turns_to_messages(t):
    return messages(t).select("conv_id", F.size("messages").alias("n"), m.flatten_prompt().alias("text"))


def _first_pair(t):
    """First user text and first assistant text of each conversation."""
    pick = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return t.conversations.groupBy("conv_id").agg(pick("user").alias("u"), pick("assistant").alias("a")).na.drop()


FIRST_PAIR = (
    "p AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS u, "
    "arg_min(text, turn) FILTER (WHERE role = 'assistant') AS a FROM conversations GROUP BY conv_id HAVING u IS NOT NULL AND a IS NOT NULL)"
)


@check(
    "source_formats",
    "B2 B3",
    f"""
    WITH {FIRST_PAIR}, {MSGS}, two AS (
      SELECT conv_id, 'answer' AS format, 'user: ' || u || E'\\nassistant: ' || a AS text FROM p
      UNION ALL SELECT conv_id, 'response', 'user: ' || u || E'\\nassistant: ' || a FROM p
      UNION ALL SELECT conv_id, 'completion', 'user: ' || u || E'\\nassistant: ' || a FROM p
      UNION ALL SELECT conv_id, 'question', E'system: be brief\\nuser: ' || u || E'\\nassistant: ' || a FROM p
      UNION ALL SELECT conv_id, 'instruction', 'user: Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.'
         || E'\\n\\n### Instruction:\\n' || u || E'\\n\\n### Input:\\n' || conv_id || E'\\n\\n### Response:' || E'\\nassistant: ' || a FROM p
      UNION ALL SELECT conv_id, 'rejection', 'user: ' || u || E'\\nassistant: ' || a FROM p
      UNION ALL SELECT conv_id, 'conversations', {sql_flat("list_filter(messages, lambda x: x.role <> 'system')")} FROM msgs)
    SELECT * FROM two
    """,
)
def source_formats(t):
    p = _first_pair(t)
    u, a = F.col("u"), F.col("a")
    speaker = lambda x: F.when(x["role"] == "user", F.lit("human")).otherwise(F.lit("gpt"))
    turns = F.transform(
        F.filter("messages", lambda x: x["role"] != "system"),
        lambda x: F.struct(speaker(x).alias("from"), x["content"].alias("value")),
    )
    pair = F.array(m.message("user", u), m.message("assistant", a))
    shaped = [
        p.select("conv_id", u.alias("query"), a.alias("answer")),
        p.select("conv_id", u.alias("query"), a.alias("response")),
        p.select("conv_id", u.alias("prompt"), a.alias("completion")),
        p.select("conv_id", F.lit("be brief").alias("system_prompt"), u.alias("question"), a.alias("response")),
        p.select("conv_id", u.alias("instruction"), F.col("conv_id").cast("string").alias("input"), a.alias("output")),
        p.select("conv_id", pair.alias("chosen"), pair.alias("rejected"), a.alias("reference_completion")),
        messages(t).select("conv_id", turns.alias("conversations")),
    ]
    out = None
    for table in shaped:
        part = m.to_messages(table).select("conv_id", F.lit(m.detect_format(table)).alias("format"), flat("messages").alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "message_format",
    "B4",
    f"""WITH {MSGS} SELECT conv_id, len(list_filter(messages, lambda x: CASE WHEN x.role = 'system' THEN NULL ELSE x.content END IS NULL)) = 0 AS ok FROM msgs""",
)
def message_format(t):
    holed = F.transform("messages", lambda x: F.struct(x["role"].alias("role"), F.when(x["role"] != "system", x["content"]).alias("content")))
    return messages(t).select("conv_id", m.is_message_format(holed).alias("ok"))


@check(
    "aligned_columns",
    "B5",
    "SELECT doc_id::VARCHAR AS id, text, NULL::VARCHAR AS title, n_chars FROM documents",
)
def aligned_columns(t):
    first = t.spark.createDataFrame([], "id string, text string, title string, n_chars long")
    docs = t.documents.withColumns({"id": F.col("doc_id").cast("string"), "n_chars": F.col("n_chars").cast("string")})
    return m.align_columns(docs, ["text", "title", "n_chars"], need=["text"], like=first)


@check(
    "provenance",
    "B6",
    """WITH i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index FROM documents)
    SELECT doc_id, index, 'corpus_' || index || '_train' AS id, 'corpus' AS source, 'corpus' AS dataset_source FROM i""",
)
def provenance(t):
    return m.add_provenance(t.documents.select("doc_id"), "corpus", "doc_id", split="train")


@check("pruned_columns", "B7", "SELECT doc_id, source AS dataset_source, lang AS tools FROM documents")
def pruned_columns(t):
    docs = t.documents.withColumnsRenamed({"source": "dataset_source", "lang": "tools"})
    return m.prune_columns(docs, ["doc_id"])


@check(
    "prompt_variants",
    "B8",
    rf"""
    WITH u AS (SELECT conv_id, turn, text, 'user: ' || text AS line, 'x Question: a Question:  ' || text AS q FROM conversations WHERE role = 'user'),
    v AS (SELECT conv_id, turn, 'plain' AS variant, text AS body FROM u
      UNION ALL SELECT conv_id, turn, 'user_line', text FROM u
      UNION ALL SELECT conv_id, turn, 'boxed_prefix', 'Solve the following math problem. Make sure to put the answer (and only answer) inside \boxed{{}}. ' || E'\n\n' || regexp_replace(text, '^\s+', '') FROM u
      UNION ALL SELECT conv_id, turn, 'last_question', 'Solve the following math problem. Make sure to put the answer (and only answer) inside \boxed{{}}.' || E'\n\n' || {strip('text')} FROM u)
    SELECT conv_id, turn, variant, E'system: You are a helpful assistant. Follow the user''s instructions carefully.\nuser: ' || body AS text FROM v
    """,
)
def prompt_variants(t):
    user = t.conversations.where("role = 'user'")
    sources = {
        "plain": F.col("text"),
        "user_line": F.concat(F.lit("user: "), "text"),
        "boxed_prefix": F.concat(F.lit("user: "), "text"),
        "last_question": F.concat(F.lit("x Question: a Question:  "), "text"),
    }
    built = F.explode(
        F.array(*[F.struct(F.lit(k).alias("variant"), flat(m.make_prompt(v, k)).alias("text")) for k, v in sources.items()])
    )
    return user.select("conv_id", "turn", built.alias("p")).select("conv_id", "turn", "p.variant", "p.text")


@check(
    "prompt_and_completion",
    "B9",
    f"""WITH {MSGS}, s AS (SELECT conv_id, messages FROM msgs UNION ALL SELECT conv_id + 1000000, messages[1:1] FROM msgs)
    SELECT conv_id, {sql_flat('CASE WHEN len(messages) = 1 THEN messages ELSE messages[1:len(messages) - 1] END')} AS prompt,
    messages[-1].role AS role, messages[-1].content AS content FROM s""",
)
def prompt_and_completion(t):
    msgs = messages(t)
    both = msgs.unionByName(msgs.select((F.col("conv_id") + 1000000).alias("conv_id"), F.slice("messages", 1, 1).alias("messages")))
    return m.split_prompt_completion(both).select("conv_id", flat("prompt").alias("prompt"), "completion.role", "completion.content")


@check(
    "without_trailing_assistant",
    "B10",
    f"""WITH {MSGS} SELECT conv_id, {sql_flat("CASE WHEN len(messages) > 1 AND messages[-1].role = 'assistant' THEN messages[1:len(messages) - 1] ELSE messages END")} AS text FROM msgs""",
)
def without_trailing_assistant(t):
    return messages(t).select("conv_id", flat(m.drop_trailing_assistant()).alias("text"))


@check(
    "system_override",
    "B11",
    f"""WITH {MSGS} SELECT conv_id, {sql_flat("list_concat([{'role': 'system', 'content': 'Be kind.'}], CASE WHEN messages[1].role = 'system' THEN messages[2:len(messages)] ELSE messages END)")} AS text,
    {sql_flat('messages')} AS unchanged FROM msgs""",
)
def system_override(t):
    return messages(t).select(
        "conv_id",
        flat(m.override_system_prompt("messages", "Be kind.")).alias("text"),
        flat(m.override_system_prompt("messages", "")).alias("unchanged"),
    )


@check(
    "judge_transcript",
    "B13",
    rf"""WITH {MSGS} SELECT conv_id, array_to_string(list_transform(messages, lambda x: CASE WHEN x.role = 'user' THEN 'User A' ELSE 'User B' END || ': ' || {strip('x.content')}), chr(10)) AS text FROM msgs""",
)
def judge_transcript(t):
    return messages(t).select("conv_id", m.flatten_for_judge().alias("text"))


@check(
    "label_normalisation",
    "B12",
    """
    WITH d AS (SELECT doc_id, source, doc_id % 5 AS k FROM documents)
    SELECT doc_id, source AS dataset,
      CASE k WHEN 0 THEN 'keywords:existence' WHEN 1 THEN 'length_constraints:number_words' WHEN 2 THEN 'keywords:frequency'
             WHEN 3 THEN 'punctuation:no_comma,startend:quotation' END AS ids,
      CASE k WHEN 0 THEN 'keywords=["the","and"]' WHEN 1 THEN 'num_words=' || (doc_id % 50) || '&relation=' ||
               CASE doc_id % 4 WHEN 0 THEN 'at least' WHEN 1 THEN 'less than' WHEN 2 THEN 'at least' ELSE 'at least' END
             WHEN 2 THEN 'frequency=' || (doc_id % 7) || '&keyword=the&relation=at least' WHEN 3 THEN '/' END AS args,
      k = 4 AS unmapped
    FROM d
    """,
)
def label_normalisation(t):
    k = F.col("doc_id") % 5
    n = lambda mod: (F.col("doc_id") % mod).cast("string")
    quantifier = F.element_at(F.array(F.lit("At Least"), F.lit("at most"), F.lit("around"), F.lit("many")), (F.col("doc_id") % 4 + 1).cast("int"))
    truth = (
        F.when(k == 0, F.lit("""[{'instruction_id': ['keywords:existence'], 'kwargs': [{'keywords': ['the', 'and'], 'unused': None}]}]"""))
        .when(k == 1, F.format_string('{"func_name": "validate_word_constraint", "N": %s, "quantifier": "%s"}', n(50), quantifier))
        .when(k == 2, F.format_string('{"func_name": "verify_keyword_frequency", "word": "the", "N": %s}', n(7)))
        .when(k == 3, F.lit('[{"instruction_id": ["punctuation:no_comma", "startend:quotation"], "kwargs": [null, {}]}]'))
        .otherwise(F.lit('{"func_name": "no_such_check"}'))
    )
    table = m.label_arrays(t.documents.select("doc_id", F.col("source").alias("dataset"), truth.alias("ground_truth")))
    constraints = m.parse_constraints(F.element_at("ground_truth", 1))
    pairs = lambda kw: F.array_join(F.array_sort(F.transform(F.map_entries(kw), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "&")
    return table.select(
        "doc_id",
        F.element_at("dataset", 1).alias("dataset"),
        F.array_join(F.transform(constraints, lambda c: c["instruction_id"]), ",").alias("ids"),
        F.array_join(F.transform(constraints, lambda c: pairs(c["kwargs"])), "/").alias("args"),
        constraints.isNull().alias("unmapped"),
    )


def _shape(env):
    entry = lambda e: F.concat_ws(
        "|",
        e["env_name"],
        F.coalesce(e["is_text_env"].cast("string"), F.lit("-")),
        F.array_join(F.array_sort(F.transform(F.map_entries(e["kwargs"]), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), "&"),
    )
    return F.array_join(F.array_sort(F.transform(env["env_configs"], entry)), ";")


def _env_json():
    return (
    F.when(F.col("event_id") % 5 == 0, F.format_string('[{"env_name": "%s", "level": 2}]', "event_type"))
    .when(F.col("event_id") % 5 == 1, F.format_string('{"env_name": "%s", "max_steps": %s, "is_text_env": true}', "event_type", F.get_json_object("props", "$.k")))
    .when(F.col("event_id") % 5 == 2, F.format_string('{"env_configs": [{"env_name": "%s", "target": 7}, {"env_name": "extra"}], "max_steps": 3}', "event_type"))
    .when(F.col("event_id") % 5 == 3, F.col("props"))
)
ENV_SQL = """
    e AS (SELECT event_id, event_id % 5 AS c, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


@check(
    "env_config_shapes",
    "B14",
    f"""WITH {ENV_SQL} SELECT event_id, CASE c WHEN 1 THEN k WHEN 2 THEN 3 END AS max_steps,
    CASE c WHEN 0 THEN event_type || '|-|level=2' WHEN 1 THEN event_type || '|true|'
           WHEN 2 THEN CASE WHEN event_type < 'extra' THEN event_type || '|-|target=7;extra|-|' ELSE 'extra|-|;' || event_type || '|-|target=7' END
           WHEN 3 THEN '' END AS envs FROM e""",
)
def env_config_shapes(t):
    env = m.normalise_env_config(_env_json())
    return t.events.select("event_id", env.alias("env")).select("event_id", "env.max_steps", _shape(F.col("env")).alias("envs"))


@check(
    "env_config_merge",
    "B15",
    f"""WITH {ENV_SQL}, x AS (SELECT event_id, c, k, event_type, CASE c WHEN 0 THEN 'level=2' WHEN 2 THEN 'target=7' ELSE '' END AS kw,
      CASE WHEN c = 1 THEN 'true' WHEN event_type = 'click' THEN 'true' ELSE 'false' END AS txt FROM e)
    SELECT event_id, CASE c WHEN 1 THEN k WHEN 2 THEN 3 ELSE 10 END AS max_steps,
      CASE WHEN c IN (3, 4) THEN 'click|true|difficulty=hard&level=1'
           WHEN event_type = 'click' THEN 'click|' || txt || '|' || CASE c WHEN 0 THEN 'difficulty=hard&level=2' WHEN 2 THEN 'difficulty=hard&level=1&target=7' ELSE 'difficulty=hard&level=1' END
                || CASE WHEN c = 2 THEN ';extra|false|' ELSE '' END
           ELSE array_to_string(list_sort(list_filter(['click|true|difficulty=hard&level=1', event_type || '|' || txt || '|' || kw,
                CASE WHEN c = 2 THEN 'extra|false|' END], lambda s: s IS NOT NULL)), ';') END AS envs
    FROM x""",
)
def env_config_merge(t):
    base = m.normalise_env_config(F.lit('{"env_name": "click", "is_text_env": true, "level": 1, "difficulty": "hard", "max_steps": 10}'))
    merged = m.merge_env_config("base", "sample")
    rows = t.events.select("event_id", base.alias("base"), m.normalise_env_config(_env_json()).alias("sample"))
    return rows.select("event_id", merged.alias("env")).select("event_id", "env.max_steps", _shape(F.col("env")).alias("envs"))


TOOL_DEFS = {"click": "{click}", "view": "{view}", "search": "{search}"}


@check(
    "active_tools",
    "B16",
    """WITH u AS (SELECT user_id, CASE WHEN user_id % 7 <> 0 THEN list(DISTINCT event_type) END AS tools FROM events WHERE user_id % 3 <> 0 OR event_type NOT IN ('click', 'view') GROUP BY user_id)
    SELECT user_id, CASE WHEN tools IS NULL THEN 'click,view,search'
      WHEN list_contains(tools, 'click') AND list_contains(tools, 'view') THEN 'click,view' WHEN list_contains(tools, 'click') THEN 'click' WHEN list_contains(tools, 'view') THEN 'view' END AS active,
      CASE WHEN tools IS NOT NULL THEN array_to_string(list_sort(list_filter(tools, lambda x: x NOT IN ('click', 'view', 'search'))), ',') END AS unknown FROM u""",
)
def active_tools(t):
    kept = t.events.where("user_id % 3 <> 0 OR event_type NOT IN ('click', 'view')")
    users = kept.groupBy("user_id").agg(F.collect_set("event_type").alias("tools"))
    users = users.withColumn("tools", F.when(F.col("user_id") % 7 != 0, F.col("tools")))
    names = F.transform(m.resolve_active_tools("tools", TOOL_DEFS), lambda d: d["name"])
    return users.select("user_id", F.array_join(names, ",").alias("active"), F.array_join(m.unknown_tools("tools", TOOL_DEFS), ",").alias("unknown"))


@check(
    "tool_coverage",
    "B17",
    """SELECT DISTINCT event_type AS tool_name, 'unconfigured' AS problem FROM events WHERE event_type NOT IN ('click', 'view', 'search')
    UNION ALL SELECT n, 'extraneous' FROM (VALUES ('click'), ('view'), ('search')) v(n) WHERE n NOT IN (SELECT event_type FROM events)""",
)
def tool_coverage(t):
    return m.tool_coverage(t.events.select(F.array("event_type", F.lit("")).alias("tools")), list(TOOL_DEFS))


@check(
    "user_query",
    "B18",
    rf"""WITH {MSGS}, r AS (SELECT conv_id, messages, conv_id % 3 AS k FROM msgs WHERE messages[1].role = 'user' AND len(messages) >= 3)
    SELECT conv_id, CASE k WHEN 2 THEN 'plain ' || messages[1].content ELSE {strip('messages[-2].content')} END AS query
    FROM r WHERE messages[-1].role = 'assistant'""",
)
def user_query(t):
    r = messages(t).where(
        (F.get("messages", F.lit(0))["role"] == "user") & (F.size("messages") >= 3) & (F.element_at("messages", -1)["role"] == "assistant")
    )
    k = F.col("conv_id") % 3
    at = lambda i: F.try_element_at("messages", F.lit(i))["content"]
    simple = F.concat(at(1), F.lit("\n<|assistant|>\nno<|user|>\n"), at(-2), F.lit("\n<|assistant|>\n<think>x"))
    tagged = F.concat(
        F.lit("<|im_start|>user\n"), at(1), F.lit("<|im_end|>\n"), F.lit("<|im_start|>user\n"), at(-2),
        F.lit("\n<functions>f</functions><|im_end|>\n<|im_start|>assistant\n<think>x"),
    )
    whole = F.when(k == 0, simple).when(k == 1, tagged).otherwise(F.concat(F.lit("plain "), at(1)))
    return r.select("conv_id", whole.alias("t")).select("conv_id", rules.extract_user_query("t").alias("query"))


def _tagged():
    return (
    F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("x</think> <answer> "), "text", F.lit(" </answer> <answer>no</answer>")))
    .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("a</think>  b</think> "), "text"))
    .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("<|assistant|> "), "text"))
    .otherwise(F.col("text"))
)


@check(
    "final_answer",
    "B19",
    rf"""SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'b</think> ' || regexp_replace(text, '\s+$', '') WHEN 3 THEN text ELSE {strip('text')} END AS answer FROM documents""",
)
def final_answer(t):
    return t.documents.withColumn("t", _tagged()).select("doc_id", rules.extract_final_answer("t").alias("answer"))


@check(
    "answers_by_source",
    "B19 B20",
    """SELECT source, count(*) AS rows, count(*) FILTER (WHERE doc_id % 4 <> 3) AS matched, count(*) FILTER (WHERE doc_id % 4 = 3) AS fallback FROM documents GROUP BY source""",
)
def answers_by_source(t):
    tagged = t.documents.withColumn("t", _tagged())
    return rules.rule_counts(rules.extract(tagged, "t", "final_answer"), "t", "final_answer", "source")


@check(
    "without_thinking",
    "B20",
    rf"""SELECT doc_id, {strip("CASE doc_id % 4 WHEN 0 THEN text || '  no' ELSE text END")} AS answer FROM documents""",
)
def without_thinking(t):
    return t.documents.withColumn("t", _tagged()).select("doc_id", rules.remove_thinking("t").alias("answer"))


@check(
    "code_blocks",
    "B21",
    rf"""SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN text ELSE {strip('text')} END AS code FROM conversations""",
)
def code_blocks(t):
    fenced = (
        F.when(F.col("turn") % 3 == 1, F.concat(F.lit("a\n```python\nfirst\n```\n```python\n"), "text", F.lit("\n```\nz")))
        .when(F.col("turn") % 3 == 2, F.concat(F.lit("``` "), "text", F.lit("\n```")))
        .otherwise(F.col("text"))
    )
    return t.conversations.withColumn("t", fenced).select("conv_id", "turn", rules.extract_code("t").alias("code"))


@check(
    "tool_calls",
    "B22",
    r"""SELECT conv_id, turn, u.n AS call_no, u.tool AS tool_name, u.body AS content FROM conversations,
    LATERAL (VALUES (0, 'search', text), (1, 'code', 'print(1)' || chr(10) || turn), (2, 'search', '')) AS u(n, tool, body)""",
)
def tool_calls(t):
    calls = F.concat(
        F.lit("hm <search>"), "text", F.lit("</search> then <code>print(1)\n"), F.col("turn").cast("string"), F.lit("</code></code><search></search> <search>open")
    )
    rows = t.conversations.select("conv_id", "turn", calls.alias("t"))
    return rules.extract_tool_calls(rows, "t", ["code", "search"]).drop("t")


@check(
    "tool_call_wrappers",
    "B22",
    r"""SELECT conv_id, turn, CASE WHEN contains(text, 'and') OR contains(text, 'zz') THEN text END AS call,
    E'<tool_output>\n' || text || E'\n</tool_output>\n\n<tool_output>\ndone\n</tool_output>\n' AS wrapped FROM conversations""",
)
def tool_call_wrappers(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        rules.stop_sequence_call("text", "agent", ["and", "zz", "and"])["content"].alias("call"),
        rules.format_tool_outputs(F.array("text", F.lit("done")), "tool_output").alias("wrapped"),
    )


@check(
    "shared_prefix",
    "B23",
    """WITH p AS (SELECT a.doc_id, a.text AS x, b.text AS y FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1
      UNION ALL SELECT doc_id + 10000000, text, text || '!' FROM documents
      UNION ALL SELECT doc_id + 20000000, text || 'ab', text || 'acd' FROM documents),
    c AS (SELECT *, string_split(x, '') AS cx, string_split(y, '') AS cy FROM p),
    n AS (SELECT *, coalesce(list_filter(range(1, least(len(cx), len(cy)) + 1), lambda i: cx[i] <> cy[i])[1] - 1, least(length(x), length(y))) AS k FROM c)
    SELECT doc_id, x[1:k] AS shared, x[k + 1:] AS chosen_rest, y[k + 1:] AS rejected_rest FROM n""",
)
def shared_prefix(t):
    docs = t.documents.select("doc_id", "text")
    nxt = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("y"))
    same = docs.select((F.col("doc_id") + 10000000).alias("doc_id"), "text", F.concat("text", F.lit("!")).alias("y"))
    fork = docs.select((F.col("doc_id") + 20000000).alias("doc_id"), F.concat("text", F.lit("ab")).alias("text"), F.concat("text", F.lit("acd")).alias("y"))
    pairs = docs.join(nxt, "doc_id").unionByName(same).unionByName(fork)
    return pairs.select("doc_id", m.shared_prefix("text", "y").alias("p")).select("doc_id", "p.*")
