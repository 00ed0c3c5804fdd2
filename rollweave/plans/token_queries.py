"""D: rendering and tokenisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import render as r
from rollweave.operators import tokens as k
from rollweave.operators.filters import filter_sft
from rollweave.operators.messages import message
from rollweave.operators.mixing import mix_statistics
from rollweave.plans import transforms
from rollweave.plans.inputs import joined, messages, preference_pairs, tokenizer
from rollweave.plans.registry import check
from rollweave.plans.sqltext import MSGS, PAIRS, VOCAB, encoded, labelled, masked, tagged, tokens
from rollweave.plans.sqltext import joined as sql_joined
from rollweave.session import materialise_stage


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _join(piece: str, separator: str = "''") -> str:
    return f"array_to_string(list_transform(messages, lambda m, i: {piece}), {separator})"


NL = "chr(10)"
CAP = "upper(m.role[1:1]) || m.role[2:]"
LAST = "i = len(messages)"


def _tags(content: str) -> str:
    return _join(
        f"CASE WHEN m.role = 'assistant' THEN '<|assistant|>' || {NL} || {content} || '</s>' || CASE WHEN {LAST} THEN '' ELSE {NL} END "
        f"ELSE '<|' || m.role || '|>' || {NL} || m.content || {NL} END"
    )


def _blocks(system: str, content: str = "m.content") -> str:
    head = f"CASE WHEN len(list_filter(messages, lambda m: m.role = 'system')) = 0 THEN '<|im_start|>system' || {NL} || {_quoted(system)} || '<|im_end|>' || {NL} ELSE '' END"
    note = _quoted(r.NO_FUNCTIONS)
    body = _join(
        f"CASE m.role WHEN 'system' THEN '<|im_start|>system' || {NL} || m.content || {note} || '<|im_end|>' || {NL} "
        f"WHEN 'user' THEN '<|im_start|>user' || {NL} || m.content || '<|im_end|>' || {NL} "
        f"ELSE '<|im_start|>assistant' || {NL} || {content} || CASE WHEN {LAST} THEN '</s>' ELSE '<|im_end|>' || {NL} END END"
    )
    return f"{head} || {body}"


def _paragraphs(preamble: str, before: str = "", named: bool = False) -> str:
    speaker = f"{CAP} || ': ' || " if named else ""
    return f"{_quoted(preamble)} || " + _join(f"{speaker}{_quoted(before)} || m.content || {NL}", f"{NL} || {NL}")


THINK = "CASE WHEN i % 2 = 0 THEN '<think>so</think>' || chr(10) ELSE '' END"
AFTER = f"CASE WHEN i % 2 = 0 THEN {NL} || m.content ELSE m.content END"

# Template → (text without generation prompt, its suffix, is the end mark dropped before a generation prompt).
TEMPLATE_SQL = {
    "simple_concat_with_space": (_join("m.content", "' '"), "", True),
    "simple_concat_with_new_line": (_join("m.content", NL), "", True),
    "simple_chat": (_join(f"{CAP} || ': ' || m.content", f"{NL} || {NL}"), "", True),
    "assistant_message_only": (_join("CASE WHEN m.role = 'assistant' THEN m.content ELSE '' END"), "", False),
    "closed_tags": (_join(f"'<|' || m.role || '|>' || {NL} || m.content || '</s>' || {NL}"), "<|assistant|>\n", False),
    "role_tags": (_tags("m.content"), "<|assistant|>\n", False),
    "role_tags_thinker": (_tags("m.content"), "<|assistant|>\n<think>", False),
    "role_tags_thinker_preamble": (
        f"{_quoted(r.DIALOGUE)} || " + _tags("list_last(string_split(m.content, '</think>'))"), "<|assistant|>\n<think>", False),
    "blocks": (_blocks(r.FUNCTION_CALLING), "<|im_start|>assistant\n", False),
    "blocks_old": (_blocks(r.FUNCTION_CALLING), "<|im_start|>assistant\n", False),
    "blocks_thinker": (_blocks(r.HELPFUL), "<|im_start|>assistant\n<think>", False),
    "blocks_no_think": (_blocks(r.HELPFUL), "<|im_start|>assistant\n", False),
    "blocks_thinker_trimmed": (
        _blocks(r.HELPFUL, f"CASE WHEN NOT {LAST} THEN ltrim(list_last(string_split(m.content, '</think>')), {NL}) ELSE m.content END"),
        "<|im_start|>assistant\n<think>", False),
    "blocks_no_think_sft": (_blocks(r.HELPFUL), "<|im_start|>assistant\n", False),
    "stepwise": (_paragraphs(r.STEPWISE), '\nRemember to put your answer on its own line after "Answer:"', False),
    "stepwise_code": (_paragraphs(r.STEPWISE_CODE), "\nRemember to put your solution inside the ```\npython\nCODE\n``` tags", False),
    "dialogue": (_paragraphs(r.DIALOGUE, named=True), "Assistant:", False),
    "dialogue_think": (_paragraphs(r.DIALOGUE, named=True), "Assistant: <think>", False),
    "dialogue_think_boxed": (_paragraphs(r.DIALOGUE, r.BOXED_REMINDER, True), "Assistant: <think>", False),
    "dialogue_think_boxed_code": (_paragraphs(r.DIALOGUE_WITH_CODE, r.BOXED_REMINDER, True), "Assistant: <think>", False),
    "dialogue_compact": (_paragraphs(r.DIALOGUE_COMPACT, named=True), "Assistant:", False),
}

# Assistant turns get a thinking part, so that the templates that cut it have something to cut.
THINKING_MSGS = (
    "msgs AS (SELECT conv_id, list({'role': role, 'content': CASE WHEN role = 'assistant' THEN '<think>so</think>' || chr(10) || text ELSE text END} "
    "ORDER BY turn) AS messages FROM conversations GROUP BY conv_id)"
)


def _render_sql() -> str:
    parts = []
    for name, (text, suffix, ends) in TEMPLATE_SQL.items():
        plain = f"{text} || '</s>'" if ends else text
        parts.append(f"SELECT conv_id, '{name}' AS template, {plain} AS text, {text} || {_quoted(suffix)} AS with_prompt FROM msgs")
    return f"WITH {THINKING_MSGS} " + " UNION ALL ".join(parts)


@check("rendered_chats", "D1", _render_sql())
def rendered_chats(t):
    thinking = F.transform(
        "messages",
        lambda m: message(m["role"], F.when(m["role"] == "assistant", F.concat(F.lit("<think>so</think>\n"), m["content"])).otherwise(m["content"])),
    )
    texts = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("template"), r.render("messages", n).alias("text"), r.render("messages", n, add_generation_prompt=True).alias("with_prompt"))
                for n in TEMPLATE_SQL
            ]
        )
    )
    return messages(t).withColumn("messages", thinking).select("conv_id", texts.alias("x")).select("conv_id", "x.*")


@check(
    "rendered_functions",
    "D1",
    f"""WITH {MSGS}, f AS (SELECT conv_id, messages, list_transform(messages, lambda m, i: CASE WHEN m.role IN ('system', 'user') AND i % 2 = 1 THEN '[f' || i || ']' END) AS fs,
      list_transform(messages, lambda m, i: CASE WHEN m.role = 'assistant' AND i % 4 = 0 THEN 'call()' END) AS cs FROM msgs)
    SELECT conv_id, CASE WHEN len(list_filter(messages, lambda m: m.role = 'system')) = 0 THEN '<|im_start|>system' || chr(10) || 'Hi.<|im_end|>' || chr(10) ELSE '' END ||
      array_to_string(list_transform(messages, lambda m, i: CASE m.role
        WHEN 'system' THEN '<|im_start|>system' || chr(10) || m.content || coalesce(' <functions>' || fs[i] || '</functions>', {_quoted(r.NO_FUNCTIONS)}) || '<|im_end|>' || chr(10)
        WHEN 'user' THEN '<|im_start|>user' || chr(10) || m.content || coalesce(chr(10) || '<functions>' || fs[i] || '</functions>', '') || '<|im_end|>' || chr(10)
        ELSE '<|im_start|>assistant' || chr(10) || m.content || coalesce('<function_calls>' || cs[i] || '</function_calls>', '') || CASE WHEN i = len(messages) THEN '<eos>' ELSE '<|im_end|>' || chr(10) END END), '') AS text FROM f""",
)
def rendered_functions(t):
    with_functions = F.transform(
        "messages",
        lambda m, i: F.struct(
            m["role"].alias("role"),
            m["content"].alias("content"),
            F.when(m["role"].isin("system", "user") & (i % 2 == 0), F.concat(F.lit("[f"), (i + 1).cast("string"), F.lit("]"))).alias("functions"),
            F.when((m["role"] == "assistant") & (i % 4 == 3), F.lit("call()")).alias("function_calls"),
        ),
    )
    rows = messages(t).withColumn("messages", with_functions)
    return r.render_chat(rows, "blocks", eos="<eos>", default_system="Hi.").select("conv_id", "text")


@check("vocabulary", "D2", f"WITH {VOCAB} SELECT token, id, frequency FROM vocab")
def vocabulary(t):
    return tokenizer(t).vocabulary


def _ids_sql(unknown: str = "3") -> str:
    return f"SELECT doc_id, len(ids) AS n, list_sum(ids)::BIGINT AS total, len(list_filter(ids, lambda x: x = {unknown})) AS unknown, md5({sql_joined('ids')}) AS ids_md5 FROM e"


def _ids(df, unknown: int = 3):
    """Whole id lists: their sums and digests."""
    return df.select(
        "doc_id",
        F.size("ids").alias("n"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        F.size(F.filter("ids", lambda x: x == unknown)).alias("unknown"),
        F.md5(joined("ids").cast("binary")).alias("ids_md5"),
    )


def _document_tokens(t):
    return t.documents.select("doc_id", k.tokens_of("text").alias("toks"))


DOCS_SQL = f"d AS (SELECT doc_id, {tokens('text')} AS toks FROM documents)"


@check("encoded_documents", "D2", f"WITH {VOCAB}, {DOCS_SQL}, {encoded('e', 'doc_id', 'toks', 'd')} {_ids_sql()}")
def encoded_documents(t):
    return _ids(k.encode(_document_tokens(t), "doc_id", {"ids": "toks"}, tokenizer(t).vocabulary))


OWN_SQL = f"{DOCS_SQL}, own AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, md5(token), token) + 3 AS rank FROM (SELECT unnest(toks) AS token FROM d) WHERE token NOT IN ('<pad>', '</s>', '<s>', '<unk>') GROUP BY token)"
# The documents hold none of the special tokens as a vocabulary entry of their own.
SPECIAL_SQL = "SELECT * FROM (VALUES ('<pad>', 0), ('</s>', 1), ('<s>', 2), ('<unk>', 3)) v(token, id)"


def _own_sql(ids: str, where: str = "true") -> str:
    vocab = f"vocab AS (SELECT token, {ids} AS id FROM own WHERE {where} UNION ALL {SPECIAL_SQL})"
    return f"WITH {OWN_SQL}, {vocab}, {encoded('e', 'doc_id', 'toks', 'd')}"


def _own_vocabulary(t, **limits):
    # Stored, as it is read three times.
    return materialise_stage(k.build_vocabulary(_document_tokens(t), "toks", **limits), "vocabulary")


@check("encoded_tail", "D2", f"{_own_sql('rank')} {_ids_sql()}")
def encoded_tail(t):
    """A head of 500 tokens: most distinct tokens come from the rest of the vocabulary."""
    return _ids(k.encode(_document_tokens(t), "doc_id", {"ids": "toks"}, _own_vocabulary(t), head=500))


@check("encoded_resized", "D2", f"{_own_sql('rank', 'rank < 700')} {_ids_sql()}")
def encoded_resized(t):
    """A vocabulary cut to 700 entries: all other tokens are unknown, on both sides of the head's bound."""
    return _ids(k.encode(_document_tokens(t), "doc_id", {"ids": "toks"}, _own_vocabulary(t, max_size=700), head=300))


@check("encoded_sparse_ids", "D2", f"{_own_sql('rank * 7 + 5')} {_ids_sql()}")
def encoded_sparse_ids(t):
    """Ids with gaps, under a vocabulary of the caller's."""
    own = _own_vocabulary(t)
    sparse = own.withColumn("id", F.when(F.col("id") > 3, F.col("id") * 7 + 5).otherwise(F.col("id")))
    return _ids(k.encode(_document_tokens(t), "doc_id", {"ids": "toks"}, sparse, head=2000))


PROMPT_SQL = "CASE WHEN len(messages) = 1 THEN messages ELSE messages[1:len(messages) - 1] END"
SFT_SQL = f"""{VOCAB}, x AS (SELECT conv_id, messages, {PROMPT_SQL} AS prompt FROM msgs),
    y AS (SELECT conv_id, {tokens(tagged('messages', False))} AS full_toks, {tokens(tagged('prompt', True))} AS prompt_toks FROM x),
    {encoded('f', 'conv_id', 'full_toks', 'y')}, {encoded('p', 'conv_id', 'prompt_toks', 'y')}"""


@check(
    "sft_rows",
    "D3 D4",
    f"""WITH {SFT_SQL} SELECT conv_id, {sql_joined('f.ids')} AS full_ids, {sql_joined('p.ids')} AS prompt_ids, len(f.ids) AS attended,
    {sql_joined('f.ids')} AS plain_labels, {sql_joined('list_transform(f.ids, lambda x, i: CASE WHEN i <= len(p.ids) THEN -100 ELSE x END)')} AS masked FROM f JOIN p USING (conv_id)""",
)
def sft_rows(t):
    tok = tokenizer(t)
    rows = k.tokenize_sft(messages(t), tok, "conv_id")
    return rows.select(
        "conv_id",
        joined("input_ids").alias("full_ids"),
        joined("input_ids_prompt").alias("prompt_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attended"),
        joined("labels").alias("plain_labels"),
        joined(k.mask_prompt("labels", "input_ids_prompt")).alias("masked"),
    )


def _turns_sql(trainable: str, limit: int) -> str:
    return f"""WITH {VOCAB}, {labelled('lab', 'messages', 'msgs', trainable)}, {encoded('e', 'conv_id', 'toks', 'lab')}
    SELECT conv_id, {sql_joined(f'ids[1:{limit}]')} AS input_ids, {sql_joined(masked('ids', 'keep') + f'[1:{limit}]')} AS labels, least(len(ids), {limit}) AS attended
    FROM e JOIN lab USING (conv_id)"""


def _turn_columns(df):
    return df.select("conv_id", joined("input_ids").alias("input_ids"), joined("labels").alias("labels"), F.size("attention_mask").alias("attended"))


@check("assistant_only_rows", "D5", _turns_sql("assistant", 200))
def assistant_only_rows(t):
    return _turn_columns(k.tokenize_assistant_only(messages(t), tokenizer(t), "conv_id", 200))


@check("last_turn_rows", "D6", _turns_sql("last", 100000))
def last_turn_rows(t):
    return _turn_columns(k.tokenize_last_turn(messages(t), tokenizer(t), "conv_id", 100000))


CHOSEN_SQL = "list_append(prompt, {'role': 'assistant', 'content': good})"
REJECTED_SQL = "list_append(prompt, {'role': 'assistant', 'content': bad})"
PAIR_ROWS = PAIRS.replace(MSGS, VOCAB, 1)


@check(
    "preference_rows",
    "D7 E2",
    f"""WITH {PAIR_ROWS}, {labelled('lc', CHOSEN_SQL, 'pairs', 'last')}, {labelled('lr', REJECTED_SQL, 'pairs', 'last')},
    {encoded('ec', 'conv_id', 'toks', 'lc')}, {encoded('er', 'conv_id', 'toks', 'lr')}
    SELECT conv_id, {sql_joined('ec.ids[1:150]')} AS chosen_input_ids, {sql_joined(masked('ec.ids', 'lc.keep') + '[1:150]')} AS chosen_labels,
      {sql_joined('er.ids[1:150]')} AS rejected_input_ids, {sql_joined(masked('er.ids', 'lr.keep') + '[1:150]')} AS rejected_labels
    FROM ec JOIN er USING (conv_id) JOIN lc USING (conv_id) JOIN lr USING (conv_id)""",
)
def preference_rows(t):
    rows = k.tokenize_preference(preference_pairs(t).select("conv_id", "chosen", "rejected"), tokenizer(t), "conv_id", "last", 150)
    names = ["chosen_input_ids", "chosen_labels", "rejected_input_ids", "rejected_labels"]
    return rows.select("conv_id", *[joined(n).alias(n) for n in names])


@check(
    "preference_rows_plain",
    "D7",
    f"""WITH {PAIR_ROWS}, z AS (SELECT conv_id, {tokens(tagged('prompt', True))} AS pt, {tokens(tagged('chosen', False))} AS ct, {tokens(tagged('rejected', False))} AS rt
      FROM (SELECT conv_id, prompt, {CHOSEN_SQL} AS chosen, {REJECTED_SQL} AS rejected FROM pairs)),
    {encoded('p', 'conv_id', 'pt', 'z')}, {encoded('c', 'conv_id', 'ct', 'z')}, {encoded('j', 'conv_id', 'rt', 'z')}
    SELECT conv_id, {sql_joined('p.ids')} AS prompt_ids, len(c.ids) AS n_chosen, len(j.ids) AS n_rejected FROM p JOIN c USING (conv_id) JOIN j USING (conv_id)""",
)
def preference_rows_plain(t):
    rows = k.tokenize_preference(preference_pairs(t).select("conv_id", "chosen", "rejected"), tokenizer(t), "conv_id", "plain")
    return rows.select(
        "conv_id", joined("input_ids_prompt").alias("prompt_ids"), F.size("chosen_attention_mask").alias("n_chosen"), F.size("rejected_attention_mask").alias("n_rejected")
    )


def _rlvr_sql(version: int, prompt: str, full: bool) -> str:
    full_ids = sql_joined("f.ids") if full else "NULL::VARCHAR"
    return f"""
    SELECT q.conv_id, {version} AS version, {sql_joined('p{0}.ids'.format(version))} AS prompt_ids, {full_ids} AS input_ids,
      array_to_string(list_transform(q.prompt, lambda m: m.role || ': ' || m.content), chr(10)) AS prompt, 'gsm8k' AS verifier, q.conv_id::VARCHAR AS truth
    FROM q{version} q JOIN p{version} USING (conv_id) {'JOIN f USING (conv_id)' if full else ''}"""


_SYS = "list_concat([{'role': 'system', 'content': 'Be kind.'}], CASE WHEN b[1].role = 'system' THEN b[2:] ELSE b END)"
_TRAIL = "CASE WHEN len(messages) > 1 AND messages[-1].role = 'assistant' THEN messages[1:len(messages) - 1] ELSE messages END"


@check(
    "verifiable_rows",
    "D8",
    f"""WITH {SFT_SQL}, q1 AS (SELECT conv_id, {_SYS} AS prompt FROM (SELECT conv_id, {PROMPT_SQL} AS b FROM msgs)),
    q2 AS (SELECT conv_id, {PROMPT_SQL} AS prompt FROM msgs), q3 AS (SELECT conv_id, {_SYS} AS prompt FROM (SELECT conv_id, {_TRAIL} AS b FROM msgs)),
    """
    + ", ".join(
        f"t{v} AS (SELECT conv_id, {tokens(tagged('prompt', True))} AS toks FROM q{v}), {encoded(f'p{v}', 'conv_id', 'toks', f't{v}')}" for v in (1, 2, 3)
    )
    + " "
    + " UNION ALL ".join([_rlvr_sql(1, "q1", True), _rlvr_sql(2, "q2", True), _rlvr_sql(3, "q3", False)]),
)
def verifiable_rows(t):
    tok = tokenizer(t)
    rows = messages(t).withColumns({"ground_truth": F.col("conv_id").cast("string"), "dataset": F.lit("gsm8k")})
    parts = []
    for version in (1, 2, 3):
        coded = k.tokenize_rlvr(rows, tok, "conv_id", version, system_prompt=None if version == 2 else "Be kind.")
        first = (lambda c: F.col(c)) if version == 1 else (lambda c: F.element_at(c, 1))
        parts.append(
            coded.select(
                "conv_id",
                F.lit(version).alias("version"),
                joined("input_ids_prompt").alias("prompt_ids"),
                (joined("input_ids") if version != 3 else F.lit(None).cast("string")).alias("input_ids"),
                "prompt",
                first("dataset").alias("verifier"),
                first("ground_truth").alias("truth"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "transform_chain",
    "D9 L1",
    f"""WITH {VOCAB}, {labelled('lab', 'messages', 'msgs', 'assistant')}, {encoded('e', 'conv_id', 'toks', 'lab')}
    SELECT conv_id, 'chats' AS dataset_source, {sql_joined(masked('ids', 'keep') + '[1:120]')} AS labels FROM e JOIN lab USING (conv_id)
    WHERE len(list_filter(keep[1:120], lambda x: x = 1)) > 0 AND len(ids) > 60""",
)
def transform_chain(t):
    transforms.register_transform("longer_than", lambda df, tok, n: F.size("input_ids") > n, "filter")
    rows = messages(t).withColumn("dataset_source", F.lit("chats"))
    steps = ["sft_assistant_tokenize_and_truncate_v1", "sft_assistant_filter_v1", "longer_than"]
    out = transforms.run_transforms(rows, steps, [{"max_seq_length": 120}, {}, {"n": 60}], tokenizer(t), "conv_id", target=["conv_id", "labels", "input_ids"])
    return out.select("conv_id", "dataset_source", joined("labels").alias("labels"))


@check(
    "cached_transform_chain",
    "C13 D9",
    f"""WITH {VOCAB}, {labelled('lab', 'messages', 'msgs', 'assistant')}, {encoded('e', 'conv_id', 'toks', 'lab')}
    SELECT conv_id, len(ids) > 80 AS longer, CASE WHEN len(ids) > 80 THEN 1 ELSE 3 END AS steps_run, md5({sql_joined(masked('ids', 'keep') + '[1:120]')}) AS labels_md5 FROM e JOIN lab USING (conv_id)
    WHERE len(list_filter(keep[1:120], lambda x: x = 1)) > 0 AND len(ids) > 60""",
)
def cached_transform_chain(t):
    """The chain twice, the second time with another last step: only that step runs."""
    transforms.register_transform("longer_than", lambda df, tok, n: F.size("input_ids") > n, "filter")
    steps, root, coder = ["sft_assistant_tokenize_and_truncate_v1", "sft_assistant_filter_v1", "longer_than"], t.scratch("steps"), tokenizer(t)

    def run(n):
        settings = {"table": f"{t.root}/conversations", "template": "role_tags"}
        out, ran = transforms.run_cached_transforms(
            messages(t), steps, [{"max_seq_length": 120}, {}, {"n": n}], coder, "conv_id", root, settings, target=["conv_id", "labels", "input_ids"]
        )
        return out.select("conv_id", F.md5(joined("labels").cast("binary")).alias("labels_md5"), F.lit(len(ran)).alias("steps_run"))

    first, second = run(60), run(80)
    return first.join(second.select("conv_id"), "conv_id", "left_anti").unionByName(second).withColumn("longer", F.col("steps_run") == 1)


@check(
    "sft_statistics",
    "B1 D1 D2 D5 E1 C11",
    f"""WITH {VOCAB}, {labelled('lab', 'messages', 'msgs', 'assistant')}, s AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'web' ELSE 'books' END AS dataset_source,
      least(len(toks), 256) AS n, len(list_filter(keep[1:256], lambda x: x = 1)) AS trainable FROM lab)
    SELECT dataset_source, count(*) FILTER (WHERE trainable > 0 AND n <= 250) AS final_instances, count(*) AS initial_instances, count(*) AS original_size, 1.0::DOUBLE AS requested,
      coalesce(sum(n) FILTER (WHERE trainable > 0 AND n <= 250), 0)::BIGINT AS total_tokens, coalesce(sum(trainable) FILTER (WHERE trainable > 0 AND n <= 250), 0)::BIGINT AS trainable_tokens,
      count(*) - count(*) FILTER (WHERE trainable > 0 AND n <= 250) AS instances_filtered, false AS is_upsampled, 1.0::DOUBLE AS upsampling_factor,
      round(coalesce(avg(n) FILTER (WHERE trainable > 0 AND n <= 250), 0), 6) AS avg_tokens_per_instance FROM s GROUP BY 1""",
)
def sft_statistics(t):
    source = F.when(F.col("conv_id") % 3 == 0, F.lit("web")).otherwise(F.lit("books"))
    rows = messages(t).withColumn("dataset_source", source)
    kept = filter_sft(k.tokenize_assistant_only(rows, tokenizer(t), "conv_id", 256), max_total=250)
    sizes = rows.groupBy("dataset_source").agg(F.count("*").alias("original_size")).withColumn("requested", F.lit(1.0))
    return mix_statistics(rows, kept, sizes).withColumn("avg_tokens_per_instance", F.round("avg_tokens_per_instance", 6))
