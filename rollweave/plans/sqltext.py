"""Shared fragments of the SQL twins."""

MSGS = (
    "msgs AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages "
    "FROM conversations GROUP BY conv_id)"
)


def flat(messages: str) -> str:
    """Messages as one text, for comparison."""
    return f"array_to_string(list_transform({messages}, lambda m: m.role || ': ' || m.content), chr(10))"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


# One rollout per lineitem row: prompt = order, sample number by all columns.
ROLLOUTS = (
    "rollouts AS (SELECT l_orderkey AS prompt_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY "
    "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
    "l_shipdate) - 1 AS INTEGER) AS sample, l_quantity AS reward, l_extendedprice AS tokens, l_suppkey AS model, "
    "l_linenumber AS line, l_discount AS d, l_tax AS t, l_returnflag AS flag, l_linestatus AS status FROM lineitem)"
)

# Preference pairs: last assistant turn chosen, first assistant turn rejected.
PAIRS = (
    MSGS + ", asst AS (SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations "
    "WHERE role = 'assistant' GROUP BY conv_id HAVING count(*) >= 2), "
    "pairs AS (SELECT a.conv_id, m.messages[1:a.last_turn] AS prompt, "
    "m.messages[a.last_turn + 1].content AS good, m.messages[a.first_turn + 1].content AS bad "
    "FROM asst a JOIN msgs m USING (conv_id))"
)

# Tokens: special tags, newlines, runs of other characters.
TOKEN_SQL = r"<\|[a-z_]+\|>|</?[a-z_]+>|\n|[^\s<]+|<"


def tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN_SQL}')"


def tagged(messages: str, generate: bool) -> str:
    """The role-tag rendering of a message list."""
    body = (
        f"array_to_string(list_transform({messages}, lambda m, i: CASE WHEN m.role = 'assistant' "
        f"THEN '<|assistant|>' || chr(10) || m.content || '</s>' || CASE WHEN i = len({messages}) THEN '' ELSE chr(10) END "
        "ELSE '<|' || m.role || '|>' || chr(10) || m.content || chr(10) END), '')"
    )
    return f"{body} || '<|assistant|>' || chr(10)" if generate else body


VOCAB = (
    MSGS + f", corpus AS (SELECT conv_id, {tokens(tagged('messages', False))} AS toks FROM msgs), "
    "vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY count(*) DESC, md5(token), token) + 3 AS INTEGER) AS id, count(*) AS frequency "
    "FROM (SELECT unnest(toks) AS token FROM corpus) WHERE token NOT IN ('<pad>', '</s>', '<s>', '<unk>') GROUP BY token "
    "UNION ALL SELECT * FROM (VALUES ('<pad>', 0, 0), ('</s>', 1, 0), ('<s>', 2, 0), ('<unk>', 3, 0)) v(token, id, frequency))"
)


def encoded(name: str, key: str, tokens_column: str, source: str) -> str:
    """CTE ``name(key, ids)``: ids of a token list, in order."""
    return (
        f"{name} AS (SELECT u.{key}, list(coalesce(v.id, 3) ORDER BY u.pos) AS ids FROM "
        f"(SELECT {key}, unnest({tokens_column}) AS token, generate_subscripts({tokens_column}, 1) AS pos FROM {source}) u "
        f"LEFT JOIN vocab v USING (token) GROUP BY u.{key})"
    )


# Tokens with their label flag under the role-tag template: per message, then unnested.
def labelled(name: str, messages: str, source: str, trainable: str, key: str = "conv_id") -> str:
    """CTE ``name(key, toks, keep)``; keep = 1 where the token carries loss."""
    if trainable == "assistant":
        head = "CASE WHEN i > 1 AND ms[i - 1].role <> 'assistant' THEN 0 ELSE 1 END"
        tail = "CASE WHEN ms[i + 1].role <> 'assistant' THEN 0 ELSE 1 END"
        own, line = "1", head
    else:
        # A prefix that ends in an assistant turn is one newline short of the full text.
        head = "CASE WHEN i = len(ms) AND i = 1 THEN 1 ELSE 0 END"
        line = "CASE WHEN i = len(ms) AND (i = 1 OR ms[i - 1].role = 'assistant') THEN 1 ELSE 0 END"
        tail = "CASE WHEN i = len(ms) - 1 AND ms[i + 1].role <> 'assistant' THEN 1 ELSE 0 END"
        own = "CASE WHEN i = len(ms) THEN 1 ELSE 0 END"
    other = "CASE WHEN i = len(ms) THEN 1 ELSE 0 END" if trainable == "last" else "0"
    content = tokens("m.content || '</s>'")
    plain = tokens("'<|' || m.role || '|>' || chr(10) || m.content || chr(10)")
    return f"""
    {name}_p AS (SELECT {key}, list_transform(ms, lambda m, i: CASE WHEN m.role = 'assistant' THEN
        list_concat(list_concat([{{'t': '<|assistant|>', 'k': {head}}}, {{'t': chr(10), 'k': {line}}}],
          list_transform({content}, lambda t: {{'t': t, 'k': {own}}})),
          CASE WHEN i = len(ms) THEN [] ELSE [{{'t': chr(10), 'k': {tail}}}] END)
        ELSE list_transform({plain}, lambda t: {{'t': t, 'k': {other}}}) END) AS parts FROM (SELECT {key}, {messages} AS ms FROM {source})),
    {name} AS (SELECT {key}, list_transform(flatten(parts), lambda x: x.t) AS toks, list_transform(flatten(parts), lambda x: x.k) AS keep FROM {name}_p)
    """


def joined(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def masked(ids: str, keep: str) -> str:
    return f"list_transform({ids}, lambda x, i: CASE WHEN {keep}[i] = 1 THEN x ELSE -100 END)"
