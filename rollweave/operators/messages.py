"""Schema normalisation and message construction.

``messages`` is ``array<struct<role,content>>``; everything below is column expressions, so
projections and filters stay inside the scan stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,content:string>>"

# Prompt frames.
TASK_FRAME = (
    "Below is an instruction that describes a task, paired with an input that provides "
    "further context. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n",
    "\n\n### Input:\n",
    "\n\n### Response:",
)
SYSTEM_PROMPT = "You are a helpful assistant. Follow the user's instructions carefully."
BOXED_PREFIX = "Solve the following math problem. Make sure to put the answer (and only answer) inside \\boxed{}. \n\n"
BOXED_TEMPLATE = "Solve the following math problem. Make sure to put the answer (and only answer) inside \\boxed{}.\n\n"

# Role names of the ``conversations`` format.
ROLE_ALIASES = {
    "gpt": "assistant",
    "Assistant": "assistant",
    "assistant": "assistant",
    "user": "user",
    "User": "user",
    "human": "user",
}


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: str | Column, use) -> Column:
    """Bind a computed value to a name: it is evaluated once per row however often ``use``
    refers to it, and the expression does not grow with each reference."""
    return F.get(F.transform(F.array(as_column(value)), lambda bound: use(bound)), 0)


def first_match(pairs, otherwise: Column) -> Column:
    """One flat CASE over (condition, value) pairs."""
    chain = None
    for condition, value in pairs:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def message(role: str | Column, content: str | Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), as_column(content).alias("content"))


# --- B1, B4, B9-B11, B13 -------------------------------------------------------------------


def turns_to_messages(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """B1: long turn table → one ordered ``messages`` array per conversation."""
    turns = F.sort_array(F.collect_list(F.struct(turn, role, text)))
    pack = lambda t: message(t[role], t[text])
    return df.groupBy(key).agg(F.transform(turns, pack).alias("messages"))


def is_message_format(messages: str | Column = "messages") -> Column:
    """An array whose every element has a role and a content."""
    col = as_column(messages)
    complete = F.forall(col, lambda m: m["role"].isNotNull() & m["content"].isNotNull())
    return F.coalesce(complete, F.lit(False))


def prompt_of(messages: str | Column = "messages") -> Column:
    """All but the last message, or the only one."""
    col = as_column(messages)
    return F.when(F.size(col) <= 1, col).otherwise(F.slice(col, 1, F.greatest(F.size(col) - 1, F.lit(0))))


def completion_of(messages: str | Column = "messages") -> Column:
    """The last message."""
    return F.try_element_at(as_column(messages), F.lit(-1))


def split_prompt_completion(df: DataFrame, messages: str = "messages") -> DataFrame:
    return df.withColumns({"prompt": prompt_of(messages), "completion": completion_of(messages)})


def drop_trailing_assistant(messages: str | Column = "messages") -> Column:
    """Cut a last assistant message when others precede it; an empty array is an error."""
    col = as_column(messages)
    last = F.try_element_at(col, F.lit(-1))["role"]
    empty = F.raise_error(F.lit("empty prompt in dataset")).cast(MESSAGES)
    return (
        F.when(F.size(col) == 0, empty)
        .when((F.size(col) > 1) & (last == "assistant"), prompt_of(col))
        .otherwise(col)
    )


def override_system_prompt(messages: str | Column, text: str | None) -> Column:
    """Replace or add the leading system message; nothing happens without a text."""
    col = as_column(messages)
    if not text:
        return col
    leading = F.get(col, 0)["role"] == "system"
    rest = F.when(leading, F.slice(col, 2, F.greatest(F.size(col) - 1, F.lit(0)))).otherwise(col)
    return F.concat(F.array(message("system", F.lit(text))), rest)


def flatten_prompt(messages: str | Column = "messages") -> Column:
    """``role: content`` lines."""
    lines = F.transform(as_column(messages), lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return F.array_join(lines, "\n")


def strip_space(text: Column) -> Column:
    """Python's ``strip()``: every kind of white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def flatten_for_judge(messages: str | Column = "messages") -> Column:
    """B13, judge form: ``User A`` for the user, ``User B`` for anyone else, contents trimmed."""

    def line(m: Column) -> Column:
        speaker = F.when(m["role"] == "user", F.lit("User A")).otherwise(F.lit("User B"))
        return F.concat(speaker, F.lit(": "), strip_space(m["content"]))

    return F.array_join(F.transform(as_column(messages), line), "\n")


# --- B2, B3: source formats ----------------------------------------------------------------


def _user_assistant(user: Column, assistant: Column) -> Column:
    return F.array(message("user", user), message("assistant", assistant))


def _from_instruction(df: DataFrame) -> Column:
    before, between, after = (F.lit(part) for part in TASK_FRAME)
    return _user_assistant(F.concat(before, F.col("instruction"), between, F.col("input"), after), F.col("output"))


def _from_question(df: DataFrame) -> Column:
    return F.concat(
        F.array(message("system", F.col("system_prompt"))), _user_assistant(F.col("question"), F.col("response"))
    )


def _from_conversations(df: DataFrame) -> Column:
    aliases = F.create_map(*[F.lit(x) for pair in ROLE_ALIASES.items() for x in pair])

    def convert(m: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("unknown speaker: "), F.coalesce(m["from"], F.lit("null")))).cast("string")
        return message(F.coalesce(aliases[m["from"]], unknown), m["value"])

    return F.transform("conversations", convert)


# First match wins.
FORMATS = (
    ("instruction", ("instruction", "output"), _from_instruction),
    ("completion", ("prompt", "completion"), lambda df: _user_assistant(F.col("prompt"), F.col("completion"))),
    ("conversations", ("conversations",), _from_conversations),
    ("question", ("question", "response"), _from_question),
    ("answer", ("query", "answer"), lambda df: _user_assistant(F.col("query"), F.col("answer"))),
    ("response", ("query", "response"), lambda df: _user_assistant(F.col("query"), F.col("response"))),
    ("rejection", ("chosen", "rejected", "reference_completion"), lambda df: F.col("chosen")),
)


def detect_format(df: DataFrame) -> str | None:
    """The source format by column names, or nothing when ``messages`` exists already."""
    if "messages" in df.columns:
        return None
    return next((name for name, needed, _ in FORMATS if set(needed) <= set(df.columns)), None)


def to_messages(df: DataFrame) -> DataFrame:
    """B2: add ``messages`` from whichever source format the columns show."""
    found = detect_format(df)
    if found is None:
        return df
    build = next(fn for name, _, fn in FORMATS if name == found)
    return df.withColumn("messages", build(df))


# --- B5-B7: columns ------------------------------------------------------------------------


def align_columns(df: DataFrame, keep: list[str], need: list[str] = (), like: DataFrame | None = None) -> DataFrame:
    """Keep ``keep`` + ``id``, fill absent ones with nulls, cast to the first table's types."""
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"needed columns {missing} not found in {df.columns}")
    wanted = [*keep, *(["id"] if "id" in df.columns and "id" not in keep else [])]
    types = {f.name: f.dataType for f in (like or df).schema.fields}
    columns = []
    for name in wanted:
        column = F.col(name) if name in df.columns else F.lit(None)
        columns.append((column.cast(types[name]) if name in types else column).alias(name))
    return df.select(*columns)


def add_provenance(df: DataFrame, name: str, key: str, split: str | None = None, source_col: str | None = "source") -> DataFrame:
    """``id`` from name and row number when missing, ``source``, ``dataset_source``, ``index``."""
    from rollweave.operators.ordering import row_index

    indexed = row_index(df, key)
    if "id" not in df.columns:
        parts = [F.lit(name), F.col("index").cast("string"), *([F.lit(split)] if split else [])]
        indexed = indexed.withColumn("id", F.concat_ws("_", *parts))
    if source_col:
        indexed = indexed.withColumn(source_col, F.lit(name))
    return indexed.withColumn("dataset_source", F.lit(name))


PRESERVED = ("dataset_source", "tools", "env_config")


def prune_columns(df: DataFrame, target: list[str] | None) -> DataFrame:
    """The target columns plus the ones every transform carries along."""
    if target is None:
        return df
    return df.select(*[c for c in df.columns if c in target or c in PRESERVED])


# --- B8: prompts ---------------------------------------------------------------------------


def _after_prefix(text: Column, prefix: str, trim: bool = False) -> Column:
    cut = F.substr(text, F.lit(len(prefix) + 1))
    cut = F.regexp_replace(cut, r"(?U)^\s+", "") if trim else cut
    return F.when(text.startswith(prefix), cut).otherwise(text)


PROMPT_VARIANTS = {
    "plain": lambda text: text,
    "user_line": lambda text: _after_prefix(text, "user: "),
    "boxed_prefix": lambda text: F.concat(F.lit(BOXED_PREFIX), _after_prefix(text, "user:", trim=True)),
    "last_question": lambda text: F.concat(
        F.lit(BOXED_TEMPLATE), strip_space(F.substring_index(text, "Question:", -1))
    ),
}


def make_prompt(text: str | Column, variant: str = "plain", system: str = SYSTEM_PROMPT) -> Column:
    """A system and a user message from raw prompt text."""
    return F.array(message("system", F.lit(system)), message("user", PROMPT_VARIANTS[variant](as_column(text))))


# --- B12: labels ---------------------------------------------------------------------------

KWARGS = "map<string,string>"
CONSTRAINT = "array<struct<instruction_id:string,kwargs:map<string,string>>>"

# Old check name → (constraint id, {new argument: old argument}, {new argument: constant}).
# ``relation`` arguments listed in RELATION_ARGS go through the quantifier rule.
FUNCTION_IDS: dict[str, tuple[str, dict[str, str], dict[str, str]]] = {
    "validate_lowercase": ("change_case:english_lowercase", {}, {}),
    "validate_uppercase": ("change_case:english_capital", {}, {}),
    "validate_no_commas": ("punctuation:no_comma", {}, {}),
    "validate_quotation": ("startend:quotation", {}, {}),
    "validate_json_format": ("detectable_format:json_format", {}, {}),
    "validate_title": ("detectable_format:title", {}, {}),
    "validate_two_responses": ("combination:two_responses", {}, {}),
    "validate_choice": ("detectable_format:constrained_response", {}, {}),
    "validate_end": ("startend:end_checker", {"end_phrase": "end_phrase"}, {}),
    "validate_forbidden_words": ("keywords:forbidden_words", {"forbidden_words": "forbidden_words"}, {}),
    "validate_highlighted_sections": ("detectable_format:number_highlighted_sections", {"num_highlights": "N"}, {}),
    "validate_placeholders": ("detectable_content:number_placeholders", {"num_placeholders": "N"}, {}),
    "validate_repeat_prompt": ("combination:repeat_prompt", {"prompt_to_repeat": "original_prompt"}, {}),
    "validate_sections": ("detectable_format:multiple_sections", {"section_spliter": "section_splitter", "num_sections": "N"}, {}),
    "validate_paragraphs": ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": "N", "nth_paragraph": "i", "first_word": "first_word"}, {}),
    "validate_frequency_capital_words": ("change_case:capital_word_frequency", {"capital_frequency": "N", "capital_relation": "quantifier"}, {}),
    "validate_word_constraint": ("length_constraints:number_words", {"num_words": "N", "relation": "quantifier"}, {}),
    "verify_paragraph_count": ("length_constraints:number_paragraphs", {"num_paragraphs": "N"}, {}),
    "verify_sentence_constraint": ("length_constraints:number_sentences", {"num_sentences": "N", "relation": "quantifier"}, {}),
    "verify_keywords": ("keywords:existence", {"keywords": "keyword_list"}, {}),
    "verify_keyword_frequency": ("keywords:frequency", {"keyword": "word", "frequency": "N"}, {"relation": "at least"}),
    "verify_letter_frequency": ("keywords:letter_frequency", {"letter": "letter", "let_frequency": "N"}, {"let_relation": "at least"}),
    "verify_bullet_points": ("detectable_format:number_bullet_lists", {"num_bullets": "N"}, {}),
    "verify_postscript": ("detectable_content:postscript", {"postscript_marker": "postscript_marker"}, {}),
}


def quantifier_relation(quantifier: Column) -> Column:
    """``at most`` and ``less than`` become ``less than``, all else ``at least``; null stays null."""
    lowered = F.lower(strip_space(quantifier))
    return (
        F.when(quantifier.isNull(), F.lit(None).cast("string"))
        .when(lowered.isin("at most", "less than"), F.lit("less than"))
        .otherwise(F.lit("at least"))
    )


def label_arrays(df: DataFrame, ground_truth: str = "ground_truth", verifier: str = "dataset") -> DataFrame:
    """Scalar verifier and ground truth → one-element arrays; arrays stay."""
    if dict(df.dtypes)[verifier].startswith("array"):
        return df
    return df.withColumns({ground_truth: F.array(ground_truth), verifier: F.array(verifier)})


def python_literal_to_json(text: Column) -> Column:
    """Quotes and constants of a Python literal rewritten as JSON.

    Covers literals without escaped quotes, which is what the constraint lists hold.
    """
    swapped = F.translate(text, "'", '"')
    for old, new in (("None", "null"), ("True", "true"), ("False", "false")):
        swapped = F.regexp_replace(swapped, rf'([:\[,]\s*){old}(\s*[,\]}}])', rf"$1{new}$2")
    return swapped


def _drop_null_args(kwargs: Column) -> Column:
    return F.map_filter(kwargs, lambda _, v: v.isNotNull())


def _old_constraint(text: Column) -> Column:
    """``{"func_name": ...}`` JSON → one constraint with renamed arguments, or null when unmapped."""
    name = F.get_json_object(text, "$.func_name")
    cases = []
    for func, (identifier, renames, constants) in FUNCTION_IDS.items():
        entries = []
        for new, old in renames.items():
            value = F.get_json_object(text, f"$.{old}")
            entries += [F.lit(new), quantifier_relation(value) if old == "quantifier" else value]
        for new, constant in constants.items():
            entries += [F.lit(new), F.lit(constant)]
        kwargs = _drop_null_args(F.create_map(*entries)) if entries else F.create_map().cast(KWARGS)
        built = F.array(F.struct(F.lit(identifier).alias("instruction_id"), kwargs.cast(KWARGS).alias("kwargs")))
        cases.append((name == func, built))
    return first_match(cases, F.lit(None).cast(CONSTRAINT))


def parse_constraints(ground_truth: str | Column) -> Column:
    """JSON or Python-literal constraint text → ``array<struct<instruction_id,kwargs>>``.

    The new form is a list whose first entry is ``{"instruction_id": [...], "kwargs": [...]}``
    (as a dict, or as JSON text inside the list); only that entry counts.  Null arguments are
    dropped.  The old ``func_name`` form is mapped; an unmapped function gives null (score 0).
    """
    text = as_column(ground_truth)
    pair = "struct<instruction_id:array<string>,kwargs:array<map<string,string>>>"
    json_text = F.when(F.try_parse_json(text).isNotNull(), text).otherwise(python_literal_to_json(text))
    inner_text = F.get(F.from_json(text, "array<string>"), 0)
    first = F.coalesce(F.get(F.from_json(json_text, f"array<{pair}>"), 0), F.from_json(inner_text, pair))
    zipped = F.transform(
        F.arrays_zip(first["instruction_id"].alias("instruction_id"), first["kwargs"].alias("kwargs")),
        lambda z: F.struct(
            z["instruction_id"].alias("instruction_id"),
            _drop_null_args(F.coalesce(z["kwargs"], F.create_map().cast(KWARGS))).alias("kwargs"),
        ),
    )
    is_old = F.get_json_object(text, "$.func_name").isNotNull()
    return F.when(is_old, _old_constraint(text)).otherwise(zipped)


# --- B14, B15: environment configuration ---------------------------------------------------

ENV_CONFIG = "struct<max_steps:int,env_configs:array<struct<env_name:string,is_text_env:boolean,kwargs:map<string,string>>>>"


def _env_entry(raw: Column) -> Column:
    """One environment from its JSON object; extra keys become kwargs, a missing name is an error."""
    fields = F.from_json(raw, KWARGS)
    unnamed = F.raise_error(F.lit("env_config entry without env_name")).cast("string")
    return F.struct(
        F.coalesce(fields["env_name"], unnamed).alias("env_name"),
        fields["is_text_env"].cast("boolean").alias("is_text_env"),
        F.map_filter(fields, lambda k, _: ~k.isin("env_name", "is_text_env")).alias("kwargs"),
    )


def normalise_env_config(raw: str | Column) -> Column:
    """List, single or canonical JSON → ``{max_steps, env_configs}``; other dicts hold none."""
    text = as_column(raw)
    trimmed = F.ltrim(text)
    fields = F.from_json(text, KWARGS)
    strings = lambda t: F.from_json(t, "array<string>")
    none = F.array().cast("array<string>")
    items = (
        F.when(trimmed.startswith("["), strings(text))
        .when(F.map_contains_key(fields, "env_configs"), F.coalesce(strings(fields["env_configs"]), none))
        .when(
            F.map_contains_key(fields, "env_name"),
            F.array(F.to_json(F.map_filter(fields, lambda k, _: k != "max_steps"))),
        )
        .otherwise(none)
    )
    steps = F.when(
        trimmed.startswith("{") & (F.map_contains_key(fields, "env_configs") | F.map_contains_key(fields, "env_name")),
        fields["max_steps"].cast("int"),
    )
    wrong = F.raise_error(F.concat(F.lit("env_config must be an object or a list: "), text)).cast(ENV_CONFIG)
    built = F.struct(steps.alias("max_steps"), F.transform(items, _env_entry).alias("env_configs"))
    is_json = trimmed.startswith("{") | trimmed.startswith("[")
    return F.when(text.isNull(), F.lit(None).cast(ENV_CONFIG)).when(~is_json, wrong).otherwise(built)


def merge_env_config(base: str | Column, sample: str | Column) -> Column:
    """The sample overrides the base per environment; its kwargs and ``max_steps`` win."""
    base, sample = as_column(base), as_column(sample)
    named = lambda entries, name: F.get(F.filter(entries, lambda e: e["env_name"] == name), 0)

    def merged(entry: Column) -> Column:
        old = named(base["env_configs"], entry["env_name"])
        kept = F.map_filter(
            F.coalesce(old["kwargs"], F.create_map().cast(KWARGS)),
            lambda k, _: ~F.map_contains_key(entry["kwargs"], k),
        )
        return F.struct(
            entry["env_name"].alias("env_name"),
            F.coalesce(entry["is_text_env"], old["is_text_env"], F.lit(False)).alias("is_text_env"),
            F.map_concat(kept, entry["kwargs"]).alias("kwargs"),
        )

    untouched = F.filter(
        base["env_configs"], lambda b: ~F.exists(sample["env_configs"], lambda s: s["env_name"] == b["env_name"])
    )
    joined = F.struct(
        F.coalesce(sample["max_steps"], base["max_steps"]).alias("max_steps"),
        F.concat(untouched, F.transform(sample["env_configs"], merged)).alias("env_configs"),
    )
    return F.when(sample.isNull(), base).otherwise(joined)


# --- B16, B17: tools -----------------------------------------------------------------------


def resolve_active_tools(tools: str | Column, definitions: dict[str, str]) -> Column:
    """Names → definitions in definition order; null means all, no match means null."""
    tools = as_column(tools)
    everything = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(d).alias("definition")) for n, d in definitions.items()])
    active = F.filter(everything, lambda d: F.array_contains(tools, d["name"]))
    return F.when(tools.isNull(), everything).when(F.size(active) > 0, active)


def unknown_tools(tools: str | Column, definitions: dict[str, str]) -> Column:
    """Names a row asks for that have no definition."""
    return F.array_sort(F.array_except(as_column(tools), F.array(*[F.lit(n) for n in definitions])))


def discover_tools(*tables: DataFrame, tools: str = "tools") -> DataFrame:
    """Distinct tool names over the tables."""
    names = [t.select(F.explode(tools).alias("tool_name")) for t in tables]
    return reduce(DataFrame.unionByName, names).where("tool_name <> ''").distinct()


def tool_coverage(df: DataFrame, configured: list[str], tools: str = "tools") -> DataFrame:
    """One row per mismatching name: ``unconfigured`` in the data, or ``extraneous`` in the setup."""
    found = discover_tools(df, tools=tools)
    setup = df.sparkSession.createDataFrame([(n,) for n in configured], "tool_name string")
    missing = found.join(F.broadcast(setup), "tool_name", "left_anti").withColumn("problem", F.lit("unconfigured"))
    unused = setup.join(found, "tool_name", "left_anti").withColumn("problem", F.lit("extraneous"))
    return missing.unionByName(unused)


def validate_tools(df: DataFrame, configured: list[str], tools: str = "tools", name: str = "dataset", shown: int = 20) -> list[str]:
    """Raise on unconfigured names, return the extraneous ones.

    The message tells how many names are wrong and the first of them; ``tool_coverage`` holds all.
    """
    coverage = tool_coverage(df, configured, tools)
    wrong = coverage.where("problem = 'unconfigured'")
    first = [r.tool_name for r in wrong.orderBy("tool_name").limit(shown).collect()]
    if first:
        raise ValueError(f"{name} uses {wrong.count()} tools that are not configured, such as {first}; configured: {configured}")
    return sorted(r.tool_name for r in coverage.where("problem = 'extraneous'").collect())


# --- B23 -----------------------------------------------------------------------------------


def shared_prefix(chosen: str | Column, rejected: str | Column) -> Column:
    """Longest common prefix and both remainders.

    When one text is a prefix of the other the whole shorter text is shared.  The length is
    found by doubling steps downwards, so a long text costs log(n) compares.
    """
    a, b = as_column(chosen), as_column(rejected)
    shorter = F.least(F.length(a), F.length(b))
    steps = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.pow(F.lit(2.0), F.lit(30) - i).cast("int"))

    def length(short: Column) -> Column:
        same = lambda at, step: F.substr(a, at + 1, step) == F.substr(b, at + 1, step)
        grow = lambda at, step: F.when((at + step <= short) & same(at, step), at + step).otherwise(at)
        return F.aggregate(steps, F.lit(0), grow)

    parts = lambda n: F.struct(
        F.substr(a, F.lit(1), n).alias("shared"),
        F.substr(a, n + 1).alias("chosen_rest"),
        F.substr(b, n + 1).alias("rejected_rest"),
    )
    return let(let(shorter, length), parts)
