"""Vocabulary, encoding and tokenised rows.

Tokens are special tags, newlines and runs of non-space characters.  A token never spans a
newline or a tag, so the pieces of a template can be counted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollweave.operators.messages import (
    as_column,
    drop_trailing_assistant,
    flatten_prompt,
    label_arrays,
    let,
    override_system_prompt,
    prompt_of,
    resolve_active_tools,
)
from rollweave.operators.ordering import running
from rollweave.operators.render import Template, piece, render, resolve
from rollweave.session import materialise_stage

TOKEN_PATTERN = r"<\|[a-z_]+\|>|</?[a-z_]+>|\n|[^\s<]+|<"
IGNORED = -100
HEAD_IDS = 262_144
SPECIALS = ("<pad>", "</s>", "<s>", "<unk>")


@dataclass(frozen=True)
class Tokenizer:
    """How rows are rendered and encoded; ``vocabulary`` is a table of (token, id)."""

    vocabulary: DataFrame
    template: str | Template = "role_tags"
    eos: str = "</s>"
    pad_id: int = 0
    unknown_id: int = 3
    default_system: str | None = None


def tokens_of(text: str | Column) -> Column:
    return F.regexp_extract_all(as_column(text), F.lit(TOKEN_PATTERN), F.lit(0))


def build_vocabulary(df: DataFrame, *token_columns: str, max_size: int | None = None, specials=SPECIALS) -> DataFrame:
    """(token, id, frequency), ids by frequency rank after the special tokens.

    Ties go by digest.  Frequent tokens are ranked in logarithmic buckets, rare ones by
    (frequency, digest) buckets, so the long tail of tokens seen once is spread out.
    """
    listed = F.explode(F.concat(*token_columns) if len(token_columns) > 1 else F.col(token_columns[0]))
    counted = df.select(listed.alias("token")).where(~F.col("token").isin(*specials)).groupBy("token")
    # Stored once: ranking reads the counts twice, and the corpus pass is the costly part.
    stored = materialise_stage(counted.agg(F.count("*").alias("frequency")), "token-counts")
    keyed = stored.withColumns({"__h": F.md5("token"), "__down": -F.col("frequency")})
    rare = (64 - F.col("frequency")) * 256 + F.conv(F.substring("__h", 1, 2), 16, 10).cast("int")
    bucket = F.when(F.col("frequency") <= 64, rare).otherwise(-F.floor(F.log2("frequency") * 64)).cast("int")
    ranked = running(keyed, ["__down", "__h", "token"], bucket, id=F.lit(1))
    words = ranked.select("token", (F.col("id") + len(specials) - 1).cast("int").alias("id"), "frequency")
    if max_size is not None:
        words = words.where(F.col("id") < max_size)
    reserved = [(token, i, 0) for i, token in enumerate(specials)]
    return df.sparkSession.createDataFrame(reserved, "token string, id int, frequency long").unionByName(words)


def _lists(flat: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _looked_up(head: pa.Table, columns: dict[str, str], unknown_id: int, missing: bool):
    """Token lists to id lists by one lookup of the flattened values of a batch.

    A token that the head does not hold gets the unknown id. With ``missing`` it is marked, and its id is its
    place among the distinct such tokens of the batch, which go with the batch's first row.
    """
    known, ids = head.column("token").combine_chunks(), head.column("id").combine_chunks().cast(pa.int32())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            kept = [n for n in batch.schema.names if n not in columns.values()]
            sizes, found, away = [], [], []
            for name in columns.values():
                tokens = batch.column(name).flatten().cast(pa.string())
                hit = ids.take(pc.index_in(tokens, value_set=known))
                gone = hit.is_null() if not missing else pc.and_(hit.is_null(), tokens.is_valid())
                sizes.append(_sizes(batch.column(name)))
                found.append((pc.fill_null(hit, unknown_id), gone))
                away.append(tokens.filter(gone) if missing else None)
            if not missing:
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *(_lists(f, n) for (f, _), n in zip(found, sizes))], names=[*kept, *columns])
                continue
            coded = pa.concat_arrays(away).dictionary_encode()
            places = np.split(coded.indices.to_numpy(), np.cumsum([len(x) for x in away])[:-1])
            arrays, marks = [], []
            for (flat, gone), place, size in zip(found, places, sizes):
                mixed, gone = flat.to_numpy().copy(), gone.to_numpy(zero_copy_only=False)
                mixed[gone] = place
                arrays.append(_lists(pa.array(mixed, pa.int32()), size))
                marks.append(_lists(pa.array(gone), size))
            chunk = pa.array(np.full(batch.num_rows, (TaskContext.get().partitionId() << 33) + number))
            first = _lists(coded.dictionary, np.array([len(coded.dictionary), *[0] * (batch.num_rows - 1)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *arrays, *marks, chunk, first], names=[*kept, *columns, *map(_mark, columns), "__chunk", "__tokens"])

    return scan


def _mark(column: str) -> str:
    return f"__rare_{column}"


def _scattered(columns: list[str], names: list[str], unknown_id: int):
    """The marked tokens of a chunk get their ids: ``met`` has those that the vocabulary holds."""

    def fill(rows: pa.Table, met: pa.Table) -> pa.Table:
        place, ids = (met.column(c).to_numpy().astype(np.int64) for c in ("__place", "__id"))
        known = np.full(place.max(initial=-1) + 1, unknown_id, np.int32)
        known[place] = ids
        for name in columns:
            lists, marks = (rows.column(c).combine_chunks() for c in (name, _mark(name)))
            flat, gone = lists.flatten().to_numpy().copy(), marks.flatten().to_numpy(zero_copy_only=False)
            places = flat[gone]
            # Places behind the last one that was met are unknown, too.
            inside = places < len(known)
            flat[gone] = np.where(inside, known[np.where(inside, places, 0)], unknown_id) if len(known) else unknown_id
            rows = rows.set_column(rows.schema.get_field_index(name), name, _lists(pa.array(flat, pa.int32()), _sizes(lists)))
        return rows.select(names)

    return fill


def encode(df: DataFrame, key: str, columns: dict[str, str], vocabulary: DataFrame, unknown_id: int = 3, head: int = HEAD_IDS) -> DataFrame:
    """Token arrays → id arrays under new names; ``key`` may repeat or be null.

    Tokens with an id below ``head`` are looked up in place, so their table is bounded; ids are frequency
    ranks, so these are the hot ones. Only the tokens it does not hold leave, each distinct one once for a
    chunk (an Arrow batch), meet the rest of the vocabulary and come back to the chunk's rows. A vocabulary
    without such a rest needs no second step.
    """
    words = vocabulary.select("token", F.col("id").cast("int").alias("id"))
    hot = words.where((F.col("id") >= 0) & (F.col("id") < head)).dropDuplicates(["token"]).toArrow()
    rest = words.where((F.col("id") < 0) | (F.col("id") >= head)).dropDuplicates(["token"])
    fields = [f for f in df.schema.fields if f.name not in columns.values()]
    coded = T.StructType([*fields, *[T.StructField(out, T.ArrayType(T.IntegerType())) for out in columns]])
    if rest.isEmpty():
        return df.mapInArrow(_looked_up(hot, columns, unknown_id, False), coded)
    marks = [T.StructField(_mark(out), T.ArrayType(T.BooleanType())) for out in columns]
    wide = T.StructType([*coded.fields, *marks, T.StructField("__chunk", T.LongType()), T.StructField("__tokens", T.ArrayType(T.StringType()))])
    # Stored: a token is known by its place in its chunk from here on.
    rows = materialise_stage(df.mapInArrow(_looked_up(hot, columns, unknown_id, True), wide), "encoded")
    left = rows.where(F.size("__tokens") > 0).select(F.col("__chunk").alias("__of"), F.posexplode("__tokens").alias("__place", "token"))
    met = left.join(rest.withColumnRenamed("id", "__id"), "token").select("__of", "__place", "__id")
    rows = rows.drop("__tokens")
    out = T.StructType([rows.schema[n] for n in coded.names])
    return rows.groupBy("__chunk").cogroup(met.groupBy("__of")).applyInArrow(_scattered(list(columns), coded.names, unknown_id), out)


# --- masks ---------------------------------------------------------------------------------


def ones(ids: str | Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(as_column(ids)))


def mask_prompt(labels: str | Column, prompt_ids: str | Column) -> Column:
    """The first ``len(prompt)`` labels become -100."""
    count = F.size(as_column(prompt_ids))
    return F.transform(as_column(labels), lambda x, i: F.when(i < count, F.lit(IGNORED)).otherwise(x))


def label_mask(messages: str | Column, tokenizer: Tokenizer, trainable: str) -> Column:
    """1 where a token carries no loss, see ``_mask``; the messages are bound once."""
    return let(messages, lambda bound: _mask(bound, tokenizer, trainable))


def _mask(messages: Column, tokenizer: Tokenizer, trainable: str) -> Column:
    """1 where a token carries no loss, over the whole untruncated conversation.

    ``trainable`` is ``assistant`` (every assistant turn) or ``last`` (the last message).  A
    masked message starts at the length of the prefix before it and ends at the length of the
    prefix with it, which includes the generation prefix when an assistant turn follows.  Each
    message is counted once as a middle and once as a last one, so prefixes are sums.
    """
    template = resolve(tokenizer.template, tokenizer.default_system)
    if not template.additive:
        raise ValueError("label spans need a template whose pieces are separated by tags or newlines")
    yes, no = F.lit(True), F.lit(False)
    n = F.size(messages)
    count = lambda m, i, last, generate: F.size(tokens_of(piece(template, m, i, last, tokenizer.eos, generate)))
    head_plain = F.size(tokens_of(F.lit(template.preamble)))
    block = F.lit(0)
    if template.default_system is not None:
        block = F.size(tokens_of(F.lit(f"<|im_start|>system\n{template.default_system}<|im_end|>\n")))
    suffix = F.size(tokens_of(F.lit(template.suffix)))

    sized = F.transform(
        messages,
        lambda m, i: F.struct(
            m["role"].alias("role"),
            count(m, i, no, False).alias("mid"),
            count(m, i, yes, False).alias("end"),
            count(m, i, yes, True).alias("gen"),
        ),
    )
    start = F.struct(
        F.lit(0).alias("i"),
        F.lit(0).alias("sum"),
        no.alias("sys"),
        F.lit(0).alias("prefix"),
        F.lit(0).alias("done"),
        F.array().cast("array<struct<gap:int,run:int>>").alias("runs"),
    )

    def spans(sizes: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            system = acc["sys"] | (s["role"] == "system")
            following = F.get(sizes, acc["i"] + 1)["role"]
            masked = acc["i"] != n - 1 if trainable == "last" else s["role"] != "assistant"
            base = head_plain + acc["sum"] + F.when(system, F.lit(0)).otherwise(block)
            opened = F.coalesce(following == "assistant", no)
            place = F.struct(
                system.alias("sys"),
                (base + s["end"]).alias("plain"),
                F.when(opened, base + s["gen"] + suffix).otherwise(base + s["end"]).alias("stop"),
                F.greatest(acc["prefix"], acc["done"]).alias("begin"),
                masked.alias("masked"),
            )

            def advance(p: Column) -> Column:
                run = F.struct((p["begin"] - acc["done"]).alias("gap"), F.greatest(p["stop"] - p["begin"], F.lit(0)).alias("run"))
                return F.struct(
                    (acc["i"] + 1).alias("i"),
                    (acc["sum"] + s["mid"]).alias("sum"),
                    p["sys"].alias("sys"),
                    p["plain"].alias("prefix"),
                    F.when(p["masked"], F.greatest(p["stop"], p["begin"])).otherwise(acc["done"]).alias("done"),
                    F.when(p["masked"], F.concat(acc["runs"], F.array(run))).otherwise(acc["runs"]).alias("runs"),
                )

            return let(place, advance)

        return F.aggregate(sizes, start, step, lambda acc: acc["runs"])

    bits = F.transform(let(sized, spans), lambda r: F.concat(F.array_repeat(F.lit(0), r["gap"]), F.array_repeat(F.lit(1), r["run"])))
    empty = F.raise_error(F.lit("messages field is empty")).cast("array<int>")
    return F.when(n == 0, empty).otherwise(F.flatten(bits))


def apply_mask(ids: Column, mask: Column) -> Column:
    """-100 under the mask; positions beyond the mask keep their id."""
    cover = lambda x: F.zip_with(
        F.slice(x["m"], 1, F.least(F.size(x["m"]), F.size(x["i"]))), x["i"], lambda m, i: F.when(m == 1, F.lit(IGNORED)).otherwise(i)
    )
    return let(F.struct(mask.alias("m"), ids.alias("i")), cover)


# --- D3-D6: SFT rows -----------------------------------------------------------------------


def _texts(df: DataFrame, tokenizer: Tokenizer, specs: dict[str, tuple[Column, bool]]) -> DataFrame:
    """Token arrays of rendered messages, named ``__t_<name>``."""
    text = lambda msgs, gen: render(msgs, tokenizer.template, tokenizer.eos, gen, default_system=tokenizer.default_system)
    return df.withColumns({f"__t_{name}": tokens_of(text(msgs, gen)) for name, (msgs, gen) in specs.items()})


def _encoded(df: DataFrame, key: str, tokenizer: Tokenizer, specs: dict[str, tuple[Column, bool]]) -> DataFrame:
    texts = _texts(df, tokenizer, specs)
    return encode(texts, key, {name: f"__t_{name}" for name in specs}, tokenizer.vocabulary, tokenizer.unknown_id)


def tokenize_sft(df: DataFrame, tokenizer: Tokenizer, key: str, messages: str = "messages") -> DataFrame:
    """D3: prompt ids (with the generation prompt), full ids, mask of ones, labels = ids."""
    specs = {"input_ids_prompt": (prompt_of(messages), True), "input_ids": (F.col(messages), False)}
    coded = _encoded(df, key, tokenizer, specs)
    return coded.withColumns({"attention_mask": ones("input_ids"), "labels": F.col("input_ids")})


def tokenize_sft_masked(df: DataFrame, tokenizer: Tokenizer, key: str, messages: str = "messages") -> DataFrame:
    """D3 with the prompt masked out of the labels."""
    coded = tokenize_sft(df, tokenizer, key, messages)
    return coded.withColumn("labels", mask_prompt("labels", "input_ids_prompt"))


def _tokenize_turns(df: DataFrame, tokenizer: Tokenizer, key: str, columns: dict[str, str], max_length: int | None, trainable: str) -> DataFrame:
    """Ids, labels and mask per message column; ``columns`` maps a name prefix to the column."""
    masks = {f"__m_{p}": label_mask(F.col(c), tokenizer, trainable) for p, c in columns.items()}
    coded = _encoded(df.withColumns(masks), key, tokenizer, {f"{p}input_ids": (F.col(c), False) for p, c in columns.items()})
    cut = (lambda a: F.slice(a, 1, max_length)) if max_length else (lambda a: a)
    out = {}
    for prefix in columns:
        ids = F.col(f"{prefix}input_ids")
        out[f"{prefix}labels"] = cut(apply_mask(ids, F.col(f"__m_{prefix}")))
        out[f"{prefix}attention_mask"] = cut(ones(ids))
        out[f"{prefix}input_ids"] = cut(ids)
    return coded.withColumns(out).drop(*masks)


def tokenize_assistant_only(df: DataFrame, tokenizer: Tokenizer, key: str, max_length: int | None = None, messages: str = "messages") -> DataFrame:
    """Loss only on assistant turns, cut at ``max_length``."""
    return _tokenize_turns(df, tokenizer, key, {"": messages}, max_length, "assistant")


def tokenize_last_turn(df: DataFrame, tokenizer: Tokenizer, key: str, max_length: int | None = None, messages: str = "messages") -> DataFrame:
    """Loss only on the last message."""
    return _tokenize_turns(df, tokenizer, key, {"": messages}, max_length, "last")


# --- D7: preference rows -------------------------------------------------------------------


def tokenize_preference(df: DataFrame, tokenizer: Tokenizer, key: str, mode: str = "last", max_length: int | None = None, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``plain`` (prompt ids and whole texts), ``assistant`` or ``last`` label masks."""
    if mode != "plain":
        return _tokenize_turns(df, tokenizer, key, {"chosen_": chosen, "rejected_": rejected}, max_length, mode)
    prompt = F.slice(chosen, 1, F.greatest(F.size(chosen) - 1, F.lit(0)))
    specs = {
        "input_ids_prompt": (prompt, True),
        "chosen_input_ids": (F.col(chosen), False),
        "rejected_input_ids": (F.col(rejected), False),
    }
    coded = _encoded(df, key, tokenizer, specs)
    return coded.withColumns(
        {
            "attention_mask_prompt": ones("input_ids_prompt"),
            "chosen_attention_mask": ones("chosen_input_ids"),
            "rejected_attention_mask": ones("rejected_input_ids"),
        }
    )


# --- D8: verifiable-task rows --------------------------------------------------------------


def tokenize_rlvr(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str,
    version: int = 3,
    system_prompt: str | None = None,
    tool_definitions: dict[str, str] | None = None,
    messages: str = "messages",
) -> DataFrame:
    """Prompt ids, flat prompt, ground truth and verifier.

    Version 1 keeps full ids and labels and the scalar labels as they are, version 2 drops the
    messages and pad ids and puts labels into arrays, version 3 holds prompt ids only.
    """
    base = drop_trailing_assistant(messages) if version == 3 else prompt_of(messages)
    prompt = base if version == 2 else override_system_prompt(base, system_prompt)
    rows = df.withColumn("__prompt", prompt)
    specs = {"input_ids_prompt": (F.col("__prompt"), True)}
    if version != 3:
        specs["input_ids"] = (F.col(messages), False)
    coded = _encoded(rows, key, tokenizer, specs).withColumn("prompt", flatten_prompt("__prompt"))
    if version != 1:
        coded = coded.withColumns({c: F.array_remove(c, tokenizer.pad_id) for c in specs})
        coded = label_arrays(coded).drop(messages)
    if version != 3:
        coded = coded.withColumns({"attention_mask": ones("input_ids"), "labels": F.col("input_ids")})
    if tool_definitions and "tools" in df.columns and version != 2:
        coded = coded.withColumn("active_tools", resolve_active_tools("tools", tool_definitions))
    return coded.drop("__prompt")
