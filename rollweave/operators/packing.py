"""Packing, padding and batching.

Next-fit packing depends on order, so rows are dealt into hash shards and each shard is
scanned in order.  The scan streams Arrow batches: list columns of consecutive rows lie next
to each other, so a pack is made by writing new offsets over the same values, and only the
open pack is carried to the next batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollweave.operators.messages import as_column
from rollweave.operators.ordering import attach, hash_rank, md5_mod, row_index, running_by_key, value_rank
from rollweave.session import materialise_stage

IGNORED = -100


#: Rows of one shard, about: up to here packing is one sequential scan.
SHARD_ROWS = 1 << 16


def default_shards(df: DataFrame) -> int:
    """Shards follow the rows alone, so that the packs of a table do not depend on the session."""
    return max(1, -(-df.count() // SHARD_ROWS))


# --- the scan ------------------------------------------------------------------------------


def _pack_starts(lengths: list[list[int]], limits: list[int], max_items: int | None) -> list[int]:
    """First row of each pack under next-fit over parallel lengths."""
    starts, totals, count = [], [0] * len(lengths), 0
    for row, limit in enumerate(limits):
        sizes = [stream[row] for stream in lengths]
        over = any(t + s > limit for t, s in zip(totals, sizes)) and count > 0
        if not starts or over or (max_items is not None and count >= max_items):
            starts.append(row)
            totals, count = [0] * len(lengths), 0
        totals = [t + s for t, s in zip(totals, sizes)]
        count += 1
    return starts


def _regroup(column: pa.Array, bounds: pa.Array) -> pa.Array:
    """One list per pack: lists are joined, plain values are gathered."""
    if pa.types.is_list(column.type):
        offsets = column.offsets.take(bounds)
        return pa.ListArray.from_arrays(offsets, column.values)
    return pa.ListArray.from_arrays(bounds, column)


def _flat_lists(table: pa.Table) -> list[pa.Array]:
    return [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in (table.column(i) for i in range(table.num_columns))]


def _make_packer(carried: list[str], lengths: list[str], max_items: int | None, schema: pa.Schema):
    def emit(table: pa.Table, starts: list[int], ends: int, first_no: int, shard: int) -> pa.RecordBatch:
        bounds = pa.array([*starts, ends], pa.int32())
        arrays = dict(zip(table.column_names, _flat_lists(table)))
        numbers = pa.array(range(first_no, first_no + len(starts)), pa.int64())
        shards = pa.array([shard] * len(starts), schema.field("shard").type)
        columns = [shards, numbers, *[_regroup(arrays[c], bounds) for c in carried]]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: pa.Table | None = None
        shard, number = None, 0
        for batch in batches:
            shards = batch.column(batch.schema.get_field_index("__shard")).to_pylist()
            cuts = [i for i in range(1, len(shards)) if shards[i] != shards[i - 1]]
            for begin, end in zip([0, *cuts], [*cuts, len(shards)]):
                if begin == end:
                    continue
                part = pa.Table.from_batches([batch.slice(begin, end - begin)])
                if shard is not None and shards[begin] != shard and open_rows is not None:
                    yield emit(open_rows, [0], open_rows.num_rows, number, shard)
                    open_rows = None
                if shards[begin] != shard:
                    shard, number = shards[begin], 0
                rows = part if open_rows is None else pa.concat_tables([open_rows, part])
                sizes = [rows.column(name).to_pylist() for name in lengths]
                starts = _pack_starts(sizes, rows.column("__limit").to_pylist(), max_items)
                if len(starts) > 1:
                    closed = rows.slice(0, starts[-1])
                    yield emit(closed, starts[:-1], starts[-1], number, shard)
                    number += len(starts) - 1
                open_rows = rows.slice(starts[-1])
        if open_rows is not None and open_rows.num_rows:
            yield emit(open_rows, [0], open_rows.num_rows, number, shard)

    return scan


def next_fit(
    df: DataFrame,
    order: str,
    lengths: Sequence[Column],
    limit: Column,
    carry: Sequence[str],
    max_items: int | None = None,
    n_shards: int | None = None,
    by: str | None = None,
) -> DataFrame:
    """One row per pack: ``shard``, ``pack_no`` and each carried column as one array.

    A shard is an even hash split of the rows, never a data group.  ``n_shards=1`` gives the
    exact order of one sequential scan; more shards leave at most one open pack each.  With ``by``
    the shards are the values of that column, groups of a size the caller bounds (a training step).
    The packs are stored, so the scan runs once however often they are read.
    """
    carry = list(carry)
    size_names = [f"__len{i}" for i in range(len(lengths))]
    if by is None:
        n_shards = n_shards or default_shards(df)
        shard = md5_mod(F.md5(F.col(order).cast("string")), n_shards)
    else:
        shard = F.col(by).cast("long")
    narrow = df.select(
        shard.alias("__shard"),
        F.col(order).alias("__order"),
        *[c.cast("int").alias(n) for c, n in zip(lengths, size_names)],
        limit.cast("int").alias("__limit"),
        *carry,
    )
    fields = [T.StructField("shard", narrow.schema["__shard"].dataType), T.StructField("pack_no", T.LongType())]
    for name in carry:
        kind = narrow.schema[name].dataType
        fields.append(T.StructField(name, kind if isinstance(kind, T.ArrayType) else T.ArrayType(kind)))
    schema = T.StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    scan = _make_packer(carry, size_names, max_items, to_arrow_schema(schema))
    dealt = narrow.repartition("__shard") if by else narrow.repartition(n_shards, "__shard")
    return materialise_stage(dealt.sortWithinPartitions("__shard", "__order").mapInArrow(scan, schema), "packs")


def number_packs(packs: DataFrame, out: str = "pack_id") -> DataFrame:
    """Dense global number in (shard, pack_no) order; the offset table has one row per shard."""
    counts = packs.groupBy("shard").agg(F.count("*").alias("__n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return attach(packs, offsets, ["shard"], bounded=True).withColumn(out, F.col("__off") + F.col("pack_no")).drop("__off")


# --- F1, F2 --------------------------------------------------------------------------------


def pack_sequences(
    df: DataFrame,
    key: str,
    pack_length: int,
    pad_id: int,
    min_packs: int = 1,
    mask_tool_use: bool = False,
    n_shards: int | None = None,
    by: str | None = None,
    query: str = "query",
    response: str = "response",
    mask: str = "mask",
    logprobs: str = "logprobs",
) -> DataFrame:
    """packs of query + response with their per-token arrays.

    Pad ids leave the query and, with their mask and logprob, the response.  Query tokens have
    logprob NaN and response mask 0; the sample ordinal is the row number in key order plus 1.
    With ``by`` (a training step, whose rows are few) ordinals, packs and the minimum are per value of it.
    """
    zipped = F.arrays_zip(F.col(response).alias("t"), F.col(mask).alias("m"), F.col(logprobs).alias("p"))
    uneven = F.raise_error(F.lit("response, mask and logprobs differ in length")).cast("array<struct<t:int,m:int,p:double>>")
    same = (F.size(response) == F.size(logprobs)) & (F.size(response) == F.size(mask))
    kept = F.filter(F.when(same, zipped).otherwise(uneven), lambda z: z["t"] != pad_id)
    if by is None:
        indexed, own = row_index(df, key, out="__i"), []
    else:
        place = F.row_number().over(Window.partitionBy(by).orderBy(key)) - 1
        indexed, own = df.withColumn("__i", place.cast("long")), [by]
    clean = indexed.select(
        *own, key, "__i", F.filter(query, lambda x: x != pad_id).alias("__q"), kept.alias("__r")
    )
    n_query, n_response = F.size("__q"), F.size("__r")
    sample = (F.col("__i") + 1).cast("int")
    total = n_query + n_response
    marked = F.transform("__r", lambda z: F.when((z["m"] != 0) | F.lit(not mask_tool_use), sample).otherwise(F.lit(0)))
    rows = clean.select(
        *own,
        key,
        "__i",
        sample.alias("samples"),
        total.alias("packed_seq_lens"),
        n_response.alias("num_actions"),
        F.concat("__q", F.transform("__r", lambda z: z["t"])).alias("tokens"),
        F.concat(F.array_repeat(F.lit(0), n_query), marked).alias("response_mask"),
        F.when(total > 0, F.concat(F.array_repeat(F.lit(0), total - 1), F.array(sample))).otherwise(F.array().cast("array<int>")).alias("dones"),
        F.when(total > 0, F.sequence(F.lit(0), total - 1)).otherwise(F.array().cast("array<int>")).alias("position_ids"),
        F.concat(F.array_repeat(F.lit(float("nan")), n_query), F.transform("__r", lambda z: z["p"])).alias("logprobs"),
    )
    limit = F.lit(pack_length)
    if min_packs > 1:
        sums = rows.groupBy(*own).agg(F.sum("packed_seq_lens").alias("__sum"))
        rows = attach(rows, sums, own) if own else rows.crossJoin(F.broadcast(sums))
        limit = F.when(F.col("__sum") > 0, F.least(F.floor(F.col("__sum") / min_packs), F.lit(pack_length))).otherwise(F.lit(pack_length))
    carried = [key, *(["samples"] if by else []), "packed_seq_lens", "num_actions", "tokens", "response_mask", "dones", "position_ids", "logprobs"]
    packs = next_fit(rows, "__i", [F.col("packed_seq_lens")], limit, carried, n_shards=n_shards, by=by)
    if by:
        packs = packs.withColumnRenamed("shard", by)
    within = F.flatten(F.transform("packed_seq_lens", lambda n, k: F.array_repeat(k + 1, n)))
    return packs.withColumnRenamed(key, f"{key}s").withColumn("attention_mask", within)


def broadcast_advantages(packs: DataFrame, advantages: DataFrame, pack: Sequence[str] = ("shard", "pack_no"), by: str | None = None) -> DataFrame:
    """token advantages by looking samples up through the response mask; 0 where it is 0.

    ``advantages`` is (sample, advantage) with the 1-based ordinal, and ``by`` if ordinals are per value
    of it.  The join runs on the samples of each pack, not on its tokens.
    """
    pack = list(pack)
    samples = packs.select(*pack, F.explode(F.array_distinct("response_mask")).alias("sample")).where("sample > 0")
    looked = samples.join(advantages, [*([by] if by else []), "sample"]).groupBy(*pack).agg(F.map_from_entries(F.collect_list(F.struct("sample", "advantage"))).alias("__a"))
    joined = attach(packs, looked, pack)
    lookup = F.transform("response_mask", lambda m: F.coalesce(F.col("__a")[m], F.lit(0.0)))
    return joined.withColumn("advantages", lookup).drop("__a")


# --- F4, F8 --------------------------------------------------------------------------------


def pack_batches(
    df: DataFrame, key: str, lengths: Sequence[Column], max_length: int, max_examples: int, world: int, drop_last: bool = False, n_shards: int | None = None
) -> DataFrame:
    """next-fit batches over one or two lengths, dealt round the workers.

    The tail is cut to a multiple of the workers, or filled by repeating the last batch.
    """
    packs = next_fit(df, key, lengths, F.lit(max_length), [key], max_items=max_examples, n_shards=n_shards)
    numbered = number_packs(packs, "batch").withColumnRenamed(key, "members")
    total = numbered.agg(F.count("*").alias("__t"))
    sized = numbered.crossJoin(F.broadcast(total))
    rest = F.col("__t") % world
    if drop_last:
        dealt = sized.where(F.col("batch") < F.col("__t") - rest).withColumn("is_padding", F.lit(False))
    else:
        copies = F.when((F.col("batch") == F.col("__t") - 1) & (rest > 0), world - rest).otherwise(F.lit(0))
        repeated = sized.withColumn("__c", F.explode(F.sequence(F.lit(0), copies.cast("int"))))
        dealt = repeated.withColumn("is_padding", F.col("__c") > 0).withColumn("batch", F.col("batch") + F.col("__c")).drop("__c")
    return dealt.withColumn("worker", F.pmod("batch", F.lit(world)).cast("int")).drop("__t")


def assign_packs(packs: DataFrame, pack: str, world: int, micro: int, seed: int = 42) -> DataFrame:
    """F8: equal contiguous blocks per worker, seeded order inside, cut into micro-batches."""
    total = packs.agg(F.floor(F.count("*") / world).alias("__block"))
    blocks = packs.crossJoin(F.broadcast(total)).where(F.col(pack) < F.col("__block") * world)
    placed = blocks.withColumn("worker", F.floor(F.col(pack) / F.col("__block")).cast("int")).drop("__block")
    ranked = hash_rank(placed, pack, seed, ["worker"], "__r")
    return ranked.withColumns({"micro_batch": F.floor((F.col("__r") - 1) / micro).cast("int"), "slot": ((F.col("__r") - 1) % micro).cast("int")}).drop("__r")


# --- F5 ------------------------------------------------------------------------------------


def take_within_budget(df: DataFrame, key: str, lengths: dict[str, Column], max_length: int | None) -> DataFrame:
    """leading rows while every running sum fits; the first row always stays."""
    if max_length is None:
        return df
    totals = running_by_key(df, key, __row=F.lit(1), **{f"__sum_{n}": c for n, c in lengths.items()})
    over = F.lit(False)
    for name in lengths:
        over = over | (F.col(f"__sum_{name}") > max_length)
    first = totals.agg(F.min(F.when(over & (F.col("__row") > 1), F.col("__row"))).alias("__stop"))
    kept = totals.crossJoin(F.broadcast(first)).where(F.col("__stop").isNull() | (F.col("__row") < F.col("__stop")))
    return kept.select(*df.columns)


# --- F6, F7, F9, F11: batch rows -----------------------------------------------------------


def flatten_batch(df: DataFrame, batch: str, order: str, ids: str = "input_ids", labels: str | None = "labels", separator: int = IGNORED, pad_to: int | None = None) -> DataFrame:
    """one row per batch with concatenated arrays and sequence bounds.

    A batch is bounded by its configuration (F4, F10), so gathering it is bounded too.
    """
    source = F.col(labels or ids)
    items = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(ids).alias("x"), source.alias("y"))))
    rows = df.groupBy(batch).agg(items.alias("__items"))
    sizes = F.transform("__items", lambda z: F.size(z["x"]))
    bounds = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    shifted = lambda z: F.concat(F.array(F.lit(separator)), F.slice(z["y"], 2, F.greatest(F.size(z["y"]) - 1, F.lit(0))))
    none = F.array().cast("array<int>")
    counted = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)
    out = {
        "index": F.transform("__items", lambda z: z["o"]),
        "input_ids": F.flatten(F.transform("__items", lambda z: z["x"])),
        "labels": F.flatten(F.transform("__items", shifted)),
        "cu_seq_lens": bounds,
        "max_length": F.array_max(sizes),
        "position_ids": F.flatten(F.transform(sizes, counted)),
        "seq_idx": F.flatten(F.transform(sizes, lambda n, k: F.array_repeat(k, n))),
    }
    if pad_to is not None:
        fills = {"input_ids": 0, "labels": IGNORED, "position_ids": 0, "seq_idx": -1}
        out.update({name: pad_right(out[name], F.lit(pad_to), value) for name, value in fills.items()})
    return rows.select(batch, *[c.alias(n) for n, c in out.items()])


def unflatten_batch(df: DataFrame, batch: str, bounds: str = "cu_seq_lens", ids: str = "input_ids") -> DataFrame:
    """F6 inverse: the rows of a batch again, cut at the sequence bounds."""
    count = F.size(bounds) - 1
    cut = lambda k: F.slice(ids, F.get(bounds, k) + 1, F.get(bounds, k + 1) - F.get(bounds, k))
    parts = F.transform(F.sequence(F.lit(0), count - 1), cut)
    return df.select(batch, F.posexplode(parts).alias("slot", ids))


def pad_right(values: str | Column, length: Column, fill: int) -> Column:
    values = as_column(values)
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(length - F.size(values), F.lit(0))))


# What each column is filled up with.
PAD_VALUES = {"labels": IGNORED, "attention_mask": 0}


def pad_batch(df: DataFrame, batch: str, columns: Sequence[str], pad_id: int) -> DataFrame:
    """right-pad to the longest row of the batch; several columns share one maximum."""
    longest = F.greatest(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    stats = df.groupBy(batch).agg(F.max(longest).alias("__max"))
    joined = attach(df, stats, [batch])
    fill = lambda name: next((v for part, v in PAD_VALUES.items() if name.endswith(part)), pad_id)
    return joined.withColumns({c: pad_right(c, F.col("__max"), fill(c)) for c in columns}).drop("__max")


def batch_tokens(columns: Sequence[str]) -> Column:
    """tokens of a batch row from its bounds, else its masks, else its ids."""
    rules = (
        ("cu_seq_lens", lambda c: F.element_at(c, -1)),
        ("attention_mask", lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x)),
        ("input_ids", lambda c: F.size(c)),
    )
    for suffix, measure in rules:
        found = [c for c in columns if c.endswith(suffix)]
        if found:
            total = measure(found[0])
            for name in found[1:]:
                total = total + measure(name)
            return total
    raise ValueError(f"no token columns in {list(columns)}")


def batch_sequences(columns: Sequence[str]) -> Column:
    """sequences of a batch row, null without bounds."""
    total = F.lit(None).cast("int")
    for name in [c for c in columns if c.endswith("cu_seq_lens")]:
        total = F.coalesce(total, F.lit(0)) + F.size(name) - 1
    return total


def sequence_lengths(bounds: str | Column) -> Column:
    """adjacent differences of the bounds."""
    bounds = as_column(bounds)
    return F.zip_with(F.slice(bounds, 2, F.size(bounds) - 1), F.slice(bounds, 1, F.size(bounds) - 1), lambda b, a: b - a)


def batch_counts(df: DataFrame) -> DataFrame:
    """F9 on a table of batch rows."""
    out = df.withColumns({"tokens": batch_tokens(df.columns), "sequences": batch_sequences(df.columns)})
    bounds = [c for c in df.columns if c.endswith("cu_seq_lens")]
    return out.withColumns({c.removesuffix("cu_seq_lens") + "lengths": sequence_lengths(c) for c in bounds})


def stack_pairs(df: DataFrame, batch: str, order: str, pad_id: int = 0) -> DataFrame:
    """F11, padded form: chosen rows, then rejected rows, all padded to the joint maximum."""
    keys = ["input_ids", "labels"]
    side = lambda name, part: F.struct(F.lit(part).alias("part"), *[F.col(f"{name}_{k}").alias(k) for k in keys])
    longest = F.greatest(F.size("chosen_input_ids"), F.size("rejected_input_ids"))
    stats = df.groupBy(batch).agg(F.max(longest).alias("__max"), F.count("*").alias("batch_size"))
    sides = attach(df, stats, [batch]).select(
        batch, order, "batch_size", "__max", F.explode(F.array(side("chosen", 0), side("rejected", 1))).alias("s")
    )
    padded = {k: pad_right(F.col(f"s.{k}"), F.col("__max"), IGNORED if k == "labels" else pad_id) for k in keys}
    return sides.select(batch, order, "batch_size", F.col("s.part").alias("part"), *[c.alias(k) for k, c in padded.items()])


def stack_flattened(df: DataFrame) -> DataFrame:
    """F11, flattened form: rejected bounds shifted by the chosen length, segment ids go on."""
    shift = F.size("chosen_input_ids")
    segments = F.size("chosen_cu_seq_lens") - 1
    rest = F.slice("rejected_cu_seq_lens", 2, F.size("rejected_cu_seq_lens") - 1)
    joined = {
        "input_ids": F.concat("chosen_input_ids", "rejected_input_ids"),
        "labels": F.concat("chosen_labels", "rejected_labels"),
        "cu_seq_lens": F.concat("chosen_cu_seq_lens", F.transform(rest, lambda x: x + shift)),
        "position_ids": F.concat("chosen_position_ids", "rejected_position_ids"),
        "seq_idx": F.concat("chosen_seq_idx", F.transform("rejected_seq_idx", lambda x: x + segments)),
        "max_length": F.greatest("chosen_max_length", "rejected_max_length"),
        "batch_size": segments,
    }
    keep = [c for c in df.columns if not c.startswith(("chosen_", "rejected_"))]
    return df.select(*keep, *[c.alias(n) for n, c in joined.items()])


# --- F10 -----------------------------------------------------------------------------------


def length_bucketed_batches(df: DataFrame, key: str, length: Column, size: int) -> DataFrame:
    """batches of rows of like length; ``position`` keeps the original order for later."""
    placed = row_index(df.withColumn("__len", length), key, out="position")
    ranked = value_rank(placed, "__len", key, "__rank")
    return ranked.withColumns({"batch": F.floor((F.col("__rank") - 1) / size).cast("long"), "slot": ((F.col("__rank") - 1) % size).cast("int")}).drop("__rank", "__len")
