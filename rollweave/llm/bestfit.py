"""Best-fit packing of documents into sequences of a fixed length, certified by lower bounds.

A document's ids (its tokens and an end id) are cut into pieces of at most ``capacity``: if it is longer,
every piece but the first is full. Full pieces are sequences of their own. All other pieces are dealt into
parts by hash; each part packs by best-fit decreasing. Dual-feasible functions give a lower bound of the
sequences that a set of pieces needs; a part whose count meets its bound is certified. The parts' bounds
add up to more than the bound of all pieces, as each rounds up, so while the whole is above its own bound,
parts hand over the pieces of their emptiest sequences, and those are dealt anew into fewer parts and
packed again by best-fit decreasing, until the whole meets its bound or a round gains nothing. Every row of
the result tells the bound and by how many sequences it is missed. Pieces are dealt by a number of their
own, so equal rows fill all parts.

Defined cases: a null text is empty and gives one piece that holds the end id; rows that repeat a doc_id
are packed each for itself; a null doc_id stays null; ties go by (length, doc_id, piece); other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.llm.fasttokens import encoder
from rollweave.session import materialise_stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Pieces that one part packs, about (some 60 bytes each).
PART = 1 << 16


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first takes what full pieces leave."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _tokenised(vocabulary: str, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary, spaced=True)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = []
                for doc, own in zip(batch.column("doc_id").to_pylist(), tool.ids(batch.column("text"))):
                    ids = np.append(own, np.uint32(end)).astype("<u4")
                    for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                        rows.append((doc, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int32() if k == 1 else pa.int64()) for k, x in enumerate(columns)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that pieces need at least; ``counts[n]`` pieces have length ``n``.

    The functions are the classical ones: with a threshold ``e``, lengths above ``capacity - e`` count as
    full and lengths below ``e`` as nothing; and with a divisor ``k``, a length counts as the share of
    ``capacity`` that floor((k + 1) * length / capacity) makes of ``k``. A multiple of a sequence is kept as
    it is when it divides evenly.
    """
    lengths = np.arange(len(counts))
    best = -(-int((counts * lengths).sum()) // capacity)
    head, mass = np.cumsum(counts), np.cumsum(counts * lengths)
    for e in range(1, capacity // 2 + 1):
        full = int(head[-1] - head[capacity - e])
        middle = int(mass[capacity - e] - mass[e - 1])
        best = max(best, full + -(-middle // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * lengths
        even = scaled % capacity == 0
        value = np.where(even, lengths * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, longest first, each into the fullest sequence that takes it.

    Open sequences are kept by their room; a bit for each room finds the least one that fits.
    """
    order = np.argsort(-lengths, kind="stable")
    place, offset, rooms, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), {}, 0
    open_ = 0
    for i in order.tolist():
        n = int(lengths[i])
        fits = open_ >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            own = rooms[room]
            k = own.pop()
            if not own:
                open_ ^= 1 << room
        else:
            k, room = used, capacity
            used += 1
        place[i], offset[i] = k, capacity - room
        room -= n
        if room:
            own = rooms.setdefault(room, [])
            if not own:
                open_ |= 1 << room
            own.append(k)
    return place, offset, used


def _pack_part(capacity: int):
    """Pack one part; the emptiest sequences, a thousandth and two at least, are ``loose``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table["length"].to_numpy()
        place, offset, used = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(place, weights=lengths, minlength=used).astype(np.int64)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        release = max(2, used // 1000, 8 * (used - bound))
        loose = np.zeros(used, dtype=bool)
        loose[np.argsort(fill, kind="stable")[:release]] = True
        loose &= fill < capacity
        part = table["part"][0].as_py()
        out = table.drop_columns(["part"])
        return (
            out.append_column("sequence_id", pa.array((part << 32) + place))
            .append_column("offset", pa.array(offset))
            .append_column("loose", pa.array(loose[place]))
        )

    return run


def pack(pieces: DataFrame, capacity: int, part_rows: int = PART) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32), a stored table, with sequence_id and offset.

    ``bound`` is the number of sequences that all pieces need at least, ``gap`` how many more there are.
    """
    schema = PACKED + ", loose boolean"
    full = pieces.where(F.col("length") == capacity).select(
        "*",
        # One row, one sequence: names below zero are no part's.
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest, done, named = pieces.where(F.col("length") < capacity), materialise_stage(full, "packed"), 0
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in rest.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[row["length"]] = row["n"]
    whole = pieces.where(F.col("length") == capacity).count()
    n, bound, settled, before, best = int(counts.sum()), lower_bound(counts, capacity), 0, None, None
    while True:
        parts = max(1, math.ceil(n / part_rows))
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(named)), F.lit(parts)) + named
        packed = materialise_stage(
            rest.withColumn("part", part).groupBy("part").applyInArrow(_pack_part(capacity), schema), "packed"
        )
        named += parts
        used = packed.agg(F.count_distinct("sequence_id").alias("n")).first()["n"]
        total = settled + used
        if before is None or total <= before:
            best = done.unionByName(packed.drop("loose")), total
        if total <= bound or (parts == 1 and not settled) or (before is not None and total >= before):
            gap = F.lit(best[1] - bound).cast("long")
            return best[0].select("*", F.lit(bound + whole).cast("long").alias("bound"), gap.alias("gap"))
        kept = packed.where("not loose").drop("loose")
        settled += kept.agg(F.count_distinct("sequence_id").alias("n")).first()["n"]
        done, before = done.unionByName(kept), total
        rest = packed.where("loose").select("doc_id", "piece", "start", "length", "ids_crc32")
        n = rest.count()


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, end: int = 0, capacity: int = 2048, part_rows: int = PART
) -> DataFrame:
    """The pieces of every document, each with its sequence and its place there; see ``pack``."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialise_stage(texts.mapInArrow(_tokenised(vocabulary, end, capacity), PIECES), "pieces")
    return pack(pieces, capacity, part_rows)
