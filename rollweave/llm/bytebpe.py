"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by concatenation.

Texts become chunks, one for each Arrow batch of some megabytes: the chunk's distinct words (matches of the
pattern) once, and every text as codes into them. A higher-order fold encodes distinct words: it starts from
a word's bytes (``Starts``) and joins, step by step, the leftmost pair of least rank; ranks come
from a literal map in the plan, laid out so that a pair is found in one step (Spark looks up a key in a map by
reading it from the start). Words
that many chunks share, at most ``HEAD``, are encoded once and sent to all tasks; all others are encoded in
the chunk where they stand. So the only shuffle counts the chunks of each word; texts and codes stay
in their task, and a chunk's work does not depend on any other.

The fold copies a word's array at each merge, which is quadratic in the word; a word of more than ``FOLDED``
bytes takes the same merges from a heap over a linked list instead.

Defined cases: a null text is empty and has no ids; a null doc_id stays null; repeated rows are encoded
each; other columns are ignored; an empty table gives an empty result. A vocabulary in which a piece is not
reached by merging two pieces of lower rank is refused. Decoding an id beyond the vocabulary is an error.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.llm import kernel
from rollweave.session import materialise_stage, scratch_path

#: Bytes of text in one chunk, at most (one longer text is a chunk of its own); Arrow batches may be smaller.
CHUNK = 1 << 22
#: Longest word that the fold takes, in bytes.
FOLDED = 256
#: Words sent to all tasks, at most, and the bytes of one, at most: below 50 MB with their ids, 10 as a rule.
HEAD, HEAD_BYTES = 1 << 18, 32
#: Factor that spreads the right piece of a pair over the cells of the rank map; odd.
SPREAD = 40_503
#: In the fold a piece is its id plus ``SHIFT`` times the id of the pair it opens; ``NONE``: no such pair.
SHIFT, NONE = 1 << 20, 1 << 40
#: Stands before the first piece, so that each piece has one on its left; opens no pair and is in none.
START = NONE * SHIFT + SHIFT - 1

CHUNKS = "docs array<long>, counts array<int>, codes binary, words array<string>"
RESOLVED = "texts array<struct<doc_id:long,codes:array<int>>>, known array<array<int>>, rest array<array<long>>"
STARTED = "word string, start array<long>"
ENCODED = "doc_id long, ids array<int>"

#: Letters, digits, signs (but the apostrophe) and white space of ASCII; the pattern never joins two kinds.
_KIND = np.zeros(256, dtype=np.uint8)
for _b in range(33, 127):
    _KIND[_b] = 1 if chr(_b).isalpha() else 2 if chr(_b).isdigit() else 3
_KIND[ord("'")] = 0
_KIND[[9, 10, 11, 12, 13, 32]] = 4
#: Second bytes of the letters that begin with byte 0xC3.
_ACCENTED = np.isin(np.arange(256), [x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)])


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a vocabulary file: base64 and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (x.split() for x in lines if x.strip())}


def merges(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The pair of ids that each longer piece is made of: what its bytes come to before its own rank."""
    out = {}
    for piece, rank in ranks.items():
        if len(piece) > 1:
            parts = heap_ids(piece, ranks, below=rank)
            if len(parts) != 2:
                raise ValueError(f"{piece!r} is no merge of two pieces of lower rank")
            out[parts[0], parts[1]] = rank
    return out


class PairTable:
    """Pairs and ranks as two arrays: the cell of a pair is its left piece's shift plus its spread right piece.

    A cell holds what the fold has for the left piece in front of the right one, so a cell of another pair is
    told by its left piece. Shifts are drawn until no two pairs share a cell, pieces with many pairs first.
    """

    def __init__(self, pairs: dict[tuple[int, int], int], seed: int = 1):
        rights: dict[int, list[int]] = {}
        for left, right in pairs:
            rights.setdefault(left, []).append(right)
        self.size = 1 << max(8, (4 * len(pairs)).bit_length())
        cells, draw = np.full(self.size, START, dtype=np.int64), np.random.default_rng(seed)
        shifts = np.zeros(max(rights, default=0) + 1, dtype=np.int64)
        for left in sorted(rights, key=lambda x: (-len(rights[x]), x)):
            own = np.array(rights[left], dtype=np.int64) * SPREAD
            while True:
                shift = int(draw.integers(self.size))
                at = (own + shift) & (self.size - 1)
                if (cells[at] == START).all():
                    break
            shifts[left] = shift
            cells[at] = [pairs[left, right] * SHIFT + left for right in rights[left]]
        self.cells, self.shifts = cells, shifts

    def paired(self, left: np.ndarray, right: np.ndarray, last: np.ndarray) -> np.ndarray:
        """What the fold has for each ``left`` piece in front of ``right``; no pair at ``last``."""
        known = left < len(self.shifts)
        cell = self.cells[(self.shifts[np.where(known, left, 0)] + right * SPREAD) & (self.size - 1)]
        return np.where(known & ~last & ((cell & (SHIFT - 1)) == left), cell, NONE * SHIFT + left)


def _bound(value: Column, kind: str, body: Callable[[Column], Column]) -> Column:
    """``body``, of type ``kind``, of a value that is computed once; a fold of one step copies nothing."""
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, x: body(x))


class Starts:
    """What the fold of a word starts from: ``START``, then its bytes, two of them as one piece where that is certain.

    ``least[x, y]`` is the least rank that joins a piece ending in byte x and one beginning with y. Two bytes whose
    own rank is below that on both sides become one piece in any order of the merges around them: nothing
    joins either of them to its other neighbour before. Such pairs never share a byte.
    """

    def __init__(self, ranks: dict[bytes, int], made: dict[tuple[int, int], int], pairs: PairTable):
        self.pairs = pairs
        self.singles = np.array([ranks[bytes([b])] for b in range(256)])
        first, last = np.zeros(max(ranks.values()) + 1, dtype=np.int64), np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for piece, rank in ranks.items():
            first[rank], last[rank] = piece[0], piece[-1]
        self.least = np.full((256, 256), NONE)
        left, right = np.array(list(made), dtype=np.int64).reshape(-1, 2).T
        np.minimum.at(self.least, (last[left], first[right]), np.array(list(made.values()), dtype=np.int64))
        self.own = np.array([[made.get((x, y), NONE) for y in self.singles.tolist()] for x in self.singles.tolist()])

    def __call__(self, words: pa.Array) -> pa.ListArray:
        data, offsets = kernel.raw_text(words)
        # Of each byte, the least rank and the own rank of it and the byte behind; none where a word ends.
        bound, own = np.full(len(data) + 1, NONE), np.full(len(data) + 1, NONE)
        inner = np.ones(len(data), dtype=bool)
        inner[offsets[1:][np.diff(offsets) > 0] - 1] = False
        at = np.flatnonzero(inner)
        bound[at], own[at] = self.least[data[at], data[at + 1]], self.own[data[at], data[at + 1]]
        # ``bound[-1]`` is the place behind the last byte: none.
        sure = (own[:-1] < bound[np.arange(len(data)) - 1]) & (own[:-1] < bound[1:])
        gone = np.append(False, sure)[: len(data)]
        pieces = np.where(sure, own[:-1], self.singles[data])[~gone]
        ends = offsets - np.append(0, np.cumsum(gone))[offsets]
        last = np.zeros(len(pieces), dtype=bool)
        last[ends[1:][np.diff(ends) > 0] - 1] = True
        states = np.insert(self.pairs.paired(pieces, np.append(pieces[1:], 0)[: len(pieces)], last), ends[:-1], START)
        return pa.ListArray.from_arrays(pa.array((ends + np.arange(len(ends))).astype(np.int32)), pa.array(states))


def _folded(start: Column, maps: Column, size: int) -> Column:
    """The ids of a word.

    A step takes the least number of the state with places for left pieces: the leftmost pair of least rank
    (``array_position`` throws at each find); the last piece opens no pair.
    """

    def paired(left: Column, right: Column) -> Column:
        cell = F.get(maps["cells"], (F.get(maps["shifts"], left) + right * SPREAD).bitwiseAND(size - 1))
        return F.when(cell.bitwiseAND(SHIFT - 1) == left, cell).otherwise(left + NONE * SHIFT)

    def piece(state: Column, at: Column) -> Column:
        return F.get(state, at).bitwiseAND(SHIFT - 1)

    def merge(state: Column, least: Column) -> Column:
        """Join the pieces ``at`` and ``at + 1``, counted from zero, to the pair's own id."""
        made, at = F.shiftright(least, SHIFT.bit_length() - 1), least.bitwiseAND(SHIFT - 1).cast("int")

        def changed(x: Column, k: Column) -> Column:
            left = F.when(k > at + 1, x).when(k < at - 1, x).when(k == at, paired(made, piece(state, at + 2)))
            return left.when(k > at, -1).otherwise(paired(x.bitwiseAND(SHIFT - 1), made))

        return F.array_remove(F.transform(state, changed), F.lit(-1).cast("long"))

    def step(state: Column, _: Column) -> Column:
        placed = F.transform(state, lambda x, at: x.bitwiseAND(-SHIFT).bitwiseOR(at))
        merged = F.aggregate(F.array(F.array_min(placed)), state, merge)
        return F.when(F.array_min(state) >= NONE * SHIFT, state).otherwise(merged)

    done = _bound(start, "array<bigint>", lambda s: F.aggregate(F.slice(s, 3, F.size(s)), s, step))
    return _bound(done, "array<int>", lambda s: F.transform(F.slice(s, 2, F.size(s)), lambda x: x.bitwiseAND(SHIFT - 1).cast("int")))


class RankMap:
    """The ranks as foldable columns, so that they are literals of the plan."""

    def __init__(self, ranks: dict[bytes, int]):
        made = merges(ranks)
        pairs = PairTable(made)
        listed = {"cells": pairs.cells.tolist(), "shifts": pairs.shifts.tolist()}
        kinds = ",".join(f"{name}:array<bigint>" for name in listed)
        self._maps = F.from_json(F.lit(json.dumps(listed, separators=(",", ":"))), f"struct<{kinds}>")
        self._size = pairs.size
        self.starts = Starts(ranks, made, pairs)
        pieces = [""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            # One character for each byte.
            pieces[rank] = piece.decode("latin-1")
        self._pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")

    def ids(self, words: Column) -> Column:
        """The ids of each word (its ``Starts``) of an array; the maps are bound once, so that the plan holds one copy of each."""
        return _bound(self._maps, "array<array<int>>", lambda m: F.transform(words, lambda w: _folded(w, m, self._size)))

    def decoded(self, ids: Column) -> Column:
        """The bytes of ``ids``, piece after piece."""
        return F.encode(F.array_join(F.transform(ids, lambda i: F.element_at(self._pieces, i + 1)), ""), "ISO-8859-1")


def heap_ids(word: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[int]:
    """The same merges for one long word: least rank first, leftmost among equal ones; only ranks ``below``."""
    ends, back = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        if ends[start] < len(word):
            stop = ends[ends[start]]
            rank = ranks.get(word[start:stop])
            if rank is not None and (below is None or rank < below):
                heapq.heappush(heap, (rank, start, stop))

    for start in range(len(word)):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = ends[start]
        # Stale: the piece is gone (its end is 0), or either half has grown.
        if not middle or middle >= len(word) or ends[middle] != stop:
            continue
        ends[start], ends[middle] = stop, 0
        if stop < len(word):
            back[stop] = start
        if back[start] >= 0:
            offer(back[start])
        offer(start)
    out, at = [], 0
    while at < len(word):
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


def _runs(texts: kernel.Texts) -> tuple[pa.Array, np.ndarray]:
    """The texts cut where two kinds of ASCII meet and the pattern cannot cross, and how many cuts each text has.

    White space belongs to what follows it, so nothing is cut behind it.
    """
    data, offsets = texts.data, texts.offsets
    kind = _KIND[data]
    two = np.flatnonzero(data[:-1] == 0xC3)
    two = two[_ACCENTED[data[two + 1]]]
    kind[two] = kind[two + 1] = 1
    before, own = kind[:-1], kind[1:]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (before != own) & (before != 0) & (own != 0) & (before != 4)
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    runs = pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(data))
    return runs, np.diff(np.searchsorted(edges, offsets))


def _coded(texts: kernel.Texts, find) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct matches, the code of each match, and the number of matches of each text."""
    runs, count = _runs(texts)
    coded = runs.dictionary_encode()
    index = coded.indices.to_numpy()
    known: dict[str, int] = {}
    flat, size = [], []
    for run in coded.dictionary.to_pylist():
        found = find(run)
        size.append(len(found))
        flat.extend(known.setdefault(w, len(known)) for w in found)
    bounds = np.concatenate([[0], np.cumsum(count)])
    codes, ends = _taken(np.array(flat, dtype=np.uint32), np.array(size, dtype=np.int64), index)
    return list(known), codes, np.diff(np.concatenate([[0], ends])[bounds])


def _taken(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``index`` of (``flat``, ``size``) on end, and where each ends."""
    length = size[index]
    ends = np.cumsum(length)
    if not len(flat):
        return flat, ends
    first = (np.cumsum(size) - size)[index]
    return flat[np.repeat(first - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


def _chunked(pattern: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        for batch in batches:
            for texts in kernel.blocks(batch.column("text"), limit):
                words, codes, counts = _coded(texts, find)
                docs = batch.column("doc_id").slice(texts.first, len(texts))
                yield _row(CHUNKS, _one(docs), _one(pa.array(counts, pa.int32())), pa.array([codes.astype("<u4").tobytes()]), _one(pa.array(words, pa.string())))

    return run


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _row(schema: str, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=[x.split()[0] for x in schema.split(", ")])


def _resolved(head, ranks: dict[bytes, int], starts: Starts):
    """Each chunk with the ids of its shared and its long words; codes count these first, then ``rest``, which come as their ``Starts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, ids = head.value["word"].combine_chunks(), head.value["shared"].combine_chunks()
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column("words")[k].values
                found = pc.index_in(words, value_set=shared)
                have = found.is_valid().to_numpy(zero_copy_only=False)
                long = ~have & (pc.binary_length(words).to_numpy() > FOLDED)
                rest = ~have & ~long
                known = [ids.take(found.drop_null())]
                known += [pa.array([heap_ids(words[int(i)].as_py().encode(), ranks)], ids.type) for i in np.flatnonzero(long)]
                place = np.empty(len(words), dtype=np.int32)
                place[np.concatenate([np.flatnonzero(have), np.flatnonzero(long), np.flatnonzero(rest)])] = np.arange(len(words))
                codes = place[np.frombuffer(batch.column("codes")[k].as_buffer(), dtype="<u4")]
                bounds = np.concatenate([[0], np.cumsum(batch.column("counts")[k].values.to_numpy())]).astype(np.int32)
                texts = pa.StructArray.from_arrays(
                    [batch.column("docs")[k].values, pa.ListArray.from_arrays(pa.array(bounds), pa.array(codes))], names=["doc_id", "codes"]
                )
                yield _row(RESOLVED, _one(texts), _one(pa.concat_arrays(known)), _one(starts(words.filter(pa.array(rest)))))

    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str, chunk_bytes: int = CHUNK, head_words: int = HEAD) -> DataFrame:
    """The ids of every text (``ENCODED``), each match of ``pattern`` encoded by itself."""
    spark = docs.sparkSession
    ranks = read_ranks(vocabulary)
    rank_map = RankMap(ranks)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    path = scratch_path(spark, "chunks")
    texts.mapInArrow(_chunked(pattern, chunk_bytes), CHUNKS).write.option("compression", "zstd").parquet(path)
    chunks = spark.read.schema(CHUNKS).parquet(path)
    head = spark.sparkContext.broadcast(_shared_words(chunks, rank_map, head_words).toArrow())
    table = F.concat("known", rank_map.ids(F.col("rest")))

    def assembled(ids: Column) -> Column:
        return F.transform(
            "texts", lambda t: F.struct(t["doc_id"].alias("doc_id"), F.flatten(F.transform(t["codes"], lambda c: F.get(ids, c))).alias("ids"))
        )

    resolved = chunks.mapInArrow(_resolved(head, ranks, rank_map.starts), RESOLVED)
    return resolved.select(F.explode(_bound(table, "array<struct<doc_id:bigint,ids:array<int>>>", assembled)).alias("x")).select("x.doc_id", "x.ids")


def _started(starts: Starts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word")
            yield _row(STARTED, words, starts(words))

    return run


def _shared_words(chunks: DataFrame, rank_map: RankMap, most: int) -> DataFrame:
    """At most ``most`` words of at most ``HEAD_BYTES`` bytes, those in the most chunks, with their ids as ``shared``."""
    spark = chunks.sparkSession
    word = chunks.select(F.explode("words").alias("word")).where(F.octet_length("word") <= HEAD_BYTES)
    counted = materialise_stage(word.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "words")
    # One row for each number of chunks; the least number that leaves few enough words.
    sizes = sorted((r.n, r.words) for r in counted.groupBy("n").agg(F.count("*").alias("words")).collect())
    least, held = (1 << 62), 0
    for n, words in reversed(sizes):
        if held + words > most:
            break
        least, held = n, held + words
    often = counted.where(F.col("n") >= least).select("word").repartition(spark.sparkContext.defaultParallelism)
    started = often.mapInArrow(_started(rank_map.starts), STARTED)
    return started.select("word", F.get(rank_map.ids(F.array("start")), F.lit(0)).alias("shared"))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with the bytes of its ids as ``decoded``."""
    return encoded.withColumn("decoded", RankMap(read_ranks(vocabulary)).decoded(F.col("ids")))


def round_trip_digests(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """Number and hash of every document's ids, and the hash of what they decode to."""
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return decode(encode(docs, vocabulary, pattern or public_tokenizers.PATTERN), vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
