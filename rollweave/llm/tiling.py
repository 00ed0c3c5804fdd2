"""Benchmark decontamination by greedy string tiling.

Words of documents and items are hashed; runs of ``seed`` words that both hold are the seeds (the
Karp-Rabin matches of the least length). For each (document, item) with seeds, tiles are marked: the
longest common run of unmarked words first, then the next, down to ``seed`` words; no word is in two
tiles. The share of the item's words under tiles is its coverage, whatever the order of the tiles, so
passages cut apart and put together anew are found. A document is contaminated by an item if coverage
reaches ``threshold``.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words; each block's seeds are broadcast (their
size is that bound) and met by one pass over the documents, which are never shuffled.

Defined cases: null or empty texts hold no seeds; an item of fewer than ``min_words`` words stands in clean
texts too and gives no verdict (``short_items`` lists them); below ``seed`` words it is matched as a whole;
rows are judged by their text alone, whatever their doc_id; equal rows give equal results; ties between tiles of one length go to the earlier place in the
item, then in the document; words are compared with A-Z folded and punctuation at their ends dropped;
other columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.llm import kernel

#: Words of the benchmark in one broadcast block (about 40 bytes each).
BLOCK_WORDS = 1 << 20
#: Words of the shortest item that gives a verdict.
MIN_WORDS = 8
#: What parts words: ASCII signs and white space.
SIGNS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TILES = "doc_id long, text_hash long, item_id long, item_words int, covered int, n_tiles int, longest int, first int"


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: word hashes of all items on end, and their seeds in order of hash."""

    ids: np.ndarray
    first: np.ndarray
    words: np.ndarray
    seeds: dict[int, tuple[np.ndarray, np.ndarray]]
    place_item: np.ndarray


def tidy_words(texts: kernel.Texts) -> kernel.Words:
    """Words by their folded letters, digits and bytes above ASCII; other signs part words."""
    data = np.where(_LETTER[texts.data], texts.data, np.uint8(32))
    return kernel.words(kernel.Texts(texts.first, data, texts.offsets), lower=True)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def build_items(ids: list[int], texts: list[str], seed: int) -> Items:
    column = pa.array(texts, pa.large_string())
    words, counts = [], []
    for block in kernel.blocks(column):
        found = tidy_words(block)
        words.append(found.hash)
        counts.append(np.diff(found.bounds))
    all_words = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    count = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    item = np.repeat(np.arange(len(count)), count)
    seeds = {}
    for width in sorted({min(seed, int(n)) for n in count if n}):
        keys = kernel.windows(all_words, width)
        at = np.arange(len(keys))
        whole = (item[at] == item[at + width - 1]) & ((count[item[at]] == width) | (width == seed)) if len(keys) else np.zeros(0, bool)
        keys, at = keys[whole], at[whole]
        order = np.argsort(keys, kind="stable")
        seeds[width] = keys[order], at[order]
    return Items(np.array(ids, dtype=np.int64), first, all_words, seeds, item)


def tile(doc: np.ndarray, item: np.ndarray, hits: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the item, place in the document, length) from seed hits (item place, document place)."""
    seed = min(seed, len(item))
    diagonal = hits[:, 1] - hits[:, 0]
    order = np.lexsort((hits[:, 0], diagonal))
    at, diagonal = hits[order, 0], diagonal[order]
    start = np.flatnonzero(np.concatenate([[True], (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)]))
    stop = np.append(start[1:], len(at))
    heap = [(-int(b - a + seed - 1), int(at[a]), int(at[a] + diagonal[a])) for a, b in zip(start, stop)]
    heapq.heapify(heap)
    item_free, doc_marks, tiles = np.ones(len(item), dtype=bool), set(), []
    while heap:
        length, i, d = heapq.heappop(heap)
        free = item_free[i : i - length].copy()
        if doc_marks:
            free &= np.fromiter((k not in doc_marks for k in range(d, d - length)), bool, -length)
        if free.all():
            tiles.append((i, d, -length))
            item_free[i : i - length] = False
            doc_marks.update(range(d, d - length))
            continue
        # Part of it went to a longer tile: its free stretches wait for their turn.
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= seed:
                heapq.heappush(heap, (-int(b - a), i + int(a), d + int(a)))
    return tiles


def _matches(doc: np.ndarray, items: Items, seed: int) -> dict[int, list[np.ndarray]]:
    """Seed hits (place among all item words, place in the document) by item."""
    found: dict[int, list[np.ndarray]] = {}
    for width, (keys, places) in items.seeds.items():
        own = kernel.windows(doc, width)
        low = np.searchsorted(keys, own, side="left")
        hit = np.flatnonzero((low < len(keys)) & (keys[np.minimum(low, len(keys) - 1)] == own)) if len(keys) else []
        if not len(hit):
            continue
        low = low[hit]
        count = np.searchsorted(keys, own[hit], side="right") - low
        base = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        pairs = np.stack([places[base], np.repeat(hit, count)], axis=1)
        of = items.place_item[pairs[:, 0]]
        for k in np.unique(of):
            found.setdefault(int(k), []).append(pairs[of == k])
    return found


def _row_tiles(column: pa.Array, items: Items, seed: int, threshold: float, min_words: int) -> Iterator[tuple]:
    """(row, item, its words, covered, tiles, longest, first) of each row that an item contaminates."""
    for texts in kernel.blocks(column):
        words = tidy_words(texts)
        for i in _rows_with_seeds(words, items):
            doc = words.hash[words.bounds[i] : words.bounds[i + 1]]
            for k, parts in _matches(doc, items, seed).items():
                first, size = int(items.first[k]), int(items.first[k + 1] - items.first[k])
                if size < min_words:
                    continue
                hits = np.concatenate(parts)
                hits[:, 0] -= first
                width = min(seed, size)
                cover = np.zeros(size + 1, dtype=np.int64)
                own = np.unique(hits[:, 0])
                np.add.at(cover, own, 1)
                np.add.at(cover, own + width, -1)
                # All seeds together bound what tiles can cover.
                if np.count_nonzero(np.cumsum(cover[:-1])) < threshold * size:
                    continue
                tiles = tile(doc, items.words[first : first + size], hits, seed)
                covered = sum(x[2] for x in tiles)
                if covered >= threshold * size:
                    yield int(texts.first + i), int(items.ids[k]), size, covered, len(tiles), tiles[0][2], min(x[1] for x in tiles)


def _tiles(shared, seed: int, threshold: float, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_row_tiles(batch.column("text"), shared.value, seed, threshold, min_words))
            columns = list(zip(*rows)) or [()] * 7
            at = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    *(pa.array(x, pa.int64() if k == 0 else pa.int32()) for k, x in enumerate(columns[1:])),
                ],
                names=[x.split()[0] for x in TILES.split(", ")],
            )

    return run


def _clean(shared, seed: int, threshold: float, min_words: int):
    """The rows that no item of the block contaminates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for row, *_ in _row_tiles(batch.column("text"), shared.value, seed, threshold, min_words):
                keep[row] = False
            yield batch if keep.all() else batch.filter(pa.array(keep))

    return run


def _rows_with_seeds(words: kernel.Words, items: Items) -> np.ndarray:
    rows = []
    for width, (keys, _) in items.seeds.items():
        own = kernel.windows(words.hash, width)
        at = np.searchsorted(keys, own)
        hit = np.flatnonzero((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == own)) if len(keys) else np.zeros(0, int)
        hit = hit[words.row[hit] == words.row[hit + width - 1]]
        rows.append(words.row[hit])
    return np.unique(np.concatenate(rows)) if rows else np.zeros(0, dtype=np.int64)


def _blocks(benchmark: DataFrame, seed: int) -> Iterator:
    """The benchmark as broadcast blocks of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.size(F.split("text", r"\W+")) + 1).alias("n")).first()["n"] or 0
    parts = max(1, math.ceil(total / BLOCK_WORDS))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct()
        table = own.orderBy("item_id", "text").toArrow()
        yield spark.sparkContext.broadcast(build_items(table["item_id"].to_pylist(), table["text"].to_pylist(), seed))


def contaminated_documents(
    docs: DataFrame, benchmark: DataFrame, seed: int = 4, threshold: float = 0.5, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, text_hash, item_id, item_words, covered, n_tiles, longest, first) where tiles cover enough of an item."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    found = [texts.mapInArrow(kernel.lean(_tiles(block, seed, threshold, min_words)), TILES) for block in _blocks(benchmark, seed)]
    return reduce(DataFrame.unionAll, found)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, seed: int = 4, threshold: float = 0.5, min_words: int = MIN_WORDS
) -> DataFrame:
    """The rows of ``docs`` whose text no item contaminates, each judged by itself; nothing is shuffled."""
    for block in _blocks(benchmark, seed):
        docs = docs.mapInArrow(kernel.lean(_clean(block, seed, threshold, min_words)), docs.schema)
    return docs


def short_items(benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The items that are too short for a verdict, with their number of words."""
    words = F.size(F.filter(F.split("text", SIGNS), lambda w: w != ""))
    return benchmark.withColumn("n_words", words).where(F.col("text").isNotNull() & F.col("n_words").between(1, min_words - 1))
