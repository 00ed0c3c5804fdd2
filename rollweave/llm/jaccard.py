"""Exact Jaccard join on word shingles through prefix trees, and the classes it links.

Documents with equal shingle sets are one class; only classes are joined. Two classes link when
``den * |A and B| >= num * |A or B|``. The steps:

1. Shingles are counted over all documents. The most frequent ones (a table of bounded size, see
   ``FREQUENT``) come last in the global order of shingles; all others are ordered by hash. Any total
   order gives the same links; this one keeps shared passages out of the prefixes.
2. Of two linked sets, the first ``|A| - need + 1`` shingles in that order share one. Only those
   prefixes are shuffled, in packed form, into the buckets where equal shingles meet.
3. In each group of classes that share a prefix shingle, members are joined to hubs of fitting size, not
   to each other. A parity bitmap bounds the overlap of a pair and discards most that do not link.
   Pairs left over are verified against a prefix tree of the members' whole sets.
4. Links give components. Groups whose classes all lie in one component need nothing more. In the others
   each member is tried with its likeliest partner of another component, twice; then all pairs of members
   that still lie in different components are verified the same way, so no link between components is
   missed, and pairs inside a component are never formed.

Defined cases: a text without words (or null) has an empty set and links with nothing; fewer words than
the shingle width make one shingle of the whole sequence; equal rows are linked; rows are told apart by
doc_id and text, so a null or repeated doc_id joins nothing by itself; a null doc_id is never the name of a
component unless all of its rows have none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.llm import kernel
from rollweave.llm.components import components
from rollweave.session import materialise_stage

#: Entries of the broadcast table of frequent shingles (9 bytes each).
FREQUENT = 1 << 20
#: A shingle held by fewer documents than this is never called frequent.
COMMON = 16
#: Distinct shingles a task gathers before it sends them on.
FLUSH = 1 << 20
#: Packed shingles that one bucket gets, about.
BUCKET = 1 << 21
#: Bits of the broadcast filter of documents whose whole sets are needed.
FILTER_BITS = 1 << 26
#: Members of one prefix tree, about.
TREE = 256
#: Members of a group that meet in one task.
TILE = 4096

DIGEST = "doc_id long, own long, cls long, n int, bitmap binary"
PACKED = "bucket int, counts binary, data binary, heads binary"
MEMBERS = "grp long, cls long, n int, short boolean, hub long"
SETS = "cls long, n int, data binary"


def needed(n, m, num: int, den: int):
    """The least overlap with which sets of ``n`` and ``m`` shingles link."""
    return -((-num * (n + m)) // (num + den))


def class_hash(own: np.ndarray) -> int:
    """One signed number for a set; equal sets get equal numbers."""
    total = np.add.reduce(kernel.mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(kernel.mix(np.array([total + np.uint64(len(own))], dtype=np.uint64)).view(np.int64)[0])


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; at least as many bits as shingles, a power of two."""
    bits = 1 << max(6, math.ceil(math.log2(max(2, len(own)))))
    places = (own >> np.uint64(13)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference: the longer bitmap is folded to the shorter one."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _sets(batches: Iterator[pa.RecordBatch], width: int, wanted=None) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        if wanted is not None:
            batch = batch.filter(wanted(batch.column("doc_id")))
        docs = batch.column("doc_id").to_pylist()
        for texts in kernel.blocks(batch.column("text")):
            found = kernel.words(texts, lower=True)
            for i, own in enumerate(kernel.shingle_sets(found, len(texts), width)):
                yield docs[texts.first + i], own


def _digests(width: int):
    def run(batches):
        rows: list[tuple] = []
        seen: set[int] = set()
        named: deque = deque()

        def named_batches():
            for batch in batches:
                named.extend(batch.column("own").to_pylist())
                yield batch

        def digests():
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=[x.split()[0] for x in DIGEST.split(", ")])

        for doc, own in _sets(named_batches(), width):
            cls = class_hash(own) if len(own) else None
            new = cls is not None and cls not in seen
            if new and len(seen) < FLUSH:
                seen.add(cls)
            rows.append((doc, named.popleft(), cls, len(own), bitmap(own) if new else None))
            if len(rows) >= 4096:
                yield digests()
                rows = []
        if rows:
            yield digests()

    return run


def _bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _packed(buckets: list[int], counts: list[bytes], data: list[bytes], heads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(counts, pa.binary()), pa.array(data, pa.binary()), pa.array(heads, pa.binary())],
        names=["bucket", "counts", "data", "heads"],
    )


def _shingle_segments(width: int, buckets: int):
    """Distinct shingles of a task, sorted, as 32 bit steps, one row for each bucket."""

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
        edges = np.searchsorted(_bucket_of(tokens, buckets), np.arange(buckets + 1))
        rows = [(k, edges[k], edges[k + 1]) for k in range(buckets) if edges[k + 1] > edges[k]]
        # 40 bits of a shingle, as steps: enough for an order, and a step is short.
        short = (tokens >> np.uint64(24)).astype(np.uint64)
        return _packed(
            [k for k, _, _ in rows],
            [np.minimum(counts[a:b], 65535).astype(np.uint16).tobytes() if counts[a:b].max() > 1 else b"" for _, a, b in rows],
            [np.diff(short[a:b], prepend=short[a]).astype(np.uint32).tobytes() for _, a, b in rows],
            [short[a : a + 1].tobytes() for _, a, _ in rows],
        )

    def run(batches):
        parts, held, seen = [], 0, set()
        for _, own in _sets(batches, width):
            if len(own):
                cls = class_hash(own)
                if cls in seen:
                    continue
                if len(seen) < FLUSH:
                    seen.add(cls)
                parts.append(own)
                held += len(own)
                if held >= FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


def _frequent_in_bucket(table: pa.Table) -> pa.Table:
    tokens, counts = [], []
    for data, count, head in zip(table["data"].to_pylist(), table["counts"].to_pylist(), table["heads"].to_pylist()):
        steps = np.frombuffer(data, dtype=np.uint32).astype(np.uint64)
        tokens.append(np.cumsum(steps, dtype=np.uint64) + np.frombuffer(head, dtype=np.uint64)[0])
        counts.append(np.frombuffer(count, dtype=np.uint16) if count else np.ones(len(steps), dtype=np.uint16))
    all_tokens = np.concatenate(tokens)
    order = np.argsort(all_tokens, kind="stable")
    all_tokens, weight = all_tokens[order], np.concatenate(counts)[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], all_tokens[1:] != all_tokens[:-1]]))
    total = np.add.reduceat(weight, first)
    often = total >= COMMON
    return pa.table(
        {
            "token": pa.array(all_tokens[first][often].astype(np.int64)),
            "level": pa.array(np.floor(np.log2(total[often])).astype(np.int32)),
        }
    )


def frequent_shingles(texts: DataFrame, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (40 bits each, sorted) and the binary logarithm of their counts."""
    often = materialise_stage(
        texts.mapInArrow(kernel.lean(_shingle_segments(width, buckets)), PACKED)
        .groupBy("bucket")
        .applyInArrow(kernel.lean_group(_frequent_in_bucket), "token long, level int"),
        "frequent",
    )
    least, total = 64, 0
    for row in sorted(often.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["level"]
    table = often.where(F.col("level") >= least).toArrow()
    tokens = np.array(table["token"].to_numpy(), dtype=np.uint64)
    order = np.argsort(tokens)
    return tokens[order], table["level"].to_numpy()[order].astype(np.uint8)


def _posting_segments(width: int, buckets: int, frequent, num: int, den: int):
    """The prefixes of a task's classes: one row for each bucket, with its shingles run after run of a class."""

    def flush(tokens, rank, cls, size) -> pa.RecordBatch:
        token, of = np.concatenate(tokens), np.repeat(np.arange(len(cls)), [len(t) for t in tokens])
        first = np.concatenate(rank)
        where = _bucket_of(token, buckets)
        order = np.argsort(where, kind="stable")
        token, of, first, where = token[order], of[order], first[order], where[order]
        edges = np.searchsorted(where, np.arange(buckets + 1))
        names, sizes = np.array(cls, dtype=np.int64), np.array(size, dtype=np.uint32)
        rows, counts, data, heads = [], [], [], []
        for k in range(buckets):
            a, b = edges[k], edges[k + 1]
            if b > a:
                own, count = np.unique(of[a:b], return_counts=True)
                rows.append(k)
                counts.append(count.astype(np.uint32).tobytes() + sizes[own].tobytes())
                # Within a bucket 32 bits tell shingles apart; the last bit says whether it is in the short prefix.
                low = (token[a:b] >> np.uint64(16)).astype(np.uint32) & np.uint32(0xFFFFFFFE)
                data.append((low | first[a:b].astype(np.uint32)).tobytes())
                heads.append(names[own].tobytes())
        return _packed(rows, counts, data, heads)

    def run(batches):
        often, level = frequent.value
        tokens, rank, cls, size, held, seen = [], [], [], [], 0, set()
        for _, own in _sets(batches, width):
            n = len(own)
            if not n:
                continue
            name = class_hash(own)
            if name in seen:
                continue
            if len(seen) < FLUSH:
                seen.add(name)
            long = n + num * -n // den + 1
            short = n - needed(n, n, num, den) + 1
            at = np.searchsorted(often, own >> np.uint64(24))
            known = (at < len(often)) & (often[np.minimum(at, len(often) - 1)] == own >> np.uint64(24)) if len(often) else np.zeros(n, bool)
            if known.any():
                key = np.where(known, level[np.minimum(at, len(level) - 1)], 0)
                prefix = own[np.lexsort((own, key))[:long]]
            else:
                prefix = own[:long]
            tokens.append(prefix)
            rank.append(np.arange(len(prefix)) < short)
            cls.append(name)
            size.append(n)
            held += len(prefix)
            if held >= FLUSH:
                yield flush(tokens, rank, cls, size)
                tokens, rank, cls, size, held = [], [], [], [], 0
        if cls:
            yield flush(tokens, rank, cls, size)

    return run


def _groups_in_bucket(num: int, den: int):
    """Groups of two or more classes that share a prefix shingle, each member with its hub."""

    def run(table: pa.Table) -> pa.Table:
        token, cls, size = [], [], []
        for data, count, head in zip(table["data"].to_pylist(), table["counts"].to_pylist(), table["heads"].to_pylist()):
            names = np.frombuffer(head, dtype=np.int64)
            both = np.frombuffer(count, dtype=np.uint32)
            times, sizes = both[: len(names)], both[len(names) :]
            token.append(np.frombuffer(data, dtype=np.uint32))
            cls.append(np.repeat(names, times))
            size.append(np.repeat(sizes, times))
        token, cls, size = np.concatenate(token), np.concatenate(cls), np.concatenate(size).astype(np.int64)
        order = np.lexsort((cls, size, token >> 1))
        token, cls, size = token[order], cls[order], size[order]
        short, token = (token & 1).astype(bool), token >> 1
        # A class sent by several tasks counts once.
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])])
        token, cls, size, short = token[new], cls[new], size[new], short[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        last = np.append(first[1:], len(token))
        many = np.flatnonzero((last - first > 1) & (np.add.reduceat(short, first) > 0))
        bucket = int(table["bucket"][0].as_py())
        out: dict[str, list[np.ndarray]] = {"grp": [], "cls": [], "n": [], "short": [], "hub": []}
        known: set[bytes] = set()
        for k in many:
            a, b = first[k], last[k]
            names, n, s = cls[a:b], size[a:b], short[a:b]
            key = names.tobytes() + s.tobytes()
            if key in known:
                continue
            known.add(key)
            hub, i, fits = np.zeros(b - a, dtype=np.int64), 0, False
            left = np.flatnonzero(s)
            while len(left):
                i = int(left[0])
                # Members are in order of size; the hub takes those its own size allows.
                until = int(np.searchsorted(n, n[i] * den // num, side="right"))
                if until > i + 1:
                    hub[i + 1 : until] = names[i]
                    fits = True
                left = left[left >= max(until, i + 1)]
            if fits:
                out["grp"].append(np.full(b - a, (bucket << 32) + int(token[a]), dtype=np.int64))
                for name, x in (("cls", names), ("n", n), ("short", s), ("hub", hub)):
                    out[name].append(x)
        join = lambda name, kind: np.concatenate(out[name]).astype(kind) if out[name] else np.zeros(0, dtype=kind)
        return pa.table(
            {
                "grp": join("grp", np.int64),
                "cls": join("cls", np.int64),
                "n": join("n", np.int32),
                "short": join("short", bool),
                "hub": join("hub", np.int64),
            }
        )

    return run


def _close_enough(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b, n, m in zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b", "n_a", "n_b"))):
                keep.append(2 * needed(n, m, num, den) <= n + m - differing(a, b))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _folded(maps: list[bytes], bits: int) -> np.ndarray:
    """Bitmaps as rows of 64 bit words, folded to ``bits``."""
    rows = [np.frombuffer(m, dtype=np.uint64) for m in maps]
    return np.stack([np.bitwise_xor.reduce(r.reshape(-1, bits // 64), axis=0) for r in rows])


def _open_pairs(num: int, den: int, nearest: bool):
    """Pairs of a group's members from different components that the bitmaps cannot tell apart.

    A hot group comes in tiles of two chunks, so its members meet in many tasks.
    """

    def pairs(tile: pa.Table) -> Iterator[tuple[int, int]]:
        n, cls, part = tile["n"].to_numpy(), tile["cls"].to_numpy(), tile["component"].to_numpy()
        hub, chunk, short = tile["hub"].to_numpy(), tile["chunk"].to_numpy(), tile["short"].to_numpy()
        low, high = tile["low"][0].as_py(), tile["high"][0].as_py()
        maps = tile["bitmap"].to_pylist()
        bits = np.array([8 * len(m) for m in maps])
        for size in np.unique(bits[short]):
            # A set fits one whose bitmap has as many bits or, being larger, twice as many.
            rows = np.flatnonzero((bits >= size) & (bits <= 4 * size))
            words = _folded([maps[i] for i in rows], int(size))
            for k in np.flatnonzero(short[rows] & (bits[rows] == size)):
                x = rows[k]
                fits = (n[rows] >= n[x]) & (n[rows] * num <= n[x] * den) & (part[rows] != part[x]) & (hub[rows] != cls[x])
                if low != high:
                    fits &= chunk[rows] != chunk[x]
                y = np.flatnonzero(fits)
                if len(y):
                    m = n[rows[y]].astype(np.int64)
                    apart = np.bitwise_count(words[y] ^ words[k]).sum(axis=1, dtype=np.int64)
                    close = 2 * needed(int(n[x]), m, num, den) <= int(n[x]) + m - apart
                    y = y[close]
                    if nearest and len(y):
                        y = y[np.argmin((apart / m)[close])][None]
                    yield from ((int(cls[x]), int(cls[rows[i]])) for i in y)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("low", "ascending"), ("high", "ascending"), ("n", "ascending")])
        key = [table[c].to_numpy() for c in ("grp", "low", "high")]
        new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)]))
        found: set[tuple[int, int]] = set()
        for first, last in zip(new, np.append(new[1:], table.num_rows)):
            found.update(pairs(table.slice(first, last - first)))
        return pa.table(
            {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
        )

    return run


class Tree:
    """A prefix tree of ascending shingle sequences; an edge holds a run of shingles."""

    __slots__ = ("run", "below", "ends", "most")

    def __init__(self, run: np.ndarray):
        self.run, self.below, self.ends, self.most = run, {}, [], 0

    def add(self, own: np.ndarray, name: int) -> None:
        node, at = self, 0
        while True:
            node.most = max(node.most, len(own) - at)
            if at == len(own):
                node.ends.append(name)
                return
            child = node.below.get(own[at])
            if child is None:
                child = node.below[own[at]] = Tree(own[at:])
                child.ends.append(name)
                return
            length = min(len(child.run), len(own) - at)
            differ = np.flatnonzero(child.run[:length] != own[at : at + length])
            same = int(differ[0]) if len(differ) else length
            if same < len(child.run):
                # Split the edge where the sequences part.
                upper = Tree(child.run[:same])
                upper.below[child.run[same]] = child
                upper.most = child.most + len(child.run) - same
                child.run = child.run[same:]
                node.below[own[at]] = upper
                child = upper
            node, at = child, at + same

    def linked(self, probe: np.ndarray, num: int, den: int) -> Iterator[int]:
        """Names of the stored sets that link with ``probe``; shared runs are compared once."""
        n = len(probe)
        stack = [(self, 0, 0, 0)]
        while stack:
            node, depth, overlap, passed = stack.pop()
            run = node.run
            if len(run):
                at = np.searchsorted(probe, run)
                overlap += int(np.count_nonzero(probe[np.minimum(at, n - 1)] == run))
                depth += len(run)
                passed = int(np.searchsorted(probe, run[-1], side="right"))
            # The subtree adds at most what is left of the probe, or of its longest set.
            best = overlap + min(n - passed, node.most)
            if best < needed(n, depth, num, den) or den * best < num * n:
                continue
            if node.ends and overlap >= needed(n, depth, num, den):
                yield from node.ends
            stack.extend((child, depth, overlap, passed) for child in node.below.values())


def _linked_in_block(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        probes, trees, found = {}, {}, []
        a, part, cls, data = (table[c].to_pylist() for c in ("a", "part", "cls", "data"))
        for hub, k, name, own in zip(a, part, cls, data):
            own = np.frombuffer(own, dtype=np.uint64)
            if name == hub:
                probes[hub, k] = own
            else:
                trees.setdefault((hub, k), Tree(own[:0])).add(own, name)
        for key, tree in trees.items():
            found.extend((key[0], name) for name in tree.linked(probes[key], num, den))
        return pa.table(
            {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
        )

    return run


def _in_filter(bits):
    def wanted(column):
        ids = column.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        place = kernel.mix(ids) & np.uint64(FILTER_BITS - 1)
        return pa.array((bits.value[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return wanted


def _filter_words(batches):
    for batch in batches:
        ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
        place = kernel.mix(ids) & np.uint64(FILTER_BITS - 1)
        word = (place >> np.uint64(5)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word), pa.array((np.uint64(1) << (place & np.uint64(31))).astype(np.int64))], names=["word", "bits"]
        )


def _whole_sets(width: int, bits):
    def run(batches):
        rows: list[tuple] = []
        for _, own in _sets(batches, width, _in_filter(bits)):
            if len(own):
                rows.append((class_hash(own), len(own), own.tobytes()))
            if len(rows) >= 512:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=["cls", "n", "data"]
                )
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=["cls", "n", "data"]
            )

    return run


def _links(texts: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that link; ``a`` is the side with many partners."""
    spark = texts.sparkSession
    own = classes.select("cls", "n", "bitmap", "doc")
    close = (
        pairs.join(own.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("bitmap").alias("bitmap_a")), "a")
        .join(own.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("bitmap").alias("bitmap_b")), "b")
        .mapInArrow(kernel.lean(_close_enough(num, den)), "a long, b long")
    )
    close = materialise_stage(close, "pairs")
    count = close.count()
    names = close.select(F.col("a").alias("cls")).unionAll(close.select(F.col("b").alias("cls"))).distinct()
    docs = names.join(own, "cls").select(F.col("doc").alias("doc_id"))
    bits = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    words = docs.mapInArrow(kernel.lean(_filter_words), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(bits.view(np.uint8))
    sets = texts.mapInArrow(kernel.lean(_whole_sets(width, shared)), SETS)
    # A hub with many members is dealt over several trees.
    load = close.groupBy("a").agg(F.expr(f"count(*) div {TREE} + 1").alias("parts"))
    dealt = close.join(load, "a").select("a", "b", F.expr("pmod(xxhash64(b), parts)").alias("part"))
    roles = dealt.select("a", "part", F.col("b").alias("cls")).unionAll(
        dealt.select("a", "part", F.col("a").alias("cls")).distinct()
    )
    blocks = max(1, count // (4 * TREE))
    found = (
        roles.join(sets, "cls")
        .select("a", "part", "cls", "data", F.pmod(F.xxhash64("a", "part"), F.lit(blocks)).alias("block"))
        .groupBy("block")
        .applyInArrow(kernel.lean_group(_linked_in_block(num, den)), "a long, b long")
    )
    links = materialise_stage(found, "links")
    shared.destroy()
    return links


def _between_components(members: DataFrame, classes: DataFrame, label: DataFrame, num: int, den: int, nearest: bool) -> DataFrame:
    """Pairs (a, b) of members of one group that lie in different components and may link.

    With ``nearest`` each member names only its likeliest partner, so a group gives no more pairs than it
    has members; those settle nearly all groups, and the last round names what is left.
    """
    named = materialise_stage(
        members.join(label.withColumnRenamed("node", "cls"), "cls", "left").select(
            "grp", "cls", "n", "short", "hub", F.coalesce("component", "cls").alias("component")
        ),
        "members",
    )
    # The only groups left are those whose classes lie in different components.
    split = named.groupBy("grp").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.expr(f"(count(*) - 1) div {TILE} + 1").alias("chunks")
    )
    own = F.pmod(F.xxhash64("cls"), F.col("chunks"))
    tiles = materialise_stage(
        named.join(split.where("a <> b").select("grp", "chunks"), "grp")
        .join(classes.select("cls", "bitmap"), "cls")
        .withColumn("chunk", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .drop("chunks", "other"),
        "members",
    )
    blocks = max(1, tiles.count() // (4 * TILE))
    return (
        tiles.withColumn("block", F.pmod(F.xxhash64("grp", "low", "high"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(kernel.lean_group(_open_pairs(num, den, nearest)), "a long, b long")
        .distinct()
    )


def row_name(text: str = "text") -> Column:
    """What tells rows apart: doc_id and text. Rows without doc_id, or with a repeated one, keep their own."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.col(text))


def linked_rows(
    docs: DataFrame, width: int = 5, num: int = 3, den: int = 4, text: str = "text", buckets: int | None = None
) -> DataFrame:
    """(row, doc_id, n_shingles, component) of each row: its ``row_name``, and a number for what links reach; null for an empty set."""
    spark = docs.sparkSession
    # Inside, a document is known by its row name alone.
    named = docs.select(row_name(text).alias("doc_id"), F.col("doc_id").cast("long").alias("own"), F.col(text).alias("text"))
    digests = materialise_stage(named.mapInArrow(kernel.lean(_digests(width)), DIGEST), "digests")
    texts = named.select("doc_id", "text")
    classes = materialise_stage(
        digests.where("cls is not null")
        .groupBy("cls")
        .agg(F.first("n").alias("n"), F.min("doc_id").alias("doc"), F.max("bitmap").alias("bitmap")),
        "classes",
    )
    total = classes.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = buckets or max(16, math.ceil(total / BUCKET))
    often = spark.sparkContext.broadcast(frequent_shingles(texts, width, buckets))
    members = materialise_stage(
        texts.mapInArrow(kernel.lean(_posting_segments(width, buckets, often, num, den)), PACKED)
        .groupBy("bucket")
        .applyInArrow(kernel.lean_group(_groups_in_bucket(num, den)), MEMBERS),
        "members",
    )
    often.destroy()
    hubs = members.where("hub <> 0").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    links = _links(texts, classes, hubs, width, num, den)
    label = components(links)
    tested = hubs
    for nearest in (True, True, False):
        rest = materialise_stage(_between_components(members, classes, label, num, den, nearest), "pairs")
        rest = rest.join(tested, ["a", "b"], "left_anti")
        if rest.isEmpty():
            continue
        more = _links(texts, classes, rest, width, num, den)
        links, tested = links.unionAll(more), tested.unionAll(rest)
        label = components(links)
    return digests.join(label.withColumnRenamed("node", "cls"), "cls", "left").select(
        F.col("doc_id").alias("row"), F.col("own").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "cls").alias("component")
    )


def jaccard_components(
    docs: DataFrame, width: int = 5, num: int = 3, den: int = 4, text: str = "text", buckets: int | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row: the least doc_id that links reach."""
    names = linked_rows(docs, width, num, den, text, buckets)
    least = names.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return names.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component: the one with the least doc_id (none comes last), then row name.

    Rows with equal doc_id and text are one row; rows without a word are linked with nothing and all stay.
    """
    rows = linked_rows(docs, **settings).where("component is not null")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("x"))
    keep = first.select(F.col("x.row").alias("__row"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Equal rows fall together before they are sent on, so copies without doc_id are no hot key.
    distinct = docs.where(worded).withColumn("__row", row_name()).dropDuplicates(["__row"])
    return distinct.join(keep, "__row", "left_semi").drop("__row").unionByName(docs.where(~worded))
