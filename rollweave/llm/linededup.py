"""Near-duplicate lines: deletion-neighbourhood join over words, keeping the earliest line.

A line is a run between ``\\n``; it is compared by its words (A-Z folded). A line with at least
``min_words`` words is dropped if an earlier line, in the order of (doc_id, line number), has the same
words, or, where both have at least ``near_words`` words, can be turned into it by one inserted, deleted
or replaced word. The comparison is with every earlier line, dropped or not, so the result depends on no
order of work.

Every variant of a line within the bound (the line, and the line without one of its words) becomes a
hashed key. Two lines one edit apart share a variant: the same place deleted in both (replacement), or
one line as it is and the other without a word. The earliest holder of each variant is a minimum, so no
pairs of a group are formed, however many lines share it. Hits are verified on the words themselves.

Lines that can have no partner emit no variants: of two lines one edit apart, the first or the last half
is untouched, so a line none of whose half keys occurs in another line is left out exactly.

A document is known by its doc_id and the hash of its text, so rows that share a doc_id, or have none, keep
lines of their own.

Defined cases: a null text has no lines and stays null; blank lines are kept unless ``drop_empty``
removes the whole document; rows with equal doc_id and text are one document and treated alike; documents
of one doc_id go by the hash of their text; a null doc_id comes last in the order; other columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rollweave.llm import kernel
from rollweave.session import materialise_stage

LAST = 2**63 - 1
LINES = "doc long, tid long, line int, n int, hash long, halves array<long>"
VARIANTS = "key long, place int, doc long, tid long, line int"
#: Lines before and after, and how many went as equal and as near lines.
COUNTS = ("_lines", "_left", "_equal", "_near")
TEXTS = "doc long, tid long, line int, words array<string>"
#: Documents whose wanted lines may be broadcast (about 64 bytes each); beyond it they are joined by shuffle.
BROADCAST_ROWS = 500_000


def _line_table(near_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tid"))
            for texts in kernel.blocks(batch.column("text")):
                found = kernel.words(texts, lower=True)
                start, first = kernel.lines(texts)
                line = np.searchsorted(start, found.start, side="right") - 1
                count = np.bincount(line, minlength=len(start))
                begin = np.cumsum(count) - count
                full = np.flatnonzero(count)
                n, begin = count[full], begin[full]
                row = np.searchsorted(first, full, side="right") - 1
                near = n >= near_words
                size = np.stack([(n - 1) // 2, (n - 2) // 2], axis=1)
                size[~near] = 0
                heads = _stretch(found.hash, begin, size)
                tails = _stretch(found.hash, begin[:, None] + n[:, None] - size, size)
                tails += np.uint64(1)
                keys = kernel.mix(np.concatenate([heads, tails], axis=1) + size[:, [0, 1, 0, 1]].astype(np.uint64))
                use = np.stack([near, near & (size[:, 0] != size[:, 1])] * 2, axis=1)
                lists = np.concatenate([[0], np.cumsum(use.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[texts.first + row], pa.int64()),
                        pa.array(tids[texts.first + row], pa.int64()),
                        pa.array((full - first[row]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(kernel.signed(kernel.sequence_hashes(found.hash, begin, n))),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(kernel.signed(keys[use]))),
                    ],
                    names=["doc", "tid", "line", "n", "hash", "halves"],
                )

    return run


def _stretch(hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of ``size`` words from ``begin``, from running sums of hashes times powers of an odd base.

    Powers wrap, and the base has an inverse, so a sum is moved to exponent zero by it.
    """
    if begin.ndim == 1:
        begin = np.broadcast_to(begin[:, None], size.shape)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * kernel.powers(len(hashes)) if len(hashes) else hashes, out=total[1:])
    return kernel.mix((total[begin + size] - total[begin]) * inverse_powers(len(hashes) + 1)[begin])


_inverse = np.ones(1, dtype=np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        table = np.full(max(n, 2 * len(_inverse)), pow(int(kernel.powers(2)[1]), -1, 2**64), dtype=np.uint64)
        table[0] = 1
        _inverse = np.cumprod(table, dtype=np.uint64)
    return _inverse[:n]


def _wanted(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, kernel.Texts, kernel.Words]]:
    """Of each wanted line: document (doc, tid), line number, and its words' place in the block."""
    docs = list(zip(batch.column("doc").to_pylist(), batch.column("tid").to_pylist()))
    wanted = batch.column("wanted").to_pylist()
    for texts in kernel.blocks(batch.column("text")):
        found = kernel.words(texts, lower=True)
        start, first = kernel.lines(texts)
        for i in range(len(texts)):
            for k in sorted(set(wanted[texts.first + i])):
                at = int(first[i]) + k
                if at >= first[i + 1]:
                    continue
                end = int(start[at + 1]) - 1 if at + 1 < first[i + 1] else int(texts.offsets[i + 1])
                a, b = np.searchsorted(found.start, [start[at], end])
                a = max(int(a), int(found.bounds[i]))
                b = min(int(b), int(found.bounds[i + 1]))
                yield docs[texts.first + i], k, texts, kernel.Words(
                    found.start[a:b], found.end[a:b], found.row[a:b], found.hash[a:b], np.array([a, b])
                )


def deletions(hashes: np.ndarray) -> np.ndarray:
    """Key of the sequence as it is, then of the sequence without each of its words in turn."""
    n = len(hashes)
    factor = kernel.factors(n)
    before = np.concatenate([[np.uint64(0)], np.cumsum(hashes * factor)]).astype(np.uint64)
    moved = np.concatenate([[np.uint64(0)], np.cumsum(hashes[1:] * factor[: n - 1])]).astype(np.uint64)
    without = before[:-1] + (moved[-1] - moved)
    return kernel.mix(np.concatenate([before[-1:] + np.uint64(n), without + np.uint64(n - 1)]))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, places, docs, lines, held = [], [], [], [], 0
        for doc, line, _, found in _wanted(batch):
            n = len(found.hash)
            keys.append(deletions(found.hash))
            places.append(np.arange(-1, n))
            docs.append(np.tile(np.array(doc, dtype=np.int64), (n + 1, 1)))
            lines.append(np.full(n + 1, line))
            held += n
            if held > 1 << 19:
                yield _variant_batch(keys, places, docs, lines)
                keys, places, docs, lines, held = [], [], [], [], 0
        if keys:
            yield _variant_batch(keys, places, docs, lines)


def _variant_batch(keys, places, docs, lines) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kernel.signed(np.concatenate(keys))),
            pa.array(np.concatenate(places).astype(np.int32)),
            *(pa.array(x, pa.int64()) for x in np.concatenate(docs).T),
            pa.array(np.concatenate(lines).astype(np.int32)),
        ],
        names=["key", "place", "doc", "tid", "line"],
    )


def _line_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (doc, line, [texts.bytes_of(a, b).translate(bytes(kernel.LOWER)).decode() for a, b in zip(f.start, f.end)])
            for doc, line, texts, f in _wanted(batch)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0][0] for x in rows], pa.int64()),
                pa.array([x[0][1] for x in rows], pa.int64()),
                pa.array([x[1] for x in rows], pa.int32()),
                pa.array([x[2] for x in rows], pa.list_(pa.string())),
            ],
            names=["doc", "tid", "line", "words"],
        )


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one inserted, deleted or replaced word, or none, turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("words").to_pylist(), batch.column("kept_words").to_pylist()
        yield batch.filter(pa.array([within_one(x, y) for x, y in zip(a, b)], pa.bool_())).drop_columns(
            ["words", "kept_words"]
        )


def _fetch(docs: DataFrame, lines: DataFrame, reader, schema: str) -> DataFrame:
    """``reader`` over the texts that hold the wanted ``lines`` (doc, tid, line)."""
    wanted = materialise_stage(lines.groupBy("doc", "tid").agg(F.collect_set("line").alias("wanted")), "lines")
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, ["doc", "tid"]).mapInArrow(kernel.lean(reader), schema)


def repeated_line_numbers(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """(doc, tid, line, near, kept_doc, kept_tid, kept_line): each line to drop and an earlier line that stands for it."""
    texts = docs.select(*_document(docs), "text")
    lines = materialise_stage(
        texts.mapInArrow(kernel.lean(_line_table(near_words)), LINES).where(F.col("n") >= min_words), "lines"
    )
    at = F.struct("doc", "tid", "line")
    first = materialise_stage(
        lines.groupBy("hash", "n").agg(
            F.min(at).alias("at"), F.max(at).alias("last"), F.first("halves").alias("halves")
        ),
        "lines",
    )
    halves = first.select("hash", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b").select("half")
    hopeful = halves.join(shared, "half", "left_semi").select("hash").distinct()
    near_first = first.where(F.size("halves") > 0).join(hopeful, "hash", "left_semi").select("at.*")
    variants = materialise_stage(_fetch(texts, near_first, _variants, VARIANTS), "variants")
    met = (
        variants.groupBy("key").agg(F.min(at).alias("a"), F.max(at).alias("b")).where("a <> b").select("key")
    )
    held = materialise_stage(variants.join(met, "key", "left_semi"), "variants")
    least = held.groupBy("key", "place").agg(F.min(at).alias("kept"))
    same = held.where("place >= 0").join(least, ["key", "place"])
    shorter = held.where("place >= 0").join(least.where("place < 0").drop("place"), "key")
    longer = held.where("place < 0").join(
        least.where("place >= 0").groupBy("key").agg(F.min("kept").alias("kept")), "key"
    )
    columns = [at.alias("at"), F.col("kept")]
    found = same.select(*columns).unionAll(shorter.select(*columns)).unionAll(longer.select(*columns)).where("kept < at")
    pairs = materialise_stage(found.distinct(), "pairs")
    both = pairs.select("at.*").unionAll(pairs.select("kept.*")).distinct()
    words = materialise_stage(_fetch(texts, both, _line_texts, TEXTS).dropDuplicates(["doc", "tid", "line"]), "words")
    checked = (
        pairs.join(words.select(at.alias("at"), "words"), "at")
        .join(words.select(at.alias("kept"), F.col("words").alias("kept_words")), "kept")
        .select("at", "kept", "words", "kept_words")
    )
    near = checked.mapInArrow(kernel.lean(_verified), pairs.select("at", "kept").schema).groupBy("at").agg(F.min("kept").alias("kept"))
    stand = (
        first.join(near, "at", "left")
        .where((F.col("kept").isNotNull()) | (F.col("at") != F.col("last")))
        .select("hash", "n", "at", F.col("kept").isNotNull().alias("near"), F.coalesce("kept", "at").alias("kept"))
    )
    return (
        lines.join(stand, ["hash", "n"])
        .where(at > F.col("kept"))
        .select(
            "doc",
            "tid",
            "line",
            # An equal earlier line goes before a near one.
            (F.col("near") & (at == F.col("at"))).alias("near"),
            F.when(at == F.col("at"), F.col("kept")).otherwise(F.col("at")).alias("kept"),
        )
        .select("doc", "tid", "line", "near", *[F.col(f"kept.{c}").alias(f"kept_{c}") for c in ("doc", "tid", "line")])
    )


def _document(docs: DataFrame) -> list:
    """What tells documents apart, and orders them."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("tid")]


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, drops = batch.column("text").to_pylist(), batch.column("__drop").to_pylist()
        out, lines, left, equal, near = [], [], [], [], []
        for text, drop in zip(texts, drops):
            own = [] if text is None else text.split("\n")
            lines.append(sum(1 for x in own if x.encode().strip()))
            gone = {x["line"] for x in drop or ()}
            near.append(sum(1 for x in drop or () if x["near"]))
            equal.append(len(gone) - near[-1])
            own = [x for i, x in enumerate(own) if i not in gone]
            left.append(sum(1 for x in own if x.encode().strip()))
            out.append(text if not gone else "\n".join(own))
        at = batch.schema.get_field_index("text")
        kept = batch.set_column(at, "text", pa.array(out, batch.schema.field("text").type)).drop_columns(["__drop"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, *(pa.array(x, pa.int64()) for x in (lines, left, equal, near))],
            names=[*kept.schema.names, *COUNTS],
        )


def line_dedup(docs: DataFrame, drop_empty: bool = False, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and the ``COUNTS`` of each row.

    ``drop_empty`` leaves out documents that had lines and lost them all.
    """
    drops = (
        repeated_line_numbers(docs, min_words, near_words)
        .groupBy(F.col("doc").alias("__doc"), F.col("tid").alias("__tid"))
        .agg(F.collect_set(F.struct("line", "near")).alias("__drop"))
    )
    doc, tid = _document(docs)
    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in COUNTS)])
    out = (
        docs.join(drops, (doc == F.col("__doc")) & (tid == F.col("__tid")), "left")
        .select(*[F.col(f"`{c}`") for c in docs.columns], "__drop")
        .mapInArrow(kernel.lean(_without), schema)
    )
    return out.where((F.col("_lines") == 0) | (F.col("_left") > 0)) if drop_empty else out
