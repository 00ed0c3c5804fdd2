"""Language identification by nearest centroid.

A text becomes a vector of hashed byte trigrams (A-Z folded, every other ASCII sign a space), weighted by
log(1 + count) times the inverse document frequency over all training documents, of length one. Each
language has several centroids, found by spherical k-means on a bounded sample of its training documents.
A text gets the language of the nearest centroid by cosine. If the cosine is below what nearly all of the
centroid's own members reach, the text is marked as rejected: it lies too far from every known language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a language that is null
teaches nothing; a null doc_id neither teaches nor is held out; ties go to the language first in order;
without training documents every text is ``und``; repeated rows get equal results; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollweave.llm import kernel
from rollweave.session import materialise_stage

SIZE = 1 << 13
#: Training documents of one language that its centroids are fitted on, at most.
SAMPLE = 600
CENTROIDS = 4
#: Share of a centroid's members that its rejection bound lets out.
OUTER = 0.01
UNKNOWN = "und"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"

_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[65:91] += 32
_SIGN[[x for x in range(128) if not chr(x).isalpha()]] = 32


def counts(texts: kernel.Texts) -> Iterator[np.ndarray]:
    """Counts of hashed trigrams of each row; a space stands before and behind every text."""
    signs = _SIGN[texts.data].astype(np.uint32)
    for i in range(len(texts)):
        own = np.full(texts.offsets[i + 1] - texts.offsets[i] + 2, 32, dtype=np.uint32)
        own[1:-1] = signs[texts.offsets[i] : texts.offsets[i + 1]]
        gram = own[:-2] << np.uint32(16) | own[1:-1] << np.uint32(8) | own[2:]
        # Runs of spaces say nothing.
        gram = gram[gram & np.uint32(0xFFFF) != np.uint32(0x2020)]
        yield np.bincount((gram * np.uint32(2654435761)) >> np.uint32(32 - 13), minlength=SIZE)


def vectors(column: pa.Array, idf: np.ndarray, most: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix of unit vectors) for up to ``most`` rows at a time."""
    for texts in kernel.blocks(column):
        rows: list[np.ndarray] = []
        first = texts.first
        for own in counts(texts):
            rows.append(np.log1p(own.astype(np.float32)))
            if len(rows) == most:
                yield first, _unit(np.stack(rows) * idf)
                first, rows = first + most, []
        if rows:
            yield first, _unit(np.stack(rows) * idf)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, docs = np.zeros(SIZE, dtype=np.int64), 0
    for batch in batches:
        docs += batch.num_rows
        for texts in kernel.blocks(batch.column("text")):
            for own in counts(texts):
                found += own > 0
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, SIZE), pa.int64()), pa.array(np.concatenate([[docs], found]))], names=["gram", "n"]
    )


def centroids(points: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit vectors and the least cosine of each; far points seed the next centroid."""
    centres = _unit(points.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(points)):
        near = (points @ centres.T).max(axis=1)
        if near.min() > 1 - 1e-6:
            break
        # A seed at the lower quarter, not an outlier.
        centres = np.vstack([centres, points[np.argsort(near, kind="stable")[len(near) // 4]]])
    for _ in range(rounds):
        own = (points @ centres.T).argmax(axis=1)
        centres = _unit(np.stack([points[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))]))
    cosine = points @ centres.T
    own, best = cosine.argmax(axis=1), cosine.max(axis=1)
    bound = [float(np.quantile(best[own == c], OUTER)) if (own == c).any() else 1.0 for c in range(len(centres))]
    return centres, np.array(bound)


def _fitted(idf: np.ndarray, k: int):
    def run(table: pa.Table) -> pa.Table:
        column = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])["text"].combine_chunks()
        column = column if isinstance(column, pa.Array) else column.chunk(0)
        centres, bound = centroids(np.vstack([x for _, x in vectors(column, idf)]), k)
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * len(centres), pa.string()),
                "centre": pa.array([c.astype(np.float32).tobytes() for c in centres], pa.binary()),
                "bound": pa.array(bound),
            }
        )

    return run


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, names, centres, bounds = shared.value
        for batch in batches:
            known = batch.column("letters").to_numpy(zero_copy_only=False)
            best, score = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            if len(names):
                for first, x in vectors(batch.column("text"), idf):
                    cosine = x @ centres.T
                    best[first : first + len(x)] = cosine.argmax(axis=1)
                    score[first : first + len(x)] = cosine.max(axis=1)
            known = known & bool(len(names))
            score = np.where(known, np.clip(score, 0, 1), 0)
            lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            far = ~known | (score < (bounds[best] if len(names) else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(far)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return run


def fit(train: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> tuple:
    """Document frequencies over all of ``train`` (doc_id, text, lang), centroids on its sample."""
    grams = train.select("text").mapInArrow(_document_frequency, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = np.zeros(SIZE + 1, dtype=np.float64)
    for row in grams.collect():
        found[row["gram"] + 1] = row["n"]
    idf = (np.log((1 + found[0]) / (1 + found[1:])) + 1).astype(np.float32)
    # One row for each language comes back; the bounds go into the scan, so few texts of any language move.
    most = {r["lang"]: 2.0 * sample * (1 << 30) / r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    bounds = F.create_map(*[F.lit(x) for pair in sorted(most.items()) for x in pair]) if most else F.create_map().cast("map<string,double>")
    drawn = train.select("doc_id", "text", "lang", draw.alias("draw")).where(F.col("draw") <= F.element_at(bounds, F.col("lang")))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    rows = materialise_stage(
        chosen.select("doc_id", "text", "lang").groupBy("lang").applyInArrow(_fitted(idf, k), "lang string, centre binary, bound double"),
        "centroids",
    )
    rows = sorted(rows.collect(), key=lambda r: (r["lang"], r["centre"]))
    centres = np.stack([np.frombuffer(r["centre"], dtype=np.float32) for r in rows]) if rows else np.zeros((0, SIZE), np.float32)
    return idf, [r["lang"] for r in rows], centres, np.array([r["bound"] for r in rows])


def identify(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected); documents with crc32(doc_id) mod 4 = 2 are held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.col("lang").cast("string").alias("lang"),
        held.alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    train = own.where("not held_out and doc_id is not null and lang is not null and letters").select("doc_id", "text", "lang")
    shared = docs.sparkSession.sparkContext.broadcast(fit(train, sample, k))
    return own.select("doc_id", "text", "held_out", "letters").mapInArrow(_predicted(shared), PREDICTED)
