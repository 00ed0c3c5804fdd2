"""Quality rules: base counts of each text, and lines that too many documents of one host share.

Lines are normalised (A-Z folded, white space collapsed) and hashed. For each host, the documents that
hold a line are counted, equal texts once; a line in more than ``max(min_docs, cube root of the host's
documents)`` of them is boilerplate and is removed. The limit hardly grows with the host (1,000 for 10^9
documents), so a line in one per cent of a host is found whatever the host's size. A document that loses so much that fewer than
``min_words`` words or less than ``min_left`` of its words remain is rejected.

Defined cases: a null text has no words and fails the base rules; an empty line or a line without a
word is never counted; a null host is a host of its own; repeated rows get equal verdicts; other columns
are ignored by ``quality_rules`` and kept by ``apply_quality``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.llm import kernel
from rollweave.session import materialise_stage

WINDOW = 8
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))

STATS = (
    "doc_id long, host string, tid long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, line array<long>, line_words array<long>"
)


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    found = kernel.windows(hashes, width)
    _, inverse, counts = np.unique(found, return_inverse=True, return_counts=True)
    if len(counts) == len(found):
        return 0
    marks = np.zeros(len(hashes) + 1, dtype=np.int64)
    again = np.flatnonzero(counts[inverse] > 1)
    np.add.at(marks, again, 1)
    np.add.at(marks, again + width, -1)
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    own = [x for x in text.split(b"\n") if x.strip()]
    return len(own) - len(set(own))


def line_hashes(texts: kernel.Texts, found: kernel.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and words of each line, the first line of each row, and the starts of lines."""
    start, first = kernel.lines(texts)
    line = np.searchsorted(start, found.start, side="right") - 1
    count = np.bincount(line, minlength=len(start))
    return kernel.sequence_hashes(found.hash, np.cumsum(count) - count, count), count, first, start


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in kernel.blocks(batch.column("text")):
            found = kernel.words(texts)
            rows = len(texts)
            lead = ((texts.data & 0xC0) != 0x80) & ~kernel.SPACE[texts.data]
            repeats = [repeated_words(found.hash[found.bounds[i] : found.bounds[i + 1]]) for i in range(rows)]
            doubles = [repeated_lines(texts.bytes_of(texts.offsets[i], texts.offsets[i + 1])) for i in range(rows)]
            hashes, count, first, _ = line_hashes(texts, kernel.words(texts, lower=True))
            full = count > 0
            lists = pa.array(np.concatenate([[0], np.cumsum(full)])[first].astype(np.int32))
            own = batch.slice(texts.first, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    own.column("doc_id"),
                    own.column("host"),
                    own.column("tid"),
                    pa.array(np.diff(found.bounds)),
                    pa.array(_sums(lead, texts.offsets)),
                    pa.array(_sums(SYMBOLS[texts.data], texts.offsets)),
                    pa.array(doubles, pa.int64()),
                    pa.array(repeats, pa.int64()),
                    pa.ListArray.from_arrays(lists, pa.array(kernel.signed(hashes[full]))),
                    pa.ListArray.from_arrays(lists, pa.array(count[full])),
                ],
                names=[x.split()[0] for x in STATS.split(", ")],
            )


def host_key(host: str) -> Column:
    """The host as a key that is never null."""
    return F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("none"))


def keyed(docs: DataFrame, host: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", host_key(host).alias("host"), F.xxhash64("text").alias("tid")
    )


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    min_docs: int = 20,
    min_words: int = 10,
    min_left: float = 0.3,
) -> DataFrame:
    """Verdict of each document with its base counts and the hashes of its frequent lines.

    Counting is a distinct of (host, line, text) and a count above it, both combined before the
    shuffle, so a hot host or line is a partial sum in each task.
    """
    stats = materialise_stage(keyed(docs, host).mapInArrow(kernel.lean(_statistics), STATS), "quality")
    held = (
        stats.select("host", "tid", F.explode(F.arrays_zip("line", "line_words")).alias("x"))
        .groupBy("host", "tid", F.col("x.line").alias("line"), F.col("x.line_words").alias("words"))
        .agg(F.count("*").alias("rows"))
    )
    # Repeated rows of one text hold each line as often; what counts is the text.
    copies = stats.groupBy("host", "tid").agg(F.count("*").alias("copies"))
    limits = copies.groupBy("host").agg(
        F.greatest(F.lit(float(min_docs)), F.cbrt(F.count("*").cast("double"))).alias("most")
    )
    often = (
        held.groupBy("host", "line", "words").agg(F.count("*").alias("docs")).join(limits, "host").where("docs > most")
    )
    lost = (
        held.join(often.select("host", "line", "words"), ["host", "line", "words"])
        .join(copies, ["host", "tid"])
        .groupBy("host", "tid")
        .agg(
            F.sum(F.col("words") * F.expr("rows div copies")).alias("lost_words"),
            F.collect_set("line").alias("frequent"),
        )
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost_words", F.lit(0))
    fine = (F.coalesce("lost_words", F.lit(0)) == 0) | ((left >= min_words) & (left >= F.col("n_words") * F.lit(min_left)))
    return stats.drop("line", "line_words").join(lost, ["host", "tid"], "left").select(
        "doc_id",
        "host",
        "tid",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & fine).alias("kept"),
        F.coalesce("lost_words", F.lit(0)).alias("lost_words"),
        "frequent",
    )


def _stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        frequent = batch.column("__frequent").to_pylist()
        out: list[str | None] = []
        for texts in kernel.blocks(batch.column("text")):
            hashes, count, first, start = line_hashes(texts, kernel.words(texts, lower=True))
            for i in range(len(texts)):
                drop = frequent[texts.first + i]
                if not drop:
                    out.append(batch.column("text")[texts.first + i].as_py())
                    continue
                a, b = int(first[i]), int(first[i + 1])
                gone = np.isin(kernel.signed(hashes[a:b]), np.array(drop)) & (count[a:b] > 0)
                ends = [*(start[a + 1 : b] - 1), texts.offsets[i + 1]]
                out.append(
                    b"\n".join(texts.bytes_of(start[a + k], ends[k]) for k in range(b - a) if not gone[k]).decode()
                )
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(out, batch.schema.field("text").type)).drop_columns(["__frequent"])


def apply_quality(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that the rules keep, without their frequent lines; all columns of ``docs`` stay."""
    keep = quality_rules(docs, host, **limits).where("kept").select(
        F.col("doc_id").alias("__doc"), F.col("host").alias("__host"), F.col("tid").alias("__tid"), F.col("frequent").alias("__frequent")
    ).dropDuplicates(["__doc", "__host", "__tid"])
    joined = docs.join(
        keep,
        F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (host_key(host) == F.col("__host")) & (F.xxhash64("text") == F.col("__tid")),
    ).select(*[F.col(f"`{c}`") for c in docs.columns], "__frequent")
    return joined.mapInArrow(kernel.lean(_stripped), docs.schema)
