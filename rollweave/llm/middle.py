"""Fill-in-the-middle: the parts of a text exchanged in place, and put back exactly.

Prefix, middle and suffix of a text lie in one bytearray in their own order, each behind its sentinel.
The two target orders are one rotation away from that: ``psm`` exchanges middle and suffix, ``spm`` takes
the suffix before both others. A rotation of a block is three reversals, done in place with a bounded
scratch buffer, so a very long text is held once. The restored text comes from the output and its form
alone: the sentinels are found, the rotation is undone and the sentinels are taken out. A text that holds
a sentinel stays plain, and no sentinel begins with its own end, so what is found is what was inserted.

Cuts and forms are drawn by DataFrame functions from the sha256 of ``seed:doc_id``; only the rotation
runs in Arrow batches, row by row in any partition: nothing is shuffled.

Defined cases: a null text is empty; an empty text is plain; a null doc_id draws from ``seed:`` and stays
null; repeated rows give equal outputs; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the format: the sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
#: Bytes that a reversal exchanges at a time.
SCRATCH = 1 << 16
#: Rows that one output batch holds, at most.
ROWS = 256

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def reverse(block: np.ndarray) -> None:
    """Reverse in place; both ends move inwards by at most ``SCRATCH`` bytes at a time."""
    low, high = 0, len(block)
    while high - low > 1:
        n = min(SCRATCH, (high - low) // 2)
        head = block[low : low + n].copy()
        block[low : low + n] = block[high - n : high][::-1]
        block[high - n : high] = head[::-1]
        low, high = low + n, high - n


def rotate(buffer: bytearray, start: int, split: int, end: int) -> None:
    """Exchange ``buffer[start:split]`` and ``buffer[split:end]`` by three reversals."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    reverse(view[start:split])
    reverse(view[split:end])
    reverse(view[start:end])


def byte_cuts(raw: bytes, chars: tuple[int, int]) -> tuple[int, int]:
    """Where the given numbers of code points end in UTF-8."""
    if raw.isascii():
        return chars
    heads = np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    first, second = (int(heads[k]) if k < len(heads) else len(raw) for k in chars)
    return first, second


def arrange(raw: bytes, form: str, prefix: int, middle: int) -> bytearray:
    """The output of ``raw``, whose prefix and middle have the given numbers of code points."""
    if form == "plain":
        return bytearray(raw)
    a, b = byte_cuts(raw, (prefix, prefix + middle))
    out = bytearray(len(raw) + 3 * MARK)
    a_out, b_out = a + MARK, b + 2 * MARK
    out[:MARK], out[MARK:a_out] = PREFIX, raw[:a]
    out[a_out : a_out + MARK], out[a_out + MARK : b_out] = MIDDLE, raw[a:b]
    out[b_out : b_out + MARK], out[b_out + MARK :] = SUFFIX, raw[b:]
    rotate(out, a_out if form == "psm" else 0, b_out, len(out))
    return out


def restore(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` turned into ``output``."""
    if form == "plain":
        return bytes(output)
    buffer = bytearray(output)
    suffix, middle = buffer.find(SUFFIX), buffer.find(MIDDLE)
    if form == "psm":
        # prefix | suffix, middle: exchange the last two.
        rotate(buffer, suffix, middle, len(buffer))
    else:
        # suffix | prefix, middle: the suffix goes behind both.
        rotate(buffer, 0, buffer.find(PREFIX), len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.find(mark)
        del buffer[at : at + MARK]
    return bytes(buffer)


def _mapped(change, names: list[str], target: str):
    """Arrow batches with a new last column, in pieces of few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                columns = [batch.column(x).cast(pa.binary()).to_pylist() if x in ("text", "output") else batch.column(x).to_pylist() for x in names]
                made = pa.array([bytes(change(*row)) for row in zip(*columns)], pa.binary()).cast(pa.string())
                kept = [x for x in batch.schema.names if x != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), made], names=[*kept, target])

    return run


def draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four 32 bit numbers of the hex sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, share: int = 90, spm_share: int = 20) -> DataFrame:
    """Each document's output with its form and cuts (``SCHEMA``); ``share`` and ``spm_share`` in per cent."""
    text = F.coalesce("text", F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    n = F.char_length("text").cast("long")
    low, high = F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark.decode()))
    plain = (n == 0) | marked | (h3 % 100 >= share)
    form = F.when(plain, "plain").when(h4 % 100 < spm_share, "spm").otherwise("psm")
    drawn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        n.alias("n"),
        form.alias("form"),
        F.when(~plain, low).alias("prefix_chars"),
        F.when(~plain, high - low).alias("middle_chars"),
        "text",
    )
    return drawn.mapInArrow(_mapped(arrange, ["text", "form", "prefix_chars", "middle_chars"], "output"), SCHEMA)


def restored(outputs: DataFrame) -> DataFrame:
    """``outputs`` of ``fill_in_middle`` with the text rebuilt from output and form alone."""
    return outputs.select(*[f.split()[0] for f in SCHEMA.split(", ")]).mapInArrow(
        _mapped(restore, ["output", "form"], "restored"), f"{SCHEMA}, restored string"
    )


def digests(docs: DataFrame) -> DataFrame:
    """Hashes of every output and of the text restored from it."""
    hashed = {x: F.sha2(F.col(x).cast("binary"), 256) for x in ("output", "restored")}
    return restored(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", *[h.alias(f"{x}_sha256") for x, h in hashed.items()]
    )
