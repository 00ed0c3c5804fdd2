"""Token ids of documents as framed binary records, with an offset index for reads in any order.

A file is a run of records. A record is

    length of the payload   unsigned 64 bit, little endian
    its masked checksum     unsigned 32 bit
    payload
    its masked checksum     unsigned 32 bit
    one newline byte

The payload is a flag byte (1: the document has no id), a byte with the width of an id (2 or 4), the
doc_id (signed 64 bit) and the ids, all little endian. Checksums are CRC-32; masking rotates them right by
15 bits and adds 0xa282ead8, so that a checksum of data that holds checksums stays useful. The closing
newline lets Spark's own text writer put the bytes on any store with its commit protocol: a task that is
tried again leaves no second copy. Readers go by lengths and never look for newlines.

Files follow the order of doc_id: rows are range partitioned by (doc_id, place in the input), so one
repeated doc_id is split too, and sorted in each partition.

Defined cases: a null text is empty and yields the end id alone; a null doc_id comes first in the order;
repeated rows yield repeated records; other columns are ignored; an empty table yields no record.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollweave.llm.fasttokens import encoder
from rollweave.session import scratch_path

#: Bytes of text that go into one file, about.
FILE_BYTES = 24 << 20
MASK = 0xA282EAD8
INDEX = "part int, record int, position long, size long, doc_id long, n_tokens long, before long, ids_crc32 long"
RECORDS = "doc_id long, ids array<int>"


class BrokenRecord(ValueError):
    """A checksum or a length does not hold."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc: int | None, ids: np.ndarray) -> bytes:
    """A record but for its closing newline, which the writer adds."""
    wide = len(ids) and int(ids.max()) > 0xFFFF
    payload = struct.pack("<BBq", doc is None, 4 if wide else 2, doc or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def parse(data: bytes, position: int) -> tuple[int | None, np.ndarray, int]:
    """The record at ``position``: doc_id, ids, and where the next one starts."""
    head = data[position : position + 12]
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise BrokenRecord(f"length at byte {position}")
    end = position + 12 + struct.unpack("<Q", head[:8])[0]
    payload, tail = data[position + 12 : end], data[end : end + 5]
    if len(tail) < 5 or tail[4:] != b"\n" or struct.unpack("<I", tail[:4])[0] != masked(payload):
        raise BrokenRecord(f"payload at byte {position}")
    empty, width, doc = struct.unpack("<BBq", payload[:10])
    return None if empty else doc, np.frombuffer(payload, dtype=f"<u{width}", offset=10), end + 5


def _framed(vocabulary: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary, spaced=False)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                frames = [
                    frame(doc, np.append(own, np.uint32(end)))
                    for doc, own in zip(batch.column("doc_id").to_pylist(), tool.ids(batch.column("text")))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    return run


def write_records(docs: DataFrame, path: str, vocabulary: str, end: int) -> None:
    """Write ``docs`` (doc_id, text) as record files below ``path`` in ascending order of doc_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    files = max(1, math.ceil(size / FILE_BYTES))
    placed = texts.withColumn("place", F.monotonically_increasing_id())
    (
        placed.repartitionByRange(files, "doc_id", "place")
        .sortWithinPartitions("doc_id", "place")
        .select("doc_id", "text")
        .mapInArrow(_framed(vocabulary, end), "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("compression", "none")
        .text(path)
    )


def _part(path: str) -> int:
    return int(re.search(r"part-(\d+)", path.rsplit("/", 1)[-1])[1])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            data, part = batch.column("content")[k].as_buffer().to_pybytes(), _part(batch.column("path")[k].as_py())
            rows, at, before = [], 0, 0
            while at < len(data):
                doc, ids, after = parse(data, at)
                rows.append((part, len(rows), at, after - at, doc, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                before += len(ids)
                at = after
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int32() if c < 2 else pa.int64()) for c, x in enumerate(zip(*rows))],
                    names=[x.split()[0] for x in INDEX.split(", ")],
                )


def record_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_index(spark: SparkSession, path: str, index: str) -> DataFrame:
    """Read the record files below ``path``, check every checksum, and write where each record is.

    ``before`` counts ids of earlier records in its file.
    """
    record_files(spark, path).mapInArrow(_indexed, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: ids of all records before it. The sum runs over files, not records."""
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = files.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return index.join(base, "part").withColumn("start", F.col("base") + F.col("before"))


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            data = batch.column("content")[k].as_buffer().to_pybytes()
            rows = [parse(data, at)[:2] for at in batch.column("positions")[k].as_py()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in rows], pa.int64()), pa.array([y.astype(np.int32) for _, y in rows], pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )


def read_records(spark: SparkSession, path: str, index: DataFrame, seed: int | None = None) -> DataFrame:
    """(doc_id, ids) of the records that ``index`` lists; with ``seed`` in an order drawn by it."""
    wanted = index.groupBy("part").agg(F.collect_list("position").alias("positions"))
    part = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"part-(\d+)", 1).cast("int")
    rows = record_files(spark, path).withColumn("part", part).join(wanted, "part").select("content", "positions")
    out = rows.mapInArrow(_picked, RECORDS)
    return out if seed is None else out.orderBy(F.xxhash64(F.lit(seed), "doc_id", "ids"))


def record_digests(docs: DataFrame, vocabulary: str | None = None, end: int = 2) -> DataFrame:
    """Write ``docs`` as records, index them, and return what the files hold of each document."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    path = scratch_path(spark, "records")
    write_records(docs, path, vocabulary, end)
    index = write_index(spark, path, scratch_path(spark, "records_index"))
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "position", "size")
