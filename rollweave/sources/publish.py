"""Tables that appear whole or not at all.

A writer puts its rows into a folder of its own and then publishes a small record that names the folder: the
record is written beside its final place and renamed, so a reader finds a complete record or none. A writer
that dies leaves a folder that nothing names, and the next one starts anew; of two writers of one table the
last record stands, and both folders hold the same rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, path: str, record: dict) -> None:
    """Make ``record`` the content of ``path``."""
    draft, files = _filesystem(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(record, sort_keys=True), "utf-8"))
    out.close()
    final, _ = _filesystem(spark, path)
    if not files.rename(draft, final):
        # Where a rename replaces nothing, another writer was first and its record stands.
        files.delete(draft, False)
        if not files.exists(final):
            raise OSError(f"could not publish {path}")


def read_record(spark: SparkSession, path: str) -> dict | None:
    """The record at ``path``, or nothing."""
    place, files = _filesystem(spark, path)
    if not files.exists(place):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The published names in a folder; drafts are not."""
    place, files = _filesystem(spark, folder)
    if not files.exists(place):
        return []
    names = (s.getPath().getName() for s in files.listStatus(place))
    return sorted(n for n in names if not n.endswith((".draft", ".crc")))


def published_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table ``name``, if it was published."""
    record = read_record(spark, f"{root}/{name}.json")
    return None if record is None else spark.read.parquet(f"{root}/{record['folder']}")


def build_table(spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame], **facts) -> DataFrame:
    """The table ``name``, built and published if it is not there."""
    found = published_table(spark, root, name)
    if found is None:
        folder = f"{name}-{uuid.uuid4().hex}"
        build().write.mode("errorifexists").parquet(f"{root}/{folder}")
        publish(spark, f"{root}/{name}.json", {"folder": folder, **facts})
        found = published_table(spark, root, name)
    return found
