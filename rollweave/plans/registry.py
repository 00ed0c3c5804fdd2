"""Registered queries: each is one operator over the standard tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from rollweave.session import scratch_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TEXTS = ("documents", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows round the cores when the input has fewer splits than cores.

    Text rules are bound by CPU, and a small file is one split; with many splits, as on any
    large table, the plan stays a plain scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class Tables:
    """Lazy access to the tables of one scale factor."""

    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return spread(self.spark.read.parquet(f"{self.root}/{name}.parquet")) if name in TEXTS else self.plain(name)

    def plain(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


@dataclass(frozen=True)
class Check:
    name: str
    survey: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, survey: str, sql: str | None = None):
    """Register a query under ``name`` with the inventory rows it covers."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(name, survey, fn, sql)
        return fn

    return register


def _run(spec: Check, spark: SparkSession, root: str) -> DataFrame:
    return spec.run(Tables(spark, root))


def load() -> dict[str, Check]:
    """Import every query module once and return the registry."""
    from rollweave.plans import load_all

    load_all()
    return CHECKS


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, spec) for name, spec in load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: spec.sql for name, spec in load().items() if spec.sql}
