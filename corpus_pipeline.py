"""The corpus pipeline: quality rules, line dedup, near-duplicate documents, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but
the last return the columns of ``documents``. ``run`` applies them to ``documents``; each stage's result is
written to the shared folder and read again by the next. Packing has no SQL form, so ``ORACLE_SQL`` is None
and the pipeline is tested stage by stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.bestfit import pack_documents
from rollweave.llm.jaccard import one_of_each
from rollweave.llm.linededup import line_dedup
from rollweave.llm.quality import apply_quality
from rollweave.llm.tiling import decontaminate
from rollweave.session import bound_batches, materialise_stage


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text it counts."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def _bounded(stage):
    """``stage`` with Arrow batches of a bounded size, also where it is called by itself."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@_bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, without the lines their host repeats.

    Rows are judged by host and text; equal rows are judged alike, and a row without doc_id as any other.
    """
    return _sized(apply_quality(docs))


@_bounded
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in an earlier place; those that lose all their lines go.

    Rows with equal doc_id and text are one document; all others have lines of their own.
    """
    return _sized(line_dedup(docs, drop_empty=True).select(*docs.columns))


@_bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join: the one with the least doc_id, rows without one last.

    Rows with equal doc_id and text are one document; different texts of one doc_id, or without a doc_id, are
    documents of their own. Rows without a word are linked with nothing and stay.
    """
    return one_of_each(docs).select(*docs.columns)


@_bounded
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by its own text, whatever its doc_id."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise_stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
