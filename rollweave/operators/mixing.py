"""Mixing, sampling and set operations."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.operators.messages import first_match
from rollweave.operators.ordering import first_hash_rows, hash_rank, md5_key, row_index
from rollweave.sources.publish import build_table

CACHE_VERSION = "v6"


# --- C1 ------------------------------------------------------------------------------------


def parse_mixer(entries: list[str]) -> dict[str, int | float]:
    """``[name, amount, ...]``; an amount with a point is a proportion, without one a count."""
    if len(entries) % 2:
        raise ValueError(f"mixer list length is not even: {entries}")
    pairs = zip(entries[::2], entries[1::2])
    return {name: float(amount) if "." in amount else int(amount) for name, amount in pairs}


def suspicious_counts(sizes: DataFrame, amounts: dict[str, int | float], source: str = "source", size: str = "n") -> DataFrame:
    """Sources whose count of at most 10 looks like a proportion written without a point."""
    few = [name for name, amount in amounts.items() if isinstance(amount, int) and amount <= 10]
    return sizes.where(F.col(source).isin(few) & (F.col(size) > 100))


def check_amounts(amounts: dict[str, int | float]) -> None:
    if any(a < 0 for a in amounts.values()):
        raise ValueError("mixing amounts cannot be negative")


def _amount(amounts: dict[str, int | float], source: Column, rule) -> Column:
    return first_match([(source == n, rule(a).cast("long")) for n, a in amounts.items()], F.lit(None).cast("long"))


def _quota(df: DataFrame, source: str, amounts: dict[str, int | float], rule) -> DataFrame:
    """Rows to take per configured source; one row per mixer entry."""
    sizes = df.where(F.col(source).isin(list(amounts))).groupBy(source).agg(F.count("*").alias("n"))
    return sizes.withColumn("quota", _amount(amounts, F.col(source), lambda a: rule(a, F.col("n"))))


# --- C2-C4 ---------------------------------------------------------------------------------


def resize(df: DataFrame, amounts: dict[str, int | float], key: str, seed: int = 42, source: str = "source") -> DataFrame:
    """Each source to its target size.

    ``target // n`` full copies plus ``target % n`` rows drawn without replacement; an integer
    is a row count, a float a proportion.  Copies come from a map-side explode, the draw ranks
    one hash bucket per source.  ``copy`` numbers the copies, ``is_upsampled`` marks growth.
    """
    check_amounts(amounts)
    target = lambda a, n: F.lit(a) if isinstance(a, int) else F.floor(F.lit(a) * n)
    sizes = _quota(df, source, amounts, target).withColumnRenamed("quota", "target")
    plan = sizes.select(
        source,
        F.floor(F.col("target") / F.col("n")).alias("repeats"),
        (F.col("target") % F.col("n")).alias("quota"),
        (F.col("target") > F.col("n")).alias("is_upsampled"),
    )
    known = df.where(F.col(source).isin(list(amounts)))
    flags = F.broadcast(plan.select(source, "repeats", "is_upsampled"))
    full = known.join(flags, source).where("repeats > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "repeats")))
    extra = first_hash_rows(known, key, seed, [source], plan.select(source, "quota")).join(flags, source)
    extra = extra.withColumn("copy", F.col("repeats") + 1)
    return full.unionByName(extra).drop("repeats")


def mix(df: DataFrame, amounts: dict[str, int | float], key: str, seed: int = 42, source: str = "source", split: str | None = None) -> DataFrame:
    """Head of the shuffled source; test splits pass whole.

    When any amount exceeds 1 all must be integer counts, else all are fractions.
    """
    check_amounts(amounts)
    counts = any(a > 1 for a in amounts.values())
    if counts and not all(isinstance(a, int) for a in amounts.values()):
        raise NotImplementedError("cannot mix fractions and counts")
    rule = lambda a, n: F.lit(a) if counts else F.floor(F.lit(float(a)) * n)
    known = df.where(F.col(source).isin(list(amounts)))
    if split is None:
        return _take(known, amounts, key, seed, source, rule)
    train = known.where(F.col(split).contains("train"))
    test = known.where(~F.col(split).contains("train"))
    return _take(train, amounts, key, seed, source, rule).unionByName(test)


def combine(df: DataFrame, amounts: dict[str, int | float], key: str, seed: int = 42, source: str = "source") -> DataFrame:
    """C4: above 1 a count, else a fraction, so both 1 and 1.0 mean everything."""
    check_amounts(amounts)
    rule = lambda a, n: F.lit(int(a)) if a > 1 else F.floor(F.lit(float(a)) * n)
    return _take(df.where(F.col(source).isin(list(amounts))), amounts, key, seed, source, rule)


def _take(df: DataFrame, amounts, key: str, seed: int, source: str, rule) -> DataFrame:
    quota = _quota(df, source, amounts, rule).select(source, "quota")
    return first_hash_rows(df, key, seed, [source], quota)


# --- C5-C10 --------------------------------------------------------------------------------


def concat(*tables: DataFrame) -> DataFrame:
    """Bag union over the common columns."""
    common = [c for c in tables[0].columns if all(c in t.columns for t in tables)]
    out = tables[0].select(*common)
    for table in tables[1:]:
        out = out.unionByName(table.select(*common))
    return out


def shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Seeded global order (a range sort on the digest)."""
    return df.orderBy(md5_key(seed, key), key)


def limit_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first rows in key order (a top-k, not a sort)."""
    return df.orderBy(key).limit(n)


def slice_rows(df: DataFrame, key: str | list[str], start: int, end: int) -> DataFrame:
    """Positional range ``[start, end)`` in the order of a key of any type, or of several; null keys first."""
    return row_index(df, key).where((F.col("index") >= start) & (F.col("index") < end))


def preview(df: DataFrame, key: str, n: int = 3, seed: int = 42) -> DataFrame:
    """A few random rows to look at."""
    return df.orderBy(md5_key(seed, key), key).limit(n)


def filter_sources(df: DataFrame, names: list[str], source: str = "source") -> DataFrame:
    """Membership filter, pushed to the scan."""
    return df.where(F.col(source).isin(names))


def epoch_order(df: DataFrame, key: str, seed: int, epoch: int, excluded: DataFrame | None = None) -> DataFrame:
    """This epoch's permutation after exclusions; ``prompt_id`` is ``epoch_key``."""
    left = df if excluded is None else df.join(excluded.select(key), key, "left_anti")
    ranked = hash_rank(left, key, seed + epoch, out="position").withColumn("position", F.col("position") - 1)
    return ranked.withColumn("prompt_id", F.concat_ws("_", F.lit(str(epoch)), F.col(key).cast("string")))


def shard_batches(df: DataFrame, position: str, batch_size: int, world: int, drop_last: bool = True) -> DataFrame:
    """Global batches cut in order and dealt round the workers by place in the batch.

    ``position`` is a dense 0-based order.  The last partial batch is dropped or filled up by
    repeating the first rows, as often as needed.
    """
    if batch_size % world:
        raise ValueError("batch size must be a multiple of the number of workers")
    total = df.agg(F.count("*").alias("__total"))
    sized = df.crossJoin(F.broadcast(total))
    place = F.col(position)
    rest = F.col("__total") % batch_size
    if drop_last:
        out = sized.where(place < F.col("__total") - rest).withColumn("is_padding", F.lit(False))
    else:
        missing = F.when(rest > 0, batch_size - rest).otherwise(F.lit(0))
        repeats = F.when(place < missing, F.floor((missing - 1 - place) / F.col("__total")) + 1).otherwise(F.lit(0))
        copies = sized.withColumn("__copy", F.explode(F.sequence(F.lit(0), repeats.cast("long"))))
        out = copies.withColumn("is_padding", F.col("__copy") > 0).withColumn(
            position, F.when(F.col("__copy") > 0, F.col("__total") + F.col(position) + (F.col("__copy") - 1) * F.col("__total")).otherwise(F.col(position))
        ).drop("__copy")
    inside = F.col(position) % batch_size
    return out.withColumns(
        {"batch": F.floor(F.col(position) / batch_size).cast("long"), "worker": (inside % world).cast("int"), "slot": F.floor(inside / world).cast("int")}
    ).drop("__total")


# --- C11-C14 -------------------------------------------------------------------------------


def mix_statistics(before: DataFrame, after: DataFrame, requested: DataFrame, source: str = "dataset_source") -> DataFrame:
    """C11: per source sizes, filtered count, up-sampling factor and token totals.

    ``requested`` has one row per source: ``requested`` and ``original_size``.
    """
    initial = before.groupBy(source).agg(F.count("*").alias("initial_instances"))
    measures = [F.count("*").alias("final_instances")]
    if "input_ids" in after.columns:
        measures += [
            F.sum(F.size("input_ids")).alias("total_tokens"),
            F.sum(F.size(F.filter("labels", lambda x: x != -100))).alias("trainable_tokens"),
        ]
    stats = requested.join(initial, source, "left").join(after.groupBy(source).agg(*measures), source, "left")
    filled = stats.na.fill(0, [c for c in stats.columns if c not in (source, "requested")])
    out = filled.withColumns(
        {
            "instances_filtered": F.col("initial_instances") - F.col("final_instances"),
            "is_upsampled": F.col("initial_instances") > F.col("original_size"),
            "upsampling_factor": F.when(F.col("original_size") > 0, F.col("initial_instances") / F.col("original_size")).otherwise(F.lit(1.0)),
        }
    )
    if "total_tokens" in out.columns:
        average = F.when(F.col("final_instances") > 0, F.col("total_tokens") / F.col("final_instances")).otherwise(F.lit(0.0))
        out = out.withColumn("avg_tokens_per_instance", average)
    return out


def filter_report(before: DataFrame, after: DataFrame, split: str = "split") -> DataFrame:
    """Filtered rows and percent per split."""
    left = before.groupBy(split).agg(F.count("*").alias("before"))
    right = after.groupBy(split).agg(F.count("*").alias("after"))
    joined = left.join(right, split, "left").na.fill(0, ["after"])
    filtered = F.col("before") - F.col("after")
    return joined.withColumns({"filtered": filtered, "percent": F.when(F.col("before") > 0, filtered * 100.0 / F.col("before")).otherwise(F.lit(0.0))})


def config_hash(config: dict, version: str = CACHE_VERSION) -> str:
    """Ten hex digits over the non-null settings and the cache version."""
    settings = {k: v for k, v in config.items() if v is not None}
    text = json.dumps({"cache_version": version, **settings}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:10]


def step_fingerprint(previous: str, step: str, args: dict, version: str = CACHE_VERSION) -> str:
    """Sixteen hex digits chained on the fingerprint of the step before."""
    text = ":".join([version, step, previous, json.dumps(args, sort_keys=True)])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def reference_cache_hash(settings: dict) -> str:
    """Key of the stored reference values."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]


def materialise(spark: SparkSession, root: str, config: dict, build, skip_cache: bool = False) -> DataFrame:
    """The table of a configuration, built once and found again by its hash; a build that died is no obstacle."""
    return build() if skip_cache else build_table(spark, root, config_hash(config), build, config=config)


def require_rows(df: DataFrame) -> DataFrame:
    """C14: error on an empty result; stops at the first row found."""
    if df.isEmpty():
        raise ValueError("no rows left after the transformation")
    return df
