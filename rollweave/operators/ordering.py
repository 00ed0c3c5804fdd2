"""Deterministic order, running sums and row numbers without a single-task sort.

Rows are put into a few thousand buckets by a monotone function of the sort key.  One
map-side combined aggregate gives the total of each bucket, the (bounded) bucket table is
prefix-summed, and the window that remains only spans one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollweave.session import materialise_stage

HASH_BUCKETS = 4096
#: Rows of one range of an ordered table, about.
BUCKET_ROWS = 1 << 17


def md5_key(seed: int | str, *cols: str | Column) -> Column:
    """``md5(seed:key)``, the reproducible stand-in for a seeded random draw."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_bucket(hashed: Column) -> Column:
    """Leading 12 bits of a hex digest: monotone in the digest, evenly filled."""
    return F.conv(F.substring(hashed, 1, 3), 16, 10).cast("int")


def md5_mod(hashed: Column, n: int) -> Column:
    """Digest modulo ``n`` from its leading 28 bits."""
    return (F.conv(F.substring(hashed, 1, 7), 16, 10).cast("long") % F.lit(n)).cast("int")


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], bounded: bool = False) -> DataFrame:
    """Left join of group statistics on null-safe keys.

    ``bounded`` marks a side whose row count is fixed by construction; only then is it
    broadcast.  Otherwise the join is left to adaptive execution, which splits hot keys.
    """
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    right = stats.withColumnsRenamed(names)
    if bounded:
        right = F.broadcast(right)
    condition = F.lit(True)
    for key, renamed in names.items():
        condition = condition & F.col(key).eqNullSafe(F.col(renamed))
    return df.join(right, condition, "left").drop(*names.values())


def running(
    df: DataFrame,
    order: Sequence[str | Column],
    bucket: Column,
    within: Sequence[str] = (),
    **measures: Column,
) -> DataFrame:
    """Inclusive running sums along ``order``, per ``within`` group or over the whole table.

    ``bucket`` must be monotone in ``order``.  A group of any size is spread over the
    buckets, so no task ever holds a whole hot group.
    """
    within = list(within)
    tagged = df.withColumn("__b", bucket).withColumns({f"__m_{n}": m for n, m in measures.items()})
    totals = tagged.groupBy(*within, "__b").agg(*[F.sum(f"__m_{n}").alias(f"__s_{n}") for n in measures])
    before = Window.partitionBy(*within).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *within,
        "__b",
        *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in measures],
    )
    joined = attach(tagged, offsets, [*within, "__b"], bounded=not within)
    local = Window.partitionBy(*within, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = {n: F.col(f"__o_{n}") + F.sum(f"__m_{n}").over(local) for n in measures}
    return joined.withColumns(summed).drop("__b", *[f"__{p}_{n}" for p in "mo" for n in measures])


def hash_rank(
    df: DataFrame, key: str, seed: int | str, within: Sequence[str] = (), out: str = "rank"
) -> DataFrame:
    """1-based position in the seeded shuffle, over the table or inside each group."""
    hashed = df.withColumn("__h", md5_key(seed, key))
    ranked = running(hashed, ["__h", key], hash_bucket(F.col("__h")), within, **{out: F.lit(1)})
    return ranked.withColumn(out, F.col(out).cast("long")).drop("__h")


def ranged(df: DataFrame, order: Sequence[str | Column], rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` cut into ranges of about ``rows`` rows along ``order``: ``__part`` and the place ``__local`` in it.

    Keys may be of any type that Spark orders, and several; nulls come first. Split points are sampled by
    Spark's range exchange on the keys themselves. The row's place in the input is the last key, so a range
    may end inside equal keys and one hot key fills many ranges. The result is stored: places are drawn once.
    """
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    keys = [*(k.asc_nulls_first() for k in keys), F.col("__salt")]
    parts = max(1, -(-df.count() // rows))
    # Also for one range: what makes the rows keeps its own tasks.
    numbered = salted.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__salt").withColumn("__at", F.monotonically_increasing_id())
    split = numbered.withColumns({"__part": F.shiftright("__at", 33).cast("int"), "__local": F.col("__at").bitwiseAND((1 << 33) - 1)})
    return materialise_stage(split.drop("__at"), "ranged")


def _offsets(parts: DataFrame, **measures: Column) -> DataFrame:
    """Sums of all ranges before each range; one row for each range."""
    totals = parts.groupBy("__part").agg(*[F.sum(m).alias(n) for n, m in measures.items()])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in measures])


def as_keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def row_index(df: DataFrame, key: str | Sequence[str], start: int = 0, out: str = "index") -> DataFrame:
    """Consecutive row number in the order of a key of any type, or of several; null keys come first.

    Equal keys are numbered in the order of the input, which is arbitrary; give a unique key.
    """
    return numbered(ranged(df, as_keys(key)), start, out)


def numbered(parts: DataFrame, start: int = 0, out: str = "index") -> DataFrame:
    """The rows of ``ranged`` with their number in its order."""
    placed = attach(parts, _offsets(parts, __before=F.lit(1)), ["__part"], bounded=True)
    return placed.withColumn(out, (F.col("__before") + F.col("__local") + start).cast("long")).drop("__part", "__local", "__before")


def running_by_key(df: DataFrame, key: str | Sequence[str], **measures: Column) -> DataFrame:
    """Inclusive running sums over the whole table in the order of a unique key."""
    parts = ranged(df, as_keys(key))
    return running(parts, ["__local"], F.col("__part"), **measures).drop("__part", "__local")


def value_rank(df: DataFrame, value: str, key: str | Sequence[str], out: str = "rank") -> DataFrame:
    """1-based position by (value, digest of the key, key); one value may fill many ranges."""
    keys = as_keys(key)
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    return row_index(df.withColumn("__h", digest), [value, "__h", *keys], start=1, out=out).drop("__h")


def first_hash_rows(df: DataFrame, key: str, seed: int | str, groups: Sequence[str], quota: DataFrame) -> DataFrame:
    """First ``quota`` rows of each group in seeded order, ranking only one bucket per group.

    ``quota`` holds the group columns, ``quota`` and any payload; its rows are the entries of
    a mixing configuration and therefore few.  Rows below the cut bucket pass without a
    shuffle; only the rows of the cut bucket (about 1/4096 of a group) are ranked.
    """
    groups = list(groups)
    tagged = df.withColumn("__h", md5_key(seed, key)).withColumn("__b", hash_bucket(F.col("__h")))
    upto = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        tagged.groupBy(*groups, "__b")
        .agg(F.count("*").alias("__n"))
        .withColumn("__upto", F.sum("__n").over(upto))
        .join(F.broadcast(quota), groups)
    )
    whole = F.col("__upto") <= F.col("quota")
    cut = ~whole & (F.col("__upto") - F.col("__n") < F.col("quota"))
    edges = filled.groupBy(*groups).agg(
        F.coalesce(F.max(F.when(whole, F.col("__b"))), F.lit(-1)).alias("__whole"),
        F.max(F.when(cut, F.col("__b"))).alias("__cut"),
        F.max(F.when(cut, F.col("quota") - F.col("__upto") + F.col("__n"))).alias("__need"),
    )
    marked = tagged.join(F.broadcast(edges), groups)
    passed = marked.where(F.col("__b") <= F.col("__whole"))
    rank = Window.partitionBy(*groups).orderBy("__h", key)
    edge = (
        marked.where(F.col("__b") == F.col("__cut"))
        .withColumn("__rn", F.row_number().over(rank))
        .where(F.col("__rn") <= F.col("__need"))
        .drop("__rn")
    )
    return passed.unionByName(edge).drop("__h", "__b", "__whole", "__cut", "__need")
