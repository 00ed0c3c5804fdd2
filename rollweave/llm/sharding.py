"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard has ``vnodes`` points on a ring of 32 bit positions. A row's key is hashed onto the ring and
belongs to the next point clockwise; that shard is its home. A shard takes at most its share of the rows:
the shares of all shards differ by one at most and add up to all rows, so the law is ``rows``. Rows at home
go first, in ring order; those that a full shard cannot take walk on clockwise, in ring order, to the first
point whose shard has room. So the rows that leave home are no more than the overflow of the full shards.

What is computed about the ring is bounded by ``shards * vnodes``, whatever the input: counts of the arcs
between points, the walk of the overflow (a fold over twice that many points), and the resulting pieces of
arcs, which are broadcast. Rows are shuffled twice, as digests without their text: once to count equal
rows (combined before the shuffle), once to be ranked within a bucket of an arc. A key that holds a third
of all rows is counted first and split into chunks, which fall into different buckets.

Defined cases: a null text has size 1 and checksum 0; null keys share one place on the ring; repeated rows
take neighbouring slots as far as a chunk goes; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollweave.session import materialise_stage

RING_BITS = 32
SEGMENT_BITS = 8
#: Rank buckets of one arc; with 1,024 arcs a bucket of 10^11 rows has about 1.5 million.
BUCKETS = 64
#: Equal rows that stay together.
CHUNK = 1000


def ring(docs: DataFrame, shards: int, vnodes: int) -> DataFrame:
    """(arc, shard, point) in ring order; an arc ends at its point. As many rows as there are points."""
    points = docs.sparkSession.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.xxhash64(F.lit("point"), F.col("id") % shards, F.floor(F.col("id") / shards)).bitwiseAND(F.lit((1 << RING_BITS) - 1)).alias("point"),
    )
    return points.withColumn("arc", F.row_number().over(Window.orderBy("point", "shard")) - 1)


def segments(points: DataFrame) -> DataFrame:
    """(segment, points, before) for each of 256 parts of the ring: its points, and how many come before."""
    spark = points.sparkSession
    own = points.groupBy(F.shiftright("point", RING_BITS - SEGMENT_BITS).cast("int").alias("segment")).agg(
        F.sort_array(F.collect_list("point")).alias("points")
    )
    every = spark.range(1 << SEGMENT_BITS).select(F.col("id").cast("int").alias("segment"))
    count = F.size("points")
    return (
        every.join(own, "segment", "left")
        .withColumn("points", F.coalesce("points", F.array().cast("array<bigint>")))
        .withColumn("before", F.sum(count).over(Window.orderBy("segment")) - count)
    )


def placed(docs: DataFrame, points: DataFrame, arcs: int) -> DataFrame:
    """Chunks of equal rows with their arc and rank bucket."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    digest = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"))
    equal = digest.groupBy("doc_id", "size", "crc").agg(F.count("*").alias("copies"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {CHUNK}"))).alias("chunk")
    position = F.xxhash64(F.lit("key"), F.col("doc_id")).bitwiseAND(F.lit((1 << RING_BITS) - 1))
    rows = equal.select("*", chunk, position.alias("position")).withColumn(
        "segment", F.shiftright("position", RING_BITS - SEGMENT_BITS).cast("int")
    )
    behind = F.size(F.filter("points", lambda p: p < F.col("position")))
    return rows.join(F.broadcast(segments(points)), "segment").select(
        "doc_id",
        "size",
        "crc",
        "chunk",
        F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK).alias("n"),
        ((F.col("before") + behind) % arcs).cast("int").alias("arc"),
        F.pmod(F.xxhash64("doc_id", "size", "crc", "chunk"), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )


def pieces(points: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """(arc, low, high, shard, slot): ranks ``low .. high - 1`` of an arc go to a shard from a slot on."""
    every = Window.partitionBy()
    by_shard, along = Window.partitionBy("shard"), Window.partitionBy("shard").orderBy("arc")
    home = (
        points.join(counts, "arc", "left")
        .withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
        .withColumn("total", F.sum("n").over(every))
        .withColumn("room", F.expr(f"total div {shards}") + (F.col("shard") < F.col("total") % shards).cast("long"))
        .withColumn("before", F.sum("n").over(along) - F.col("n"))
        .withColumn("own", F.greatest(F.lit(0).cast("long"), F.least("n", F.col("room") - F.col("before"))))
        .withColumn("at_home", F.sum("own").over(by_shard))
        .withColumn("over", F.col("n") - F.col("own"))
    )
    settled = home.where("own > 0").select("arc", F.lit(0).cast("long").alias("low"), F.col("own").alias("high"), "shard", F.col("before").alias("slot"))

    # The walk: each point takes what its shard has room for out of the overflow that has come so far.
    whole = home.agg(
        F.sort_array(F.collect_list(F.struct("arc", "shard", "over"))).alias("stops"),
        F.transform(
            F.sort_array(F.collect_set(F.struct("shard", "room", "at_home"))), lambda x: x["room"] - x["at_home"]
        ).alias("spare"),
    )
    none = F.array().cast("array<struct<shard:int,start:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0).cast("long").alias("taken"), F.col("spare"), none.alias("takes"))

    def step(state, stop):
        carry = state["carry"] + stop["over"]
        take = F.least(carry, F.get(state["spare"], stop["shard"]))
        taken = F.struct(stop["shard"].alias("shard"), state["taken"].alias("start"))
        return F.struct(
            (carry - take).alias("carry"),
            (state["taken"] + take).alias("taken"),
            F.transform(state["spare"], lambda room, i: F.when(i == stop["shard"], room - take).otherwise(room)).alias("spare"),
            F.when(take > 0, F.concat(state["takes"], F.array(taken))).otherwise(state["takes"]).alias("takes"),
        )

    second = F.transform("stops", lambda x: F.struct(x["arc"].alias("arc"), x["shard"].alias("shard"), F.lit(0).cast("long").alias("over")))
    takes = whole.select(F.explode(F.aggregate(F.concat("stops", second), start, step)["takes"]).alias("t")).select(
        F.col("t.start").alias("start"), F.col("t.shard").alias("taker"), F.lit(None).cast("int").alias("arc"), F.lit(None).cast("long").alias("own")
    )
    # Overflow is numbered in ring order; arcs and takes both cut that line.
    in_order = Window.orderBy("arc")
    sources = home.where("over > 0").select(
        (F.sum("over").over(in_order) - F.col("over")).alias("start"), F.lit(None).cast("int").alias("taker"), "arc", "own"
    )
    end = home.agg(F.sum("over").alias("start")).where("start > 0")
    line = Window.orderBy("start")
    cuts = (
        sources.unionByName(takes)
        .unionByName(end, allowMissingColumns=True)
        .groupBy("start")
        .agg(F.max("taker").alias("taker"), F.max("arc").alias("arc"), F.max("own").alias("own"))
    )
    moved = (
        cuts.select(
            "start",
            F.lead("start").over(line).alias("stop"),
            F.last("taker", ignorenulls=True).over(line).alias("shard"),
            F.last("arc", ignorenulls=True).over(line).alias("arc"),
            F.last("own", ignorenulls=True).over(line).alias("own"),
            F.last(F.when(F.col("arc").isNotNull(), F.col("start")), ignorenulls=True).over(line).alias("arc_start"),
        )
        .where("stop is not null")
        .withColumn("n", F.col("stop") - F.col("start"))
        .withColumn("filled", F.sum("n").over(Window.partitionBy("shard").orderBy("start")) - F.col("n"))
        .join(home.select("shard", "at_home").distinct(), "shard")
    )
    low = F.col("own") + F.col("start") - F.col("arc_start")
    return settled.unionByName(
        moved.select("arc", low.alias("low"), (low + F.col("n")).alias("high"), "shard", (F.col("at_home") + F.col("filled")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = 8, vnodes: int = 128) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard) of each row of ``docs``."""
    points = ring(docs, shards, vnodes)
    rows = materialise_stage(placed(docs, points, shards * vnodes), "placed")
    buckets = rows.groupBy("arc", "bucket").agg(F.sum("n").alias("rows"))
    counts = buckets.groupBy("arc").agg(F.sum("rows").alias("n"))
    spots = materialise_stage(pieces(points, counts, shards), "pieces")
    along = Window.partitionBy("arc").orderBy("bucket")
    offsets = buckets.select("arc", "bucket", (F.sum("rows").over(along) - F.col("rows")).alias("base"))
    order = Window.partitionBy("arc", "bucket").orderBy("doc_id", "size", "crc", "chunk")
    ranked = (
        rows.withColumn("rank", F.sum("n").over(order) - F.col("n"))
        .join(offsets, ["arc", "bucket"])
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"))
        .withColumn("rank", F.col("base") + F.col("rank") + F.col("k"))
    )
    fits = (F.col("r.arc") == F.col("p.arc")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    # At most a piece for each point at home and two for each overflow cut.
    found = ranked.alias("r").join(F.broadcast(spots).alias("p"), fits)
    homes = points.select("arc", F.col("shard").alias("home_shard"))
    return (
        found.select("r.arc", "doc_id", "size", "crc", "p.shard", (F.col("slot") + F.col("rank") - F.col("low")).alias("slot"))
        .join(F.broadcast(homes), "arc")
        .select(
            "doc_id",
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
            "home_shard",
        )
    )
