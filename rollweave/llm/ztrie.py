"""Prefix trie of conversations, built as a z-fast trie by joins.

A conversation is a sequence of turns; the prefix of ``d`` turns is known by a 128 bit hash, so all texts
stay where they are. The trie is compacted: a node stands for the longest prefix (its extent) that all
its members share, and its edge covers the depths from its parent's extent to its own. Each node lies in a
table under its handle: the prefix of its extent at the 2-fattest depth of the edge.

Conversations come in batches, equal ones as one class. A batch finds the exit node of each of its classes
by fat binary search: each round is one equi-join of (depth, hash) with the handles, and halves the depths
that are left. Then the edges that classes leave in their middle are split, and the tails that are new
become nodes, where a conversation ends or two tails part. At the end every edge is expanded to one node
for each depth.

Sums over a subtree need no walk: a class counts in each node on its own path, and the bytes of an edge
belong to one class, the one with the node's smallest conversation. So each is a sum over (class, node on
its path), combined before the shuffle; a hot prefix is a partial sum in each task. A class joins nodes and
handles by hash; adaptive execution splits a hot handle. The ids that end at a node are sorted by range,
which cuts a hot node anywhere, joined to texts in each range, and only these texts go through one hash.

Defined cases: a null role or text is empty; a null turn comes first; turns of equal number go by the md5 of
role and text; rows without conv_id belong to no conversation and are left out; a repeated row is a turn of
its own; other columns are ignored; an empty table has no conversation and gives no node, not even a root.
A conversation is one row of hashes (24 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollweave.llm import kernel
from rollweave.session import materialise_stage

#: Share of the classes in each batch; the first finds an empty trie.
BATCHES = (0.25, 0.75)
#: Ids that one text of sorted ids holds, at most.
RUN = 1 << 16

PATHS = "conv_id long, n int, hi array<long>, lo array<long>, size array<long>, last_hi long, last_lo long"
KEY = ["len", "hi", "lo"]
NODE = ["len", "hi", "lo", "top", "up_hi", "up_lo", "e_hi", "e_lo", "e_size"]


# --- sequences ------------------------------------------------------------------------------


def rebuilt(turns: DataFrame, group: int = 5, shared: int = 9) -> DataFrame:
    """Every conversation with its first turns taken from the first conversation of its group.

    ``crc32(conv_id) % shared`` turns are taken; gives (conv_id, turns), a turn being (md5, bytes).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(key).alias("key"), F.octet_length(text).alias("size")).alias("x"),
    )
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns"))
    head = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head"), F.slice("turns", 1, shared - 1).alias("lent")
    )
    own = own.withColumn("head", F.col("conv_id") - F.col("conv_id") % group)
    n = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    lent = F.slice(F.coalesce("lent", F.slice("turns", 1, 0)), F.lit(1), n)
    rest = F.slice("turns", n + 1, F.size("turns"))
    return own.join(head, "head", "left").select("conv_id", F.concat(lent, rest).alias("turns"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running hashes: at each depth the sum of all turns so far, each mixed with its place."""
    for batch in batches:
        turns = batch.column("turns")
        flat, bounds = turns.flatten(), np.concatenate([[0], np.cumsum(turns.value_lengths().to_numpy())])
        n = np.diff(bounds)
        raw = b"".join(flat.field("key").to_pylist())
        keys = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
        place = kernel.mix((np.arange(bounds[-1]) - np.repeat(bounds[:-1], n) + 1).astype(np.uint64))
        columns, last = [], []
        for values in (kernel.mix(keys[:, 0] + place), kernel.mix(kernel.mix(keys[:, 1]) ^ place), flat.field("size").to_numpy().astype(np.uint64)):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            own = total[1:] - np.repeat(total[bounds[:-1]], n)
            columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(kernel.signed(own))))
            last.append(pa.array(kernel.signed(total[bounds[1:]] - total[bounds[:-1]])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(n.astype(np.int32)), *columns, *last[:2]], names=[x.split()[0] for x in PATHS.split(", ")]
        )


def prefix_hashes(sequences: DataFrame) -> DataFrame:
    """``PATHS``: of each conversation, hash and bytes of its prefixes by depth."""
    return sequences.select("conv_id", "turns").mapInArrow(_hashed, PATHS)


# --- the z-fast trie ------------------------------------------------------------------------


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that is divisible by the largest power of two."""
    return F.expr(f"shiftleft(shiftright({high}, cast(floor(log2({low} ^ {high})) as int)), cast(floor(log2({low} ^ {high})) as int))")


def handles(nodes: DataFrame) -> DataFrame:
    """Nodes with the depth and hash of their handle and the hash of their first turn's prefix."""
    at = fattest("top", "len")
    return nodes.select(
        *NODE,
        at.alias("fat"),
        F.element_at("e_hi", at - F.col("top")).alias("fat_hi"),
        F.element_at("e_lo", at - F.col("top")).alias("fat_lo"),
        F.get("e_hi", F.lit(0)).alias("first_hi"),
        F.get("e_lo", F.lit(0)).alias("first_lo"),
    )


def _common(top: Column, length: Column) -> Column:
    """Depth to which a class and the edge of node ``w`` agree, given that they agree at ``top + 1`` at least."""
    depths = F.sequence(F.lit(1), F.least(F.col("n"), length) - top)
    same = F.filter(
        depths,
        lambda j: (F.element_at("hi", top + j) == F.element_at("w.e_hi", j)) & (F.element_at("lo", top + j) == F.element_at("w.e_lo", j)),
    )
    return top + F.size(same)


def locate(classes: DataFrame, trie: DataFrame, deepest: int) -> DataFrame:
    """The exit of each class: ``depth`` that it shares with the trie, and its node ``w`` if that is inside an edge.

    ``low`` is the deepest extent known to be a prefix of the class, ``high`` the depth from which no
    handle on its path is left.
    """
    nodes = trie.select(F.struct(*trie.columns).alias("w"))
    found = classes.withColumns({"low": F.lit(0), "high": F.col("n"), "inside": F.lit(None).cast("struct<len:int,hi:long,lo:long>")})
    own = [F.col(c) for c in classes.columns]
    for _ in range(deepest.bit_length() + 1):
        probe = found.withColumn("at", F.when(F.col("low") < F.col("high"), fattest("low", "high")))
        met = probe.join(
            nodes,
            (F.col("at") == F.col("w.fat"))
            & (F.get("hi", F.col("at") - 1) == F.col("w.fat_hi"))
            & (F.get("lo", F.col("at") - 1) == F.col("w.fat_lo")),
            "left",
        )
        length, top = F.col("w.len"), F.col("w.top")
        # A prefix of the class as long as the extent, with the extent's hash: the node is on its path.
        passed = (F.get("hi", length - 1) == F.col("w.hi")) & (F.get("lo", length - 1) == F.col("w.lo"))
        shared = _common(top, length)
        exits = F.col("w").isNotNull() & ~F.coalesce(passed, F.lit(False))
        found = met.select(
            *own,
            F.when(exits, shared).when(F.col("w").isNotNull(), length).otherwise(F.col("low")).alias("low"),
            F.when(exits, shared).when(F.col("w").isNull() & F.col("at").isNotNull(), F.col("at") - 1).otherwise(F.col("high")).alias("high"),
            F.when(exits, F.struct(length.alias("len"), F.col("w.hi").alias("hi"), F.col("w.lo").alias("lo"))).otherwise(F.col("inside")).alias("inside"),
        )
    # The exit node may have its handle below the exit: it is the child of the last extent that shares the next turn.
    met = found.join(
        nodes,
        F.col("inside").isNull()
        & (F.col("low") == F.col("w.top"))
        & (F.get("hi", F.col("low")) == F.col("w.first_hi"))
        & (F.get("lo", F.col("low")) == F.col("w.first_lo")),
        "left",
    )
    child = F.struct(F.col("w.len").alias("len"), F.col("w.hi").alias("hi"), F.col("w.lo").alias("lo"))
    return met.select(
        *own,
        F.when(F.col("w").isNotNull(), _common(F.col("w.top"), F.col("w.len"))).otherwise(F.col("low")).alias("depth"),
        F.when(F.col("w").isNotNull(), child).otherwise(F.col("inside")).alias("inside"),
    )


def _edges(cuts: str) -> Column:
    """(top, len) of the pieces between ascending depths."""
    return F.expr(f"transform(sequence(1, size({cuts}) - 1), i -> struct(get({cuts}, i - 1) as top, get({cuts}, i) as len))")


def _piece(base: Column, hi: str, lo: str, up: bool) -> list[Column]:
    """The node of piece ``e`` of arrays that begin behind depth ``base``."""
    top, length = F.col("e.top"), F.col("e.len")
    return [
        length.alias("len"),
        F.element_at(hi, length - base).alias("hi"),
        F.element_at(lo, length - base).alias("lo"),
        top.alias("top"),
        F.coalesce(F.get(hi, top - base - 1), F.col("up_hi") if up else F.lit(0)).cast("long").alias("up_hi"),
        F.coalesce(F.get(lo, top - base - 1), F.col("up_lo") if up else F.lit(0)).cast("long").alias("up_lo"),
        F.slice(hi, top - base + 1, length - top).alias("e_hi"),
        F.slice(lo, top - base + 1, length - top).alias("e_lo"),
    ]


def split(nodes: DataFrame, exits: DataFrame) -> DataFrame:
    """Nodes whose edges end at every depth where a class leaves or ends inside them."""
    cuts = exits.where(F.col("inside").isNotNull()).select("inside.*", "depth").groupBy(*KEY).agg(F.collect_set("depth").alias("cuts"))
    joined = nodes.select(*NODE).join(cuts, KEY, "left").withColumn(
        "cuts", F.sort_array(F.array_distinct(F.concat(F.array("top", "len"), F.coalesce("cuts", F.array().cast("array<int>")))))
    )
    pieces = joined.withColumnsRenamed({"top": "base", "len": "whole"}).select("*", F.explode(_edges("cuts")).alias("e"))
    base = F.col("base")
    return pieces.select(
        *_piece(base, "e_hi", "e_lo", True), F.slice("e_size", F.col("e.top") - base + 1, F.col("e.len") - F.col("e.top")).alias("e_size")
    )


def tails(exits: DataFrame) -> DataFrame:
    """Nodes of the parts of classes below their exits: where one ends, or two part."""
    deep = F.sequence(F.col("depth") + 1, F.col("n"))
    steps = exits.where("depth < n").select("conv", "n", "hi", "lo", F.explode(deep).alias("len")).select(
        "conv",
        "len",
        F.element_at("hi", F.col("len")).alias("p_hi"),
        F.element_at("lo", F.col("len")).alias("p_lo"),
        F.get("hi", F.col("len")).alias("c_hi"),
        F.get("lo", F.col("len")).alias("c_lo"),
    )
    # A path that ends has no next prefix: one distinct null.
    kinds = steps.select("len", "p_hi", "p_lo", "c_hi", "c_lo").distinct().groupBy("len", "p_hi", "p_lo").agg(
        F.count("*").alias("ways"), F.count("c_hi").alias("on")
    )
    stops = kinds.where("ways > 1 or on < ways").select("len", "p_hi", "p_lo")
    cuts = steps.join(stops, ["len", "p_hi", "p_lo"]).groupBy("conv").agg(F.collect_list("len").alias("cuts"))
    pieces = exits.join(cuts, "conv").withColumn("cuts", F.sort_array(F.concat(F.array("depth"), "cuts")))
    made = pieces.select("conv", "hi", "lo", "size", F.explode(_edges("cuts")).alias("e")).select(
        "conv",
        *_piece(F.lit(0), "hi", "lo", False),
        F.expr("transform(sequence(e.top + 1, e.len), d -> get(size, d - 1) - coalesce(get(size, d - 2), 0))").alias("e_size"),
    )
    # Many classes run along one edge; any of them tells it.
    rest = [c for c in NODE if c not in KEY]
    return made.groupBy(*KEY).agg(F.min_by(F.struct(*rest), "conv").alias("x")).select(*KEY, "x.*")


def build(classes: DataFrame, batches: tuple[float, ...] = BATCHES) -> DataFrame:
    """The nodes of the compacted trie of all classes, but for the root."""
    deepest = classes.agg(F.max("n")).first()[0] or 0
    draw, done, trie = F.pmod(F.xxhash64("conv"), F.lit(1 << 20)) / (1 << 20), 0.0, None
    for k, share in enumerate(batches):
        last = k == len(batches) - 1
        batch = classes.where((draw >= done) & (F.lit(last) | (draw < done + share)))
        done += share
        if trie is None:
            exits = batch.select("*", F.lit(0).alias("depth"), F.lit(None).cast("struct<len:int,hi:long,lo:long>").alias("inside"))
            nodes = tails(exits)
        else:
            exits = materialise_stage(locate(batch, trie, deepest), "exits")
            nodes = split(trie, exits).unionByName(tails(exits))
        trie = materialise_stage(handles(nodes), "trie")
    return trie.select(*NODE)


# --- what the nodes report ------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) rows as texts of joined ids, a bounded number of ids in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in (*KEY, "conv_id")]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
        starts = np.unique(np.concatenate([[0], edges, np.arange(0, batch.num_rows, RUN)]))
        ids = list(map(str, columns[3].tolist()))
        texts = [",".join(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]
        yield pa.RecordBatch.from_arrays([pa.array(c[starts]) for c in columns] + [pa.array(texts)], names=[*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined texts of each node; only the open hash is kept."""
    open_, state = None, None
    for batch in batches:
        keys, out = list(zip(*[batch.column(c).to_pylist() for c in KEY])), []
        for key, text in zip(keys, batch.column("ids").to_pylist()):
            if key == open_:
                state.update(b"," + text.encode())
                continue
            if state is not None:
                out.append((*open_, state.hexdigest()))
            open_, state = key, hashlib.sha256(text.encode())
        if out:
            yield _digest_rows(out)
    if state is not None:
        yield _digest_rows([(*open_, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*KEY, "ends_sha256"])


def ends(paths: DataFrame) -> DataFrame:
    """Of each node where conversations end, the hash of their ids in ascending order."""
    rows = paths.select(F.col("n").alias("len"), F.col("last_hi").alias("hi"), F.col("last_lo").alias("lo"), "conv_id")
    runs = rows.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(
        _runs, "len int, hi long, lo long, first long, ids string"
    )
    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "len int, hi long, lo long, ends_sha256 string")


def report(paths: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row for each prefix of each depth."""
    parents = nodes.groupBy(F.col("top").alias("len"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count("*").alias("n_children"))
    end = [F.col("n") == F.col("len"), F.col("last_hi") == F.col("hi"), F.col("last_lo") == F.col("lo")]
    inner = parents.select(*[F.col(c).alias(f"i_{c}") for c in KEY])
    leaf = classes.join(
        inner, (F.col("n") == F.col("i_len")) & (F.col("last_hi") == F.col("i_hi")) & (F.col("last_lo") == F.col("i_lo")), "left"
    ).select(*classes.columns, F.col("i_len").isNull().cast("long").alias("leaf"))
    total = F.coalesce(F.element_at(F.col("size"), -1), F.lit(0))
    total = F.when(F.col("n") > 0, total).otherwise(0)

    def at_depths(df: DataFrame, *columns: Column) -> DataFrame:
        """A row for each class and node on its path; the root is on every path."""
        steps = df.select("n", "size", "hi", "lo", *columns, total.alias("total"), F.explode(F.sequence(F.lit(0), F.col("n"))).alias("len")).select(
            *[c for c in df.columns if c not in ("n", "size", "hi", "lo", "last_hi", "last_lo")],
            "len",
            F.coalesce(F.get("hi", F.col("len") - 1), F.lit(0)).alias("hi"),
            F.coalesce(F.get("lo", F.col("len") - 1), F.lit(0)).alias("lo"),
            F.coalesce(F.get("size", F.col("len") - 1), F.lit(0)).alias("above"),
            "total",
        )
        named = nodes.select(*KEY)
        return steps.where("len > 0").join(named, KEY, "left_semi").unionByName(steps.where("len = 0"))

    counted = at_depths(leaf.select("conv", "copies", "leaf", "n", "hi", "lo", "size"), F.col("conv"), F.col("copies"), F.col("leaf"))
    stats = materialise_stage(
        counted.groupBy(*KEY).agg(
            F.min("conv").alias("conv_id"),
            F.sum("copies").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(F.col("copies") * (F.col("total") - F.col("above"))).alias("below"),
        ),
        "members",
    )
    # Each edge is counted once, by the class whose conversation is the smallest of the node.
    owned = nodes.select(*KEY, "top").join(stats.select(*KEY, F.col("conv_id").alias("conv")), KEY).groupBy("conv").agg(F.min("top").alias("owns"))
    own = classes.join(owned, "conv").withColumn("owned", F.coalesce(F.get("size", F.col("owns") - 1), F.lit(0)))
    once = at_depths(own.select("owned", "n", "hi", "lo", "size"), F.col("owned")).groupBy(*KEY).agg(
        F.sum(F.col("total") - F.greatest("above", "owned")).alias("once")
    )
    none = hashlib.sha256(b"").hexdigest()
    facts = (
        stats.join(once, KEY, "left").join(parents, KEY, "left").join(ends(paths), KEY, "left").select(
            *KEY,
            "conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            (F.col("below") - F.coalesce("once", F.lit(0))).alias("saved"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
    facts = materialise_stage(facts, "facts")
    root = facts.where("len = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"
    )
    above = facts.select(F.col("len").alias("top"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("up"))
    edge = nodes.join(facts, KEY).join(above, ["top", "up_hi", "up_lo"])
    below = F.expr("transform(e_size, (x, i) -> aggregate(slice(e_size, i + 1, size(e_size)), 0L, (s, y) -> s + y))")
    expanded = edge.withColumn("below", below).select("*", F.posexplode("below").alias("k", "bytes"))
    last = F.col("top") + F.col("k") + 1 == F.col("len")
    return root.unionByName(
        expanded.select(
            "conv_id",
            (F.col("top") + F.col("k") + 1).cast("long").alias("depth"),
            F.when(F.col("k") == 0, F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.when(last, F.col("n_children")).otherwise(1).alias("n_children"),
            "n_leaves",
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
            F.when(last, F.col("ends_sha256")).otherwise(F.lit(none)).alias("ends_sha256"),
        )
    )


def prefix_trie(sequences: DataFrame, batches: tuple[float, ...] = BATCHES) -> DataFrame:
    """All nodes of the trie of ``sequences`` (conv_id, turns), as ``report`` gives them."""
    paths = materialise_stage(prefix_hashes(sequences), "paths")
    equal = paths.groupBy("n", "last_hi", "last_lo").agg(F.min("conv_id").alias("conv"), F.count("*").alias("copies")).select("conv", "copies")
    classes = materialise_stage(paths.join(equal, F.col("conv_id") == F.col("conv")).drop("conv_id"), "classes")
    return report(paths, classes, build(classes, batches))


def conversation_trie(turns: DataFrame) -> DataFrame:
    return prefix_trie(rebuilt(turns))
