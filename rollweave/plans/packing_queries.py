"""F: packing, padding and batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollweave.operators import packing as p
from rollweave.plans.inputs import joined, preference_pairs
from rollweave.plans.registry import check
from rollweave.plans.sqltext import PAIRS
from rollweave.plans.sqltext import joined as sql_joined

PAD = 3
SHARDS = 4


def _items(t):
    """Turns as samples: word lengths are the response ids, so the pad id 3 occurs in them."""
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    return t.conversations.select(
        (F.col("conv_id") * 10 + F.col("turn")).alias("item"),
        F.array(F.lit(1), F.lit(2), (F.col("turn") + 10).cast("int")).alias("query"),
        ids.alias("response"),
        F.transform(ids, lambda x, i: F.when(i % 3 == 0, F.lit(0)).otherwise(F.lit(1))).alias("mask"),
        F.transform(ids, lambda x: -x / F.lit(10.0)).alias("logprobs"),
    )


ITEMS = f"""items AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS i, turn,
      list_filter(list_transform(string_split(text, ' '), lambda w, k: {{'t': length(w)::INTEGER, 'm': CASE WHEN (k - 1) % 3 = 0 THEN 0 ELSE 1 END}}), lambda z: z.t <> {PAD}) AS r
    FROM (SELECT conv_id * 10 + turn AS item, turn, text FROM conversations))"""


def _shard(column: str, n: int) -> str:
    return f"(('0x' || substr(md5({column}::VARCHAR), 1, 7))::BIGINT % {n})::INTEGER"


def _next_fit(source: str, sizes: list[str], limit: str, max_items: int | None = None) -> str:
    """Recursive twin of the scan: ``packed(shard, o, pack_no, k)`` with k the place in the pack."""
    total = " OR ".join(f"p.t{j} + n.{s} > {limit}" for j, s in enumerate(sizes))
    full = f" OR p.k + 1 >= {max_items}" if max_items else ""
    carry = ", ".join(f"CASE WHEN ({total}{full}) THEN n.{s} ELSE p.t{j} + n.{s} END AS t{j}" for j, s in enumerate(sizes))
    first = ", ".join(f"{s} AS t{j}" for j, s in enumerate(sizes))
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY o) AS rn FROM {source}),
    packed AS (SELECT shard, o, rn, 0 AS pack_no, 0 AS k, {first} FROM numbered WHERE rn = 1
      UNION ALL SELECT n.shard, n.o, n.rn, CASE WHEN ({total}{full}) THEN p.pack_no + 1 ELSE p.pack_no END, CASE WHEN ({total}{full}) THEN 0 ELSE p.k + 1 END, {carry}
      FROM packed p JOIN numbered n ON n.shard = p.shard AND n.rn = p.rn + 1)"""


def _packs_sql(limit: str, tool_mask: bool) -> str:
    mark = "CASE WHEN z.m = 1 THEN (i + 1)::INTEGER ELSE 0 END" if tool_mask else "(i + 1)::INTEGER"
    return f"""WITH RECURSIVE {ITEMS}, sized AS (SELECT {_shard('i', SHARDS)} AS shard, i AS o, len(r) + 3 AS n, (SELECT sum(len(r) + 3) FROM items) AS total FROM items),
    {_next_fit('sized', ['n'], limit)},
    x AS (SELECT pk.shard, pk.pack_no, pk.k, items.i, items.item, list_concat([1, 2, (turn + 10)::INTEGER], list_transform(r, lambda z: z.t)) AS toks,
        list_concat([0, 0, 0], list_transform(r, lambda z: {mark})) AS rmask, len(r) AS n_resp FROM packed pk JOIN items ON items.i = pk.o)
    SELECT shard, pack_no::BIGINT AS pack_no, array_to_string(list(item ORDER BY k), ' ') AS members, array_to_string(flatten(list(toks ORDER BY k)), ' ') AS tokens,
      array_to_string(flatten(list(rmask ORDER BY k)), ' ') AS response_mask, array_to_string(list(n_resp ORDER BY k), ' ') AS num_actions,
      array_to_string(list(len(toks) ORDER BY k), ' ') AS seq_lens,
      array_to_string(flatten(list(list_transform(toks, lambda t: k + 1) ORDER BY k)), ' ') AS attention_mask,
      array_to_string(flatten(list(list_transform(toks, lambda t, j: CASE WHEN j = len(toks) THEN i + 1 ELSE 0 END) ORDER BY k)), ' ') AS dones,
      array_to_string(flatten(list(list_transform(toks, lambda t, j: j - 1) ORDER BY k)), ' ') AS positions,
      sum(3)::BIGINT AS nan_logprobs, round(-sum(list_sum(toks) - turn10) / 10.0, 6)::DOUBLE AS logprob_sum
    FROM (SELECT *, list_sum(toks[1:3]) AS turn10 FROM x) GROUP BY shard, pack_no"""


def _pack_columns(packs):
    real = F.filter("logprobs", lambda x: ~F.isnan(x))
    return packs.select(
        "shard",
        "pack_no",
        joined("items").alias("members"),
        joined("tokens").alias("tokens"),
        joined("response_mask").alias("response_mask"),
        joined("num_actions").alias("num_actions"),
        joined("packed_seq_lens").alias("seq_lens"),
        joined("attention_mask").alias("attention_mask"),
        joined("dones").alias("dones"),
        joined("position_ids").alias("positions"),
        F.size(F.filter("logprobs", lambda x: F.isnan(x))).cast("long").alias("nan_logprobs"),
        F.round(F.aggregate(real, F.lit(0.0), lambda a, x: a + x), 6).alias("logprob_sum"),
    )


@check("packed_sequences", "F1 F2", _packs_sql("300", False))
def packed_sequences(t):
    return _pack_columns(p.pack_sequences(_items(t), "item", 300, PAD, n_shards=SHARDS))


@check("packed_sequences_minimum", "F1 F2", _packs_sql("least(n.total // 400, 2000)", True))
def packed_sequences_minimum(t):
    return _pack_columns(p.pack_sequences(_items(t), "item", 2000, PAD, min_packs=400, mask_tool_use=True, n_shards=SHARDS))


@check(
    "token_advantages",
    "F3",
    f"""WITH RECURSIVE {ITEMS}, sized AS (SELECT {_shard('i', SHARDS)} AS shard, i AS o, len(r) + 3 AS n FROM items), {_next_fit('sized', ['n'], '300')}
    SELECT pk.shard, pk.pack_no::BIGINT AS pack_no, round(sum((items.i % 7 - 3.0) * len(r)), 6)::DOUBLE AS total, sum(len(r) + 3)::BIGINT AS tokens, sum(CASE WHEN items.i % 7 = 3 THEN len(r) + 3 ELSE 3 END)::BIGINT AS zeros
    FROM packed pk JOIN items ON items.i = pk.o GROUP BY 1, 2""",
)
def token_advantages(t):
    from rollweave.operators.ordering import row_index

    items = _items(t)
    packs = p.pack_sequences(items, "item", 300, PAD, n_shards=SHARDS)
    scores = row_index(items.select("item"), "item").select(
        (F.col("index") + 1).cast("int").alias("sample"), (F.col("index") % 7 - 3.0).alias("advantage")
    )
    out = p.broadcast_advantages(packs, scores)
    return out.select(
        "shard",
        "pack_no",
        F.round(F.aggregate("advantages", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.size("advantages").cast("long").alias("tokens"),
        F.size(F.filter("advantages", lambda x: x == 0)).cast("long").alias("zeros"),
    )


PAIR_SIZES = f"{PAIRS}, sizes AS (SELECT conv_id, length(good)::INTEGER AS a, length(bad)::INTEGER AS b FROM pairs)"


def _pair_batches_sql(drop: bool) -> str:
    tail = (
        "SELECT batch, members, false AS is_padding FROM g, n WHERE batch < n.total - n.total % 4"
        if drop
        else "SELECT batch, members, false AS is_padding FROM g UNION ALL SELECT batch + u.c, members, true FROM g, n, LATERAL (SELECT unnest(range(1, (4 - n.total % 4) % 4 + 1)) AS c) u WHERE batch = n.total - 1"
    )
    return f"""WITH RECURSIVE {PAIR_SIZES}, sized AS (SELECT {_shard('conv_id', 2)} AS shard, conv_id AS o, a, b FROM sizes), {_next_fit('sized', ['a', 'b'], '900', 5)},
    h AS (SELECT shard, pack_no, array_to_string(list(o ORDER BY k), ' ') AS members FROM packed GROUP BY 1, 2),
    g AS (SELECT row_number() OVER (ORDER BY shard, pack_no) - 1 AS batch, members FROM h), n AS (SELECT count(*) AS total FROM g),
    d AS ({tail}) SELECT batch, (batch % 4)::INTEGER AS worker, members, is_padding FROM d"""


def _pair_batches(t, drop: bool):
    rows = preference_pairs(t).select("conv_id", F.length("good").alias("a"), F.length("bad").alias("b"))
    out = p.pack_batches(rows, "conv_id", [F.col("a"), F.col("b")], 900, 5, 4, drop_last=drop, n_shards=2)
    return out.select("batch", "worker", joined("members").alias("members"), "is_padding")


@check("pair_batches_dropped", "F4", _pair_batches_sql(True))
def pair_batches_dropped(t):
    return _pair_batches(t, True)


@check("pair_batches_padded", "F4", _pair_batches_sql(False))
def pair_batches_padded(t):
    return _pair_batches(t, False)


@check(
    "within_budget",
    "F5",
    f"""WITH {PAIR_SIZES}, r AS (SELECT conv_id, sum(a) OVER w AS sa, sum(b) OVER w AS sb, row_number() OVER w AS rn FROM sizes WINDOW w AS (ORDER BY conv_id)),
    v AS (SELECT min(rn) AS stop FROM r WHERE rn > 1 AND (sa > 6000 OR sb > 6000)) SELECT conv_id FROM r, v WHERE stop IS NULL OR rn < stop""",
)
def within_budget(t):
    rows = preference_pairs(t).select("conv_id", F.length("good").alias("a"), F.length("bad").alias("b"))
    return p.take_within_budget(rows, "conv_id", {"chosen": F.col("a"), "rejected": F.col("b")}, 6000).select("conv_id")


def _turn_rows(t):
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    return t.conversations.select(
        "conv_id", "turn", ids.alias("input_ids"), F.transform(ids, lambda x, i: F.when(i % 2 == 0, F.lit(-100)).otherwise(x)).alias("labels")
    )


TURN_IDS = "w AS (SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda v: length(v)::INTEGER) AS ids FROM conversations)"


@check(
    "flattened_batches",
    "F6 F9",
    f"""WITH {TURN_IDS}, s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, coalesce(sum(len(ids)) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS upto FROM w),
    g AS (SELECT conv_id, flatten(list(ids ORDER BY k)) AS ids, flatten(list(list_transform(ids, lambda x, i: CASE WHEN i % 2 = 1 THEN -100 ELSE x END) ORDER BY k)) AS labels,
      list_concat([0], list(upto ORDER BY k)) AS cu, max(len(ids)) AS m, flatten(list(list_transform(ids, lambda x, i: i - 1) ORDER BY k)) AS pos, flatten(list(list_transform(ids, lambda x: k) ORDER BY k)) AS seg,
      list(len(ids) ORDER BY k) AS lens FROM s GROUP BY conv_id)
    SELECT conv_id, array_to_string(ids, ' ') AS ids, array_to_string(labels, ' ') AS loss, array_to_string(cu, ' ') AS cu, m::INTEGER AS longest, array_to_string(pos, ' ') AS positions, array_to_string(seg, ' ') AS segments,
      len(ids)::INTEGER AS tokens, len(lens)::INTEGER AS sequences, array_to_string(lens, ' ') AS lengths FROM g""",
)
def flattened_batches(t):
    flat = p.batch_counts(p.flatten_batch(_turn_rows(t), "conv_id", "turn"))
    return flat.select(
        "conv_id",
        joined("input_ids").alias("ids"),
        joined("labels").alias("loss"),
        joined("cu_seq_lens").alias("cu"),
        F.col("max_length").alias("longest"),
        joined("position_ids").alias("positions"),
        joined("seq_idx").alias("segments"),
        "tokens",
        "sequences",
        joined("lengths").alias("lengths"),
    )


@check(
    "flattened_and_padded",
    "F6",
    f"""WITH {TURN_IDS}, g AS (SELECT conv_id, sum(len(ids)) AS n FROM w GROUP BY conv_id)
    SELECT conv_id, greatest(n, 900)::INTEGER AS n_ids, greatest(n, 900)::INTEGER AS n_seg, greatest(900 - n, 0)::INTEGER AS pads FROM g""",
)
def flattened_and_padded(t):
    flat = p.flatten_batch(_turn_rows(t), "conv_id", "turn", pad_to=900)
    return flat.select("conv_id", F.size("input_ids").alias("n_ids"), F.size("seq_idx").alias("n_seg"), F.size(F.filter("seq_idx", lambda x: x == -1)).alias("pads"))


@check("unflattened_rows", "F6", f"WITH {TURN_IDS} SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS slot, {sql_joined('ids')} AS ids FROM w")
def unflattened_rows(t):
    return p.unflatten_batch(p.flatten_batch(_turn_rows(t), "conv_id", "turn"), "conv_id").select("conv_id", "slot", joined("input_ids").alias("ids"))


@check(
    "padded_batches",
    "F7",
    f"""WITH {TURN_IDS}, m AS (SELECT conv_id, max(len(ids)) AS n FROM w GROUP BY 1)
    SELECT conv_id, turn, array_to_string(list_concat(ids, list_transform(range(n - len(ids)), lambda x: 9)), ' ') AS ids,
      array_to_string(list_concat(list_transform(ids, lambda x, i: CASE WHEN i % 2 = 1 THEN -100 ELSE x END), list_transform(range(n - len(ids)), lambda x: -100)), ' ') AS loss FROM w JOIN m USING (conv_id)""",
)
def padded_batches(t):
    return p.pad_batch(_turn_rows(t), "conv_id", ["input_ids", "labels"], 9).select("conv_id", "turn", joined("input_ids").alias("ids"), joined("labels").alias("loss"))


@check(
    "worker_packs",
    "F8",
    """WITH k AS (SELECT o_orderkey AS pack, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, (SELECT count(*) // 7 FROM orders) AS b FROM orders),
    w AS (SELECT i, (i // b)::INTEGER AS worker FROM k WHERE i < b * 7), r AS (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY md5(concat(42, ':', i)), i) - 1 AS r FROM w)
    SELECT i AS pack_id, worker, (r // 3)::INTEGER AS micro_batch, (r % 3)::INTEGER AS slot FROM r""",
)
def worker_packs(t):
    from rollweave.operators.ordering import row_index

    packs = row_index(t.orders.select("o_orderkey"), "o_orderkey", out="pack_id").drop("o_orderkey")
    return p.assign_packs(packs, "pack_id", 7, 3)


@check(
    "length_buckets",
    "F10",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, row_number() OVER (ORDER BY n_chars, md5(doc_id::VARCHAR), doc_id) - 1 AS rk FROM documents)
    SELECT doc_id, position, rk // 32 AS batch, (rk % 32)::INTEGER AS slot FROM r""",
)
def length_buckets(t):
    return p.length_bucketed_batches(t.documents.select("doc_id", "n_chars"), "doc_id", F.col("n_chars"), 32).drop("n_chars")


def _pair_ids(t):
    ids = lambda c: F.transform(F.split(c, " "), lambda w: F.length(w))
    rows = preference_pairs(t).select("conv_id", (F.col("conv_id") % 10).alias("batch"), ids("good").alias("chosen_input_ids"), ids("bad").alias("rejected_input_ids"))
    return rows.withColumns({"chosen_labels": F.col("chosen_input_ids"), "rejected_labels": F.col("rejected_input_ids")})


PAIR_IDS = f"""{PAIRS}, q AS (SELECT conv_id, conv_id % 10 AS batch, list_transform(string_split(good, ' '), lambda v: length(v)::INTEGER) AS c, list_transform(string_split(bad, ' '), lambda v: length(v)::INTEGER) AS r FROM pairs)"""


@check(
    "stacked_pairs",
    "F11",
    f"""WITH {PAIR_IDS}, m AS (SELECT batch, max(greatest(len(c), len(r))) AS n, count(*) AS size FROM q GROUP BY 1),
    s AS (SELECT conv_id, batch, 0 AS part, c AS ids FROM q UNION ALL SELECT conv_id, batch, 1, r FROM q)
    SELECT batch, conv_id, size AS batch_size, part, array_to_string(list_concat(ids, list_transform(range(n - len(ids)), lambda x: 0)), ' ') AS ids,
      array_to_string(list_concat(ids, list_transform(range(n - len(ids)), lambda x: -100)), ' ') AS loss FROM s JOIN m USING (batch)""",
)
def stacked_pairs(t):
    out = p.stack_pairs(_pair_ids(t), "batch", "conv_id")
    return out.select("batch", "conv_id", "batch_size", "part", joined("input_ids").alias("ids"), joined("labels").alias("loss"))


@check(
    "stacked_flat_pairs",
    "F11",
    f"""WITH {PAIR_IDS}, g AS (SELECT batch, list(len(c) ORDER BY conv_id) AS lc, list(len(r) ORDER BY conv_id) AS lr, flatten(list(c ORDER BY conv_id)) AS c, flatten(list(r ORDER BY conv_id)) AS r FROM q GROUP BY 1),
    l AS (SELECT *, list_concat(lc, lr) AS ls FROM g)
    SELECT batch, array_to_string(list_concat(c, r), ' ') AS ids, array_to_string(list_transform(range(len(ls) + 1), lambda i: coalesce(list_sum(ls[1:i]), 0)::INTEGER), ' ') AS cu,
      array_to_string(flatten(list_transform(ls, lambda n, i: list_transform(range(n), lambda j: i - 1))), ' ') AS segments, list_max(ls)::INTEGER AS longest, len(lc)::INTEGER AS batch_size FROM l""",
)
def stacked_flat_pairs(t):
    rows = _pair_ids(t)
    side = lambda s: p.flatten_batch(rows, "batch", "conv_id", f"{s}_input_ids", f"{s}_labels")
    prefixed = lambda df, s: df.select("batch", *[F.col(c).alias(f"{s}_{c}") for c in df.columns if c != "batch"])
    both = prefixed(side("chosen"), "chosen").join(prefixed(side("rejected"), "rejected"), "batch")
    out = p.stack_flattened(both)
    return out.select("batch", joined("input_ids").alias("ids"), joined("cu_seq_lens").alias("cu"), joined("seq_idx").alias("segments"), F.col("max_length").alias("longest"), "batch_size")
