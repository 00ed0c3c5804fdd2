"""op11 to op13 against the contract by brute force, exact round trips and the tokenizer's library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollweave.llm import bytebpe, middle, queries, ztrie
from tests.llm.cases import SCHEMA, awkward, rows, with_clashes

ROOT = "/root/testdata/sf0.001"


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    return awkward(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return queries.documents(spark, ROOT)


OPERATORS = {"op11": middle.digests, "op13": bytebpe.round_trip_digests}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_clashing_columns(spark, odd, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []
    assert rows(OPERATORS[name](with_clashes(odd))) == rows(OPERATORS[name](odd))


# --- op11 ------------------------------------------------------------------------------------


def by_slices(doc_id, text):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    return (doc_id, n, "spm", a, b - a, s + p + m) if h4 % 100 < 20 else (doc_id, n, "psm", a, b - a, p + s + m)


@pytest.mark.parametrize("table", ["docs", "odd", "marked"])
def test_fill_in_middle(spark, request, table):
    if table == "marked":
        parts = ["<P>", "<S>", "<M>", "<", "P>", "S", ">", "<P", "é", "😀", "a", "\x00", "<<", "M>"]
        draw = random.Random(3)
        table = spark.createDataFrame([(k, "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))) for k in range(800)], "doc_id long, text string")
    else:
        table = request.getfixturevalue(table)
    want = [by_slices(r.doc_id, r.text) for r in table.collect()]
    assert Counter(tuple(r) for r in middle.fill_in_middle(table).collect()) == Counter(want)
    got = Counter(tuple(r) for r in middle.digests(table).collect())
    assert got == Counter((*w[:5], sha(w[5]), sha(r.text or "")) for w, r in zip(want, table.collect()))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab<>PSM é😀\n"), max_size=30), st.data())
def test_restored_is_the_text(text, data):
    if any(m in text for m in ("<P>", "<S>", "<M>")):
        return
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(0, len(text) - a))
    for form in ("psm", "spm"):
        out = bytes(middle.arrange(text.encode(), form, a, b))
        p, m, s = "<P>" + text[:a], "<M>" + text[a : a + b], "<S>" + text[a + b :]
        assert out.decode() == (p + s + m if form == "psm" else s + p + m)
        assert middle.restore(out, form).decode() == text


def test_rotation_of_long_blocks():
    draw = random.Random(5)
    for n in (0, 1, 2, 3, middle.SCRATCH * 2 - 1, middle.SCRATCH * 2, middle.SCRATCH * 5 + 7):
        own = draw.randbytes(n)
        for cut in {0, n // 3, n // 2, n}:
            buffer = bytearray(own)
            middle.rotate(buffer, 0, cut, n)
            assert bytes(buffer) == own[cut:] + own[:cut]


# --- op12 ------------------------------------------------------------------------------------


def rebuilt(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    lent = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: lent[c]] + v[lent[c] :] for c, v in own.items()}


def nodes_of(conversations):
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    saved, leaves = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += not children[path]
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(path))
        up = min(members[path[:-1]]) if path else None
        yield min(convs), len(path), up, len(convs), len(children[path]), leaves[path], saved[path], sha(ends)


NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id long, turn long, role string, text string"


def drawn(seed, convs, words, depth):
    draw, out = random.Random(seed), [(None, 0, "u", "x"), (3, None, "u", "first"), (convs + 7, None, None, None)]
    for c in range(convs):
        out += [(c, t, draw.choice(["u", "a", None]), draw.choice(words)) for t in range(draw.randint(0, depth))]
    return out


CASES = {
    "few words": drawn(1, 100, ["a", None], 5),
    "many words": drawn(2, 120, ["a", "b", None, "é", "long " * 40], 8),
    "long": drawn(3, 12, ["a", "b"], 120),
    "equal turns": [(c, t // 2, "u", str(t % 3)) for c in range(30) for t in range(6)] * 2,
    "a chain": [(5 * c, t, "u", "x") for c in range(30) for t in range(c)],
    "one conversation many times": [(5 * c, t, "u", f"t{t}") for c in range(200) for t in range(4)] + [(5 * c, 4, "u", str(c)) for c in range(0, 200, 3)],
    "turnless beside others": [(5, 0, "u", "x"), (6, 0, "u", "y"), (11, 0, "u", "z")],
}


@pytest.mark.parametrize("name", CASES)
def test_conversation_trie(spark, name):
    got = ztrie.conversation_trie(spark.createDataFrame(CASES[name], TURNS)).select(*NODE)
    assert Counter(tuple(r) for r in got.collect()) == Counter(nodes_of(rebuilt(CASES[name])))


def test_trie_does_not_depend_on_batches_or_runs(spark, monkeypatch):
    turns = CASES["many words"]
    want = Counter(nodes_of({c: v for c, v in rebuilt(turns).items()}))
    monkeypatch.setattr(ztrie, "RUN", 2)
    for batches in ((1.0,), (0.05, 0.2, 0.25, 0.5)):
        got = ztrie.prefix_trie(ztrie.rebuilt(spark.createDataFrame(turns, TURNS)), batches).select(*NODE)
        assert Counter(tuple(r) for r in got.collect()) == want


def test_trie_of_awkward_tables(spark):
    assert ztrie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert ztrie.conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], TURNS)).collect() == []
    from pyspark.sql import functions as F

    turns = spark.createDataFrame(CASES["few words"], TURNS)
    clashing = turns.select("*", *[F.lit("extra").alias(c) for c in ("len", "hi", "lo", "n", "conv", "top", "w", "turns", "size", "key", "head")])
    assert rows(ztrie.conversation_trie(clashing)) == rows(ztrie.conversation_trie(turns))


def test_trie_query_is_its_sql(spark):
    import duckdb

    from tests.oracle import rows_of

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{ROOT}/conversations.parquet'")
    df, rel = queries.QUERIES["op12_conversation_trie"](spark, ROOT), con.execute(queries.SQL["op12_conversation_trie"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in rel.description], rel.fetchall())


# --- op13 ------------------------------------------------------------------------------------


def library(name="byte_bpe_50k.tiktoken"):
    import public_tokenizers
    import tiktoken

    ranks = bytebpe.read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def by_library(tool, r):
    ids = tool.encode_ordinary(r.text or "")
    return r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(r.text or "")


def mixed(spark):
    draw = random.Random(11)
    parts = ["the", " The", "'s", "'re", " don't", "12345", " 7", "…", "é", " naïve", "中文字", "😀", "\n", "\n\n  ", "\t", " ", "   ", "_x_", "--", "\x85", "\xa0", "\x1f", "a" * 300, "ab" * 200, " " * 300, "٣", "½", "Ⅷ", "x1y2", "(foo)bar.baz", "\x00", "'", "''S"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(400)]
    texts += ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000)), "x" * 30_000, None, ""]
    return spark.createDataFrame([(k % 390 or None, t) for k, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize("table", ["docs", "odd", "mixed"])
def test_byte_bpe_is_the_librarys(spark, request, table):
    table = mixed(spark) if table == "mixed" else request.getfixturevalue(table)
    tool, _ = library()
    want = Counter(by_library(tool, r) for r in table.collect())
    assert Counter(tuple(r) for r in bytebpe.round_trip_digests(table).collect()) == want


def test_small_chunks_and_another_vocabulary(spark):
    import public_tokenizers

    name = "byte_bpe_multi_50k.tiktoken"
    tool, _ = library(name)
    table = mixed(spark).repartition(3)
    want = Counter((r.doc_id, tuple(tool.encode_ordinary(r.text or ""))) for r in table.collect())
    for chunk, head in ((200, 1 << 19), (2000, 10), (1 << 22, 0)):
        got = bytebpe.encode(table, public_tokenizers.path(name), public_tokenizers.PATTERN, chunk, head)
        assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want


def test_every_piece_is_its_own_encoding():
    tool, ranks = library()
    assert all(bytebpe.heap_ids(piece, ranks) == [rank] for piece, rank in ranks.items())
    assert len(bytebpe.merges(ranks)) == sum(len(p) > 1 for p in ranks)
    with pytest.raises(ValueError, match="no merge"):
        bytebpe.merges({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_folds_start_from_certain_pieces_and_end_at_the_librarys(spark, name):
    import public_tokenizers
    import pyarrow as pa

    draw = random.Random(3)
    words = ["".join(draw.choice(" aaabbthenr01üß中") for _ in range(draw.randint(0, 30))) for _ in range(500)] + ["a" * 256, "", "é"]
    ranks = bytebpe.read_ranks(public_tokenizers.path(name))
    rank_map = bytebpe.RankMap(ranks)
    starts = rank_map.starts(pa.array(words)).to_pylist()
    # Fewer pieces than bytes, so fewer steps.
    assert sum(len(s) - 1 for s in starts) < 0.9 * sum(len(w.encode()) for w in words)
    assert rank_map.starts(pa.array([], pa.string())).to_pylist() == []
    assert rank_map.starts(pa.array(words).slice(7, 9)).to_pylist() == starts[7:16]
    table = spark.createDataFrame([(starts,)], "starts array<array<long>>")
    assert table.select(rank_map.ids("starts")).first()[0] == [bytebpe.heap_ids(w.encode(), ranks) for w in words]


def test_cuts_lie_between_matches():
    import public_tokenizers
    import pyarrow as pa
    import regex

    find = regex.compile(public_tokenizers.PATTERN).findall
    draw = random.Random(2)
    texts = ["".join(draw.choice(list("ab1 .'_\n\té ½中") + ["'s", "  ", "\xa0", "\x85"]) for _ in range(draw.randint(0, 20))) for _ in range(2000)]
    for block in bytebpe.kernel.blocks(pa.array(texts)):
        runs, count = bytebpe._runs(block)
        at = 0
        for text, n in zip(texts[block.first :], count):
            assert [m for run in runs[at : at + n].to_pylist() for m in find(run)] == find(text)
            at += int(n)


def test_contract_columns(spark):
    assert re.fullmatch("[0-9a-f]{64}", queries.QUERIES["op13_byte_bpe"](spark, ROOT).first().decoded_sha256)
