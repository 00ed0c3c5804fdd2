"""Inline cases of single rules and the invariants of the batch operators."""

import math

import pytest
from pyspark.sql import functions as F

from rollweave.functions import constraints as c
from rollweave.functions import latex
from rollweave.functions import verifiers as v
from rollweave.operators import judging, messages, mixing, packing, preferences, rewards, tokens
from rollweave.operators.ordering import row_index, running_by_key
from rollweave.plans import constraint_queries, transforms
from rollweave.session import materialise_stage


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def score(spark, rule, prediction, label, **config):
    return one(spark, rule(v.Sample(F.lit(prediction), F.lit(label), F.lit(0), config)))


@pytest.mark.parametrize(
    "prediction,label,expected",
    [
        ("The answer is 42", "answer is 42", 1.0),
        ("<think>hm</think>Paris", "paris", 1.0),
        ("<answer>New York City!</answer>", "new york city", 1.0),
        ("wrong", "right", 0.0),
    ],
)
def test_puzzle(spark, prediction, label, expected):
    assert score(spark, v.puzzle, prediction, label) == expected


def test_token_f1(spark):
    assert score(spark, v.string_f1, "hello world", "hello") == pytest.approx(2 / 3)
    assert score(spark, v.string_f1, "none", "other") == 0
    best = v.best_f1(F.lit("hello world"), F.array(F.lit("hello"), F.lit("hello world")))
    assert one(spark, best) == pytest.approx(1.0)


@pytest.mark.parametrize("text,label,expected", [("it is -3", "-3", 1), ("+7", "+7", 1), ("x -3.5", "-3.5", 1), ("\\boxed{-3}", "-3", 1), ("-3", "3", 0)])
def test_last_number(spark, text, label, expected):
    assert score(spark, v.gsm8k, text, label) == expected


@pytest.mark.parametrize(
    "raw,wanted",
    [
        (r"\frac{1}{2}", r"\frac{1}{2}"),
        (r"\frac 1 2", r"\frac{1}{2}"),
        (r"  \frac{1}{2}  ", r"\frac{1}{2}"),
        (r"\left(\frac{1}{2}\right)", r"(\frac{1}{2})"),
        (r"50\%", "50"),
        ("0.5", r"\frac{1}{2}"),
        (r"\tfrac{3}{4}", r"\frac{3}{4}"),
        (r"\sqrt2", r"\sqrt{2}"),
        ("1 + 2", "1+2"),
        (r"\sqrt", None),
        ("x/2", None),
    ],
)
def test_latex(spark, raw, wanted):
    assert one(spark, latex.canonical(F.lit(raw))) == wanted


def sources(spark):
    rows = spark.range(300).select(F.col("id"), F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("source"))
    both = F.explode(F.array(F.lit("train"), F.lit("test")))
    return rows.select("*", both.alias("split"))


def test_mix_counts(spark):
    mixed = mixing.mix(sources(spark), {"d0": 0.5, "d1": 0.3, "d2": 0.2}, "id", split="split")
    counts = {r.split: r["count"] for r in mixed.groupBy("split").count().collect()}
    assert counts == {"train": 100, "test": 300}
    train = sources(spark).where("split = 'train'")
    assert mixing.mix(train, {"d0": 0.7, "d1": 0.4}, "id").count() == 110


def test_mix_errors(spark):
    train = sources(spark).where("split = 'train'")
    with pytest.raises(ValueError):
        mixing.mix(train, {"d0": -1}, "id")
    with pytest.raises(NotImplementedError):
        mixing.mix(train, {"d0": 5, "d1": 0.5}, "id")
    with pytest.raises(ValueError):
        mixing.parse_mixer(["a", "1", "b"])
    assert mixing.parse_mixer(["a", "1", "b", "1.0"]) == {"a": 1, "b": 1.0}
    with pytest.raises(ValueError):
        mixing.require_rows(train.where("false"))


def test_config_hash():
    config = {"name": "a", "limit": None, "seed": 1}
    assert mixing.config_hash(config) == mixing.config_hash({"seed": 1, "name": "a"})
    assert mixing.config_hash(config) != mixing.config_hash({"seed": 2, "name": "a"})
    assert len(mixing.config_hash(config)) == 10 and len(mixing.step_fingerprint("x", "s", {})) == 16


def samples(spark, n=40):
    ids = F.sequence(F.lit(1), (F.col("id") % 7 + 1).cast("int"))
    return spark.range(n).select(
        "id", F.array(F.lit(8), F.lit(9)).alias("query"), ids.alias("response"), F.transform(ids, lambda x: F.lit(1)).alias("mask"), F.transform(ids, lambda x: F.lit(-0.1)).alias("logprobs")
    )


@pytest.mark.parametrize("shards", [1, 3])
def test_pack_invariants(spark, shards):
    packs = packing.pack_sequences(samples(spark), "id", 20, 0, n_shards=shards).collect()
    members = [i for p in packs for i in p.ids]
    assert sorted(members) == list(range(40))
    for p in packs:
        assert len(p.tokens) <= 20 and p.ids == sorted(p.ids)
        assert sum(p.packed_seq_lens) == len(p.tokens) == len(p.response_mask) == len(p.attention_mask)
        assert [d for d in p.dones if d] == [i + 1 for i in p.ids]
        assert sum(math.isnan(x) for x in p.logprobs) == 2 * len(p.ids)
    if shards == 1:
        limits = [sum(packs[k].packed_seq_lens) + packs[k + 1].packed_seq_lens[0] for k in range(len(packs) - 1)]
        assert all(x > 20 for x in limits)


def test_minimum_packs_keep_tokens(spark):
    few = packing.pack_sequences(samples(spark, 6), "id", 1000, 0, n_shards=1)
    more = packing.pack_sequences(samples(spark, 6), "id", 1000, 0, min_packs=3, n_shards=1)
    total = lambda df: df.agg(F.sum(F.size("tokens"))).first()[0]
    assert few.count() == 1 and more.count() >= 3 and total(few) == total(more)


@pytest.mark.parametrize("world,drop", [(1, True), (2, True), (4, False), (3, False)])
def test_batches_per_worker(spark, world, drop):
    rows = spark.range(50).select("id", (F.col("id") % 9 + 1).cast("int").alias("n"))
    batches = packing.pack_batches(rows, "id", [F.col("n")], 20, 4, world, drop, n_shards=2).collect()
    per_worker = {}
    for b in batches:
        per_worker[b.worker] = per_worker.get(b.worker, 0) + 1
    assert len(set(per_worker.values())) == 1 and len(per_worker) == world
    if not drop:
        assert {i for b in batches for i in b.members} == set(range(50))


def test_budget(spark):
    rows = spark.createDataFrame([(0, 50, 1), (1, 10, 1), (2, 10, 100), (3, 1, 1)], "id long, a int, b int")
    keep = lambda n: [r.id for r in packing.take_within_budget(rows, "id", {"a": F.col("a"), "b": F.col("b")}, n).orderBy("id").collect()]
    assert keep(60) == [0, 1] and keep(5) == [0] and keep(1000) == [0, 1, 2, 3]


def test_masked_mean_empty(spark):
    assert one(spark, rewards.masked_mean(F.array(F.lit(1.0)), F.array(F.lit(0.0)))) == 0


def test_rubric_metrics(spark):
    rows = [(0.8, 1.0, "persistent"), (0.5, 1.0, "persistent"), (1.0, 1.0, "evolving"), (0.6, 1.0, "evolving"), (0.5, -1.0, "evolving")]
    out = judging.rubric_metrics(spark.createDataFrame(rows, "score double, weight double, kind string")).first()
    assert out.avg_persistent_reward == pytest.approx(0.65) and out.avg_evolving_reward == pytest.approx(1.1 / 3)


def test_prune_rubrics(spark):
    buffer = spark.createDataFrame([("q", t, "active") for t in "abcd"], "query string, title string, state string")
    stats = spark.createDataFrame([("q", "a", 0.0), ("q", "b", 0.1), ("q", "c", 0.9), ("q", "d", 0.5)], "query string, title string, std double")
    out = {r.title: r.state for r in judging.prune_rubrics(buffer, stats, 2).collect()}
    assert out == {"a": "inactive", "b": "inactive", "c": "active", "d": "active"}


def test_env_config_shapes(spark):
    shape = lambda raw: one(spark, messages.normalise_env_config(F.lit(raw)))
    single = shape('{"env_name": "counter", "target": 5, "max_steps": 3}')
    assert single.max_steps == 3 and single.env_configs[0].env_name == "counter" and single.env_configs[0].kwargs == {"target": "5"}
    assert [e.env_name for e in shape('[{"env_name": "a"}, {"env_name": "b"}]').env_configs] == ["a", "b"]
    assert shape('{"other": 1}').env_configs == [] and shape(None) is None
    with pytest.raises(Exception, match="env_name"):
        shape('[{"target": 3}]')
    with pytest.raises(Exception, match="object or a list"):
        shape("7")


def test_message_errors(spark):
    bad = spark.createDataFrame([([("robot", "x")],)], "conversations array<struct<from:string,value:string>>")
    with pytest.raises(Exception, match="unknown speaker"):
        messages.to_messages(bad).collect()
    with pytest.raises(ValueError):
        messages.align_columns(bad, ["text"], need=["text"])
    empty = F.array().cast(messages.MESSAGES)
    with pytest.raises(Exception, match="empty prompt"):
        one(spark, messages.drop_trailing_assistant(empty))


def test_tool_validation(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,)], "tools array<string>")
    assert messages.validate_tools(df, ["a", "b", "c"]) == ["c"]
    with pytest.raises(ValueError, match="not configured"):
        messages.validate_tools(df, ["a"])


def check_rule(spark, family, name, text, **args):
    kwargs = F.create_map(*[F.lit(x) for k, a in args.items() for x in (k, str(a))]) if args else F.create_map().cast("map<string,string>")
    return one(spark, family[name](c.Check(F.lit(text), kwargs, F.lit("en"))))


@pytest.mark.parametrize(
    "family,name,text,args,expected",
    [
        (c.LEGACY, "verify_sentence_constraint", "Mr. X came. He left? Yes", {"N": 3, "quantifier": "at least"}, True),
        (c.LEGACY, "verify_sentence_constraint", "One. Two. Three.", {"N": 1, "quantifier": "at most"}, False),
        (c.REGISTRY, "detectable_format:sentence_hyphens", "One.-Two.", {}, True),
        (c.REGISTRY, "detectable_format:sentence_hyphens", "One. -Two.", {}, False),
        (c.REGISTRY, "count:counting_composition", "A b.***C d.***E f.", {"n_sent": 1, "n_words": 3}, True),
        (c.REGISTRY, "count:counting_composition", "A b.***C d.", {"n_sent": 1, "n_words": 3}, False),
        (c.EXTENDED, "count:counting_composition", "A b. * * * C d. *** E f.", {"n_sent": 1, "n_words": 2}, True),
        (c.UNREGISTERED, "multi-turn:constrained_start", "hi\n  Well then", {"starter": "Well"}, True),
        (c.UNREGISTERED, "keywords:key_sentences", "One. Two.", {"key_sentences": '["One.", "Six."]', "num_sentences": 1}, True),
        (c.UNREGISTERED, "detectable_format:rephrase", "a *b* c", {"original_message": "a *x* c"}, True),
        (c.UNREGISTERED, "detectable_content:rephrase_paragraph", "the cat sat", {"original_paragraph": "The cat ran", "low": 2, "high": 2}, True),
        (c.REGISTRY, "copy:repeat_phrase", "I see you. I hear you.", {"phrase": "I see you.", "small_n": 2}, True),
        (c.REGISTRY, "copy:repeat_phrase", "I see you. I see you.", {"phrase": "I see you.", "small_n": 2}, False),
    ],
)
def test_rules(spark, family, name, text, args, expected):
    assert bool(check_rule(spark, family, name, text, **args)) is expected


def test_custom_registrations(spark):
    import pandas as pd

    @F.pandas_udf("double")
    def half(texts: pd.Series) -> pd.Series:
        return texts.str.len() / 2

    v.register_verifier("Doubled", lambda s: F.length(s.prediction) * 1.0, weight=2.0)
    rows = spark.createDataFrame([("abcd", ["x"], ["DOUBLED"])], "p string, ground_truth array<string>, dataset array<string>")
    assert rewards.score_rewards(rows, v.build_verifiers(names=["doubled"]), "p", mult=1.0).first().reward == 8.0
    assert rows.select(half("p").alias("x")).first().x == 2.0
    with pytest.raises(ValueError):
        v.build_verifiers("a=missing")
    with pytest.raises(ValueError):
        transforms.register_transform("x", None, "neither")
    uneven = spark.createDataFrame([("abcd", ["x", "y"], ["doubled"])], rows.schema)
    with pytest.raises(Exception, match="lengths do not match"):
        rewards.score_rewards(uneven, v.build_verifiers(names=["doubled"]), "p").collect()


def test_group_guards(spark):
    prompts = spark.range(2).withColumnRenamed("id", "k")
    results = spark.createDataFrame([(0, 1), (0, 2), (1, 1)], "k long, s int")
    with pytest.raises(Exception, match="wrong number of samples"):
        rewards.join_rollouts(prompts, results, "k", samples=2).collect()
    cands = spark.createDataFrame([(1, i, [("user", "x")]) for i in range(5)], "k long, cand int, messages array<struct<role:string,content:string>>")
    with pytest.raises(Exception, match="more candidates"):
        preferences.pairwise_comparisons(cands, "k", 3).collect()
    assert preferences.pairwise_comparisons(cands, "k", 4).count() == 10


def test_encoder_keeps_repeated_and_null_keys(spark):
    rows = spark.createDataFrame([(1, ["a", "c", "x"]), (1, ["b"]), (None, ["c", "c", "a"]), (2, []), (3, None)], "id long, toks array<string>")
    vocabulary = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "token string, id int")
    want = [(None, [6, 6, 4]), (1, [4, 6, 3]), (1, [5]), (2, []), (3, [])]
    for head in (1000, 6, 5, 1):
        got = tokens.encode(rows, "id", {"ids": "toks"}, vocabulary, head=head).collect()
        assert sorted(((r.id, r.ids) for r in got), key=lambda r: (r[0] or 0, r[1])) == sorted(want, key=lambda r: (r[0] or 0, r[1])), head
    two = tokens.encode(rows.withColumn("more", F.reverse("toks")), "id", {"ids": "toks", "back": "more"}, vocabulary, head=5).collect()
    assert all(r.back == r.ids[::-1] for r in two)


def test_rare_tokens_leave_once_for_a_chunk(spark, monkeypatch):
    stages = []
    monkeypatch.setattr(tokens, "materialise_stage", lambda df, name: stages.append(materialise_stage(df, name)) or stages[-1])
    words = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.concat(F.lit("w"), ((F.col("id") + i) % 30).cast("string")))
    rows = spark.range(400, numPartitions=1).select("id", words.alias("toks"), F.array(F.lit("none"), F.lit(None), F.lit("w29")).alias("more"))
    vocabulary = spark.range(30).select(F.concat(F.lit("w"), "id").alias("token"), (F.col("id") - 5).cast("int").alias("id"))
    got = tokens.encode(rows, "id", {"ids": "toks", "back": "more"}, vocabulary, unknown_id=77, head=3).collect()
    assert sorted((r.id, r.ids, r.back) for r in got) == [(k, [(k + i) % 30 - 5 for i in range(20)], [77, 77, 24]) for k in range(400)]
    # 27 of the vocabulary, one that it does not hold; not one for each of 400 rows.
    assert stages[0].select(F.explode("__tokens")).count() == 28


def test_only_the_pieces_that_rules_read_are_made(spark):
    texts = spark.createDataFrame([(1, "fr", "Level one."), (2, "en", "two"), (3, None, None)], "doc_id long, lang string, t string")
    rules = {name: constraint_queries.REGISTRY_SQL[name] for name in ("keywords:palindrome", "keywords:word_once")}
    found = constraint_queries._family(None, rules, c.REGISTRY, texts)
    assert {(r.doc_id, r.rule) for r in found.collect() if r.ok} == {(1, "keywords:word_once")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # White-space words are read; neither sentences nor word tokens are.
    assert "split" in plan and "<stop>" not in plan and "[-'’]" not in plan


def test_order_with_hot_ties_and_empty_input(spark):
    rows = spark.range(1000).select("id", F.lit(1).alias("n"))
    indexed = {r.id: r["index"] for r in row_index(rows, "id").collect()}
    assert indexed == {i: i for i in range(1000)}
    assert running_by_key(rows, "id", total=F.col("n")).agg(F.max("total")).first()[0] == 1000
    assert row_index(rows.where("false"), "id").count() == 0


def test_group_advantages_mode(spark):
    with pytest.raises(ValueError):
        rewards.group_advantages(spark.range(1), "id", "id", "other")
