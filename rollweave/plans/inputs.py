"""Roles of the standard tables: messages, preference pairs, rollouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollweave.operators.messages import as_column, message, turns_to_messages


def messages(t) -> DataFrame:
    return turns_to_messages(t.conversations)


def flat(col: str | Column) -> Column:
    return F.array_join(F.transform(as_column(col), lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def preference_pairs(t) -> DataFrame:
    """Prompt = turns before the last assistant turn, chosen = that turn, rejected = the first one."""
    msgs = messages(t).withColumn(
        "spots",
        F.filter(F.sequence(F.lit(0), F.size("messages") - 1), lambda i: F.get("messages", i)["role"] == "assistant"),
    )
    pairs = msgs.where(F.size("spots") >= 2).select(
        "conv_id",
        F.slice("messages", 1, F.element_at("spots", -1)).alias("prompt"),
        F.get("messages", F.element_at("spots", -1))["content"].alias("good"),
        F.get("messages", F.element_at("spots", 1))["content"].alias("bad"),
    )
    return pairs.select(
        "*",
        F.concat("prompt", F.array(message("assistant", "good"))).alias("chosen"),
        F.concat("prompt", F.array(message("assistant", "bad"))).alias("rejected"),
    )


ROLLOUT_ORDER = (
    "l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


def rollouts(t) -> DataFrame:
    """Line items as samples of their order; the test data has no unique line key to use instead."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ROLLOUT_ORDER)) - 1
    return t.lineitem.select(
        F.col("l_orderkey").alias("prompt_id"),
        number.alias("sample"),
        F.col("l_quantity").alias("reward"),
        F.col("l_extendedprice").alias("tokens"),
        F.col("l_suppkey").alias("model"),
        F.col("l_linenumber").alias("line"),
        F.col("l_discount").alias("d"),
        F.col("l_tax").alias("t"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def joined(ids: str | Column) -> Column:
    return F.array_join(as_column(ids).cast("array<string>"), " ")


def tokenizer(t, template: str = "role_tags"):
    """Vocabulary over the rendered conversations, stored once in the shared folder."""
    from rollweave.operators.render import render
    from rollweave.operators.tokens import Tokenizer, build_vocabulary, tokens_of
    from rollweave.session import materialise_stage

    corpus = messages(t).select(tokens_of(render("messages", template)).alias("toks"))
    return Tokenizer(materialise_stage(build_vocabulary(corpus, "toks"), "vocabulary"), template)
