"""Named transforms and their chain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators import filters, tokens
from rollweave.operators.messages import prune_columns
from rollweave.operators.mixing import config_hash, step_fingerprint
from rollweave.sources.publish import build_table, published_table, read_record

TRANSFORMS: dict[str, tuple[Callable, str]] = {}


def register_transform(name: str, fn: Callable, kind: str) -> None:
    """L1: ``map`` takes (df, tokenizer, key, **args) and returns a table, ``filter`` takes
    (df, tokenizer, **args) and returns a condition."""
    if kind not in ("map", "filter"):
        raise ValueError(f"unknown transform kind: {kind}")
    TRANSFORMS[name] = (fn, kind)


def _renamed(kwargs: dict) -> dict:
    names = {"max_seq_length": "max_length", "sft_messages_key": "messages", "chosen_key": "chosen", "rejected_key": "rejected", "system_prompt_override": "system_prompt"}
    return {names.get(k, k): v for k, v in kwargs.items()}


def _map(fn: Callable, **fixed) -> Callable:
    return lambda df, tok, key, **args: fn(df, tok, key, **fixed, **_renamed(args))


def _limits(fn: Callable[..., Column]) -> Callable:
    def condition(df, tok, max_prompt_token_length=None, max_token_length=None, **args):
        return fn(max_prompt_token_length, max_token_length, **args)

    return condition


register_transform("sft_tokenize_v1", _map(tokens.tokenize_sft), "map")
register_transform("sft_tokenize_mask_out_prompt_v1", _map(tokens.tokenize_sft_masked), "map")
register_transform("sft_filter_v1", lambda df, tok, max_prompt_token_length=None, max_token_length=None, need_contain_labels=True: filters.sft_ok(max_prompt_token_length, max_token_length, need_contain_labels), "filter")
register_transform("sft_assistant_tokenize_and_truncate_v1", _map(tokens.tokenize_assistant_only), "map")
register_transform("sft_assistant_filter_v1", lambda df, tok: filters.has_labels("labels"), "filter")
register_transform("preference_tokenize_v1", _map(tokens.tokenize_preference, mode="plain"), "map")
register_transform("preference_filter_v1", _limits(filters.preference_ok), "filter")
register_transform("preference_last_turn_tokenize_and_truncate_v1", _map(tokens.tokenize_preference, mode="last"), "map")
register_transform("preference_trainable_filter_v1", lambda df, tok: filters.preference_trainable(), "filter")
register_transform("rlvr_tokenize_v1", _map(tokens.tokenize_rlvr, version=3), "map")
register_transform("rlvr_max_length_filter_v1", lambda df, tok, max_prompt_token_length=None: filters.within("input_ids_prompt", max_prompt_token_length), "filter")


def run_transforms(df: DataFrame, steps: list[str], args: list[dict], tokenizer, key: str, target: list[str] | None = None) -> DataFrame:
    """The steps in order, as one lazy plan; maps are narrowed to the target columns."""
    if len(steps) != len(args):
        raise ValueError(f"steps and arguments differ in length: {steps} {args}")
    for name, kwargs in zip(steps, args):
        df = _step(df, name, kwargs, tokenizer, key, target)
    return df


def _step(df: DataFrame, name: str, kwargs: dict, tokenizer, key: str, target: list[str] | None) -> DataFrame:
    fn, kind = TRANSFORMS[name]
    if kind == "map":
        return prune_columns(fn(df, tokenizer, key, **kwargs), target)
    return df.where(F.coalesce(fn(df, tokenizer, **kwargs), F.lit(False)))


def run_cached_transforms(
    df: DataFrame, steps: list[str], args: list[dict], tokenizer, key: str, root: str, source: dict, target: list[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """The steps in order, each one's table kept under the fingerprint of its whole lineage.

    ``source`` is what tells the input and the tokenizer apart (names, revisions, settings); a step's
    fingerprint chains on the one before it. Work begins behind the last step whose table is there, so a
    changed step reruns itself and what follows. Returns the table and the names of the steps that ran.
    """
    if len(steps) != len(args):
        raise ValueError(f"steps and arguments differ in length: {steps} {args}")
    spark, prints, ran = df.sparkSession, [config_hash(source)], []
    for name, kwargs in zip(steps, args):
        prints.append(step_fingerprint(prints[-1], name, {"args": kwargs, "target": target, "key": key}))
    there = next((k for k in range(len(steps), 0, -1) if read_record(spark, f"{root}/{prints[k]}.json")), 0)
    out = published_table(spark, root, prints[there]) if there else df
    for k in range(there, len(steps)):
        step = _step(out, steps[k], args[k], tokenizer, key, target)
        out = build_table(spark, root, prints[k + 1], lambda step=step: step, step=steps[k], after=prints[k])
        ran.append(steps[k])
    return out, ran
