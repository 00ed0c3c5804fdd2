"""Registered queries by section of the inventory."""

from importlib import import_module

SECTIONS = (
    "source_queries",
    "message_queries",
    "mixing_queries",
    "token_queries",
    "filter_queries",
    "packing_queries",
    "reward_queries",
    "analytics_queries",
    "preference_queries",
    "judging_queries",
    "evaluation_queries",
    "constraint_queries",
    "streaming_queries",
)


def load_all() -> None:
    from importlib.util import find_spec

    for section in SECTIONS:
        name = f"rollweave.plans.{section}"
        if find_spec(name):
            import_module(name)
