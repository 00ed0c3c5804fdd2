"""Every registered query against its SQL twin (scale by ORACLE_SF, default sf0.001)."""

import os

import pytest

from rollweave.plans import registry
from tests.oracle import compare, connect

ROOT = f"/root/testdata/{os.environ.get('ORACLE_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


# Queries whose filter keeps nothing at the smallest scale.
MAY_BE_EMPTY = {"sft_filter", "preference_filter", "user_query"}


@pytest.mark.parametrize("name", list(registry.load()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, ROOT, name)
    assert ok or (name in MAY_BE_EMPTY and note.startswith("0 rows")), note
