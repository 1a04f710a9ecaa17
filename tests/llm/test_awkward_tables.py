"""Every operator and the pipeline over empty tables, over rows of nulls, and over repeated rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from llm_tables import empty_sf, nulls_sf, tables  # noqa: F401
from vitalake.llm import registry

NAMES = list(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, empty_sf, name):
    out = registry.queries()[name](spark, empty_sf)
    assert out.collect() == []
    assert len(out.columns) > 2


@pytest.mark.parametrize("name", NAMES)
def test_rows_of_nulls_do_not_crash(spark, nulls_sf, name):
    rows = registry.queries()[name](spark, nulls_sf).collect()
    # without letters, language ID rejects them; there are no conversations and no words
    assert len(rows) == (0 if name in ("pipeline", "op11_conversation_trie", "op12_spelling_variants") else 3)


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in NAMES if n != "pipeline"]
    assert sorted(numbers) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(NAMES)
    assert len(corpus_pipeline.STAGES) == 5
