"""Every registered query with an oracle equals DuckDB at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from interlens.plans import catalog
from oracle_harness import compare, duck

from conftest import SF01

_CON = {}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_duckdb(spark, name):
    con = _CON.setdefault("c", duck(SF01))
    r = compare(spark, name, SF01, con)
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["cols_match"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and 0 <= rows[0].precision_at_k <= 1


def test_every_query_has_sql():
    """All of the library's own queries; the training-data ones are tested in tests/llm."""
    from interlens.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
