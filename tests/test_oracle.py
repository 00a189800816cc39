"""Every registered query against its DuckDB oracle on sf0.001 (exact values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, as_multiset, df_multiset
from txlake.plans import registry

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["block_number", "total_gas_used", "utilization"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got_cols, got = df_multiset(QUERIES[name](spark, SF_SMALL))
    res = duck.execute(ORACLE[name])
    want_cols, want = as_multiset([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want
