"""Every registered query equals its DuckDB oracle (small scale).

The driver repeats this at sf0.01; tools/check.py runs it at any scale.
"""

import pytest

import __spark_entry__ as E
from oracle import all_sql
from shelfline.plans.registry import load_all
from tests.compare import compare
from tests.conftest import SF_SMALL

QUERIES = load_all()
ORACLE = all_sql()


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert compare(df, duck_small, ORACLE[key]) is None


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["d_year", "brand_id", "brand", "sum_agg"]
    df.collect()
