"""grouping_levels (UNION ALL of GROUP BY levels as one grouping-sets
aggregate) against the literal UNION ALL, on driver data and on empty input."""

from pyspark.sql import functions as F

from shelfline.functions.grouping import grouping_levels
from shelfline.sources.tables import read_table
from tests.conftest import SF_SMALL

KEYS = ["o_orderstatus", "o_orderpriority"]
LEVELS = [KEYS, KEYS[:1], []]


def _aggs():
    return [F.sum("o_totalprice").alias("total"), F.count("o_custkey").alias("n")]


def _union_all(df):
    parts = []
    for lv in LEVELS:
        g = df.groupBy(*lv).agg(*_aggs())
        parts.append(g.select(*[F.col(k) if k in lv else F.lit(None).cast("string").alias(k) for k in KEYS],
                              "total", "n"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_levels_equal_union_all(spark):
    od = read_table(spark, SF_SMALL, "orders")
    got = grouping_levels(od, KEYS, LEVELS, _aggs())
    assert got.columns == KEYS + ["total", "n"]
    assert _same(got, _union_all(od))


def test_empty_input_keeps_grand_total(spark):
    od = read_table(spark, SF_SMALL, "orders").filter(F.col("o_orderkey") < 0)
    rows = grouping_levels(od, KEYS, LEVELS, _aggs()).collect()
    assert len(rows) == 1
    assert rows[0]["o_orderstatus"] is None and rows[0]["total"] is None and rows[0]["n"] == 0
    assert _same(grouping_levels(od, KEYS, LEVELS, _aggs()), _union_all(od))


def test_levels_without_total_need_no_sentinel(spark):
    od = read_table(spark, SF_SMALL, "orders")
    got = grouping_levels(od, KEYS, LEVELS[:2], _aggs())
    assert got.count() == _union_all(od).filter(F.col("o_orderstatus").isNotNull()).count()
