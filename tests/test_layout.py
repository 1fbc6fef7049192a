"""The date-partitioned fact layout (cluster layout) answers like the flat
one, and a query that joins a filtered date_dim prunes fact partitions
dynamically."""

import pytest

import __spark_entry__ as E
from tests.compare import compare
from tests.conftest import SF_SMALL

KEYS = ["q03", "q22", "q72", "q05a", "q14a", "q02"]
CONF = "spark.shelfline.star.partitionFactsByDate"


@pytest.fixture()
def partitioned(spark):
    spark.conf.set(CONF, "true")
    try:
        yield spark
    finally:
        spark.conf.unset(CONF)


@pytest.mark.parametrize("key", KEYS)
def test_partitioned_layout_matches_oracle(partitioned, duck_small, key):
    df = E.queries()[key](partitioned, SF_SMALL)
    assert compare(df, duck_small, E.oracle_sql()[key]) is None


def test_partitioned_layout_prunes_by_date(partitioned):
    df = E.queries()["q03"](partitioned, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet [ss_" in ln]
    assert scans and all("dynamicpruningexpression" in ln for ln in scans)


def test_rebuild_removes_the_copy_it_replaces(spark, tmp_path):
    import os

    from shelfline.plans.star import load_star
    old = load_star(spark, SF_SMALL, rebuild=True).root.removeprefix("file:")
    new = load_star(spark, SF_SMALL, rebuild=True).root.removeprefix("file:")
    assert old != new and os.path.isdir(new) and not os.path.exists(old)


def test_fact_tasks_follow_the_data(spark):
    from shelfline.plans.star import StarBuilder, _fact_tasks
    b = StarBuilder(spark, SF_SMALL)
    assert _fact_tasks(b, "store_sales", 1 << 20, 200) == 8
    assert _fact_tasks(b, "store_sales", 100 << 40, 200) > 1_000_000
    assert _fact_tasks(b, "inventory", 0, 20_000_000_000) > 1_000_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["agg_global", "join_star", "win_avg"])
def test_year_filters_reach_the_scan(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_q84_counts_returns_before_the_join(spark):
    plan = _plan(E.queries()["q84"](spark, SF_SMALL))
    assert "count(1)" in plan and "Generate explode" in plan
