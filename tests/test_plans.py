"""Plans: demographics are cut before they are joined, q95 compares the warehouses of its own orders only."""

import pytest

from shelfline.plans.registry import load_all
from tests.conftest import SF_SMALL


def plan(spark, key):
    return load_all()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["q13", "q48", "q85"])
def test_demographics_are_sent_filtered(spark, key):
    lines = plan(spark, key).splitlines()
    scans = [x for x in lines if "cd_marital_status" in x and "FileScan" in x]
    assert scans and all("PushedFilters: [IsNotNull" in x or "Or(" in x for x in scans)
    joins = [x for x in lines if "SortMergeJoin" in x and ("cd_demo_sk" in x or "cd1_sk" in x or "cd2_sk" in x)]
    assert not joins


def test_q95_reduces_first(spark):
    p = plan(spark, "q95")
    # web_sales is read for the filtered lines (once for them, once for their orders' lines), never grouped whole and joined twice
    assert p.count("HashAggregate(keys=[ws_order_number") <= 4
