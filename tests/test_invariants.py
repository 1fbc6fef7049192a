"""Invariants of the built star schema (pricing identities, return split,
key integrity, rollup totals)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_CHECK


def _q(spark, key):
    return E.queries()[key](spark, SF_CHECK)


def test_pricing_identities_hold(spark):
    assert _q(spark, "sales_pricing").agg(F.sum("violations")).first()[0] == 0


def test_return_refund_split_adds_up(spark):
    r = _q(spark, "returns_from_sales").agg(F.sum("split_violations"), F.sum("qty_violations")).first()
    assert r[0] == 0 and r[1] == 0


def test_primary_keys_unique(spark):
    assert _q(spark, "dq_pk").agg(F.sum("duplicate_rows")).first()[0] == 0


def test_no_foreign_key_orphans(spark):
    assert _q(spark, "dq_fk").agg(F.sum("orphans")).first()[0] == 0


def test_rollup_total_equals_sum_of_leaves(spark):
    g = _q(spark, "agg_rollup")
    total = g.filter("r_name IS NULL").first()["revenue"]
    leaves = g.filter("n_name IS NOT NULL").agg(F.sum("revenue")).first()[0]
    assert abs(total - leaves) < 1e-6 * max(1.0, abs(total))


def test_orders_explode_items_unique_per_order(spark):
    assert _q(spark, "orders_explode").filter("lines != distinct_pairs").count() == 0
