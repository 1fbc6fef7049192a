"""Sort, limit and set operations (survey section 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators.common import T, dec, in_year
from shelfline.plans.registry import raw_query, star_query


@raw_query("sort_multi")
def sort_multi(spark, sf_dir):
    """Multi-key sort with mixed directions and an expression key."""
    t = T(spark, sf_dir)
    g = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.sum(dec("o_totalprice")).cast("double").alias("total"))
    return g.orderBy(F.col("o_orderpriority").asc(), F.col("total").desc(),
                     F.length("o_orderstatus").asc(), F.col("o_orderstatus").asc())


@raw_query("sort_topk")
def sort_topk(spark, sf_dir, k=100):
    """ORDER BY ... LIMIT k (TakeOrderedAndProject: per-task top-k, then merge)."""
    t = T(spark, sf_dir)
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice") \
        .orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(k)


@star_query("sort_nulls")
def sort_nulls(st):
    """Explicit NULLS FIRST / NULLS LAST ordering with a limit (the null
    placement decides which rows survive the limit)."""
    g = st.store_sales.groupBy("ss_store_sk", "ss_promo_sk").agg(F.count(F.lit(1)).alias("lines"))
    return g.orderBy(F.col("ss_store_sk").asc_nulls_first(), F.col("ss_promo_sk").desc_nulls_last()).limit(40)


def _nations_of(t, seg):
    return t.customer.filter(F.col("c_mktsegment") == seg).select(F.col("c_nationkey").alias("nk"))


@raw_query("set_union_all")
def set_union_all(spark, sf_dir):
    """UNION ALL keeps duplicates."""
    t = T(spark, sf_dir)
    u = _nations_of(t, "BUILDING").unionByName(t.supplier.select(F.col("s_nationkey").alias("nk")))
    return u.groupBy("nk").agg(F.count(F.lit(1)).alias("n"))


@raw_query("set_union")
def set_union(spark, sf_dir):
    """UNION (distinct)."""
    t = T(spark, sf_dir)
    return _nations_of(t, "BUILDING").unionByName(_nations_of(t, "MACHINERY")).distinct()


def _parts_shipped(t, year):
    return t.lineitem.filter(in_year("l_shipdate", year)).select("l_partkey")


@raw_query("set_intersect")
def set_intersect(spark, sf_dir):
    """INTERSECT (distinct, null-safe): parts shipped in both years."""
    t = T(spark, sf_dir)
    return _parts_shipped(t, 1996).intersect(_parts_shipped(t, 1997))


@raw_query("set_except")
def set_except(spark, sf_dir):
    """EXCEPT (distinct): parts shipped in one year but not the next."""
    t = T(spark, sf_dir)
    return _parts_shipped(t, 1996).subtract(_parts_shipped(t, 1997))
