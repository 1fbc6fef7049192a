"""Filters and subquery predicates (survey section 2.5).

Scalar subqueries become one-row aggregates joined (broadcast: 1 row) to
the outer query; correlated aggregates become a grouped aggregate joined
back on the correlation key; nested IN becomes chained semi joins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.money import avg_exact
from shelfline.operators.common import T, dec, dsum
from shelfline.plans.registry import raw_query, star_query


@raw_query("filter_predicates")
def filter_predicates(spark, sf_dir):
    """Range, IN-list, equality and boolean combinations, pushed to the scan."""
    t = T(spark, sf_dir)
    li = t.lineitem.filter(
        F.col("l_quantity").between(10, 30) & F.col("l_returnflag").isin("A", "R")
        & ((F.col("l_discount") >= 0.05) | (F.col("l_tax") == 0.0)) & ~(F.col("l_linestatus") == "O"))
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), dsum("l_extendedprice", "price"))


@raw_query("filter_like")
def filter_like(spark, sf_dir, prefix="blue"):
    """LIKE prefix match."""
    t = T(spark, sf_dir)
    p = t.part.filter(F.col("p_name").like(f"{prefix}%"))
    return p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


@star_query("filter_null")
def filter_null(st):
    """IS NULL / IS NOT NULL over nullable foreign keys of store sales."""
    ss = st.store_sales
    return ss.groupBy(F.col("ss_store_sk").isNull().alias("store_missing")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("ss_customer_sk").isNull(), 1).otherwise(0)).alias("customer_missing"),
        F.sum(F.when(F.col("ss_promo_sk").isNotNull(), 1).otherwise(0)).alias("promo_present"))


@raw_query("subq_scalar")
def subq_scalar(spark, sf_dir):
    """Uncorrelated scalar subquery: orders above the overall average total."""
    t = T(spark, sf_dir)
    avg = t.orders.agg(avg_exact(dec("o_totalprice")).alias("avg_total"))
    o = t.orders.crossJoin(F.broadcast(avg)).filter(dec("o_totalprice").cast("double") > F.col("avg_total"))
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))


@raw_query("subq_corr_agg")
def subq_corr_agg(spark, sf_dir, factor=1.5):
    """Correlated aggregate: lines whose quantity exceeds 1.5x the part's average."""
    t = T(spark, sf_dir)
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("a_part")).agg(
        (F.lit(factor) * (F.sum(F.col("l_quantity").cast("long")).cast("double") / F.count("l_quantity"))).alias("lim"))
    j = t.lineitem.join(per_part, (F.col("l_partkey") == F.col("a_part")) & (F.col("l_quantity") > F.col("lim")))
    return j.agg(F.count(F.lit(1)).alias("lines"), dsum("l_extendedprice", "price"))


@raw_query("subq_corr_count")
def subq_corr_count(spark, sf_dir):
    """Correlated COUNT(*) > 0 with OR-ed conditions: a semi join."""
    t = T(spark, sf_dir)
    hit = t.lineitem.filter((F.col("l_discount") >= 0.09) & (F.col("l_quantity") > 45)
                            | (F.col("l_tax") == 0.0) & (F.col("l_returnflag") == "R")).select("l_partkey")
    p = t.part.join(hit, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"))


@raw_query("subq_nested_in")
def subq_nested_in(spark, sf_dir):
    """Nested IN subqueries as chained semi joins."""
    t = T(spark, sf_dir)
    li = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select("l_orderkey")
    o = t.orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_custkey")
    c = t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@raw_query("subq_case")
def subq_case(spark, sf_dir, thresholds=(11000, 13000, 11500, 12500, 12000)):
    """CASE over scalar subqueries, computed as one conditional-aggregate pass."""
    t = T(spark, sf_dir)
    aggs, sel = [], []
    for b in range(5):
        inb = F.col("l_quantity").between(10 * b + 1, 10 * b + 10)
        aggs += [F.count(F.when(inb, 1)).alias(f"c{b}"),
                 avg_exact(F.when(inb, F.col("l_discount").cast("decimal(4,2)"))).alias(f"d{b}"),
                 avg_exact(F.when(inb, F.col("l_tax").cast("decimal(4,2)"))).alias(f"t{b}")]
        sel.append(F.when(F.col(f"c{b}") > thresholds[b], F.col(f"d{b}")).otherwise(F.col(f"t{b}")).alias(f"bucket{b + 1}"))
    return t.lineitem.agg(*aggs).select(*sel)


@raw_query("cte_reuse")
def cte_reuse(spark, sf_dir):
    """A CTE referenced twice (per-customer spend; customers above 2x the mean)."""
    t = T(spark, sf_dir)
    spend = t.orders.groupBy("o_custkey").agg(F.sum(dec("o_totalprice")).alias("spend"))
    mean = spend.agg(avg_exact("spend").alias("mean_spend"))
    j = spend.crossJoin(F.broadcast(mean)).filter(F.col("spend").cast("double") > 2 * F.col("mean_spend"))
    return j.select("o_custkey", F.col("spend").cast("double").alias("spend")).orderBy(F.desc("spend"), "o_custkey").limit(100)


@raw_query("filter_guarded_ratio")
def filter_guarded_ratio(spark, sf_dir, min_ratio=0.3):
    """Guarded ratio filter: CASE WHEN total > 0 THEN returned / total END."""
    t = T(spark, sf_dir)
    g = t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long")).otherwise(0)).alias("ret_qty"),
        F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    ratio = F.when(F.col("qty") > 0, F.col("ret_qty") / F.col("qty"))
    return g.filter(ratio > min_ratio).select("l_partkey", "ret_qty", "qty", ratio.alias("ratio"))


