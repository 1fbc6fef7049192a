"""Scalar functions (survey section 2.9), all built-in Catalyst expressions.

Each showcase groups by the function's result so the output stays small
while every input row is evaluated.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators.common import T
from shelfline.plans.registry import raw_query


@raw_query("fn_substr")
def fn_substr(spark, sf_dir):
    t = T(spark, sf_dir)
    return t.part.groupBy(F.substring("p_name", 1, 3).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@raw_query("fn_concat")
def fn_concat(spark, sf_dir):
    t = T(spark, sf_dir)
    k = F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type"))
    return t.part.groupBy(k.alias("brand_type")).agg(F.count(F.lit(1)).alias("n"))


@raw_query("fn_upper")
def fn_upper(spark, sf_dir):
    t = T(spark, sf_dir)
    return t.part.groupBy(F.upper(F.split("p_name", " ").getItem(1)).alias("noun")).agg(F.count(F.lit(1)).alias("n"))


@raw_query("fn_coalesce")
def fn_coalesce(spark, sf_dir):
    """coalesce over a left join's NULLs and nullif on a zero."""
    t = T(spark, sf_dir)
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    j = t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    n = F.coalesce(F.col("n_orders"), F.lit(0))
    return j.groupBy(n.alias("n_orders")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.nullif(n, F.lit(0))).alias("nonzero"))


@raw_query("fn_math")
def fn_math(spark, sf_dir):
    """abs, round (half-up on exact decimals) and arithmetic."""
    t = T(spark, sf_dir)
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    return t.customer.groupBy(F.round(bal / 1000, 0).cast("int").alias("k_bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(bal)).cast("double").alias("sum_abs"),
        F.max(F.round(bal * F.lit(1.1).cast("decimal(2,1)"), 1)).cast("double").alias("max_scaled"))


@raw_query("fn_cast")
def fn_cast(spark, sf_dir):
    """Casts between decimal, integer, string and date."""
    t = T(spark, sf_dir)
    o = t.orders.select(F.to_date("o_orderdate").cast("string").substr(1, 4).cast("int").alias("yr"),
                        F.col("o_totalprice").cast("decimal(12,2)").alias("tp"))
    return o.groupBy("yr").agg(F.sum("tp").cast("double").alias("total"), F.count(F.lit(1)).alias("n"))


@raw_query("fn_date_add")
def fn_date_add(spark, sf_dir, days=30):
    """date + n days, date BETWEEN."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    od = F.to_date("o_orderdate")
    within = F.to_date("l_shipdate").between(od, F.date_add(od, days))
    return j.groupBy(F.year(F.date_add(od, days)).alias("due_year")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.when(within, 1).otherwise(0)).alias("on_time"))


@raw_query("fn_date_diff")
def fn_date_diff(spark, sf_dir):
    """Date difference in days."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    d = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return j.groupBy(F.signum(d).cast("int").alias("sign")).agg(
        F.count(F.lit(1)).alias("lines"), F.min(d).alias("min_days"), F.max(d).alias("max_days"),
        F.sum(d.cast("long")).alias("sum_days"))


@raw_query("fn_case")
def fn_case(spark, sf_dir):
    """Searched and simple CASE."""
    t = T(spark, sf_dir)
    searched = (F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 40, "medium").otherwise("large"))
    simple = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "accepted") \
        .otherwise("none")
    return t.lineitem.groupBy(searched.alias("size"), simple.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@raw_query("fn_lit")
def fn_lit(spark, sf_dir):
    """Literal/constant columns in a union of tagged branches."""
    t = T(spark, sf_dir)
    a = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nk"), "n", F.lit(1).alias("weight"))
    b = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nk"), "n", F.lit(2).alias("weight"))
    return a.unionByName(b)


