"""Aggregation operators (survey section 2.6).

All aggregates are declarative ``groupBy/rollup().agg()``: Spark plans a
partial (map-side) aggregate before the shuffle, so a hot group key costs
one partial row per task rather than all of its raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.grouping import rollup
from shelfline.functions.money import avg_exact, stddev_samp_exact
from shelfline.operators.common import B, T, dec, dsum, revenue, in_year, year_of
from shelfline.plans.registry import raw_query

AGG_ALLOWED = {"sum": F.sum, "avg": avg_exact, "min": F.min, "max": F.max, "count": F.count}


@raw_query("agg_basic")
def agg_basic(spark, sf_dir, ship_before="1998-09-02"):
    """sum/avg/count per group (pricing summary report shape)."""
    t = T(spark, sf_dir)
    li = t.lineitem.filter(F.to_date("l_shipdate") <= F.lit(ship_before).cast("date"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"), dsum("l_extendedprice", "sum_base_price"),
        F.sum(revenue()).cast("double").alias("sum_disc_price"),
        avg_exact(F.col("l_quantity").cast("long")).alias("avg_qty"),
        avg_exact(dec("l_extendedprice")).alias("avg_price"),
        avg_exact(F.col("l_discount").cast("decimal(4,2)")).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"))


@raw_query("agg_global")
def agg_global(spark, sf_dir, year=1996):
    """Aggregate without keys."""
    t = T(spark, sf_dir)
    li = t.lineitem.filter(in_year("l_shipdate", year))
    return li.agg(F.count(F.lit(1)).alias("lines"), F.sum(revenue()).cast("double").alias("revenue"),
                  F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"))


@raw_query("agg_count_distinct")
def agg_count_distinct(spark, sf_dir):
    """COUNT(DISTINCT) per group."""
    t = T(spark, sf_dir)
    j = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_nationkey").agg(F.countDistinct("o_custkey").alias("customers"),
                                        F.count(F.lit(1)).alias("orders"))


@raw_query("agg_stddev")
def agg_stddev(spark, sf_dir):
    """Sample standard deviation and coefficient of variation of quantity per brand."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    q = F.col("l_quantity").cast("long")
    sd, av = stddev_samp_exact(q), avg_exact(q)
    return j.groupBy("p_brand").agg(sd.alias("stdev"), av.alias("mean"), (sd / av).alias("cov"))


@raw_query("agg_pivot")
def agg_pivot(spark, sf_dir, years=(1995, 1996, 1997, 1998)):
    """Pivot: revenue per region with one column per year."""
    t = T(spark, sf_dir)
    j = (t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(B(t.nation.select("n_nationkey", "n_regionkey")), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(B(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
         .withColumn("yr", year_of("l_shipdate")).withColumn("rev", dec("l_extendedprice")))
    p = j.groupBy("r_name").pivot("yr", list(years)).agg(F.sum("rev").cast("double"))
    return p.select("r_name", *[F.col(str(y)).alias(f"y{y}") for y in years])


@raw_query("agg_buckets")
def agg_buckets(spark, sf_dir):
    """Conditional counts: shipping-latency buckets per order priority."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate"),
                        F.col("l_orderkey") == F.col("o_orderkey"))
    lag = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return j.groupBy("o_orderpriority").agg(
        F.sum(F.when(lag < 0, 1).otherwise(0)).alias("before_order"),
        F.sum(F.when((lag >= 0) & (lag <= 30), 1).otherwise(0)).alias("days_0_30"),
        F.sum(F.when((lag > 30) & (lag <= 120), 1).otherwise(0)).alias("days_31_120"),
        F.sum(F.when(lag > 120, 1).otherwise(0)).alias("days_over_120"))


@raw_query("agg_having")
def agg_having(spark, sf_dir, fraction=0.01):
    """HAVING against a scalar subquery: suppliers above 1% of total revenue."""
    t = T(spark, sf_dir)
    per = t.lineitem.groupBy("l_suppkey").agg(F.sum(dec("l_extendedprice")).alias("value"))
    # the total is the sum of the groups: one scan, whose exchange both sides use
    total = per.agg((F.sum("value").cast("double") * fraction).alias("limit_"))
    return per.crossJoin(F.broadcast(total)).filter(F.col("value").cast("double") > F.col("limit_")) \
        .select("l_suppkey", F.col("value").cast("double").alias("value"))


def _nation_revenue(t):
    return (t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(B(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(B(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("r_name", "n_name", dec("l_extendedprice").alias("rev")))


@raw_query("agg_rollup")
def agg_rollup(spark, sf_dir):
    """ROLLUP(region, nation)."""
    j = _nation_revenue(T(spark, sf_dir))
    return rollup(j, ["r_name", "n_name"], [F.sum("rev").cast("double").alias("revenue"),
                                            F.count("rev").alias("lines")])


@raw_query("agg_grouping")
def agg_grouping(spark, sf_dir):
    """GROUPING() flags and level arithmetic on a ROLLUP."""
    j = _nation_revenue(T(spark, sf_dir))
    return rollup(j, ["r_name", "n_name"], [
        F.sum("rev").cast("double").alias("revenue"),
        F.grouping("r_name").cast("int").alias("g_region"), F.grouping("n_name").cast("int").alias("g_nation"),
        (F.grouping("r_name") + F.grouping("n_name")).cast("int").alias("lvl"),
        F.grouping_id("r_name", "n_name").cast("int").alias("gid")])


@raw_query("agg_rollup_union")
def agg_rollup_union(spark, sf_dir):
    """The same ROLLUP written as a UNION ALL of three GROUP BYs."""
    j = _nation_revenue(T(spark, sf_dir))
    a = j.groupBy("r_name", "n_name").agg(F.sum("rev").cast("double").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    b = j.groupBy("r_name").agg(F.sum("rev").cast("double").alias("revenue"), F.count(F.lit(1)).alias("lines")) \
        .select("r_name", F.lit(None).cast("string").alias("n_name"), "revenue", "lines")
    c = j.agg(F.sum("rev").cast("double").alias("revenue"), F.count(F.lit(1)).alias("lines")) \
        .select(F.lit(None).cast("string").alias("r_name"), F.lit(None).cast("string").alias("n_name"), "revenue", "lines")
    return a.unionByName(b).unionByName(c)


@raw_query("agg_distinct")
def agg_distinct(spark, sf_dir):
    """DISTINCT rows / GROUP BY without aggregates."""
    t = T(spark, sf_dir)
    j = t.customer.join(t.orders.select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return j.select("c_nationkey", "c_mktsegment").distinct()


@raw_query("agg_two_level")
def agg_two_level(spark, sf_dir):
    """Aggregate of an aggregate: average and maximum per-customer spend per segment."""
    t = T(spark, sf_dir)
    per = (t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
           .groupBy("c_mktsegment", "o_custkey").agg(F.sum(dec("o_totalprice")).alias("spend")))
    return per.groupBy("c_mktsegment").agg(avg_exact("spend").alias("avg_spend"),
                                           F.max("spend").cast("double").alias("max_spend"))


@raw_query("agg_param")
def agg_param(spark, sf_dir, agg="max"):
    """Aggregate function chosen by a parameter from an allow-list."""
    if agg not in AGG_ALLOWED:
        raise ValueError(f"aggregate {agg!r} not in {sorted(AGG_ALLOWED)}")
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("p_brand").agg(AGG_ALLOWED[agg](dec("l_extendedprice")).cast("double").alias("value"))


@raw_query("agg_multi_filter")
def agg_multi_filter(spark, sf_dir):
    """Several filtered aggregates side by side in one pass."""
    t = T(spark, sf_dir)
    d = F.col("l_discount")
    return t.lineitem.agg(
        F.count(F.when(d < 0.03, 1)).alias("low_disc"), F.count(F.when(d.between(0.03, 0.07), 1)).alias("mid_disc"),
        F.count(F.when(d > 0.07, 1)).alias("high_disc"),
        F.sum(F.when(F.col("l_returnflag") == "R", dec("l_extendedprice"))).cast("double").alias("returned_value"),
        F.countDistinct(F.when(F.col("l_quantity") > 45, F.col("l_partkey"))).alias("parts_big_qty"))
