"""Window operators (survey section 2.7).

Each window runs over an aggregate (one row per key x period), so a window
partition holds at most one row per period of a key. Global ranks run over
per-entity aggregates whose size is bounded by the entity count.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions.grouping import rollup
from shelfline.operators.common import B, T, dec, in_year, year_of
from shelfline.plans.registry import raw_query


def _brand_part_revenue(t):
    j = t.lineitem.join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("p_type", "p_brand", "p_partkey").agg(F.sum(dec("l_extendedprice")).cast("double").alias("rev"))


@raw_query("win_share")
def win_share(spark, sf_dir):
    """Share of partition total over an aggregate: sum(sum(x)) over (partition by type)."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    g = j.groupBy("p_type", "p_brand").agg(F.sum(dec("l_extendedprice")).alias("rev"))
    w = Window.partitionBy("p_type")
    return g.select("p_type", "p_brand", F.col("rev").cast("double").alias("revenue"),
                    (F.col("rev").cast("double") * 100 / F.sum("rev").over(w).cast("double")).alias("share"))


@raw_query("win_avg")
def win_avg(spark, sf_dir, year=1997):
    """avg(sum(x)) over (partition by nation): monthly revenue vs. the nation's average month."""
    t = T(spark, sf_dir)
    j = (t.lineitem.filter(in_year("l_shipdate", year))
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    g = j.groupBy("s_nationkey", F.month(F.to_date("l_shipdate")).alias("mon")).agg(F.sum(dec("l_extendedprice")).alias("rev"))
    w = Window.partitionBy("s_nationkey")
    return g.select("s_nationkey", "mon", F.col("rev").cast("double").alias("revenue"),
                    (F.sum("rev").over(w).cast("double") / F.count("rev").over(w)).alias("avg_month"))


@raw_query("win_rank")
def win_rank(spark, sf_dir):
    """rank() within a partition."""
    g = _brand_part_revenue(T(spark, sf_dir))
    return g.select("p_brand", "p_partkey", "rev", F.rank().over(Window.partitionBy("p_brand").orderBy(F.desc("rev"))).alias("rk"))


@raw_query("win_rank_global")
def win_rank_global(spark, sf_dir):
    """rank() over the whole (pre-aggregated, nation-sized) input."""
    t = T(spark, sf_dir)
    g = (t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .groupBy("s_nationkey").agg(F.sum(dec("l_extendedprice")).cast("double").alias("rev")))
    return g.select("s_nationkey", "rev", F.rank().over(Window.orderBy(F.desc("rev"))).alias("rk"))


@raw_query("win_rank_rollup")
def win_rank_rollup(spark, sf_dir):
    """Rank within a roll-up level and parent (grouping() in PARTITION BY)."""
    t = T(spark, sf_dir)
    j = (t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(B(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(B(t.region), F.col("n_regionkey") == F.col("r_regionkey")))
    g = rollup(j, ["r_name", "n_name"], [F.sum(dec("l_extendedprice")).cast("double").alias("rev"),
                                         (F.grouping("r_name") + F.grouping("n_name")).cast("int").alias("lvl"),
                                         F.grouping("n_name").alias("g_n")])
    w = Window.partitionBy("lvl", F.when(F.col("g_n") == 0, F.col("r_name"))).orderBy(F.desc("rev"))
    return g.select("r_name", "n_name", "lvl", "rev", F.rank().over(w).alias("rank_within_parent"))


@raw_query("win_running_sum")
def win_running_sum(spark, sf_dir):
    """Running sum with ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW."""
    t = T(spark, sf_dir)
    g = t.orders.groupBy("o_custkey", year_of("o_orderdate").alias("yr")).agg(F.sum(dec("o_totalprice")).alias("spend"))
    w = Window.partitionBy("o_custkey").orderBy("yr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.select("o_custkey", "yr", F.sum("spend").over(w).cast("double").alias("cume_spend"))


@raw_query("win_running_max")
def win_running_max(spark, sf_dir):
    """Running maximum over the same frame."""
    t = T(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.orders.select("o_custkey", "o_orderkey", F.max("o_totalprice").over(w).alias("max_so_far"))


@raw_query("win_row_number")
def win_row_number(spark, sf_dir):
    """row_number(): each customer's first order."""
    t = T(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = t.orders.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
    return o.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("first_order_date"))


@raw_query("win_lag_lead")
def win_lag_lead(spark, sf_dir):
    """lag/lead: nation revenue with the previous and next year."""
    t = T(spark, sf_dir)
    g = (t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .groupBy("s_nationkey", year_of("l_shipdate").alias("yr")).agg(F.sum(dec("l_extendedprice")).cast("double").alias("rev")))
    w = Window.partitionBy("s_nationkey").orderBy("yr")
    return g.select("s_nationkey", "yr", "rev", F.lag("rev").over(w).alias("prev_rev"), F.lead("rev").over(w).alias("next_rev"))


@raw_query("win_topn")
def win_topn(spark, sf_dir, n=3):
    """Top-N per group (rank filter, planned as WindowGroupLimit)."""
    g = _brand_part_revenue(T(spark, sf_dir))
    w = Window.partitionBy("p_brand").orderBy(F.desc("rev"))
    return g.withColumn("rk", F.rank().over(w)).filter(F.col("rk") <= n).select("p_brand", "p_partkey", "rev", "rk")
