"""Join operators (survey section 2.4) as small jobs over the driver tables.

Strategy notes
--------------
* Dimension-sized sides that are bounded by construction (nation, region)
  carry a broadcast hint. Sides that grow with the data (part, customer,
  orders) are left to the planner: the size threshold broadcasts them when
  they are small and AQE turns a sort-merge join into a broadcast join at
  runtime when a filtered side turns out small; otherwise both sides are
  shuffled on the key.
* Existence tests are semi/anti joins; "another row of the same group with
  a different value" is answered from a per-group min/max, never from
  emitting pairs.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions.money import avg_exact
from shelfline.operators.common import B, T, dec, dsum, revenue, in_year, year_of
from shelfline.plans.registry import raw_query, star_query


@raw_query("join_star")
def join_star(spark, sf_dir, year=1997):
    """Fact x dimensions: revenue by supplier nation and part brand."""
    t = T(spark, sf_dir)
    li = t.lineitem.filter(in_year("l_shipdate", year)).select("l_partkey", "l_suppkey", "l_extendedprice")
    j = (li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
           .join(B(t.nation.select("n_nationkey", "n_name")), F.col("s_nationkey") == F.col("n_nationkey"))
           .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")))
    return j.groupBy("n_name", "p_brand").agg(dsum("l_extendedprice", "revenue"), F.count(F.lit(1)).alias("lines"))


@raw_query("join_fact_fact")
def join_fact_fact(spark, sf_dir):
    """Large x large equi-join (lines x orders on the order key)."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority", "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(revenue()).cast("double").alias("revenue"),
        F.countDistinct("o_orderkey").alias("orders"))


@raw_query("join_left")
def join_left(spark, sf_dir, year=1998):
    """Left outer join: customers by their number of orders in a year (0 included)."""
    t = T(spark, sf_dir)
    o = t.orders.filter(in_year("o_orderdate", year)).select("o_custkey", "o_orderkey")
    per = (t.customer.select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
           .groupBy("c_custkey").agg(F.count("o_orderkey").alias("c_count")))
    return per.groupBy("c_count").agg(F.count(F.lit(1)).alias("custdist"))


@raw_query("join_full")
def join_full(spark, sf_dir, y1=1996, y2=1997):
    """Full outer join of two per-customer aggregates with coalesced keys."""
    t = T(spark, sf_dir)
    a = t.orders.filter(in_year("o_orderdate", y1)).groupBy(F.col("o_custkey").alias("a_cust")).agg(
        F.count(F.lit(1)).alias("n1"))
    b = t.orders.filter(in_year("o_orderdate", y2)).groupBy(F.col("o_custkey").alias("b_cust")).agg(
        F.count(F.lit(1)).alias("n2"))
    j = a.join(b, a.a_cust == b.b_cust, "full")
    return j.select(F.coalesce("a_cust", "b_cust").alias("custkey"), F.coalesce("n1", F.lit(0)).alias("orders_y1"),
                    F.coalesce("n2", F.lit(0)).alias("orders_y2"))


@raw_query("join_semi")
def join_semi(spark, sf_dir, min_total=300000.0):
    """Semi join (EXISTS): customers with at least one large order, by segment."""
    t = T(spark, sf_dir)
    big = t.orders.filter(F.col("o_totalprice") > min_total).select("o_custkey")
    c = t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@raw_query("join_anti")
def join_anti(spark, sf_dir, year=1998):
    """Anti join (NOT EXISTS): parts never shipped in a year, by brand."""
    t = T(spark, sf_dir)
    shipped = t.lineitem.filter(in_year("l_shipdate", year)).select("l_partkey")
    p = t.part.join(shipped, F.col("p_partkey") == F.col("l_partkey"), "left_anti")
    return p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


@raw_query("join_anti_null")
def join_anti_null(spark, sf_dir):
    """LEFT JOIN ... IS NULL form of an anti join: orders without a returned line."""
    t = T(spark, sf_dir)
    r = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey").distinct()
    j = t.orders.join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left").filter(F.col("l_orderkey").isNull())
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@raw_query("join_mark")
def join_mark(spark, sf_dir, acct_min=9000.0):
    """EXISTS under OR (mark join): customers with an urgent order OR a high balance."""
    t = T(spark, sf_dir)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("u_cust")).distinct()
    c = t.customer.join(urgent, F.col("c_custkey") == F.col("u_cust"), "left")
    c = c.filter(F.col("u_cust").isNotNull() | (F.col("c_acctbal") > acct_min))
    return c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))


@raw_query("join_semi_theta")
def join_semi_theta(spark, sf_dir):
    """EXISTS another line of the same order from a different supplier.

    Equivalent to a semi join with a ``<>`` residual; answered with the
    order's min/max supplier so no line pairs are produced."""
    t = T(spark, sf_dir)
    li = t.lineitem
    mm = li.groupBy(F.col("l_orderkey").alias("m_order")).agg(F.min("l_suppkey").alias("smin"),
                                                             F.max("l_suppkey").alias("smax"))
    j = li.join(mm, (F.col("l_orderkey") == F.col("m_order")) & (F.col("smin") != F.col("smax")), "left_semi")
    return j.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


@raw_query("join_theta")
def join_theta(spark, sf_dir):
    """Equi-join with a non-equi residual: lines shipped before their order date."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.orders, (F.col("l_orderkey") == F.col("o_orderkey"))
                        & (F.to_date("l_shipdate") < F.to_date("o_orderdate")))
    return j.groupBy(year_of("o_orderdate").alias("order_year")).agg(F.count(F.lit(1)).alias("early_lines"))


@raw_query("join_cross")
def join_cross(spark, sf_dir):
    """Cross join of two one-row aggregates (bounded: 1 x 1 rows)."""
    t = T(spark, sf_dir)
    r = t.lineitem.filter(F.col("l_returnflag") == "R").agg(avg_exact(dec("l_extendedprice")).alias("avg_r"))
    n = t.lineitem.filter(F.col("l_returnflag") == "N").agg(avg_exact(dec("l_extendedprice")).alias("avg_n"))
    return r.crossJoin(n).select("avg_r", "avg_n", (F.col("avg_r") / F.col("avg_n")).alias("ratio"))


@raw_query("join_self_offset")
def join_self_offset(spark, sf_dir):
    """Self join with an offset: nation revenue vs. the previous year."""
    t = T(spark, sf_dir)
    j = (t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .groupBy("s_nationkey", year_of("l_shipdate").alias("yr")).agg(F.sum(dec("l_extendedprice")).alias("rev")))
    prev = j.select(F.col("s_nationkey").alias("p_nation"), F.col("yr").alias("p_yr"), F.col("rev").alias("p_rev"))
    k = j.join(prev, (j.s_nationkey == prev.p_nation) & (j.yr == prev.p_yr + 1))
    return k.select("s_nationkey", "yr", F.col("rev").cast("double").alias("revenue"),
                    F.col("p_rev").cast("double").alias("prev_revenue"))


@star_query("join_asof_scd")
def join_asof_scd(st):
    """As-of lookup of a type-2 dimension: each sale is matched to the item
    revision (same business id) valid on the sale date. Equi-join on the
    business key, validity interval as the residual (revisions do not overlap)."""
    items = st.item.select("i_item_id", "i_item_sk", "i_rec_start_date", "i_rec_end_date", "i_current_price")
    sales = (st.store_sales.join(st.item.select(F.col("i_item_sk").alias("sold_sk"), F.col("i_item_id").alias("sold_id")),
                                 F.col("ss_item_sk") == F.col("sold_sk"))
             .join(F.broadcast(st.date_dim.select("d_date_sk", "d_date")), F.col("ss_sold_date_sk") == F.col("d_date_sk")))
    j = sales.join(items, (F.col("sold_id") == F.col("i_item_id"))
                   & (F.col("d_date") >= F.col("i_rec_start_date"))
                   & (F.col("d_date") <= F.coalesce(F.col("i_rec_end_date"), F.lit("9999-12-31").cast("date"))))
    return j.groupBy("i_rec_start_date").agg(F.count(F.lit(1)).alias("sales"),
                                             F.sum("ss_ext_sales_price").cast("double").alias("revenue"))


@raw_query("join_triangular")
def join_triangular(spark, sf_dir):
    """Running order count and spend per customer (what a triangular self join
    ``rk >= rk`` computes), as a window frame: linear per customer instead of
    quadratic pairs."""
    t = T(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderkey", dec("o_totalprice").alias("tp"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return o.select("o_custkey", "o_orderkey", F.count(F.lit(1)).over(w).alias("n_so_far"),
                    F.sum("tp").over(w).cast("double").alias("spent_so_far"))


@raw_query("join_roles")
def join_roles(spark, sf_dir, region="EUROPE"):
    """One dimension in two roles: customer nation and supplier nation."""
    t = T(spark, sf_dir)
    n1 = t.nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cust_nation"), F.col("n_regionkey").alias("cn_reg"))
    n2 = t.nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supp_nation"))
    r = t.region.filter(F.col("r_name") == region).select("r_regionkey")
    j = (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(B(n1), F.col("c_nationkey") == F.col("cn_key"))
         .join(B(r), F.col("cn_reg") == F.col("r_regionkey"))
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(B(n2), (F.col("s_nationkey") == F.col("sn_key")) & (F.col("cust_nation") != F.col("supp_nation"))))
    return j.groupBy("cust_nation", "supp_nation").agg(F.sum(revenue()).cast("double").alias("revenue"))


@raw_query("join_or_factored")
def join_or_factored(spark, sf_dir):
    """OR-of-ANDs that all contain the join key: the key is written as the
    equi-join condition and only the residual ORs remain as a filter."""
    t = T(spark, sf_dir)
    j = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    q, b, s = F.col("l_quantity"), F.col("p_brand"), F.col("p_size")
    cond = (((b == "Brand#12") & q.between(1, 11) & s.between(1, 5))
            | ((b == "Brand#23") & q.between(10, 20) & s.between(1, 10))
            | ((b == "Brand#3") & q.between(20, 30) & s.between(1, 15)))
    return j.filter(cond).agg(F.sum(revenue()).cast("double").alias("revenue"), F.count(F.lit(1)).alias("lines"))
