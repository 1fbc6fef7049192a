"""Sales -> returns -> re-purchase chains and return analytics.

Fact-to-fact joins (store_sales x store_returns on (item, ticket), returns
x catalog_sales on (customer, item)) are large-large equi-joins: both
sides are first reduced by their date-dimension filters (broadcast, bounded
calendar) and then shuffled on the composite key.
"""

from __future__ import annotations

from shelfline.functions.grouping import grouping_levels, rollup
from shelfline.functions.money import round_ratio2, stddev_samp_exact
from shelfline.functions.ranking import ranked_up_to
from shelfline.plans.catalog.common import (B, F, avg_exact, dates_between, demographics_of, order,
                                             star_query, topk)
from shelfline.sources.io import scratch_path


def _dates(st, cond, alias):
    return st.date_dim.filter(cond).select(F.col("d_date_sk").alias(alias))


def _sale_return_rebuy(st, d1, d2, d3):
    """store sale (d1) -> its return (d2) -> a catalog purchase of the same
    item by the same customer (d3)."""
    ss = st.store_sales.join(B(d1), F.col("ss_sold_date_sk") == d1.d1_sk)
    sr = st.store_returns.join(B(d2), F.col("sr_returned_date_sk") == d2.d2_sk)
    cs = st.catalog_sales.join(B(d3), F.col("cs_sold_date_sk") == d3.d3_sk)
    return (ss.join(sr, (F.col("ss_customer_sk") == F.col("sr_customer_sk"))
                    & (F.col("ss_item_sk") == F.col("sr_item_sk"))
                    & (F.col("ss_ticket_number") == F.col("sr_ticket_number")))
              .join(cs, (F.col("sr_customer_sk") == F.col("cs_bill_customer_sk"))
                    & (F.col("sr_item_sk") == F.col("cs_item_sk"))))


@star_query("q17", quarters=("1999Q1", "1999Q2", "1999Q3"))
def q17(st, quarters=("2001Q1", "2001Q2", "2001Q3")):
    """Quantity statistics (count, mean, stddev, CoV) along sale->return->re-buy."""
    qn = F.col("d_quarter_name")
    j = _sale_return_rebuy(st, _dates(st, qn == quarters[0], "d1_sk"),
                           _dates(st, qn.isin(*quarters), "d2_sk"), _dates(st, qn.isin(*quarters), "d3_sk"))
    j = (j.join(B(st.store.select("s_store_sk", "s_state")), F.col("ss_store_sk") == F.col("s_store_sk"))
          .join(st.item.select("i_item_sk", "i_item_id", "i_item_desc"), F.col("ss_item_sk") == F.col("i_item_sk")))
    aggs = []
    for col, name in [("ss_quantity", "store_sales_quantity"), ("sr_return_quantity", "store_returns_quantity"),
                      ("cs_quantity", "catalog_sales_quantity")]:
        sd, av = stddev_samp_exact(col), avg_exact(col)
        aggs += [F.count(col).alias(f"{name}count"), av.alias(f"{name}ave"), sd.alias(f"{name}stdev"),
                 (sd / av).alias(f"{name}cov")]
    g = j.groupBy("i_item_id", "i_item_desc", "s_state").agg(*aggs)
    return topk(g, 100, "i_item_id", "i_item_desc", "s_state")


def _chain_sums(st, d1, d2, d3, cols):
    j = _sale_return_rebuy(st, d1, d2, d3)
    j = (j.join(B(st.store.select("s_store_sk", "s_store_id", "s_store_name")),
                F.col("ss_store_sk") == F.col("s_store_sk"))
          .join(st.item.select("i_item_sk", "i_item_id", "i_item_desc"), F.col("ss_item_sk") == F.col("i_item_sk")))
    g = j.groupBy("i_item_id", "i_item_desc", "s_store_id", "s_store_name").agg(
        *[F.sum(c).cast("double" if "profit" in n or "loss" in n else "long").alias(n) for c, n in cols])
    return topk(g, 100, "i_item_id", "i_item_desc", "s_store_id", "s_store_name")


@star_query("q25", year=1999)
def q25(st, year=2001, month=4):
    """Profit/loss along sale -> return -> catalog re-buy within the season."""
    y, m = F.col("d_year"), F.col("d_moy")
    return _chain_sums(st, _dates(st, (m == month) & (y == year), "d1_sk"),
                       _dates(st, m.between(month, 10) & (y == year), "d2_sk"),
                       _dates(st, m.between(month, 10) & (y == year), "d3_sk"),
                       [("ss_net_profit", "store_sales_profit"), ("sr_net_loss", "store_returns_loss"),
                        ("cs_net_profit", "catalog_sales_profit")])


@star_query("q29")
def q29(st, year=1999, month=9):
    """Quantities along sale -> return (3 months) -> catalog re-buy (3 years)."""
    y, m = F.col("d_year"), F.col("d_moy")
    return _chain_sums(st, _dates(st, (m == month) & (y == year), "d1_sk"),
                       _dates(st, m.between(month, month + 3) & (y == year), "d2_sk"),
                       _dates(st, y.isin(year, year + 1, year + 2), "d3_sk"),
                       [("ss_quantity", "store_sales_quantity"), ("sr_return_quantity", "store_returns_quantity"),
                        ("cs_quantity", "catalog_sales_quantity")])


def _q24(st, color, market_id):
    """Net paid per customer/store for returned items of one color, above 5%
    of the average over all colors (two-level aggregate + scalar compare)."""
    ss = st.store_sales.select("ss_ticket_number", "ss_item_sk", "ss_customer_sk", "ss_store_sk", "ss_net_paid")
    sr = st.store_returns.select("sr_ticket_number", "sr_item_sk")
    s = st.store.filter(F.col("s_market_id") == market_id).select("s_store_sk", "s_store_name", "s_state", "s_zip")
    j = (ss.join(sr, (ss.ss_ticket_number == sr.sr_ticket_number) & (ss.ss_item_sk == sr.sr_item_sk))
           .join(B(s), ss.ss_store_sk == s.s_store_sk)
           .join(st.item.select("i_item_sk", "i_color", "i_current_price", "i_manager_id", "i_units", "i_size"),
                 ss.ss_item_sk == F.col("i_item_sk"))
           .join(st.customer.select("c_customer_sk", "c_current_addr_sk", "c_last_name", "c_first_name",
                                    "c_birth_country"), ss.ss_customer_sk == F.col("c_customer_sk"))
           .join(st.customer_address.select("ca_address_sk", "ca_state", "ca_zip", "ca_country"),
                 (F.col("c_current_addr_sk") == F.col("ca_address_sk"))
                 & (F.col("c_birth_country") != F.upper("ca_country")) & (F.col("s_zip") == F.col("ca_zip"))))
    ssales = j.groupBy("c_last_name", "c_first_name", "s_store_name", "ca_state", "s_state", "i_color",
                       "i_current_price", "i_manager_id", "i_units", "i_size").agg(
        F.sum("ss_net_paid").alias("netpaid"))
    threshold = ssales.agg((F.lit(0.05) * avg_exact("netpaid")).alias("thr"))
    g = (ssales.filter(F.col("i_color") == color)
         .groupBy("c_last_name", "c_first_name", "s_store_name").agg(F.sum("netpaid").alias("paid")))
    out = g.crossJoin(threshold).filter(F.col("paid").cast("double") > F.col("thr")) \
        .select("c_last_name", "c_first_name", "s_store_name", F.col("paid").cast("double").alias("paid"))
    return out.orderBy(*order("c_last_name", "c_first_name", "s_store_name"))


@star_query("q24_1", market_id=2)
def q24_1(st, color="red", market_id=8):
    return _q24(st, color, market_id)


@star_query("q24_2", market_id=5, color="cold")
def q24_2(st, color="blue", market_id=8):
    return _q24(st, color, market_id)


@star_query("q40")
def q40(st, day="2000-03-11", price_lo=10.0, price_hi=40.0):
    """Catalog sales net of refunds before/after a date, by warehouse state and item."""
    d0 = F.lit(day).cast("date")
    dt = st.date_dim.filter(F.col("d_date").between(F.date_sub(d0, 30), F.date_add(d0, 30))) \
        .select("d_date_sk", "d_date")
    cs = st.catalog_sales.select("cs_order_number", "cs_item_sk", "cs_warehouse_sk", "cs_sold_date_sk", "cs_sales_price")
    cr = st.catalog_returns.select("cr_order_number", "cr_item_sk", "cr_refunded_cash")
    it = st.item.filter(F.col("i_current_price").between(price_lo, price_hi)).select("i_item_sk", "i_item_id")
    j = (cs.join(B(dt), cs.cs_sold_date_sk == dt.d_date_sk)
           .join(it, cs.cs_item_sk == it.i_item_sk)
           .join(cr, (cs.cs_order_number == cr.cr_order_number) & (cs.cs_item_sk == cr.cr_item_sk), "left")
           .join(B(st.warehouse.select("w_warehouse_sk", "w_state")), cs.cs_warehouse_sk == F.col("w_warehouse_sk")))
    net = F.col("cs_sales_price") - F.coalesce(F.col("cr_refunded_cash"), F.lit(0))
    g = j.groupBy("w_state", "i_item_id").agg(
        F.sum(F.when(F.col("d_date") < d0, net).otherwise(0)).cast("double").alias("sales_before"),
        F.sum(F.when(F.col("d_date") >= d0, net).otherwise(0)).cast("double").alias("sales_after"))
    return topk(g, 100, "w_state", "i_item_id")


def _return_ratios(st, ch, sales, rets, p, r, ticket, rticket, ramt, year, month, amt_min):
    dt = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_moy") == month)).select("d_date_sk")
    s = st[sales].filter((F.col(f"{p}_net_profit") > 1) & (F.col(f"{p}_net_paid") > 0) & (F.col(f"{p}_quantity") > 0))
    rt = st[rets].filter(F.col(ramt) > amt_min)
    j = (s.join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
          .join(rt, (F.col(ticket) == F.col(rticket)) & (F.col(f"{p}_item_sk") == F.col(f"{r}_item_sk"))))
    g = j.groupBy(F.col(f"{p}_item_sk").alias("item")).agg(
        (F.sum(F.coalesce(F.col(f"{r}_return_quantity"), F.lit(0))).cast("double")
         / F.sum(F.coalesce(F.col(f"{p}_quantity"), F.lit(0))).cast("double")).alias("return_ratio"),
        (F.sum(F.coalesce(F.col(ramt), F.lit(0))).cast("double")
         / F.sum(F.coalesce(F.col(f"{p}_net_paid"), F.lit(0))).cast("double")).alias("currency_ratio"))
    return g.select(F.lit(ch).alias("channel"), "*")


@star_query("q49", amt_min=100)
def q49(st, year=2001, month=12, amt_min=10000):
    """Top-10 items by return ratio / currency ratio per channel (union distinct)."""
    w = _return_ratios(st, "web", "web_sales", "web_returns", "ws", "wr", "ws_order_number", "wr_order_number",
                        "wr_return_amt", year, month, amt_min)
    c = _return_ratios(st, "catalog", "catalog_sales", "catalog_returns", "cs", "cr", "cs_order_number",
                        "cr_order_number", "cr_return_amount", year, month, amt_min)
    s = _return_ratios(st, "store", "store_sales", "store_returns", "ss", "sr", "ss_ticket_number",
                        "sr_ticket_number", "sr_return_amt", year, month, amt_min)
    path = scratch_path(st.spark, "return-ratios")
    ratios = w.unionByName(c).unionByName(s)
    ratios.write.mode("overwrite").parquet(path)          # one row an item and channel; counted and ranked from here
    best = ranked_up_to(st.spark.read.schema(ratios.schema).parquet(path),
                        {"return_ratio": "return_rank", "currency_ratio": "currency_rank"}, 10, "channel")
    u = best.select("channel", "item", "return_ratio", "return_rank", "currency_rank").distinct()
    return topk(u, 100, "channel", "return_rank", "currency_rank", "item", "return_ratio")


@star_query("q50", year=1999, month=8)
def q50(st, year=2001, month=8):
    """Return-latency buckets (days between sale and return) per store."""
    d2 = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_moy") == month)).select("d_date_sk")
    ss = st.store_sales.select("ss_ticket_number", "ss_item_sk", "ss_customer_sk", "ss_store_sk", "ss_sold_date_sk")
    sr = st.store_returns.select("sr_ticket_number", "sr_item_sk", "sr_customer_sk", "sr_returned_date_sk") \
        .join(B(d2), F.col("sr_returned_date_sk") == d2.d_date_sk)
    s = st.store.select("s_store_sk", "s_store_name", "s_company_id", "s_street_number", "s_street_name",
                        "s_street_type", "s_suite_number", "s_city", "s_county", "s_state", "s_zip")
    j = (ss.join(sr, (ss.ss_ticket_number == sr.sr_ticket_number) & (ss.ss_item_sk == sr.sr_item_sk)
                 & (ss.ss_customer_sk == sr.sr_customer_sk))
           .join(B(s), ss.ss_store_sk == s.s_store_sk))
    lag = F.col("sr_returned_date_sk") - F.col("ss_sold_date_sk")
    keys = ["s_store_name", "s_company_id", "s_street_number", "s_street_name", "s_street_type",
            "s_suite_number", "s_city", "s_county", "s_state", "s_zip"]
    g = j.groupBy(*keys).agg(
        F.sum(F.when(lag <= 30, 1).otherwise(0)).alias("days_30"),
        F.sum(F.when((lag > 30) & (lag <= 60), 1).otherwise(0)).alias("days_31_60"),
        F.sum(F.when((lag > 60) & (lag <= 90), 1).otherwise(0)).alias("days_61_90"),
        F.sum(F.when((lag > 90) & (lag <= 120), 1).otherwise(0)).alias("days_91_120"),
        F.sum(F.when(lag > 120, 1).otherwise(0)).alias("days_over_120"))
    return topk(g, 100, *keys)


@star_query("q72")
def q72(st, year=1999, buy_potential=">10000", marital="D"):
    """Catalog lines that outsell the week's inventory, by item/warehouse/week."""
    d1 = st.date_dim.filter(F.col("d_year") == year).select(
        F.col("d_date_sk").alias("d1_sk"), F.col("d_week_seq").alias("d1_week"), F.col("d_date").alias("d1_date"))
    # inventory weeks must equal a sale week: restrict d2 to the weeks of d1
    # (a bounded semi join) so only those snapshots are read and joined
    weeks = d1.select(F.col("d1_week").alias("w")).distinct()
    d2 = (st.date_dim.join(B(weeks), F.col("d_week_seq") == weeks.w, "left_semi")
          .select(F.col("d_date_sk").alias("d2_sk"), F.col("d_week_seq").alias("d2_week")))
    d3 = st.date_dim.select(F.col("d_date_sk").alias("d3_sk"), F.col("d_date").alias("d3_date"))
    hd = st.household_demographics.filter(F.col("hd_buy_potential") == buy_potential).select("hd_demo_sk")
    cd = st.customer_demographics.filter(F.col("cd_marital_status") == marital).select("cd_demo_sk")
    cs = (st.catalog_sales
          .join(B(d1), F.col("cs_sold_date_sk") == d1.d1_sk)
          .join(B(hd), F.col("cs_bill_hdemo_sk") == hd.hd_demo_sk)
          .join(B(cd), F.col("cs_bill_cdemo_sk") == cd.cd_demo_sk)
          .join(B(d3), (F.col("cs_ship_date_sk") == d3.d3_sk) & (d3.d3_date > F.date_add(d1.d1_date, 5))))
    # a snapshot that no line left can outsell is dropped before the shuffle of the year's snapshots
    most = cs.agg(F.max("cs_quantity").alias("most_sold"))
    inv = (st.inventory.join(B(most), F.col("inv_quantity_on_hand") < F.col("most_sold")).drop("most_sold")
           .join(B(d2), F.col("inv_date_sk") == d2.d2_sk))
    # equi-join on (item, week): the week equality is part of the key, not a residual
    j = (cs.join(inv, (F.col("cs_item_sk") == F.col("inv_item_sk")) & (F.col("d1_week") == F.col("d2_week"))
                 & (F.col("inv_quantity_on_hand") < F.col("cs_quantity")))
           .join(B(st.warehouse.select("w_warehouse_sk", "w_warehouse_name")),
                 F.col("inv_warehouse_sk") == F.col("w_warehouse_sk"))
           .join(st.item.select("i_item_sk", "i_item_desc"), F.col("cs_item_sk") == F.col("i_item_sk"))
           .join(B(st.promotion.select("p_promo_sk")), F.col("cs_promo_sk") == F.col("p_promo_sk"), "left")
           .join(st.catalog_returns.select("cr_item_sk", "cr_order_number"),
                 (F.col("cr_item_sk") == F.col("cs_item_sk")) & (F.col("cr_order_number") == F.col("cs_order_number")),
                 "left"))
    g = j.groupBy("i_item_desc", "w_warehouse_name", F.col("d1_week").alias("d_week_seq")).agg(
        F.sum(F.when(F.col("p_promo_sk").isNull(), 1).otherwise(0)).alias("no_promo"),
        F.sum(F.when(F.col("p_promo_sk").isNotNull(), 1).otherwise(0)).alias("promo"),
        F.count(F.lit(1)).alias("total_cnt"))
    return topk(g, 100, "-total_cnt", "i_item_desc", "w_warehouse_name", "d_week_seq")


@star_query("q75", category="gear", year=2000)
def q75(st, category="ring", year=2002):
    """Brands/classes whose net sales count fell >10% year over year, all channels.

    Detail rows are combined with UNION (distinct), as in the benchmark."""
    it = st.item.filter(F.col("i_category") == category).select(
        "i_item_sk", "i_brand_id", "i_class_id", "i_category_id", "i_manufact_id")
    dt = st.date_dim.filter(F.col("d_year").isin(year - 1, year)).select("d_date_sk", "d_year")
    parts = []
    for sales, rets, p, r, on_s, on_r, ramt in [
            ("catalog_sales", "catalog_returns", "cs", "cr", "cs_order_number", "cr_order_number", "cr_return_amount"),
            ("store_sales", "store_returns", "ss", "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt"),
            ("web_sales", "web_returns", "ws", "wr", "ws_order_number", "wr_order_number", "wr_return_amt")]:
        s = (st[sales].join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
             .join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk))
        j = s.join(st[rets].select(on_r, f"{r}_item_sk", f"{r}_return_quantity", ramt),
                   (F.col(on_s) == F.col(on_r)) & (F.col(f"{p}_item_sk") == F.col(f"{r}_item_sk")), "left")
        parts.append(j.select("d_year", "i_brand_id", "i_class_id", "i_category_id", "i_manufact_id",
                              (F.col(f"{p}_quantity") - F.coalesce(F.col(f"{r}_return_quantity"), F.lit(0))).alias("sales_cnt"),
                              (F.col(f"{p}_ext_sales_price") - F.coalesce(F.col(ramt), F.lit(0))).alias("sales_amt")))
    detail = parts[0].union(parts[1]).union(parts[2]).distinct()
    keys = ["i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]
    all_sales = detail.groupBy("d_year", *keys).agg(F.sum("sales_cnt").alias("sales_cnt"),
                                                    F.sum("sales_amt").alias("sales_amt"))
    cur = all_sales.filter(F.col("d_year") == year)
    prev = all_sales.filter(F.col("d_year") == year - 1).select(*[F.col(c).alias("p_" + c) for c in all_sales.columns])
    j = cur.join(prev, [cur[k] == prev["p_" + k] for k in keys])
    j = j.filter(F.when(F.col("p_sales_cnt") != 0,
                        F.col("sales_cnt").cast("double") / F.col("p_sales_cnt").cast("double")) < 0.9)
    out = j.select(F.col("p_d_year").alias("prev_year"), F.col("d_year").alias("year"), *keys,
                   F.col("p_sales_cnt").alias("prev_yr_cnt"), F.col("sales_cnt").alias("curr_yr_cnt"),
                   (F.col("sales_cnt") - F.col("p_sales_cnt")).alias("sales_cnt_diff"),
                   (F.col("sales_amt") - F.col("p_sales_amt")).cast("double").alias("sales_amt_diff"))
    return topk(out, 100, "sales_cnt_diff", "sales_amt_diff", *keys)


def _unreturned(st, sales, rets, p, r, on_s, on_r, cust, year):
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk", "d_year")
    s = st[sales].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
    # anti join: sales lines that were never returned
    s = s.join(st[rets].select(on_r, f"{r}_item_sk"),
               (F.col(on_s) == F.col(on_r)) & (F.col(f"{p}_item_sk") == F.col(f"{r}_item_sk")), "left_anti")
    return s.groupBy(F.col("d_year").alias(f"{p}_sold_year"), F.col(f"{p}_item_sk").alias(f"{p}_item"),
                     F.col(cust).alias(f"{p}_customer_sk")).agg(
        F.sum(f"{p}_quantity").alias(f"{p}_qty"), F.sum(f"{p}_wholesale_cost").alias(f"{p}_wc"),
        F.sum(f"{p}_sales_price").alias(f"{p}_sp"))


@star_query("q78")
def q78(st, year=2000):
    """Unreturned store purchases vs. the same customer's unreturned web/catalog
    purchases of the item in the same year."""
    ss = _unreturned(st, "store_sales", "store_returns", "ss", "sr", "ss_ticket_number", "sr_ticket_number",
                     "ss_customer_sk", year)
    ws = _unreturned(st, "web_sales", "web_returns", "ws", "wr", "ws_order_number", "wr_order_number",
                     "ws_bill_customer_sk", year)
    cs = _unreturned(st, "catalog_sales", "catalog_returns", "cs", "cr", "cs_order_number", "cr_order_number",
                     "cs_bill_customer_sk", year)
    j = (ss.join(ws, (ws.ws_sold_year == ss.ss_sold_year) & (ws.ws_item == ss.ss_item)
                 & (ws.ws_customer_sk == ss.ss_customer_sk), "left")
           .join(cs, (cs.cs_sold_year == ss.ss_sold_year) & (cs.cs_item == ss.ss_item)
                 & (cs.cs_customer_sk == ss.ss_customer_sk), "left"))
    oq = F.coalesce(F.col("ws_qty"), F.lit(0)) + F.coalesce(F.col("cs_qty"), F.lit(0))
    j = j.filter((F.coalesce(F.col("ws_qty"), F.lit(0)) > 0) | (F.coalesce(F.col("cs_qty"), F.lit(0)) > 0))
    out = j.select(F.col("ss_sold_year"), F.col("ss_item").alias("ss_item_sk"), "ss_customer_sk",
                   round_ratio2(F.col("ss_qty"), oq).alias("ratio"),
                   F.col("ss_qty").alias("store_qty"), F.col("ss_wc").cast("double").alias("store_wholesale_cost"),
                   F.col("ss_sp").cast("double").alias("store_sales_price"), oq.alias("other_chan_qty"),
                   (F.coalesce(F.col("ws_wc"), F.lit(0)) + F.coalesce(F.col("cs_wc"), F.lit(0))).cast("double")
                   .alias("other_chan_wholesale_cost"),
                   (F.coalesce(F.col("ws_sp"), F.lit(0)) + F.coalesce(F.col("cs_sp"), F.lit(0))).cast("double")
                   .alias("other_chan_sales_price"))
    return topk(out, 100, "ss_sold_year", "ss_item_sk", "ss_customer_sk", "-store_qty", "-store_wholesale_cost",
                "-store_sales_price", "other_chan_qty", "other_chan_wholesale_cost", "other_chan_sales_price",
                "ratio")


def _channel_net(st, sales, rets, p, r, on_s, on_r, ramt, rloss, outlet_join, outlet_key, id_col, start, price_min):
    dt = dates_between(st, start, 30)
    it = st.item.filter(F.col("i_current_price") > price_min).select("i_item_sk")
    pr = st.promotion.filter(F.col("p_channel_tv") == "N").select("p_promo_sk")
    s = (st[sales].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
         .join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
         .join(B(pr), F.col(f"{p}_promo_sk") == pr.p_promo_sk)
         .join(B(outlet_join), F.col(outlet_key) == outlet_join[outlet_join.columns[0]]))
    j = s.join(st[rets].select(on_r, f"{r}_item_sk", ramt, rloss),
               (F.col(on_s) == F.col(on_r)) & (F.col(f"{p}_item_sk") == F.col(f"{r}_item_sk")), "left")
    return j.groupBy(F.col(id_col).alias("oid")).agg(
        F.sum(f"{p}_ext_sales_price").alias("sales"),
        F.sum(F.coalesce(F.col(ramt), F.lit(0))).alias("returns_"),
        F.sum(F.col(f"{p}_net_profit") - F.coalesce(F.col(rloss), F.lit(0))).alias("profit"))


def _q80_union(st, start, price_min):
    ssr = _channel_net(st, "store_sales", "store_returns", "ss", "sr", "ss_ticket_number", "sr_ticket_number",
                       "sr_return_amt", "sr_net_loss", st.store.select("s_store_sk", "s_store_id"), "ss_store_sk",
                       "s_store_id", start, price_min)
    csr = _channel_net(st, "catalog_sales", "catalog_returns", "cs", "cr", "cs_order_number", "cr_order_number",
                       "cr_return_amount", "cr_net_loss",
                       st.catalog_page.select("cp_catalog_page_sk", "cp_catalog_page_id"), "cs_catalog_page_sk",
                       "cp_catalog_page_id", start, price_min)
    wsr = _channel_net(st, "web_sales", "web_returns", "ws", "wr", "ws_order_number", "wr_order_number",
                       "wr_return_amt", "wr_net_loss", st.web_site.select("web_site_sk", "web_site_id"),
                       "ws_web_site_sk", "web_site_id", start, price_min)
    return (ssr.select(F.lit("store channel").alias("channel"), F.concat(F.lit("store"), "oid").alias("id"),
                       "sales", "returns_", "profit")
            .unionByName(csr.select(F.lit("catalog channel").alias("channel"),
                                    F.concat(F.lit("catalog_page"), "oid").alias("id"), "sales", "returns_", "profit"))
            .unionByName(wsr.select(F.lit("web channel").alias("channel"), F.concat(F.lit("web_site"), "oid").alias("id"),
                                    "sales", "returns_", "profit")))


_TOT = [("sales", "sales"), ("returns_", "returns"), ("profit", "profit")]


@star_query("q80", price_min=20)
def q80(st, start="2000-08-23", price_min=50):
    """Sales/returns/profit per outlet and channel with a ROLLUP (channel, id)."""
    u = _q80_union(st, start, price_min)
    g = rollup(u, ["channel", "id"], [F.sum(c).cast("double").alias(a) for c, a in _TOT])
    return topk(g, 100, "channel", "id", "sales", "returns", "profit")


@star_query("q80a", price_min=20)
def q80a(st, start="2000-08-23", price_min=50):
    """q80 with the levels written as UNION (distinct) of detail, channel and
    total (the levels evaluated as one grouping-sets aggregate)."""
    u = _q80_union(st, start, price_min)
    g = grouping_levels(u, ["channel", "id"], [["channel", "id"], ["channel"], []],
                        [F.sum(c).cast("double").alias(a) for c, a in _TOT])
    return topk(g.distinct(), 100, "channel", "id", "sales", "returns", "profit")


@star_query("q85", year=2000)
def q85(st, year=2000):
    """Average quantity/refund/fee of web returns by reason for demographic x
    price x geography profiles (OR-of-ANDs; join keys written explicitly)."""
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    ws = st.web_sales.select("ws_web_page_sk", "ws_item_sk", "ws_order_number", "ws_sold_date_sk", "ws_quantity",
                             "ws_sales_price", "ws_net_profit")
    wr = st.web_returns.select("wr_item_sk", "wr_order_number", "wr_refunded_cdemo_sk", "wr_returning_cdemo_sk",
                               "wr_refunded_addr_sk", "wr_reason_sk", "wr_refunded_cash", "wr_fee")
    pairs = [("M", "Advanced Degree"), ("S", "College"), ("W", "2 yr Degree")]
    cd1 = demographics_of(st, pairs, F.col("cd_demo_sk").alias("cd1_sk"), F.col("cd_marital_status").alias("m1"),
                          F.col("cd_education_status").alias("e1"))
    cd2 = demographics_of(st, pairs, F.col("cd_demo_sk").alias("cd2_sk"), F.col("cd_marital_status").alias("m2"),
                          F.col("cd_education_status").alias("e2"))
    ca = st.customer_address.select("ca_address_sk", "ca_country", "ca_state")
    j = (ws.join(B(dt), ws.ws_sold_date_sk == dt.d_date_sk)
           .join(B(st.web_page.select("wp_web_page_sk")), ws.ws_web_page_sk == F.col("wp_web_page_sk"))
           .join(wr, (ws.ws_item_sk == wr.wr_item_sk) & (ws.ws_order_number == wr.wr_order_number))
           .join(cd1, wr.wr_refunded_cdemo_sk == cd1.cd1_sk)
           .join(cd2, wr.wr_returning_cdemo_sk == cd2.cd2_sk)
           .join(ca, wr.wr_refunded_addr_sk == ca.ca_address_sk)
           .join(B(st.reason.select("r_reason_sk", "r_reason_desc")), wr.wr_reason_sk == F.col("r_reason_sk")))
    price, profit = F.col("ws_sales_price"), F.col("ws_net_profit")
    same = (F.col("m1") == F.col("m2")) & (F.col("e1") == F.col("e2"))
    demo = same & (((F.col("m1") == "M") & (F.col("e1") == "Advanced Degree") & price.between(100, 150))
                   | ((F.col("m1") == "S") & (F.col("e1") == "College") & price.between(50, 100))
                   | ((F.col("m1") == "W") & (F.col("e1") == "2 yr Degree") & price.between(150, 200)))
    us = F.col("ca_country") == "United States"
    geo = ((us & F.col("ca_state").isin("IN", "IL", "KY") & profit.between(100, 200))
           | (us & F.col("ca_state").isin("CT", "MA", "MD") & profit.between(150, 300))
           | (us & F.col("ca_state").isin("LA", "IA", "AR") & profit.between(50, 250)))
    g = j.filter(demo & geo).groupBy("r_reason_desc").agg(
        avg_exact("ws_quantity").alias("avg_qty"), avg_exact("wr_refunded_cash").alias("avg_refund"),
        avg_exact("wr_fee").alias("avg_fee"))
    g = g.select(F.substring("r_reason_desc", 1, 20).alias("reason"), "avg_qty", "avg_refund", "avg_fee")
    return topk(g, 100, "reason", "avg_qty", "avg_refund", "avg_fee")


@star_query("q93")
def q93(st, reason="reason 28"):
    """Actual (net of returns) store revenue per customer for one return reason."""
    r = st.reason.filter(F.col("r_reason_desc") == reason).select("r_reason_sk")
    sr = st.store_returns.select("sr_item_sk", "sr_ticket_number", "sr_reason_sk", "sr_return_quantity") \
        .join(B(r), F.col("sr_reason_sk") == r.r_reason_sk)
    ss = st.store_sales.select("ss_item_sk", "ss_ticket_number", "ss_customer_sk", "ss_quantity", "ss_sales_price")
    j = ss.join(sr, (sr.sr_item_sk == ss.ss_item_sk) & (sr.sr_ticket_number == ss.ss_ticket_number))
    act = F.when(F.col("sr_return_quantity").isNotNull(),
                 (F.col("ss_quantity") - F.col("sr_return_quantity")) * F.col("ss_sales_price")) \
        .otherwise(F.col("ss_quantity") * F.col("ss_sales_price"))
    g = j.groupBy("ss_customer_sk").agg(F.sum(act).cast("double").alias("sumsales"))
    return topk(g, 100, "sumsales", "ss_customer_sk")
