"""EXISTS / NOT EXISTS / IN / INTERSECT / EXCEPT query family.

Existence tests are semi/anti joins on the correlation key. "Another line of
the same order shipped from a different warehouse" is answered from a
per-order min/max of the warehouse key (one aggregate) instead of a
self-join, so an order with thousands of lines never emits line pairs.
"""

from __future__ import annotations

from shelfline.functions.grouping import grouping_levels, rollup
from shelfline.functions.money import rdiv
from shelfline.plans.catalog.common import B, F, avg_exact, demographics, star_query, topk


def _buyers(st, fact, p, cust, dates):
    """Distinct customers of a channel within a date set."""
    return (st[fact].join(B(dates), F.col(f"{p}_sold_date_sk") == dates.d_date_sk, "left_semi")
            .select(F.col(cust).alias("b_cust")).distinct())


# ZIP list of the q08 parameter: every 5-digit ZIP of the address rule
# (10000 + 100 * nation + k, k in 0..2) plus a filler range, built by rule.
Q8_ZIPS = tuple(sorted({str(10000 + 100 * n + k) for n in range(25) for k in range(3)}
                       | {str(z) for z in range(20000, 20325)}))


@star_query("q08", min_preferred=3)
def q08(st, zips=Q8_ZIPS, qoy=2, year=1998, min_preferred=10):
    """Store profit where the store's ZIP prefix matches listed ZIPs that also
    have many preferred customers (IN-list INTERSECT grouped HAVING)."""
    ca = st.customer_address
    listed = ca.select(F.substring("ca_zip", 1, 5).alias("ca_zip5")).filter(F.col("ca_zip5").isin(*zips))
    preferred = (ca.join(st.customer.filter(F.col("c_preferred_cust_flag") == "Y"),
                         F.col("ca_address_sk") == F.col("c_current_addr_sk"))
                   .groupBy(F.substring("ca_zip", 1, 5).alias("ca_zip5")).agg(F.count(F.lit(1)).alias("cnt"))
                   .filter(F.col("cnt") > min_preferred).select("ca_zip5"))
    v1 = listed.intersect(preferred).select(F.substring("ca_zip5", 1, 2).alias("zip2"))
    dt = st.date_dim.filter((F.col("d_qoy") == qoy) & (F.col("d_year") == year)).select("d_date_sk")
    s = st.store.select("s_store_sk", "s_store_name", F.substring("s_zip", 1, 2).alias("s_zip2"))
    ss = st.store_sales.select("ss_store_sk", "ss_sold_date_sk", "ss_net_profit")
    # v1 is bounded by the ZIP domain; each matching ZIP counts the store's sales once (benchmark semantics)
    j = (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk)
           .join(B(s), ss.ss_store_sk == s.s_store_sk)
           .join(B(v1), F.col("s_zip2") == v1.zip2))
    g = j.groupBy("s_store_name").agg(F.sum("ss_net_profit").cast("double").alias("net_profit"))
    return topk(g, 100, "s_store_name")


_Q10_COUNTIES = ("NATION_1 County", "NATION_5 County", "NATION_9 County", "NATION_13 County", "NATION_17 County")


def _active_customers(st, counties_or_states, by, period_ss, period_other, other_mode):
    """Customers living in the listed places (``by`` None: anywhere) who bought in the channels asked for."""
    c = st.customer.select("c_customer_sk", "c_current_addr_sk", "c_current_cdemo_sk")
    ca = st.customer_address if by is None else st.customer_address.filter(F.col(by).isin(*counties_or_states))
    ca = ca.select("ca_address_sk", "ca_state")
    cd = demographics(st)
    base = (c.join(ca, c.c_current_addr_sk == ca.ca_address_sk)
             .join(cd, F.col("cd_demo_sk") == c.c_current_cdemo_sk))
    store_b = _buyers(st, "store_sales", "ss", "ss_customer_sk", period_ss)
    base = base.join(store_b, base.c_customer_sk == store_b.b_cust, "left_semi")
    web_b = _buyers(st, "web_sales", "ws", "ws_bill_customer_sk", period_other).withColumnRenamed("b_cust", "w_cust")
    cat_b = _buyers(st, "catalog_sales", "cs", "cs_ship_customer_sk", period_other).withColumnRenamed("b_cust", "c_cust")
    if other_mode == "exists_or":      # mark join: EXISTS(web) OR EXISTS(catalog)
        m = (base.join(web_b, base.c_customer_sk == web_b.w_cust, "left")
                 .join(cat_b, base.c_customer_sk == cat_b.c_cust, "left"))
        return m.filter(F.col("w_cust").isNotNull() | F.col("c_cust").isNotNull())
    if other_mode == "exists_union":   # EXISTS over the UNION ALL of both channels
        both = web_b.select(F.col("w_cust").alias("o_cust")).unionByName(cat_b.select(F.col("c_cust").alias("o_cust")))
        return base.join(both, base.c_customer_sk == both.o_cust, "left_semi")
    # NOT EXISTS(web) AND NOT EXISTS(catalog)
    return (base.join(web_b, base.c_customer_sk == web_b.w_cust, "left_anti")
                .join(cat_b, base.c_customer_sk == cat_b.c_cust, "left_anti"))


def _months(st, year, lo, hi):
    return st.date_dim.filter((F.col("d_year") == year) & F.col("d_moy").between(lo, hi)).select("d_date_sk")


_Q10_KEYS = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating",
             "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]


def _q10_out(m):
    g = m.groupBy(*_Q10_KEYS).agg(F.count(F.lit(1)).alias("cnt"))
    out = g.select("cd_gender", "cd_marital_status", "cd_education_status", F.col("cnt").alias("cnt1"),
                   "cd_purchase_estimate", F.col("cnt").alias("cnt2"), "cd_credit_rating", F.col("cnt").alias("cnt3"),
                   "cd_dep_count", F.col("cnt").alias("cnt4"), "cd_dep_employed_count", F.col("cnt").alias("cnt5"),
                   "cd_dep_college_count", F.col("cnt").alias("cnt6"))
    return topk(out, 100, *_Q10_KEYS)


@star_query("q10", year=1999)
def q10(st, counties=_Q10_COUNTIES, year=2002, months=(1, 4)):
    """Demographics of store customers who also bought on the web OR catalog
    (EXISTS ... OR EXISTS: mark joins)."""
    p = _months(st, year, *months)
    return _q10_out(_active_customers(st, counties, "ca_county", p, p, "exists_or"))


@star_query("q10a", year=1999)
def q10a(st, counties=_Q10_COUNTIES, year=2002, months=(1, 4)):
    """q10 with the OR of EXISTS written as one EXISTS over a UNION ALL."""
    p = _months(st, year, *months)
    return _q10_out(_active_customers(st, counties, "ca_county", p, p, "exists_union"))


def _q35(m, agg):
    aggf = getattr(F, agg)
    keys = ["ca_state", "cd_gender", "cd_marital_status", "cd_dep_count", "cd_dep_employed_count",
            "cd_dep_college_count"]
    g = m.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        *[x for c, n in [("cd_dep_count", "1"), ("cd_dep_employed_count", "2"), ("cd_dep_college_count", "3")]
          for x in (avg_exact(c).alias(f"avg{n}") if agg == "avg" else aggf(c).cast("double").alias(f"avg{n}"),
                    F.max(c).alias(f"max{n}"), F.sum(c).alias(f"sum{n}"))])
    out = g.select("ca_state", "cd_gender", "cd_marital_status", "cd_dep_count", F.col("cnt").alias("cnt1"),
                   "avg1", "max1", "sum1", "cd_dep_employed_count", F.col("cnt").alias("cnt2"), "avg2", "max2", "sum2",
                   "cd_dep_college_count", F.col("cnt").alias("cnt3"), "avg3", "max3", "sum3")
    return topk(out, 100, *keys)


@star_query("q35", year=1999)
def q35(st, year=2002, agg="avg"):
    """Dependant statistics by state/demographic for multi-channel customers."""
    ss_p = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_qoy") < 4)).select("d_date_sk")
    return _q35(_active_customers(st, (), None, ss_p, ss_p, "exists_or"), agg)


@star_query("q35a", year=1999)
def q35a(st, year=2002, agg="avg"):
    """q35 with the OR of EXISTS written as one EXISTS over a UNION ALL."""
    ss_p = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_qoy") < 4)).select("d_date_sk")
    return _q35(_active_customers(st, (), None, ss_p, ss_p, "exists_union"), agg)


@star_query("q69", states=("KS", "KY", "MA", "MD", "IA"))
def q69(st, states=("KY", "GA", "NM"), year=2001, month=4):
    """Demographics of store customers with NO web and NO catalog purchase
    in the same quarter (anti joins)."""
    p = _months(st, year, month, month + 2)
    m = _active_customers(st, states, "ca_state", p, p, "not_exists")
    keys = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating"]
    g = m.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    out = g.select("cd_gender", "cd_marital_status", "cd_education_status", F.col("cnt").alias("cnt1"),
                   "cd_purchase_estimate", F.col("cnt").alias("cnt2"), "cd_credit_rating", F.col("cnt").alias("cnt3"))
    return topk(out, 100, *keys)


def _named_buyer_days(st, fact, p, cust, month_seq):
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", "d_date")
    c = st.customer.select("c_customer_sk", "c_last_name", "c_first_name")
    return (st[fact].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
            .join(c, F.col(cust) == c.c_customer_sk)
            .select("c_last_name", "c_first_name", "d_date").distinct())


@star_query("q38", month_seq=1164)
def q38(st, month_seq=1200):
    """Count of (name, day) pairs that bought in all three channels (INTERSECT)."""
    s = _named_buyer_days(st, "store_sales", "ss", "ss_customer_sk", month_seq)
    c = _named_buyer_days(st, "catalog_sales", "cs", "cs_bill_customer_sk", month_seq)
    w = _named_buyer_days(st, "web_sales", "ws", "ws_bill_customer_sk", month_seq)
    return s.intersect(c).intersect(w).agg(F.count(F.lit(1)).alias("cnt"))


@star_query("q87", month_seq=1176)
def q87(st, month_seq=1200):
    """Count of (name, day) pairs that bought in stores only (EXCEPT)."""
    s = _named_buyer_days(st, "store_sales", "ss", "ss_customer_sk", month_seq)
    c = _named_buyer_days(st, "catalog_sales", "cs", "cs_bill_customer_sk", month_seq)
    w = _named_buyer_days(st, "web_sales", "ws", "ws_bill_customer_sk", month_seq)
    return s.subtract(c).subtract(w).agg(F.count(F.lit(1)).alias("cnt"))


def _multi_warehouse_orders(df, order_col, wh_col):
    """Orders with lines from at least two different (non-null) warehouses."""
    return (df.groupBy(F.col(order_col).alias("m_order"))
              .agg(F.min(wh_col).alias("wmin"), F.max(wh_col).alias("wmax"))
              .filter(F.col("wmin") != F.col("wmax")).select("m_order"))


def _shipping_summary(j, p):
    return j.agg(F.countDistinct(f"{p}_order_number").alias("order_count"),
                 F.sum(f"{p}_ext_ship_cost").cast("double").alias("total_shipping_cost"),
                 F.sum(f"{p}_net_profit").cast("double").alias("total_net_profit"))


@star_query("q16", state="IL", start="2000-02-01", counties=("NATION_0 County", "NATION_4 County",
                                                             "NATION_8 County", "NATION_12 County",
                                                             "NATION_16 County", "NATION_20 County"))
def q16(st, start="2002-02-01", state="GA", counties=("Williamson County",)):
    """Catalog orders shipped from several warehouses and never returned."""
    d0 = F.lit(start).cast("date")
    dt = st.date_dim.filter(F.col("d_date").between(d0, F.date_add(d0, 60))).select("d_date_sk")
    ca = st.customer_address.filter(F.col("ca_state") == state).select("ca_address_sk")
    cc = st.call_center.filter(F.col("cc_county").isin(*counties)).select("cc_call_center_sk")
    cs = st.catalog_sales
    cs1 = (cs.join(B(dt), F.col("cs_ship_date_sk") == dt.d_date_sk)
             .join(ca, F.col("cs_ship_addr_sk") == ca.ca_address_sk)
             .join(B(cc), F.col("cs_call_center_sk") == cc.cc_call_center_sk))
    # only the orders that pass the filters need their warehouses compared
    mine = cs.join(cs1.select(F.col("cs_order_number").alias("my_order")).distinct(), F.col("cs_order_number") == F.col("my_order"), "left_semi")
    multi = _multi_warehouse_orders(mine, "cs_order_number", "cs_warehouse_sk")
    cs1 = (cs1.filter(F.col("cs_warehouse_sk").isNotNull())
              .join(multi, F.col("cs_order_number") == multi.m_order, "left_semi")
              .join(st.catalog_returns.select("cr_order_number"),
                    F.col("cs_order_number") == F.col("cr_order_number"), "left_anti"))
    return _shipping_summary(cs1, "cs")


@star_query("q94", state="IL", start="1999-02-01", company="company 2")
def q94(st, start="1999-02-01", state="IL", company="company 2"):
    """Web orders shipped from several warehouses and never returned."""
    d0 = F.lit(start).cast("date")
    dt = st.date_dim.filter(F.col("d_date").between(d0, F.date_add(d0, 60))).select("d_date_sk")
    ca = st.customer_address.filter(F.col("ca_state") == state).select("ca_address_sk")
    site = st.web_site.filter(F.col("web_company_name") == company).select("web_site_sk")
    ws = st.web_sales
    ws1 = (ws.join(B(dt), F.col("ws_ship_date_sk") == dt.d_date_sk)
             .join(ca, F.col("ws_ship_addr_sk") == ca.ca_address_sk)
             .join(B(site), F.col("ws_web_site_sk") == site.web_site_sk))
    mine = ws.join(ws1.select(F.col("ws_order_number").alias("my_order")).distinct(), F.col("ws_order_number") == F.col("my_order"), "left_semi")
    multi = _multi_warehouse_orders(mine, "ws_order_number", "ws_warehouse_sk")
    ws1 = (ws1.filter(F.col("ws_warehouse_sk").isNotNull())
              .join(multi, F.col("ws_order_number") == multi.m_order, "left_semi")
              .join(st.web_returns.select("wr_order_number"),
                    F.col("ws_order_number") == F.col("wr_order_number"), "left_anti"))
    return _shipping_summary(ws1, "ws")


@star_query("q95", start="1999-02-01", state="IL", company="company 2")
def q95(st, start="1999-02-01", state="IL", company="company 2"):
    """Web orders shipped from several warehouses that were returned."""
    d0 = F.lit(start).cast("date")
    dt = st.date_dim.filter(F.col("d_date").between(d0, F.date_add(d0, 60))).select("d_date_sk")
    ca = st.customer_address.filter(F.col("ca_state") == state).select("ca_address_sk")
    site = st.web_site.filter(F.col("web_company_name") == company).select("web_site_sk")
    ws = st.web_sales
    ws1 = (ws.join(B(dt), F.col("ws_ship_date_sk") == dt.d_date_sk)
             .join(ca, F.col("ws_ship_addr_sk") == ca.ca_address_sk)
             .join(B(site), F.col("ws_web_site_sk") == site.web_site_sk)
             .join(st.web_returns.select("wr_order_number"), F.col("ws_order_number") == F.col("wr_order_number"), "left_semi"))
    # only the orders that pass the filters need their warehouses compared; one check serves the sale and its return
    mine = ws.join(ws1.select(F.col("ws_order_number").alias("my_order")).distinct(), F.col("ws_order_number") == F.col("my_order"), "left_semi")
    multi = _multi_warehouse_orders(mine, "ws_order_number", "ws_warehouse_sk")
    return _shipping_summary(ws1.join(multi, F.col("ws_order_number") == multi.m_order, "left_semi"), "ws")


@star_query("q97", month_seq=1176)
def q97(st, month_seq=1200):
    """Customer-item pairs bought in store only / catalog only / both (full outer join)."""
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    ssci = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
            .select(F.col("ss_customer_sk").alias("s_cust"), F.col("ss_item_sk").alias("s_item")).distinct())
    csci = (st.catalog_sales.join(B(dt), F.col("cs_sold_date_sk") == dt.d_date_sk)
            .select(F.col("cs_bill_customer_sk").alias("c_cust"), F.col("cs_item_sk").alias("c_item")).distinct())
    j = ssci.join(csci, (ssci.s_cust == csci.c_cust) & (ssci.s_item == csci.c_item), "full")
    s_in, c_in = F.col("s_cust").isNotNull(), F.col("c_cust").isNotNull()
    return j.agg(F.sum(F.when(s_in & ~c_in, 1).otherwise(0)).alias("store_only"),
                 F.sum(F.when(~s_in & c_in, 1).otherwise(0)).alias("catalog_only"),
                 F.sum(F.when(s_in & c_in, 1).otherwise(0)).alias("store_and_catalog"))


@star_query("q54", category="gear", klass="economy")
def q54(st, category="Women", klass="maternity", year=1998, month=12):
    """Revenue segments of customers who bought a category/class on the web or
    catalog in one month, measured in stores over the next three months."""
    cs_ws = (st.catalog_sales.select(F.col("cs_sold_date_sk").alias("sold_date_sk"),
                                     F.col("cs_bill_customer_sk").alias("customer_sk"),
                                     F.col("cs_item_sk").alias("item_sk"))
             .unionByName(st.web_sales.select(F.col("ws_sold_date_sk").alias("sold_date_sk"),
                                              F.col("ws_bill_customer_sk").alias("customer_sk"),
                                              F.col("ws_item_sk").alias("item_sk"))))
    it = st.item.filter((F.col("i_category") == category) & (F.col("i_class") == klass)).select("i_item_sk")
    dm = st.date_dim.filter((F.col("d_moy") == month) & (F.col("d_year") == year)).select("d_date_sk")
    my_customers = (cs_ws.join(B(dm), cs_ws.sold_date_sk == dm.d_date_sk)
                    .join(it, cs_ws.item_sk == it.i_item_sk)
                    .join(st.customer.select("c_customer_sk", "c_current_addr_sk"),
                          F.col("c_customer_sk") == cs_ws.customer_sk)
                    .select("c_customer_sk", "c_current_addr_sk").distinct())
    base_seq = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_moy") == month)) \
        .select(F.col("d_month_seq").alias("m0")).distinct()
    d3 = st.date_dim.join(B(base_seq), F.col("d_month_seq").between(base_seq.m0 + 1, base_seq.m0 + 3)) \
        .select("d_date_sk")
    ca = st.customer_address.select("ca_address_sk", "ca_county", "ca_state")
    s = st.store.select("s_county", "s_state")
    rev = (my_customers.join(ca, my_customers.c_current_addr_sk == ca.ca_address_sk)
           .join(B(s), (ca.ca_county == s.s_county) & (ca.ca_state == s.s_state))
           .join(st.store_sales.select("ss_customer_sk", "ss_sold_date_sk", "ss_ext_sales_price"),
                 F.col("c_customer_sk") == F.col("ss_customer_sk"))
           .join(B(d3), F.col("ss_sold_date_sk") == d3.d_date_sk)
           .groupBy("c_customer_sk").agg(F.sum("ss_ext_sales_price").alias("revenue")))
    # the host's cast of a quotient to integer rounds half up
    seg = rev.select(rdiv((F.col("revenue") * 100).cast("long"), 5000).alias("segment"))
    g = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("num_customers")) \
        .withColumn("segment_base", F.col("segment") * 50)
    return topk(g, 100, "segment", "num_customers")


def _cross_items(st, y0):
    """Items whose (brand, class, category) sold in all three channels in the
    three years starting y0 (INTERSECT of three distinct key sets).

    INTERSECT keeps distinct keys only, so each channel is first reduced to
    its distinct sold item keys (partial aggregation before the shuffle);
    the join with ``item`` then sees one row per sold item, not one per
    sale of three years."""
    dt = st.date_dim.filter(F.col("d_year").between(y0, y0 + 2)).select("d_date_sk")
    keys = ["i_brand_id", "i_class_id", "i_category_id"]
    it = st.item.select("i_item_sk", *keys)
    sets = []
    for fact, p in [("store_sales", "ss"), ("catalog_sales", "cs"), ("web_sales", "ws")]:
        sold = (st[fact].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk, "left_semi")
                .select(F.col(f"{p}_item_sk").alias("sold_sk")).distinct())
        sets.append(sold.join(it, sold.sold_sk == it.i_item_sk).select(*keys))
    x = sets[0].intersect(sets[1]).intersect(sets[2])
    return it.join(x, keys, "left_semi").select(F.col("i_item_sk").alias("x_item_sk"))


def _avg_sales(st, y0):
    dt = st.date_dim.filter(F.col("d_year").between(y0, y0 + 2)).select("d_date_sk")
    parts = [st[f].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
             .select((F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("v"))
             for f, p in [("store_sales", "ss"), ("catalog_sales", "cs"), ("web_sales", "ws")]]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.agg(avg_exact("v").alias("average_sales"))


_CHANNELS = [("store", "store_sales", "ss"), ("catalog", "catalog_sales", "cs"), ("web", "web_sales", "ws")]


def _channel_brand_sales(st, y0, dates, cross, avg, channels=_CHANNELS):
    """Per channel and (brand, class, category): sales of cross-channel items
    above the 3-year average. Channels are unioned first, so the cross-item
    semi join and the average appear once in the plan."""
    keys = ["i_brand_id", "i_class_id", "i_category_id"]
    it = st.item.select("i_item_sk", *keys)
    parts = [st[fact].join(B(dates), F.col(f"{p}_sold_date_sk") == dates.d_date_sk)
             .select(F.lit(ch).alias("channel"), F.col(f"{p}_item_sk").alias("sold_item_sk"),
                     (F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("v"))
             for ch, fact, p in channels]
    u = parts[0]
    for o in parts[1:]:
        u = u.unionByName(o)
    j = (u.join(cross, u.sold_item_sk == cross.x_item_sk, "left_semi")
          .join(it, u.sold_item_sk == it.i_item_sk))
    g = j.groupBy("channel", *keys).agg(F.sum("v").alias("sales"), F.count(F.lit(1)).alias("number_sales"))
    g = g.crossJoin(F.broadcast(avg)).filter(F.col("sales").cast("double") > F.col("average_sales")).drop("average_sales")
    return g.select("channel", *keys, "sales", "number_sales")


@star_query("q14_1", year=1998)
def q14_1(st, year=1999, month=11):
    """Cross-channel items: sales above the 3-year average, ROLLUP by channel/brand/class/category."""
    cross, avg = _cross_items(st, year), _avg_sales(st, year)
    dates = st.date_dim.filter((F.col("d_year") == year + 2) & (F.col("d_moy") == month)).select("d_date_sk")
    y = _channel_brand_sales(st, year, dates, cross, avg)
    g = rollup(y, ["channel", "i_brand_id", "i_class_id", "i_category_id"],
               [F.sum("sales").cast("double").alias("sum_sales"), F.sum("number_sales").alias("sum_number_sales")])
    return topk(g, 100, "channel", "i_brand_id", "i_class_id", "i_category_id", "sum_sales", "sum_number_sales")


@star_query("q14a", year=1998)
def q14a(st, year=1999, month=11):
    """q14_1 with the ROLLUP written as a UNION ALL of the five grouping levels
    (one grouping-sets aggregate over the per-channel brand sales)."""
    cross, avg = _cross_items(st, year), _avg_sales(st, year)
    dates = st.date_dim.filter((F.col("d_year") == year + 2) & (F.col("d_moy") == month)).select("d_date_sk")
    y = _channel_brand_sales(st, year, dates, cross, avg)
    keys = ["channel", "i_brand_id", "i_class_id", "i_category_id"]
    g = grouping_levels(y, keys, [keys[:n] for n in range(len(keys), -1, -1)],
                        [F.sum("sales").cast("double").alias("sum_sales"),
                         F.sum("number_sales").alias("sum_number_sales")])
    return topk(g, 100, "channel", "i_brand_id", "i_class_id", "i_category_id", "sum_sales", "sum_number_sales")


@star_query("q14_2", year=1998)
def q14_2(st, year=1999):
    """Cross-channel brand sales in one week vs. the same week a year earlier."""
    cross, avg = _cross_items(st, year), _avg_sales(st, year)

    def week(y):
        w = st.date_dim.filter((F.col("d_year") == y) & (F.col("d_moy") == 12) & (F.col("d_dom") == 11)) \
            .select(F.col("d_week_seq").alias("w"))
        return st.date_dim.join(B(w), F.col("d_week_seq") == w.w).select("d_date_sk")

    keys = ["i_brand_id", "i_class_id", "i_category_id"]
    ty = _channel_brand_sales(st, year, week(year + 1), cross, avg, _CHANNELS[:1])
    ly = _channel_brand_sales(st, year, week(year), cross, avg, _CHANNELS[:1])
    ly = ly.select(*[F.col(c).alias("ly_" + c) for c in ly.columns])
    j = ty.join(ly, [ty[k] == ly["ly_" + k] for k in keys])
    out = j.select(F.col("channel").alias("ty_channel"), F.col("i_brand_id").alias("ty_brand"),
                   F.col("i_class_id").alias("ty_class"), F.col("i_category_id").alias("ty_category"),
                   F.col("sales").cast("double").alias("ty_sales"), F.col("number_sales").alias("ty_number_sales"),
                   F.col("ly_channel"), F.col("ly_i_brand_id").alias("ly_brand"), F.col("ly_i_class_id").alias("ly_class"),
                   F.col("ly_i_category_id").alias("ly_category"), F.col("ly_sales").cast("double").alias("ly_sales"),
                   F.col("ly_number_sales"))
    return topk(out, 100, "ty_channel", "ty_brand", "ty_class", "ty_category")


def _q23_sets(st, y0, min_cnt, best_frac):
    years = [y0, y0 + 1, y0 + 2, y0 + 3]
    dt = st.date_dim.filter(F.col("d_year").isin(*years)).select("d_date_sk", "d_date")
    it = st.item.select("i_item_sk", F.substring("i_item_desc", 1, 30).alias("itemdesc"))
    freq = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
            .join(it, F.col("ss_item_sk") == it.i_item_sk)
            .groupBy("itemdesc", F.col("i_item_sk").alias("item_sk"), F.col("d_date").alias("solddate"))
            .agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > min_cnt).select("item_sk").distinct())
    per_cust = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
                .join(st.customer.select("c_customer_sk"), F.col("ss_customer_sk") == F.col("c_customer_sk"))
                .groupBy("c_customer_sk").agg(F.sum(F.col("ss_quantity") * F.col("ss_sales_price")).alias("csales")))
    cmax = per_cust.agg(F.max("csales").alias("best_csales"))
    all_time = (st.store_sales.join(st.customer.select("c_customer_sk"), F.col("ss_customer_sk") == F.col("c_customer_sk"))
                .groupBy("c_customer_sk").agg(F.sum(F.col("ss_quantity") * F.col("ss_sales_price")).alias("ssales")))
    best = (all_time.crossJoin(cmax)
            .filter(F.col("ssales").cast("double") > F.lit(best_frac) * F.col("best_csales").cast("double"))
            .select(F.col("c_customer_sk").alias("best_sk")))
    return freq, best


def _q23_channel_rows(st, y0, month, freq, best):
    """Catalog + web lines of one month for frequent items bought by best
    customers (channels unioned first: one semi join per filter)."""
    dt = st.date_dim.filter((F.col("d_year") == y0) & (F.col("d_moy") == month)).select("d_date_sk")
    parts = [st[fact].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
             .select(F.lit(p).alias("ch"), F.col(f"{p}_item_sk").alias("item"),
                     F.col(f"{p}_bill_customer_sk").alias("cust"),
                     (F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("sales"))
             for fact, p in [("catalog_sales", "cs"), ("web_sales", "ws")]]
    u = parts[0].unionByName(parts[1])
    return (u.join(freq, u.item == freq.item_sk, "left_semi")
             .join(best, u.cust == best.best_sk, "left_semi"))


@star_query("q23_1", min_cnt=1, best_frac=0.3)
def q23_1(st, year=2000, month=2, min_cnt=4, best_frac=0.95):
    """Catalog+web revenue from frequently bought store items sold to the best store customers."""
    freq, best = _q23_sets(st, year, min_cnt, best_frac)
    return _q23_channel_rows(st, year, month, freq, best).agg(F.sum("sales").cast("double").alias("sum_sales"))


@star_query("q23_2", min_cnt=1, best_frac=0.3)
def q23_2(st, year=2000, month=2, min_cnt=4, best_frac=0.95):
    """q23_1 broken down by customer name (shares the CTEs of statement 1)."""
    freq, best = _q23_sets(st, year, min_cnt, best_frac)
    rows = _q23_channel_rows(st, year, month, freq, best)
    c = st.customer.select("c_customer_sk", "c_last_name", "c_first_name")
    j = rows.join(c, rows.cust == c.c_customer_sk)
    # grouped per channel, then UNION ALL of the two channel reports
    g = j.groupBy("ch", "c_last_name", "c_first_name").agg(F.sum("sales").cast("double").alias("sales"))
    return topk(g.select("c_last_name", "c_first_name", "sales"), 100, "c_last_name", "c_first_name", "sales")
