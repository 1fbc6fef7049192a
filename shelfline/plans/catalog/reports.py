"""Remaining catalogue reports: demographic/geography OR-of-AND filters,
inventory ratios, ticket-level customer reports, shipping latency buckets,
and the 18-relation cross-sales comparison (q64).
"""

from __future__ import annotations

from shelfline.functions.money import stddev_samp_exact
from shelfline.plans.catalog.common import (B, F, avg_exact, demographics, demographics_of, order, star_query, topk)


def _demo_geo_sales(st, year, pairs):
    """store_sales with the dimension columns the OR-of-AND filters read.
    The join keys (cdemo, hdemo, addr) are written explicitly, and the
    demographics are cut to the listed ``pairs`` first; only the residual
    attribute predicates remain inside the OR."""
    profiles = demographics_of(st, pairs, "cd_demo_sk", "cd_marital_status", "cd_education_status")
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    return (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
            .join(B(st.store.select("s_store_sk")), F.col("ss_store_sk") == F.col("s_store_sk"))
            .join(profiles, F.col("ss_cdemo_sk") == F.col("cd_demo_sk"))
            .join(st.customer_address.select("ca_address_sk", "ca_country", "ca_state"),
                  F.col("ss_addr_sk") == F.col("ca_address_sk")))


@star_query("q13", year=1999, marital=("D", "W", "S"), education=("2 yr Degree", "Secondary", "College"))
def q13(st, year=2001, marital=("M", "S", "W"), education=("Advanced Degree", "College", "2 yr Degree")):
    """Averages of store lines matching demographic x price and geography x profit profiles."""
    j = _demo_geo_sales(st, year, list(zip(marital, education))).join(
        B(st.household_demographics.select("hd_demo_sk", "hd_dep_count")), F.col("ss_hdemo_sk") == F.col("hd_demo_sk"))
    m, e, p, hd = F.col("cd_marital_status"), F.col("cd_education_status"), F.col("ss_sales_price"), F.col("hd_dep_count")
    demo = (((m == marital[0]) & (e == education[0]) & p.between(100, 150) & (hd == 3))
            | ((m == marital[1]) & (e == education[1]) & p.between(50, 100) & (hd == 1))
            | ((m == marital[2]) & (e == education[2]) & p.between(150, 200) & (hd == 1)))
    us, s, np_ = F.col("ca_country") == "United States", F.col("ca_state"), F.col("ss_net_profit")
    geo = ((us & s.isin("IN", "KS", "KY") & np_.between(100, 200))
           | (us & s.isin("MA", "MD", "IA") & np_.between(150, 300))
           | (us & s.isin("ME", "CT", "ID") & np_.between(50, 250)))
    return j.filter(demo & geo).agg(avg_exact("ss_quantity").alias("avg_qty"),
                                    avg_exact("ss_ext_sales_price").alias("avg_ext_sales_price"),
                                    avg_exact("ss_ext_wholesale_cost").alias("avg_ext_wholesale_cost"),
                                    F.sum("ss_ext_wholesale_cost").cast("double").alias("sum_ext_wholesale_cost"))


@star_query("q48", year=1999)
def q48(st, year=2000):
    """Total quantity of store lines matching demographic x price and geography x profit profiles."""
    j = _demo_geo_sales(st, year, [("M", "4 yr Degree"), ("D", "2 yr Degree"), ("S", "College")])
    m, e, p = F.col("cd_marital_status"), F.col("cd_education_status"), F.col("ss_sales_price")
    demo = (((m == "M") & (e == "4 yr Degree") & p.between(100, 150))
            | ((m == "D") & (e == "2 yr Degree") & p.between(50, 100))
            | ((m == "S") & (e == "College") & p.between(150, 200)))
    us, s, np_ = F.col("ca_country") == "United States", F.col("ca_state"), F.col("ss_net_profit")
    geo = ((us & s.isin("CO", "IN", "KS") & np_.between(0, 2000))
           | (us & s.isin("MA", "MD", "KY") & np_.between(150, 3000))
           | (us & s.isin("IA", "CT", "ME") & np_.between(50, 25000)))
    return j.filter(demo & geo).agg(F.sum("ss_quantity").alias("sum_quantity"))


@star_query("q21", price_lo=10.0, price_hi=40.0)
def q21(st, day="2000-03-11", price_lo=0.99, price_hi=1.49):
    """Inventory before/after a date per warehouse and item, kept when the
    after/before ratio is between 2/3 and 3/2."""
    d0 = F.lit(day).cast("date")
    dt = st.date_dim.filter(F.col("d_date").between(F.date_sub(d0, 30), F.date_add(d0, 30))).select("d_date_sk", "d_date")
    it = st.item.filter(F.col("i_current_price").between(price_lo, price_hi)).select("i_item_sk", "i_item_id")
    j = (st.inventory.join(B(dt), F.col("inv_date_sk") == dt.d_date_sk)
         .join(it, F.col("inv_item_sk") == it.i_item_sk)
         .join(B(st.warehouse.select("w_warehouse_sk", "w_warehouse_name")), F.col("inv_warehouse_sk") == F.col("w_warehouse_sk")))
    q = F.col("inv_quantity_on_hand")
    g = j.groupBy("w_warehouse_name", "i_item_id").agg(
        F.sum(F.when(F.col("d_date") < d0, q).otherwise(0)).alias("inv_before"),
        F.sum(F.when(F.col("d_date") >= d0, q).otherwise(0)).alias("inv_after"))
    ratio = F.when(F.col("inv_before") > 0, F.col("inv_after") / F.col("inv_before"))
    return topk(g.filter(ratio.between(2.0 / 3.0, 3.0 / 2.0)), 100, "w_warehouse_name", "i_item_id")


def _ticket_counts(st, dom_cond, potentials, ratio_min, years, counties):
    dt = st.date_dim.filter(dom_cond & F.col("d_year").isin(*years)).select("d_date_sk")
    hd = st.household_demographics.filter(
        F.col("hd_buy_potential").isin(*potentials) & (F.col("hd_vehicle_count") > 0)
        & (F.when(F.col("hd_vehicle_count") > 0, F.col("hd_dep_count") / F.col("hd_vehicle_count")) > ratio_min)
    ).select("hd_demo_sk")
    s = st.store.filter(F.col("s_county").isin(*counties)).select("s_store_sk")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_hdemo_sk", "ss_ticket_number", "ss_customer_sk")
    dn = (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk).join(B(s), ss.ss_store_sk == s.s_store_sk)
            .join(B(hd), ss.ss_hdemo_sk == hd.hd_demo_sk)
            .groupBy("ss_ticket_number", "ss_customer_sk").agg(F.count(F.lit(1)).alias("cnt")))
    return dn.join(st.customer.select("c_customer_sk", "c_last_name", "c_first_name", "c_salutation",
                                      "c_preferred_cust_flag"), F.col("ss_customer_sk") == F.col("c_customer_sk"))


_COUNTIES = tuple(f"NATION_{n} County" for n in (0, 1, 4, 5, 8, 12, 16, 20))


@star_query("q34", cnt_range=(2, 20), counties=_COUNTIES)
def q34(st, years=(1999, 2000, 2001), cnt_range=(15, 20), counties=("Williamson County",)):
    """Customers with mid-size tickets on month edges in high-potential households."""
    dom = F.col("d_dom").between(1, 3) | F.col("d_dom").between(25, 28)
    j = _ticket_counts(st, dom, (">10000", "Unknown"), 1.2, years, counties)
    j = j.filter(F.col("cnt").between(*cnt_range))
    out = j.select("c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt")
    return out.orderBy(*order("c_last_name", "c_first_name", "c_salutation", "-c_preferred_cust_flag",
                              "ss_ticket_number", "cnt"))


@star_query("q73", counties=_COUNTIES)
def q73(st, years=(1999, 2000, 2001), cnt_range=(1, 5), counties=("Williamson County",)):
    """Customers with small tickets on the first two days of a month."""
    j = _ticket_counts(st, F.col("d_dom").between(1, 2), (">10000", "Unknown"), 1.0, years, counties)
    j = j.filter(F.col("cnt").between(*cnt_range))
    out = j.select("c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt")
    return out.orderBy(*order("-cnt", "c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag",
                              "ss_ticket_number"))


def _inv_cov(st, year, cov_min):
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk", "d_moy")
    j = (st.inventory.join(B(dt), F.col("inv_date_sk") == dt.d_date_sk)
         .join(B(st.warehouse.select("w_warehouse_sk", "w_warehouse_name")), F.col("inv_warehouse_sk") == F.col("w_warehouse_sk")))
    g = j.groupBy("w_warehouse_name", "w_warehouse_sk", F.col("inv_item_sk").alias("i_item_sk"), "d_moy").agg(
        stddev_samp_exact("inv_quantity_on_hand").alias("stdev"), avg_exact("inv_quantity_on_hand").alias("mean"))
    g = g.withColumn("cov", F.when(F.col("mean") == 0, F.lit(None)).otherwise(F.col("stdev") / F.col("mean")))
    return g.filter(F.when(F.col("mean") == 0, F.lit(0.0)).otherwise(F.col("stdev") / F.col("mean")) > cov_min)


def _q39(st, year, month, cov_min, cov1_min):
    inv = _inv_cov(st, year, cov_min)
    i1 = inv.filter(F.col("d_moy") == month).select(*[F.col(c).alias(c + "1") for c in
                                                      ("w_warehouse_sk", "i_item_sk", "d_moy", "mean", "cov")])
    i2 = inv.filter(F.col("d_moy") == month + 1).select(*[F.col(c).alias(c + "2") for c in
                                                          ("w_warehouse_sk", "i_item_sk", "d_moy", "mean", "cov")])
    j = i1.join(i2, (i1.i_item_sk1 == i2.i_item_sk2) & (i1.w_warehouse_sk1 == i2.w_warehouse_sk2))
    if cov1_min is not None:
        j = j.filter(F.col("cov1") > cov1_min)
    return j.orderBy(*order("w_warehouse_sk1", "i_item_sk1", "d_moy1", "mean1", "cov1", "d_moy2", "mean2", "cov2"))


@star_query("q39_1", year=2000, cov_min=0.5)
def q39_1(st, year=2001, month=1, cov_min=1.0):
    """Item/warehouse months with high on-hand variability in two consecutive months."""
    return _q39(st, year, month, cov_min, None)


@star_query("q39_2", year=2000, cov_min=0.5, cov1_min=0.6)
def q39_2(st, year=2001, month=1, cov_min=1.0, cov1_min=1.5):
    """q39_1 restricted to a higher variability in the first month."""
    return _q39(st, year, month, cov_min, cov1_min)


def _ticket_city(st, date_cond, hd_cond, store_cond):
    dt = st.date_dim.filter(date_cond).select("d_date_sk")
    hd = st.household_demographics.filter(hd_cond).select("hd_demo_sk")
    s = st.store.filter(store_cond).select("s_store_sk", "s_city")
    ss = st.store_sales
    return (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk).join(B(s), ss.ss_store_sk == s.s_store_sk)
              .join(B(hd), ss.ss_hdemo_sk == hd.hd_demo_sk))


def _moved_customers(st, dn):
    cur = st.customer_address.select(F.col("ca_address_sk").alias("cur_sk"), F.col("ca_city"))
    c = st.customer.select("c_customer_sk", "c_current_addr_sk", "c_last_name", "c_first_name")
    return (dn.join(c, dn.ss_customer_sk == c.c_customer_sk)
              .join(cur, (c.c_current_addr_sk == cur.cur_sk) & (cur.ca_city != dn.bought_city)))


@star_query("q46", cities=("Ambervale", "Elkhaven", "Inkwell"))
def q46(st, years=(1999, 2000, 2001), cities=("Ambervale", "Elkhaven")):
    """Weekend tickets bought in a city other than the customer's current one."""
    j = _ticket_city(st, F.col("d_dow").isin(6, 0) & F.col("d_year").isin(*years),
                     (F.col("hd_dep_count") == 4) | (F.col("hd_vehicle_count") == 3), F.col("s_city").isin(*cities))
    ca = st.customer_address.select("ca_address_sk", F.col("ca_city").alias("bought_city"))
    dn = (j.join(ca, F.col("ss_addr_sk") == ca.ca_address_sk)
           .groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city")
           .agg(F.sum("ss_coupon_amt").cast("double").alias("amt"), F.sum("ss_net_profit").cast("double").alias("profit")))
    out = _moved_customers(st, dn).select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number",
                                          "amt", "profit")
    return topk(out, 100, "c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "amt", "profit")


@star_query("q68", cities=("Ambervale", "Elkhaven", "Inkwell"))
def q68(st, years=(1999, 2000, 2001), cities=("Elkhaven", "Ambervale")):
    """Early-month tickets bought in another city: extended price, tax and list price."""
    j = _ticket_city(st, F.col("d_dom").between(1, 2) & F.col("d_year").isin(*years),
                     (F.col("hd_dep_count") == 4) | (F.col("hd_vehicle_count") == 3), F.col("s_city").isin(*cities))
    ca = st.customer_address.select("ca_address_sk", F.col("ca_city").alias("bought_city"))
    dn = (j.join(ca, F.col("ss_addr_sk") == ca.ca_address_sk)
           .groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city")
           .agg(F.sum("ss_ext_sales_price").cast("double").alias("extended_price"),
                F.sum("ss_ext_list_price").cast("double").alias("list_price"),
                F.sum("ss_ext_tax").cast("double").alias("extended_tax")))
    out = _moved_customers(st, dn).select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number",
                                          "extended_price", "extended_tax", "list_price")
    return topk(out, 100, "c_last_name", "ss_ticket_number", "c_first_name", "ca_city", "bought_city",
                "extended_price", "extended_tax", "list_price")


@star_query("q79")
def q79(st, years=(1999, 2000, 2001), employees=(200, 295)):
    """Monday tickets at mid-size stores: coupon amount and profit per customer ticket."""
    j = _ticket_city(st, (F.col("d_dow") == 1) & F.col("d_year").isin(*years),
                     (F.col("hd_dep_count") == 6) | (F.col("hd_vehicle_count") > 2),
                     F.col("s_number_employees").between(*employees))
    ms = (j.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city")
           .agg(F.sum("ss_coupon_amt").cast("double").alias("amt"), F.sum("ss_net_profit").cast("double").alias("profit")))
    c = st.customer.select("c_customer_sk", "c_last_name", "c_first_name")
    out = ms.join(c, ms.ss_customer_sk == c.c_customer_sk).select(
        "c_last_name", "c_first_name", F.substring("s_city", 1, 30).alias("city"), "ss_ticket_number", "amt", "profit")
    return topk(out, 100, "c_last_name", "c_first_name", "city", "profit", "ss_ticket_number", "amt")


def _ship_latency(st, fact, p, outlet, outlet_sk, outlet_name, month_seq):
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    j = (st[fact].join(B(dt), F.col(f"{p}_ship_date_sk") == dt.d_date_sk)
         .join(B(st.warehouse.select("w_warehouse_sk", "w_warehouse_name")), F.col(f"{p}_warehouse_sk") == F.col("w_warehouse_sk"))
         .join(B(st.ship_mode.select("sm_ship_mode_sk", "sm_type")), F.col(f"{p}_ship_mode_sk") == F.col("sm_ship_mode_sk"))
         .join(B(st[outlet].select(outlet_sk, outlet_name)), F.col(f"{p}_{'web_site' if p == 'ws' else 'call_center'}_sk")
               == F.col(outlet_sk)))
    lag = F.col(f"{p}_ship_date_sk") - F.col(f"{p}_sold_date_sk")
    g = j.groupBy(F.substring("w_warehouse_name", 1, 20).alias("warehouse"), "sm_type", outlet_name).agg(
        F.sum(F.when(lag <= 30, 1).otherwise(0)).alias("days_30"),
        F.sum(F.when((lag > 30) & (lag <= 60), 1).otherwise(0)).alias("days_31_60"),
        F.sum(F.when((lag > 60) & (lag <= 90), 1).otherwise(0)).alias("days_61_90"),
        F.sum(F.when((lag > 90) & (lag <= 120), 1).otherwise(0)).alias("days_91_120"),
        F.sum(F.when(lag > 120, 1).otherwise(0)).alias("days_over_120"))
    return topk(g, 100, "warehouse", "sm_type", outlet_name)


@star_query("q62", month_seq=1176)
def q62(st, month_seq=1200):
    """Web shipping-latency buckets per warehouse, ship type and site."""
    return _ship_latency(st, "web_sales", "ws", "web_site", "web_site_sk", "web_name", month_seq)


@star_query("q99", month_seq=1176)
def q99(st, month_seq=1200):
    """Catalog shipping-latency buckets per warehouse, ship type and call center."""
    return _ship_latency(st, "catalog_sales", "cs", "call_center", "cc_call_center_sk", "cc_name", month_seq)


@star_query("q84", city="Ambervale", income_lo=20000)
def q84(st, city="Edgewood", income_lo=38128):
    """Customers in a city and income band who have store returns."""
    ib = st.income_band.filter((F.col("ib_lower_bound") >= income_lo)
                               & (F.col("ib_upper_bound") <= income_lo + 50000)).select("ib_income_band_sk")
    hd = st.household_demographics.join(B(ib), F.col("hd_income_band_sk") == ib.ib_income_band_sk).select("hd_demo_sk")
    ca = st.customer_address.filter(F.col("ca_city") == city).select("ca_address_sk")
    c = (st.customer.join(ca, F.col("c_current_addr_sk") == ca.ca_address_sk)
         .join(B(hd), F.col("c_current_hdemo_sk") == hd.hd_demo_sk)
         .join(demographics(st, "cd_demo_sk"), F.col("c_current_cdemo_sk") == F.col("cd_demo_sk")))
    # a customer appears once for each return of its demographic: counted first, and
    # only the customers that can reach the first 100 rows are expanded
    n = st.store_returns.where("sr_cdemo_sk IS NOT NULL").groupBy("sr_cdemo_sk").agg(F.count(F.lit(1)).alias("n_returns"))
    out = c.join(n, F.col("sr_cdemo_sk") == F.col("cd_demo_sk")).select(
        F.col("c_customer_id").alias("customer_id"),
        F.concat(F.coalesce("c_last_name", F.lit("")), F.lit(", "), F.coalesce("c_first_name", F.lit(""))).alias("customername"),
        F.least("n_returns", F.lit(100)).cast("int").alias("times"))
    first = topk(out, 100, "customer_id", "customername")
    return topk(first.select("customer_id", "customername", F.explode(F.sequence(F.lit(1), "times"))).drop("col"),
                100, "customer_id", "customername")


_Q64_COLORS = ("blue", "red", "cold", "hot", "new", "old")


def _cross_sales(st, colors, price_lo):
    cs_ui = (st.catalog_sales.join(st.catalog_returns, (F.col("cs_item_sk") == F.col("cr_item_sk"))
                                   & (F.col("cs_order_number") == F.col("cr_order_number")))
             .groupBy(F.col("cs_item_sk").alias("ui_item_sk"))
             .agg(F.sum("cs_ext_list_price").alias("sale"),
                  F.sum(F.col("cr_refunded_cash") + F.col("cr_reversed_charge") + F.col("cr_store_credit")).alias("refund"))
             .filter(F.col("sale") > F.lit(2) * F.col("refund")).select("ui_item_sk"))
    it = st.item.filter(F.col("i_color").isin(*colors) & F.col("i_current_price").between(price_lo, price_lo + 10)
                        & F.col("i_current_price").between(price_lo + 1, price_lo + 15)).select("i_item_sk", "i_product_name")
    d = lambda a: st.date_dim.select(F.col("d_date_sk").alias(f"{a}_sk"), F.col("d_year").alias(f"{a}_year"))
    cd = lambda a: demographics(st, F.col("cd_demo_sk").alias(f"{a}_sk"), F.col("cd_marital_status").alias(f"{a}_ms"))
    hd = lambda a: st.household_demographics.select(F.col("hd_demo_sk").alias(f"{a}_sk"),
                                                    F.col("hd_income_band_sk").alias(f"{a}_ib"))
    ad = lambda a: st.customer_address.select(F.col("ca_address_sk").alias(f"{a}_sk"),
                                              *[F.col(f"ca_{c}").alias(f"{a}_{c}") for c in
                                                ("street_number", "street_name", "city", "zip")])
    ib = lambda a: st.income_band.select(F.col("ib_income_band_sk").alias(f"{a}_sk"))
    ss = st.store_sales
    j = (ss.join(it, ss.ss_item_sk == it.i_item_sk)
           .join(cs_ui, ss.ss_item_sk == cs_ui.ui_item_sk, "left_semi")
           .join(st.store_returns.select("sr_item_sk", "sr_ticket_number"),
                 (ss.ss_item_sk == F.col("sr_item_sk")) & (ss.ss_ticket_number == F.col("sr_ticket_number")))
           .join(B(d("d1")), ss.ss_sold_date_sk == F.col("d1_sk"))
           .join(B(st.store.select("s_store_sk", "s_store_name", "s_zip")), ss.ss_store_sk == F.col("s_store_sk"))
           .join(st.customer.select("c_customer_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_current_addr_sk",
                                    "c_first_sales_date_sk", "c_first_shipto_date_sk"),
                 ss.ss_customer_sk == F.col("c_customer_sk"))
           .join(cd("cd1"), ss.ss_cdemo_sk == F.col("cd1_sk"))
           .join(B(hd("hd1")), ss.ss_hdemo_sk == F.col("hd1_sk"))
           .join(ad("ad1"), ss.ss_addr_sk == F.col("ad1_sk"))
           .join(cd("cd2"), (F.col("c_current_cdemo_sk") == F.col("cd2_sk")) & (F.col("cd1_ms") != F.col("cd2_ms")))
           .join(B(hd("hd2")), F.col("c_current_hdemo_sk") == F.col("hd2_sk"))
           .join(ad("ad2"), F.col("c_current_addr_sk") == F.col("ad2_sk"))
           .join(B(d("d2")), F.col("c_first_sales_date_sk") == F.col("d2_sk"))
           .join(B(d("d3")), F.col("c_first_shipto_date_sk") == F.col("d3_sk"))
           .join(B(st.promotion.select("p_promo_sk")), ss.ss_promo_sk == F.col("p_promo_sk"))
           .join(B(ib("ib1")), F.col("hd1_ib") == F.col("ib1_sk"))
           .join(B(ib("ib2")), F.col("hd2_ib") == F.col("ib2_sk")))
    return j.groupBy(
        F.col("i_product_name").alias("product_name"), F.col("i_item_sk").alias("item_sk"),
        F.col("s_store_name").alias("store_name"), F.col("s_zip").alias("store_zip"),
        F.col("ad1_street_number").alias("b_street_number"), F.col("ad1_street_name").alias("b_street_name"),
        F.col("ad1_city").alias("b_city"), F.col("ad1_zip").alias("b_zip"),
        F.col("ad2_street_number").alias("c_street_number"), F.col("ad2_street_name").alias("c_street_name"),
        F.col("ad2_city").alias("c_city"), F.col("ad2_zip").alias("c_zip"),
        F.col("d1_year").alias("syear"), F.col("d2_year").alias("fsyear"), F.col("d3_year").alias("s2year")).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("ss_wholesale_cost").alias("s1"), F.sum("ss_list_price").alias("s2"),
        F.sum("ss_coupon_amt").alias("s3"))


@star_query("q64", price_lo=20)
def q64(st, year=1999, colors=_Q64_COLORS, price_lo=64):
    """Store items with returns and healthy catalog refund ratios: per-store
    cross-sales in one year compared with the next."""
    cs = _cross_sales(st, colors, price_lo)
    c1 = cs.filter(F.col("syear") == year)
    c2 = cs.filter(F.col("syear") == year + 1).select(
        F.col("item_sk").alias("item_sk2"), F.col("store_name").alias("store_name2"),
        F.col("store_zip").alias("store_zip2"), F.col("syear").alias("syear2"), F.col("cnt").alias("cnt2"),
        F.col("s1").alias("s12"), F.col("s2").alias("s22"), F.col("s3").alias("s32"))
    j = c1.join(c2, (c1.item_sk == c2.item_sk2) & (c1.store_name == c2.store_name2) & (c1.store_zip == c2.store_zip2)
                & (c2.cnt2 <= c1.cnt))
    out = j.select("product_name", "store_name", "store_zip", "b_street_number", "b_street_name", "b_city", "b_zip",
                   "c_street_number", "c_street_name", "c_city", "c_zip", "syear", "cnt",
                   F.col("s1").cast("double").alias("s11"), F.col("s2").cast("double").alias("s21"),
                   F.col("s3").cast("double").alias("s31"), F.col("s12").cast("double").alias("s12"),
                   F.col("s22").cast("double").alias("s22"), F.col("s32").cast("double").alias("s32"),
                   "syear2", "cnt2")
    return out.orderBy(*order("product_name", "store_name", "cnt2", "s11", "s12", "b_street_number", "b_street_name",
                              "b_city", "b_zip", "c_street_number", "c_street_name", "c_city", "c_zip", "cnt",
                              "s21", "s31", "s22", "s32"))
