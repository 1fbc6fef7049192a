"""Queries built on scalar, correlated and nested subqueries.

Correlated aggregates are decorrelated into a grouped aggregate joined back
on the correlation key; the grouped side is small (one row per key) and is
produced with partial (map-side) aggregation, so a hot key never lands in a
single task the way a per-key window would.
"""

from __future__ import annotations

from shelfline.plans.catalog.common import (B, F, avg_exact, dates_between, star_query,
                                             topk)


@star_query("q01")
def q01(st, year=2000, state="MA", agg_col="sr_fee"):
    """Customers whose returns at a store exceed 1.2x that store's average."""
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    sr = st.store_returns.select("sr_returned_date_sk", "sr_customer_sk", "sr_store_sk", agg_col)
    ctr = (sr.join(B(dt), sr.sr_returned_date_sk == dt.d_date_sk)
             .groupBy(F.col("sr_customer_sk").alias("ctr_customer_sk"),
                      F.col("sr_store_sk").alias("ctr_store_sk"))
             .agg(F.sum(agg_col).alias("ctr_total_return")))
    store_avg = ctr.groupBy(F.col("ctr_store_sk").alias("a_store_sk")).agg(
        (avg_exact("ctr_total_return") * 1.2).alias("limit_"))
    s = st.store.filter(F.col("s_state") == state).select("s_store_sk")
    j = (ctr.join(B(s), ctr.ctr_store_sk == s.s_store_sk)
            .join(B(store_avg), (ctr.ctr_store_sk == store_avg.a_store_sk)
                  & (ctr.ctr_total_return.cast("double") > store_avg.limit_))
            .join(st.customer.select("c_customer_sk", "c_customer_id"),
                  ctr.ctr_customer_sk == F.col("c_customer_sk")))
    return topk(j.select("c_customer_id"), 100, "c_customer_id")


@star_query("q06", min_count=1)
def q06(st, year=2001, month=1, min_count=10):
    """States with many purchases of items priced 20% above their category average."""
    month_seq = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_moy") == month)) \
        .select(F.col("d_month_seq").alias("m_seq")).distinct()
    dt = st.date_dim.join(month_seq, F.col("d_month_seq") == month_seq.m_seq, "left_semi").select("d_date_sk")
    cat_avg = st.item.groupBy(F.col("i_category").alias("a_category")).agg(
        (avg_exact("i_current_price") * 1.2).alias("limit_"))
    it = st.item.join(B(cat_avg), (F.col("i_category") == cat_avg.a_category)
                      & (F.col("i_current_price").cast("double") > cat_avg.limit_)).select("i_item_sk")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_customer_sk")
    j = (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk)
           .join(it, ss.ss_item_sk == it.i_item_sk)
           .join(st.customer.select("c_customer_sk", "c_current_addr_sk"),
                 ss.ss_customer_sk == F.col("c_customer_sk"))
           .join(st.customer_address.select("ca_address_sk", "ca_state"),
                 F.col("c_current_addr_sk") == F.col("ca_address_sk")))
    g = (j.groupBy(F.col("ca_state").alias("state")).agg(F.count(F.lit(1)).alias("cnt"))
          .filter(F.col("cnt") >= min_count))
    return topk(g, 100, "cnt", "state")


def _returns_above_state_avg(st, returns, p, amt, year, state, extra_cols):
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    r = st[returns].select(f"{p}_returned_date_sk", f"{p}_returning_customer_sk",
                           f"{p}_returning_addr_sk", amt)
    ctr = (r.join(B(dt), F.col(f"{p}_returned_date_sk") == dt.d_date_sk)
            .join(st.customer_address.select("ca_address_sk", "ca_state"),
                  F.col(f"{p}_returning_addr_sk") == F.col("ca_address_sk"))
            .groupBy(F.col(f"{p}_returning_customer_sk").alias("ctr_customer_sk"),
                     F.col("ca_state").alias("ctr_state"))
            .agg(F.sum(amt).alias("ctr_total_return")))
    state_avg = ctr.groupBy(F.col("ctr_state").alias("a_state")).agg(
        (avg_exact("ctr_total_return") * 1.2).alias("limit_"))
    above = ctr.join(state_avg, (ctr.ctr_state == state_avg.a_state)
                     & (ctr.ctr_total_return.cast("double") > state_avg.limit_))
    cust = st.customer.join(st.customer_address.filter(F.col("ca_state") == state),
                            F.col("c_current_addr_sk") == F.col("ca_address_sk"))
    j = above.join(cust, above.ctr_customer_sk == F.col("c_customer_sk"))
    out = j.select(*extra_cols, F.col("ctr_total_return").cast("double").alias("ctr_total_return"))
    return topk(out, 100, *extra_cols, "ctr_total_return")


_Q30_COLS = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "c_preferred_cust_flag",
             "c_birth_day", "c_birth_month", "c_birth_year", "c_birth_country", "c_login",
             "c_email_address", "c_last_review_date"]


@star_query("q30")
def q30(st, year=2000, state="GA"):
    """Web returners whose state-level return total beats 1.2x the state average."""
    return _returns_above_state_avg(st, "web_returns", "wr", "wr_return_amt", year, state, _Q30_COLS)


_Q81_COLS = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "ca_street_number",
             "ca_street_name", "ca_street_type", "ca_suite_number", "ca_city", "ca_county",
             "ca_state", "ca_zip", "ca_country", "ca_gmt_offset", "ca_location_type"]


@star_query("q81")
def q81(st, year=2000, state="GA"):
    """Catalog returners whose return total beats 1.2x their state's average."""
    out = _returns_above_state_avg(st, "catalog_returns", "cr", "cr_return_amt_inc_tax", year, state,
                                   _Q81_COLS)
    return out.withColumn("ca_gmt_offset", F.col("ca_gmt_offset").cast("double"))


def _excess_discount(st, fact, p, manufact_id, start):
    dt = dates_between(st, start, 90)
    f = st[fact].select(f"{p}_item_sk", f"{p}_sold_date_sk", f"{p}_ext_discount_amt")
    window_sales = f.join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
    it = st.item.filter(F.col("i_manufact_id") == manufact_id).select("i_item_sk")
    sales = window_sales.join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
    item_avg = sales.groupBy(F.col(f"{p}_item_sk").alias("a_item_sk")).agg(
        (F.lit(1.3) * avg_exact(f"{p}_ext_discount_amt")).alias("limit_"))
    j = sales.join(item_avg, (F.col(f"{p}_item_sk") == item_avg.a_item_sk)
                   & (F.col(f"{p}_ext_discount_amt").cast("double") > item_avg.limit_))
    return j.agg(F.sum(f"{p}_ext_discount_amt").cast("double").alias("excess_discount_amount"))


@star_query("q32")
def q32(st, manufact_id=77, start="2000-01-27"):
    """Catalog discounts above 1.3x the item's 90-day average discount."""
    return _excess_discount(st, "catalog_sales", "cs", manufact_id, start)


@star_query("q92")
def q92(st, manufact_id=50, start="2000-01-27"):
    """Web discounts above 1.3x the item's 90-day average discount."""
    return _excess_discount(st, "web_sales", "ws", manufact_id, start)


@star_query("q41")
def q41(st, manufact_lo=38):
    """Product names of manufacturers that make at least one item matching
    any of several (category, color, units, size) profiles."""
    c, col, u, sz = F.col("i_category"), F.col("i_color"), F.col("i_units"), F.col("i_size")
    profile = (
        ((c == "ring") & col.isin("blue", "red") & u.isin("Each", "Box") & sz.isin("small", "medium"))
        | ((c == "ring") & col.isin("cold", "hot") & u.isin("Dozen", "Case") & sz.isin("large", "petite"))
        | ((c == "gear") & col.isin("new", "old") & u.isin("Lb", "Oz") & sz.isin("small", "medium"))
        | ((c == "gear") & col.isin("small", "large") & u.isin("Gram", "Pallet") & sz.isin("large", "petite"))
        | ((c == "bolt") & col.isin("blue", "cold") & u.isin("Each", "Oz") & sz.isin("economy", "N/A"))
        | ((c == "rod") & col.isin("red", "hot") & u.isin("Box", "Lb") & sz.isin("extra large", "small")))
    makers = st.item.filter(profile).select(F.col("i_manufact").alias("m_manufact")).distinct()
    i1 = st.item.filter(F.col("i_manufact_id").between(manufact_lo, manufact_lo + 40))
    j = i1.join(makers, i1.i_manufact == makers.m_manufact, "left_semi")
    return topk(j.select("i_product_name").distinct(), 100, "i_product_name")


@star_query("q09", thresholds=(3000, 5000, 4000, 9000, 2000))
def q09(st, thresholds=(74129, 122840, 56580, 10097, 165306), reason_sk=1):
    """Five quantity buckets; each reports the average of one of two columns
    depending on the bucket's row count. One conditional-aggregation pass."""
    ss = st.store_sales.select("ss_quantity", "ss_ext_discount_amt", "ss_net_paid")
    aggs = []
    for b in range(5):
        lo, hi = 20 * b + 1, 20 * b + 20
        inb = F.col("ss_quantity").between(lo, hi)
        aggs += [F.count(F.when(inb, 1)).alias(f"c{b}"),
                 F.sum(F.when(inb, F.col("ss_ext_discount_amt"))).cast("double").alias(f"d{b}"),
                 F.count(F.when(inb, F.col("ss_ext_discount_amt"))).alias(f"dn{b}"),
                 F.sum(F.when(inb, F.col("ss_net_paid"))).cast("double").alias(f"p{b}"),
                 F.count(F.when(inb, F.col("ss_net_paid"))).alias(f"pn{b}")]
    one = ss.agg(*aggs)
    sel = [F.when(F.col(f"c{b}") > thresholds[b], F.col(f"d{b}") / F.col(f"dn{b}"))
            .otherwise(F.col(f"p{b}") / F.col(f"pn{b}")).alias(f"bucket{b + 1}") for b in range(5)]
    r = st.reason.filter(F.col("r_reason_sk") == reason_sk).select("r_reason_sk")
    return r.crossJoin(one).select(*sel)


_Q28_BUCKETS = [(0, 5, 8, 459, 57), (6, 10, 90, 2323, 31), (11, 15, 142, 12214, 79),
                (16, 20, 135, 6071, 38), (21, 25, 122, 836, 17), (26, 30, 154, 7326, 7)]


@star_query("q28")
def q28(st, buckets=_Q28_BUCKETS):
    """Six quantity buckets: avg, count and distinct count of list price.

    Buckets are disjoint, so each row is tagged with its bucket and one
    grouped aggregate (one count-distinct) computes all six; the six result
    rows are folded into one."""
    ss = st.store_sales.select("ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_wholesale_cost")
    tag = F.lit(None)
    for i, (qlo, qhi, lp, cp, wc) in enumerate(buckets):
        cond = (F.col("ss_quantity").between(qlo, qhi)
                & (F.col("ss_list_price").between(lp, lp + 10)
                   | F.col("ss_coupon_amt").between(cp, cp + 1000)
                   | F.col("ss_wholesale_cost").between(wc, wc + 20)))
        tag = F.when(cond, F.lit(i + 1)).otherwise(tag) if i else F.when(cond, F.lit(1))
    per = (ss.withColumn("b", tag).filter(F.col("b").isNotNull())
             .groupBy("b").agg(avg_exact("ss_list_price").alias("lp"),
                               F.count("ss_list_price").alias("cnt"),
                               F.countDistinct("ss_list_price").alias("cntd")))
    cols = []
    for i in range(1, len(buckets) + 1):
        cols += [F.max(F.when(F.col("b") == i, F.col("lp"))).alias(f"b{i}_lp"),
                 F.coalesce(F.max(F.when(F.col("b") == i, F.col("cnt"))), F.lit(0)).alias(f"b{i}_cnt"),
                 F.coalesce(F.max(F.when(F.col("b") == i, F.col("cntd"))), F.lit(0)).alias(f"b{i}_cntd")]
    return per.agg(*cols)


@star_query("q88")
def q88(st, store_name="meadow"):
    """Counts of store sales in eight half-hour slots from 8:30 to 12:30 for
    three household (dependents, vehicles) profiles; one pass."""
    hd = st.household_demographics.filter(
        ((F.col("hd_dep_count") == 4) & (F.col("hd_vehicle_count") <= 6))
        | ((F.col("hd_dep_count") == 2) & (F.col("hd_vehicle_count") <= 4))
        | ((F.col("hd_dep_count") == 0) & (F.col("hd_vehicle_count") <= 2))).select("hd_demo_sk")
    t = st.time_dim.filter(F.col("t_time").between(8 * 3600 + 1800, 12 * 3600 + 1799)) \
        .select("t_time_sk", ((F.col("t_time") - 8 * 3600 - 1800) / 1800).cast("int").alias("slot"))
    s = st.store.filter(F.col("s_store_name") == store_name).select("s_store_sk")
    ss = st.store_sales.select("ss_sold_time_sk", "ss_hdemo_sk", "ss_store_sk")
    j = (ss.join(B(t), ss.ss_sold_time_sk == t.t_time_sk)
           .join(B(hd), ss.ss_hdemo_sk == hd.hd_demo_sk)
           .join(B(s), ss.ss_store_sk == s.s_store_sk))
    names = ["h8_30_to_9", "h9_to_9_30", "h9_30_to_10", "h10_to_10_30", "h10_30_to_11",
             "h11_to_11_30", "h11_30_to_12", "h12_to_12_30"]
    return j.agg(*[F.count(F.when(F.col("slot") == i, 1)).alias(n) for i, n in enumerate(names)])


@star_query("q90", char_range=(4000, 5200))
def q90(st, am_hour=8, pm_hour=19, dep_count=6, char_range=(5000, 5200)):
    """Morning-to-evening ratio of web sales for one household size."""
    hd = st.household_demographics.filter(F.col("hd_dep_count") == dep_count).select("hd_demo_sk")
    wp = st.web_page.filter(F.col("wp_char_count").between(*char_range)).select("wp_web_page_sk")
    t = st.time_dim.select("t_time_sk", "t_hour")
    ws = st.web_sales.select("ws_sold_time_sk", "ws_ship_hdemo_sk", "ws_web_page_sk")
    j = (ws.join(B(t), ws.ws_sold_time_sk == t.t_time_sk)
           .join(B(hd), ws.ws_ship_hdemo_sk == hd.hd_demo_sk)
           .join(B(wp), ws.ws_web_page_sk == wp.wp_web_page_sk))
    c = j.agg(F.count(F.when(F.col("t_hour").between(am_hour, am_hour + 1), 1)).alias("amc"),
              F.count(F.when(F.col("t_hour").between(pm_hour, pm_hour + 1), 1)).alias("pmc"))
    return c.select(F.when(F.col("pmc") > 0, F.col("amc").cast("double") / F.col("pmc"))
                    .alias("am_pm_ratio"))


@star_query("q61", months=(10, 11))
def q61(st, category="ring", gmt_offset=-5, year=1998, months=(11,)):
    """Promoted share of one category's store revenue (promotions vs total)."""
    dt = st.date_dim.filter((F.col("d_year") == year) & F.col("d_moy").isin(*months)).select("d_date_sk")
    s = st.store.filter(F.col("s_gmt_offset") == gmt_offset).select("s_store_sk")
    ca = st.customer_address.filter(F.col("ca_gmt_offset") == gmt_offset).select("ca_address_sk")
    it = st.item.filter(F.col("i_category") == category).select("i_item_sk")
    pr = st.promotion.select("p_promo_sk", ((F.col("p_channel_dmail") == "Y") | (F.col("p_channel_email") == "Y")
                                            | (F.col("p_channel_tv") == "Y")).alias("promoted"))
    ss = st.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_promo_sk", "ss_customer_sk",
                               "ss_item_sk", "ss_ext_sales_price")
    base = (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk)
              .join(B(s), ss.ss_store_sk == s.s_store_sk)
              .join(st.customer.select("c_customer_sk", "c_current_addr_sk"),
                    ss.ss_customer_sk == F.col("c_customer_sk"))
              .join(ca, F.col("c_current_addr_sk") == ca.ca_address_sk)
              .join(it, ss.ss_item_sk == it.i_item_sk)
              .join(B(pr), ss.ss_promo_sk == pr.p_promo_sk, "left"))
    t = base.agg(F.sum(F.when(F.col("promoted"), F.col("ss_ext_sales_price"))).alias("promotions"),
                 F.sum("ss_ext_sales_price").alias("total"))
    return t.select(F.col("promotions").cast("double").alias("promotions"),
                    F.col("total").cast("double").alias("total"),
                    (F.col("promotions").cast("double") / F.col("total").cast("double") * 100).alias("pct"))
