"""Queries that combine the store, catalog and web channels.

Year-over-year and quarter-over-quarter comparisons that the benchmark text
writes as 4- or 6-way self joins of one aggregate are computed as ONE
grouped aggregate with conditional sums per (channel, period): a single
shuffle on the entity key instead of several joins of the same large
aggregate.
"""

from __future__ import annotations

from shelfline.plans.catalog.common import B, DataFrame, F, order, star_query, topk

_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_SHORT = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]


def _ratio(a, b):
    return F.when(b != 0, a / b)


def _weekday_pivot(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("d_day_name") == d, F.col(amount))).cast("double").alias(f"{s}_sales")
        for d, s in zip(_DAYS, _SHORT)])


@star_query("q02")
def q02(st, year=2001):
    """Web+catalog weekly revenue by weekday, week vs. the same week a year later."""
    wscs = (st.web_sales.select(F.col("ws_sold_date_sk").alias("sold_date_sk"),
                                F.col("ws_ext_sales_price").alias("sales_price"))
            .unionByName(st.catalog_sales.select(F.col("cs_sold_date_sk").alias("sold_date_sk"),
                                                 F.col("cs_ext_sales_price").alias("sales_price"))))
    # Only weeks that touch the two compared years are read back, so only
    # their days (whole weeks, also the days across a year boundary) are
    # aggregated; the day set is a small broadcast side, and on the
    # date-partitioned layout it prunes fact partitions.
    weeks = st.date_dim.filter(F.col("d_year").isin(year, year + 1)).select(F.col("d_week_seq").alias("wk")).distinct()
    dd = (st.date_dim.join(B(weeks), F.col("d_week_seq") == weeks.wk, "left_semi")
          .select("d_date_sk", "d_week_seq", "d_day_name"))
    weekly = _weekday_pivot(wscs.join(B(dd), wscs.sold_date_sk == dd.d_date_sk), ["d_week_seq"], "sales_price")

    def year_rows(y, suffix):
        days = st.date_dim.filter(F.col("d_year") == y).select(F.col("d_week_seq").alias("w"))
        # one row per calendar day of the year: keeps the benchmark's duplicate rows
        return weekly.join(B(days), weekly.d_week_seq == days.w).select(
            F.col("d_week_seq").alias(f"d_week_seq{suffix}"),
            *[F.col(f"{s}_sales").alias(f"{s}_sales{suffix}") for s in _SHORT])

    y1, y2 = year_rows(year, "1"), year_rows(year + 1, "2")
    j = y1.join(y2, y1.d_week_seq1 == y2.d_week_seq2 - 53)
    out = j.select("d_week_seq1", *[F.round(_ratio(F.col(f"{s}_sales1"), F.col(f"{s}_sales2")), 2)
                                    .alias(f"r_{s}") for s in _SHORT])
    return out.orderBy("d_week_seq1")


def _channel_year_totals(st, channels, years, value_fn):
    """Union of (customer_sk, channel, year, value) over the given channels."""
    parts = []
    for ch, fact, p, cust in channels:
        f = st[fact]
        dt = st.date_dim.filter(F.col("d_year").isin(*years)).select("d_date_sk", "d_year")
        parts.append(f.join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
                      .select(F.col(cust).alias("cust_sk"), F.lit(ch).alias("ch"), "d_year",
                              value_fn(p).alias("v")))
    u = parts[0]
    for p_ in parts[1:]:
        u = u.unionByName(p_)
    return u


def _growth_customers(st, channels, years, value_fn, cond_fn, out_cols, agg="sum"):
    """Per customer: one aggregate with a column per (channel, year), on the integer
    key; the names join the few customers that pass the condition."""
    u = _channel_year_totals(st, channels, years, value_fn)
    c = st.customer.select("c_customer_sk", "c_customer_id", "c_first_name", "c_last_name",
                           "c_preferred_cust_flag", "c_birth_country", "c_login", "c_email_address")
    aggf = getattr(F, agg)
    cols = []
    for ch, *_ in channels:
        for i, y in enumerate(years):
            sel = (F.col("ch") == ch) & (F.col("d_year") == y)
            cols.append(aggf(F.when(sel, F.col("v"))).cast("double").alias(f"{ch}{i + 1}"))
    g = u.groupBy("cust_sk").agg(*cols).filter(cond_fn).join(c, F.col("cust_sk") == c.c_customer_sk)
    return topk(g.select(*out_cols), 100, *out_cols)


def _gt(num_a, den_a, num_b, den_b):
    """(num_a/den_a) > (num_b/den_b) with both ratios guarded by den > 0."""
    return _ratio(F.col(num_a), F.when(F.col(den_a) > 0, F.col(den_a))) > \
        _ratio(F.col(num_b), F.when(F.col(den_b) > 0, F.col(den_b)))


@star_query("q04")
def q04(st, year=2000):
    """Customers whose catalog growth beats both store and web growth."""
    chans = [("s", "store_sales", "ss", "ss_customer_sk"),
             ("c", "catalog_sales", "cs", "cs_bill_customer_sk"),
             ("w", "web_sales", "ws", "ws_bill_customer_sk")]

    def val(p):
        return ((F.col(f"{p}_ext_list_price") - F.col(f"{p}_ext_wholesale_cost")
                 - F.col(f"{p}_ext_discount_amt")) + F.col(f"{p}_ext_sales_price"))

    cond = ((F.col("s1") > 0) & (F.col("c1") > 0) & (F.col("w1") > 0)
            & _gt("c2", "c1", "s2", "s1") & _gt("c2", "c1", "w2", "w1"))
    out = ["c_customer_id", "c_first_name", "c_last_name", "c_preferred_cust_flag"]
    return _growth_customers(st, chans, [year, year + 1], val, cond, out)


@star_query("q11")
def q11(st, year=2000):
    """Customers whose web growth beats their store growth (list - discount)."""
    chans = [("s", "store_sales", "ss", "ss_customer_sk"), ("w", "web_sales", "ws", "ws_bill_customer_sk")]

    def val(p):
        return F.col(f"{p}_ext_list_price") - F.col(f"{p}_ext_discount_amt")

    cond = (F.col("s1") > 0) & (F.col("w1") > 0) & _gt("w2", "w1", "s2", "s1")
    out = ["c_customer_id", "c_first_name", "c_last_name", "c_preferred_cust_flag"]
    return _growth_customers(st, chans, [year, year + 1], val, cond, out)


@star_query("q74")
def q74(st, year=2000, agg="sum"):
    """Customers whose web net-paid growth beats their store growth."""
    chans = [("s", "store_sales", "ss", "ss_customer_sk"), ("w", "web_sales", "ws", "ws_bill_customer_sk")]
    cond = (F.col("s1") > 0) & (F.col("w1") > 0) & _gt("w2", "w1", "s2", "s1")
    out = ["c_customer_id", "c_first_name", "c_last_name"]
    return _growth_customers(st, chans, [year, year + 1], lambda p: F.col(f"{p}_net_paid"), cond, out, agg)


@star_query("q31")
def q31(st, year=2000):
    """Counties where web quarter-over-quarter growth beats store growth twice."""
    parts = []
    for ch, fact, p, addr in [("s", "store_sales", "ss", "ss_addr_sk"), ("w", "web_sales", "ws", "ws_bill_addr_sk")]:
        dt = st.date_dim.filter((F.col("d_year") == year) & F.col("d_qoy").isin(1, 2, 3)).select("d_date_sk", "d_qoy")
        parts.append(st[fact].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
                     .select(F.col(addr).alias("addr"), F.lit(ch).alias("ch"), "d_qoy",
                             F.col(f"{p}_ext_sales_price").alias("v")))
    u = parts[0].unionByName(parts[1])
    ca = st.customer_address.select("ca_address_sk", "ca_county")
    j = u.join(ca, u.addr == ca.ca_address_sk)
    g = j.groupBy("ca_county").agg(*[
        F.sum(F.when((F.col("ch") == ch) & (F.col("d_qoy") == qn), F.col("v"))).cast("double").alias(f"{ch}{qn}")
        for ch in ("s", "w") for qn in (1, 2, 3)])
    # the benchmark's inner joins require all six (county, channel, quarter) aggregates to exist
    g = g.filter(F.col("s1").isNotNull() & F.col("s2").isNotNull() & F.col("s3").isNotNull()
                 & F.col("w1").isNotNull() & F.col("w2").isNotNull() & F.col("w3").isNotNull())
    g = g.filter(_gt("w2", "w1", "s2", "s1") & _gt("w3", "w2", "s3", "s2"))
    out = g.select("ca_county", F.lit(year).alias("d_year"),
                   _ratio(F.col("w2"), F.col("w1")).alias("web_q1_q2_increase"),
                   _ratio(F.col("s2"), F.col("s1")).alias("store_q1_q2_increase"),
                   _ratio(F.col("w3"), F.col("w2")).alias("web_q2_q3_increase"),
                   _ratio(F.col("s3"), F.col("s2")).alias("store_q2_q3_increase"))
    return out.orderBy(*order("ca_county"))


def _three_channel_totals(st, key, item_filter, year, month, gmt_offset):
    """Per-channel revenue by item attribute for items matching a set filter,
    unioned and re-aggregated (partial aggregates before the union)."""
    keys = st.item.filter(item_filter).select(F.col(key).alias("k_")).distinct()
    it = st.item.join(keys, F.col(key) == keys.k_, "left_semi").select("i_item_sk", key)
    dt = st.date_dim.filter((F.col("d_year") == year) & (F.col("d_moy") == month)).select("d_date_sk")
    ca = st.customer_address.filter(F.col("ca_gmt_offset") == gmt_offset).select("ca_address_sk")
    parts = []
    for fact, p, addr in [("store_sales", "ss", "ss_addr_sk"), ("catalog_sales", "cs", "cs_bill_addr_sk"),
                          ("web_sales", "ws", "ws_bill_addr_sk")]:
        f = st[fact]
        parts.append(f.join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
                      .join(ca, F.col(addr) == ca.ca_address_sk)
                      .join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
                      .groupBy(key).agg(F.sum(f"{p}_ext_sales_price").alias("total_sales")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy(key).agg(F.sum("total_sales").cast("double").alias("total_sales"))


@star_query("q33")
def q33(st, category="ring", year=1998, month=5, gmt_offset=-5):
    """Revenue by manufacturer (of a category) over all three channels."""
    g = _three_channel_totals(st, "i_manufact_id", F.col("i_category") == category, year, month, gmt_offset)
    return topk(g, 100, "total_sales", "i_manufact_id")


@star_query("q56")
def q56(st, colors=("blue", "red", "cold"), year=2001, month=2, gmt_offset=-5):
    """Revenue by item id (of some colors) over all three channels."""
    g = _three_channel_totals(st, "i_item_id", F.col("i_color").isin(*colors), year, month, gmt_offset)
    return topk(g, 100, "total_sales", "i_item_id")


@star_query("q60")
def q60(st, category="gear", year=1998, month=9, gmt_offset=-5):
    """Revenue by item id (of a category) over all three channels."""
    g = _three_channel_totals(st, "i_item_id", F.col("i_category") == category, year, month, gmt_offset)
    return topk(g, 100, "i_item_id", "total_sales")


@star_query("q58", weeks=26, band=(0.4, 1.6))
def q58(st, day="2000-01-03", weeks=1, band=(0.9, 1.1)):
    """Items whose revenue in one week is balanced (+-10%) across channels."""
    wk = st.date_dim.filter(F.col("d_date") == F.lit(day).cast("date")).select(F.col("d_week_seq").alias("w0"))
    days = (st.date_dim.join(B(wk), (F.col("d_week_seq") >= wk.w0) & (F.col("d_week_seq") < wk.w0 + weeks))
            .select("d_date_sk"))
    it = st.item.select("i_item_sk", "i_item_id")
    revs = []
    for fact, p in [("store_sales", "ss"), ("catalog_sales", "cs"), ("web_sales", "ws")]:
        revs.append(st[fact].join(B(days), F.col(f"{p}_sold_date_sk") == days.d_date_sk)
                    .join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
                    .groupBy(F.col("i_item_id").alias(f"{p}_id"))
                    .agg(F.sum(f"{p}_ext_sales_price").cast("double").alias(f"{p}_item_rev")))
    ss, cs, ws = revs
    j = ss.join(cs, ss.ss_id == cs.cs_id).join(ws, ss.ss_id == ws.ws_id)
    lo, hi = band
    s, c, w = F.col("ss_item_rev"), F.col("cs_item_rev"), F.col("ws_item_rev")
    j = j.filter(s.between(lo * c, hi * c) & s.between(lo * w, hi * w) & c.between(lo * s, hi * s)
                 & c.between(lo * w, hi * w) & w.between(lo * s, hi * s) & w.between(lo * c, hi * c))
    avg3 = (s + c + w) / 3
    out = j.select(F.col("ss_id").alias("item_id"), "ss_item_rev", (s / avg3 * 100).alias("ss_dev"),
                   "cs_item_rev", (c / avg3 * 100).alias("cs_dev"), "ws_item_rev",
                   (w / avg3 * 100).alias("ws_dev"), avg3.alias("average"))
    return topk(out, 100, "item_id", "ss_item_rev")


@star_query("q59", month_seq=1176)
def q59(st, month_seq=1212):
    """Store weekly weekday sales vs. the same week 52 weeks later."""
    # aggregate only the (whole) weeks that touch the two compared 12-month spans
    weeks = (st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 23))
             .select(F.col("d_week_seq").alias("wk")).distinct())
    dd = (st.date_dim.join(B(weeks), F.col("d_week_seq") == weeks.wk, "left_semi")
          .select("d_date_sk", "d_week_seq", "d_day_name"))
    ss = st.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_sales_price")
    wss = _weekday_pivot(ss.join(B(dd), ss.ss_sold_date_sk == dd.d_date_sk), ["d_week_seq", "ss_store_sk"],
                         "ss_sales_price")
    s = st.store.select("s_store_sk", "s_store_id", "s_store_name")

    def side(lo, suffix):
        days = st.date_dim.filter(F.col("d_month_seq").between(lo, lo + 11)).select(F.col("d_week_seq").alias("w"))
        return (wss.join(B(days), wss.d_week_seq == days.w)
                   .join(B(s), wss.ss_store_sk == s.s_store_sk)
                   .select(F.col("s_store_name").alias(f"s_store_name{suffix}"),
                           F.col("s_store_id").alias(f"s_store_id{suffix}"),
                           F.col("d_week_seq").alias(f"d_week_seq{suffix}"),
                           *[F.col(f"{d}_sales").alias(f"{d}_sales{suffix}") for d in _SHORT]))

    y, x = side(month_seq, "1"), side(month_seq + 12, "2")
    j = y.join(x, (y.s_store_id1 == x.s_store_id2) & (y.d_week_seq1 == x.d_week_seq2 - 52))
    out = j.select("s_store_name1", "s_store_id1", "d_week_seq1",
                   *[_ratio(F.col(f"{d}_sales1"), F.col(f"{d}_sales2")).alias(f"r_{d}") for d in _SHORT])
    return topk(out, 100, "s_store_name1", "s_store_id1", "d_week_seq1", *[f"r_{d}" for d in _SHORT])


@star_query("q71", manager_id=1)
def q71(st, manager_id=1, month=11, year=1999):
    """Brand revenue by time of day (breakfast/dinner) over all channels."""
    dt = st.date_dim.filter((F.col("d_moy") == month) & (F.col("d_year") == year)).select("d_date_sk")
    parts = []
    for fact, p in [("web_sales", "ws"), ("catalog_sales", "cs"), ("store_sales", "ss")]:
        parts.append(st[fact].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
                     .select(F.col(f"{p}_ext_sales_price").alias("ext_price"),
                             F.col(f"{p}_item_sk").alias("sold_item_sk"),
                             F.col(f"{p}_sold_time_sk").alias("time_sk")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    it = st.item.filter(F.col("i_manager_id") == manager_id).select("i_item_sk", "i_brand_id", "i_brand")
    t = st.time_dim.filter(F.col("t_meal_time").isin("breakfast", "dinner")).select("t_time_sk", "t_hour", "t_minute")
    j = u.join(it, u.sold_item_sk == it.i_item_sk).join(B(t), u.time_sk == t.t_time_sk)
    g = j.groupBy("i_brand", "i_brand_id", "t_hour", "t_minute").agg(
        F.sum("ext_price").cast("double").alias("ext_price"))
    g = g.select(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"), "t_hour", "t_minute",
                 "ext_price")
    return g.orderBy(*order("-ext_price", "brand_id", "brand", "t_hour", "t_minute"))


@star_query("q76")
def q76(st):
    """Counts and revenue of sales lines with a missing key, by channel/quarter/category."""
    it = st.item.select("i_item_sk", "i_category")
    dd = st.date_dim.select("d_date_sk", "d_year", "d_qoy")
    parts = []
    for ch, fact, p, col in [("store", "store_sales", "ss", "ss_store_sk"),
                             ("web", "web_sales", "ws", "ws_ship_customer_sk"),
                             ("catalog", "catalog_sales", "cs", "cs_ship_addr_sk")]:
        f = st[fact].filter(F.col(col).isNull())
        parts.append(f.join(B(dd), F.col(f"{p}_sold_date_sk") == dd.d_date_sk)
                      .join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
                      .select(F.lit(ch).alias("channel"), F.lit(col).alias("col_name"), "d_year", "d_qoy",
                              "i_category", F.col(f"{p}_ext_sales_price").alias("ext_sales_price")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    g = u.groupBy("channel", "col_name", "d_year", "d_qoy", "i_category").agg(
        F.count(F.lit(1)).alias("sales_cnt"), F.sum("ext_sales_price").cast("double").alias("sales_amt"))
    return topk(g, 100, "channel", "col_name", "d_year", "d_qoy", "i_category")


_WEEKLY_2000 = tuple(f"2000-{m:02d}-{d:02d}" for m in (2, 5, 8, 11) for d in (3, 10, 17))


@star_query("q83", days=_WEEKLY_2000)
def q83(st, days=("2000-06-30", "2000-09-27", "2000-11-17")):
    """Returned quantities per item id in three weeks, compared across channels."""
    wk = st.date_dim.filter(F.col("d_date").isin(*[F.lit(d).cast("date") for d in days])) \
        .select(F.col("d_week_seq").alias("w")).distinct()
    dsel = st.date_dim.join(B(wk), F.col("d_week_seq") == wk.w, "left_semi").select("d_date_sk")
    it = st.item.select("i_item_sk", "i_item_id")
    qs = []
    for fact, p, qty in [("store_returns", "sr", "sr_return_quantity"),
                         ("catalog_returns", "cr", "cr_return_quantity"),
                         ("web_returns", "wr", "wr_return_quantity")]:
        qs.append(st[fact].join(B(dsel), F.col(f"{p}_returned_date_sk") == dsel.d_date_sk)
                  .join(it, F.col(f"{p}_item_sk") == it.i_item_sk)
                  .groupBy(F.col("i_item_id").alias(f"{p}_id"))
                  .agg(F.sum(qty).alias(f"{p}_item_qty")))
    sr, cr, wr = qs
    j = sr.join(cr, sr.sr_id == cr.cr_id).join(wr, sr.sr_id == wr.wr_id)
    s, c, w = F.col("sr_item_qty"), F.col("cr_item_qty"), F.col("wr_item_qty")
    tot = (s + c + w).cast("double")
    out = j.select(F.col("sr_id").alias("item_id"), "sr_item_qty", (s / tot / 3.0 * 100).alias("sr_dev"),
                   "cr_item_qty", (c / tot / 3.0 * 100).alias("cr_dev"), "wr_item_qty",
                   (w / tot / 3.0 * 100).alias("wr_dev"), (tot / 3.0).alias("average"))
    return topk(out, 100, "item_id", "sr_item_qty")
