"""Window and ROLLUP query family (and the variants that expand ROLLUP into
UNION ALL of grouping levels).

Every window here runs over a pre-aggregated input (one row per group key x
period), so a window partition is bounded by the number of periods or
roll-up rows of one key, never by raw fact rows. Rank filters (rank <= k)
are planned as WindowGroupLimit, which trims each partition before the
shuffle.
"""

from __future__ import annotations

from shelfline.functions.grouping import grouping_levels, rollup
from shelfline.functions.money import avg_exact
from shelfline.plans.catalog.common import (B, DataFrame, F, Window, dates_between, demographics, order, star_query,
                                             topk)


def _union(parts: list[DataFrame]) -> DataFrame:
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


# --------------------------------------------------------------------------- q05
def _q05_channels(st, start):
    dt = dates_between(st, start, 14)
    z = F.lit(0).cast("decimal(7,2)")

    ss = st.store_sales.select(F.col("ss_store_sk").alias("outlet_sk"), F.col("ss_sold_date_sk").alias("date_sk"),
                               F.col("ss_ext_sales_price").alias("sales_price"), F.col("ss_net_profit").alias("profit"),
                               z.alias("return_amt"), z.alias("net_loss"))
    sr = st.store_returns.select(F.col("sr_store_sk").alias("outlet_sk"), F.col("sr_returned_date_sk").alias("date_sk"),
                                 z.alias("sales_price"), z.alias("profit"), F.col("sr_return_amt").alias("return_amt"),
                                 F.col("sr_net_loss").alias("net_loss"))
    cs = st.catalog_sales.select(F.col("cs_catalog_page_sk").alias("outlet_sk"), F.col("cs_sold_date_sk").alias("date_sk"),
                                 F.col("cs_ext_sales_price").alias("sales_price"), F.col("cs_net_profit").alias("profit"),
                                 z.alias("return_amt"), z.alias("net_loss"))
    cr = st.catalog_returns.select(F.col("cr_catalog_page_sk").alias("outlet_sk"),
                                   F.col("cr_returned_date_sk").alias("date_sk"), z.alias("sales_price"), z.alias("profit"),
                                   F.col("cr_return_amount").alias("return_amt"), F.col("cr_net_loss").alias("net_loss"))
    ws = st.web_sales.select(F.col("ws_web_site_sk").alias("outlet_sk"), F.col("ws_sold_date_sk").alias("date_sk"),
                             F.col("ws_ext_sales_price").alias("sales_price"), F.col("ws_net_profit").alias("profit"),
                             z.alias("return_amt"), z.alias("net_loss"))
    # web returns carry no site key: take it from the originating sale (left join on item, order)
    # (the returns of the 14 days only: few keys, before the whole fact is met)
    wr = (st.web_returns.join(B(dt), F.col("wr_returned_date_sk") == dt.d_date_sk, "left_semi").join(st.web_sales.select("ws_item_sk", "ws_order_number", "ws_web_site_sk"),
                              (F.col("wr_item_sk") == F.col("ws_item_sk"))
                              & (F.col("wr_order_number") == F.col("ws_order_number")), "left")
          .select(F.col("ws_web_site_sk").alias("outlet_sk"), F.col("wr_returned_date_sk").alias("date_sk"),
                  z.alias("sales_price"), z.alias("profit"), F.col("wr_return_amt").alias("return_amt"),
                  F.col("wr_net_loss").alias("net_loss")))
    out = []
    for ch, prefix, u, dim, dim_sk, dim_id in [
            ("store channel", "store", ss.unionByName(sr), st.store, "s_store_sk", "s_store_id"),
            ("catalog channel", "catalog_page", cs.unionByName(cr), st.catalog_page, "cp_catalog_page_sk",
             "cp_catalog_page_id"),
            ("web channel", "web_site", ws.unionByName(wr), st.web_site, "web_site_sk", "web_site_id")]:
        d = dim.select(dim_sk, dim_id)
        g = (u.join(B(dt), u.date_sk == dt.d_date_sk).join(B(d), u.outlet_sk == d[dim_sk])
              .groupBy(dim_id).agg(F.sum("sales_price").alias("sales"), F.sum("profit").alias("profit"),
                                   F.sum("return_amt").alias("returns_"), F.sum("net_loss").alias("profit_loss")))
        out.append(g.select(F.lit(ch).alias("channel"), F.concat(F.lit(prefix), F.col(dim_id)).alias("id"),
                            "sales", "returns_", (F.col("profit") - F.col("profit_loss")).alias("profit")))
    return _union(out)


def _money_totals(df):
    return [F.sum("sales").cast("double").alias("sales"), F.sum("returns_").cast("double").alias("returns"),
            F.sum("profit").cast("double").alias("profit")]


@star_query("q05")
def q05(st, start="2000-08-23"):
    """Sales, returns and profit per channel and outlet over 14 days, ROLLUP(channel, id)."""
    x = _q05_channels(st, start)
    g = rollup(x, ["channel", "id"], _money_totals(x))
    return topk(g, 100, "channel", "id", "sales", "returns", "profit")


_CHANNEL_ID_LEVELS = [["channel", "id"], ["channel"], []]


@star_query("q05a")
def q05a(st, start="2000-08-23"):
    """q05 with the ROLLUP expanded into detail UNION ALL channel totals UNION ALL
    grand total (the three levels evaluated as one grouping-sets aggregate)."""
    x = _q05_channels(st, start)
    g = grouping_levels(x, ["channel", "id"], _CHANNEL_ID_LEVELS, _money_totals(x))
    return topk(g, 100, "channel", "id", "sales", "returns", "profit")


# --------------------------------------------------------------------------- q18
_Q18_STATES = ("IN", "KS", "KY", "MA", "MD", "IA", "ME")


def _q18_detail(st, gender, education, months, year, states):
    cd1 = st.customer_demographics.filter((F.col("cd_gender") == gender) & (F.col("cd_education_status") == education)) \
        .select("cd_demo_sk", "cd_dep_count")
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    c = st.customer.filter(F.col("c_birth_month").isin(*months)).select(
        "c_customer_sk", "c_current_cdemo_sk", "c_current_addr_sk", "c_birth_year")
    ca = st.customer_address.filter(F.col("ca_state").isin(*states)).select(
        "ca_address_sk", "ca_country", "ca_state", "ca_county")
    cd2 = demographics(st, F.col("cd_demo_sk").alias("cd2_sk"))
    cs = st.catalog_sales.select("cs_sold_date_sk", "cs_item_sk", "cs_bill_cdemo_sk", "cs_bill_customer_sk",
                                 "cs_quantity", "cs_list_price", "cs_coupon_amt", "cs_sales_price", "cs_net_profit")
    return (cs.join(B(dt), cs.cs_sold_date_sk == dt.d_date_sk)
              .join(B(cd1), cs.cs_bill_cdemo_sk == cd1.cd_demo_sk)
              .join(c, cs.cs_bill_customer_sk == c.c_customer_sk)
              .join(cd2, c.c_current_cdemo_sk == cd2.cd2_sk)
              .join(ca, c.c_current_addr_sk == ca.ca_address_sk)
              .join(st.item.select("i_item_sk", "i_item_id"), cs.cs_item_sk == F.col("i_item_sk")))


_Q18_AGGS = [("cs_quantity", "agg1"), ("cs_list_price", "agg2"), ("cs_coupon_amt", "agg3"), ("cs_sales_price", "agg4"),
             ("cs_net_profit", "agg5"), ("c_birth_year", "agg6"), ("cd_dep_count", "agg7")]


@star_query("q18", year=1999)
def q18(st, gender="F", education="Unknown", months=(1, 6, 8, 9, 12, 2), year=1998, states=_Q18_STATES):
    """Catalog averages for one demographic, ROLLUP(item, country, state, county)."""
    j = _q18_detail(st, gender, education, months, year, states)
    g = rollup(j, ["i_item_id", "ca_country", "ca_state", "ca_county"],
               [avg_exact(c).alias(a) for c, a in _Q18_AGGS])
    return topk(g, 100, "ca_country", "ca_state", "ca_county", "i_item_id", *[a for _, a in _Q18_AGGS])


@star_query("q18a", year=1999)
def q18a(st, gender="F", education="Unknown", months=(1, 6, 8, 9, 12, 2), year=1998, states=_Q18_STATES):
    """q18 with the ROLLUP written as UNION ALL of averages recomputed from detail
    rows per level (one grouping-sets aggregate over the detail rows)."""
    j = _q18_detail(st, gender, education, months, year, states)
    keys = ["i_item_id", "ca_country", "ca_state", "ca_county"]
    g = grouping_levels(j, keys, [keys[:n] for n in range(len(keys), -1, -1)],
                        [avg_exact(c).alias(a) for c, a in _Q18_AGGS])
    return topk(g, 100, "ca_country", "ca_state", "ca_county", "i_item_id", *[a for _, a in _Q18_AGGS])


def _q22_detail(st, month_seq):
    """Sum and count of on-hand quantity per item, with the item's attributes.

    Snapshots are reduced to one row per item key (an integer key, partial
    aggregation before the shuffle) before the join with ``item``: the item
    attributes are a function of the item key, so grouping the per-item sums
    by them afterwards is exact, and the string-keyed join and grouping see
    one row per item instead of one per snapshot."""
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    per_item = (st.inventory.join(B(dt), F.col("inv_date_sk") == dt.d_date_sk)
                .groupBy("inv_item_sk")
                .agg(F.sum("inv_quantity_on_hand").alias("s"), F.count("inv_quantity_on_hand").alias("c")))
    return per_item.join(st.item.select("i_item_sk", "i_product_name", "i_brand", "i_class", "i_category"),
                         F.col("inv_item_sk") == F.col("i_item_sk"))


_Q22_KEYS = ["i_product_name", "i_brand", "i_class", "i_category"]


@star_query("q22", month_seq=1176)
def q22(st, month_seq=1200):
    """Average on-hand quantity, ROLLUP(product, brand, class, category).

    The average decomposes into (sum, count), so snapshots are first reduced
    to one row per detail group and only those rows are expanded into the
    five roll-up levels (exact: integer sums)."""
    detail = _q22_detail(st, month_seq).groupBy(*_Q22_KEYS).agg(
        F.sum("s").alias("s"), F.sum("c").alias("c"))
    g = rollup(detail, _Q22_KEYS, [(F.sum("s").cast("double") / F.sum("c")).alias("qoh")])
    return topk(g, 100, "qoh", *_Q22_KEYS)


@star_query("q22a", month_seq=1176)
def q22a(st, month_seq=1200):
    """Average of averages per roll-up level (numerically differs from q22 on purpose)."""
    j = _q22_detail(st, month_seq)
    base = j.groupBy(*_Q22_KEYS).agg((F.sum("s").cast("double") / F.sum("c")).alias("qoh"))
    parts = [base]
    for n in (3, 2, 1, 0):
        lv = _Q22_KEYS[:n]
        g = base.groupBy(*lv).agg(F.avg("qoh").alias("qoh"))
        parts.append(g.select(*[F.col(k) if k in lv else F.lit(None).cast("string").alias(k) for k in _Q22_KEYS], "qoh"))
    return topk(_union(parts), 100, "qoh", *_Q22_KEYS)


# --------------------------------------------------------------------------- q27
_Q27_STATES = ("KS", "MA", "KY", "IA", "ID", "CT")


def _q27_detail(st, gender, marital, education, year, states):
    cd = st.customer_demographics.filter((F.col("cd_gender") == gender) & (F.col("cd_marital_status") == marital)
                                         & (F.col("cd_education_status") == education)).select("cd_demo_sk")
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    s = st.store.filter(F.col("s_state").isin(*states)).select("s_store_sk", "s_state")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_store_sk", "ss_cdemo_sk", "ss_quantity",
                               "ss_list_price", "ss_coupon_amt", "ss_sales_price")
    return (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk).join(B(cd), ss.ss_cdemo_sk == cd.cd_demo_sk)
              .join(B(s), ss.ss_store_sk == s.s_store_sk)
              .join(st.item.select("i_item_sk", "i_item_id"), ss.ss_item_sk == F.col("i_item_sk")))


_Q27_AGGS = [("ss_quantity", "agg1"), ("ss_list_price", "agg2"), ("ss_coupon_amt", "agg3"), ("ss_sales_price", "agg4")]


@star_query("q27", year=2000)
def q27(st, gender="M", marital="S", education="College", year=2002, states=_Q27_STATES):
    """Store averages for one demographic, ROLLUP(item, state) with GROUPING(state)."""
    j = _q27_detail(st, gender, marital, education, year, states)
    g = rollup(j, ["i_item_id", "s_state"], [F.grouping("s_state").cast("int").alias("g_state"),
                                             *[avg_exact(c).alias(a) for c, a in _Q27_AGGS]])
    return topk(g, 100, "i_item_id", "s_state", "g_state", *[a for _, a in _Q27_AGGS])


@star_query("q27a", year=2000)
def q27a(st, gender="M", marital="S", education="College", year=2002, states=_Q27_STATES):
    """q27 as UNION ALL of levels with a literal g_state (one grouping-sets
    aggregate; the per-level literal is GROUPING(s_state))."""
    j = _q27_detail(st, gender, marital, education, year, states)
    g = grouping_levels(j, ["i_item_id", "s_state"], [["i_item_id", "s_state"], ["i_item_id"], []],
                        [F.grouping("s_state").cast("int").alias("g_state"),
                         *[avg_exact(c).alias(a) for c, a in _Q27_AGGS]])
    return topk(g, 100, "i_item_id", "s_state", "g_state", *[x for _, x in _Q27_AGGS])


# --------------------------------------------------------------------------- q36 / q70 / q86 (rank within roll-up level)
def _rank_within_parent(g, top, sub, measure, desc):
    """lochierarchy = grouping(top)+grouping(sub); rank inside (level, parent)."""
    w = Window.partitionBy("lochierarchy", "_parent").orderBy(F.col(measure).desc() if desc else F.col(measure).asc())
    g = g.withColumn("_parent", F.when(F.col("_g_sub") == 0, F.col(top)))
    g = g.withColumn("rank_within_parent", F.rank().over(w))
    g = g.withColumn("_ord", F.when(F.col("lochierarchy") == 0, F.col(top)))
    return g


def _level_aggs(measure, top, sub):
    """The measure with the level literals of the UNION variants: lochierarchy
    (0 detail, 1 parent, 2 total) and whether ``sub`` is rolled up."""
    return [measure, (F.grouping(top) + F.grouping(sub)).cast("int").alias("lochierarchy"),
            F.grouping(sub).cast("int").alias("_g_sub")]


def _finish_rank(g, cols, measure):
    out = g.orderBy(F.col("lochierarchy").desc(), F.col("_ord").asc_nulls_last(), F.col("rank_within_parent").asc(),
                    *order(*[c for c in cols if c not in ("lochierarchy", "rank_within_parent")])).limit(100)
    return out.select(*cols)


_Q36_STATES = ("KS", "MA", "KY", "IA", "ID", "CT", "DE", "ME")


def _q36_detail(st, year, states):
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    s = st.store.filter(F.col("s_state").isin(*states)).select("s_store_sk")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_store_sk", "ss_net_profit", "ss_ext_sales_price")
    return (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk).join(B(s), ss.ss_store_sk == s.s_store_sk)
              .join(st.item.select("i_item_sk", "i_category", "i_class"), ss.ss_item_sk == F.col("i_item_sk")))


_Q36_COLS = ["gross_margin", "i_category", "i_class", "lochierarchy", "rank_within_parent"]


@star_query("q36")
def q36(st, year=2001, states=_Q36_STATES):
    """Gross margin by category/class ROLLUP, ranked within each parent."""
    j = _q36_detail(st, year, states)
    g = rollup(j, ["i_category", "i_class"], [
        (F.sum("ss_net_profit").cast("double") / F.sum("ss_ext_sales_price").cast("double")).alias("gross_margin"),
        (F.grouping("i_category") + F.grouping("i_class")).cast("int").alias("lochierarchy"),
        F.grouping("i_class").alias("_g_sub")])
    return _finish_rank(_rank_within_parent(g, "i_category", "i_class", "gross_margin", False), _Q36_COLS, "gross_margin")


@star_query("q36a")
def q36a(st, year=2001, states=_Q36_STATES):
    """q36 with the roll-up levels written as UNION and a literal lochierarchy
    (one grouping-sets aggregate; the per-level literal is the sum of the
    GROUPING flags)."""
    j = _q36_detail(st, year, states)
    gm = (F.sum("ss_net_profit").cast("double") / F.sum("ss_ext_sales_price").cast("double")).alias("gross_margin")
    g = grouping_levels(j, ["i_category", "i_class"], [["i_category", "i_class"], ["i_category"], []],
                        _level_aggs(gm, "i_category", "i_class")).distinct()
    return _finish_rank(_rank_within_parent(g, "i_category", "i_class", "gross_margin", False), _Q36_COLS, "gross_margin")


def _q70_detail(st, month_seq, top_states):
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    s = st.store.select("s_store_sk", "s_state", "s_county")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_net_profit")
    base = ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk).join(B(s), ss.ss_store_sk == s.s_store_sk)
    by_state = base.groupBy("s_state").agg(F.sum("ss_net_profit").alias("p"))
    ranked = (by_state.withColumn("ranking", F.rank().over(Window.partitionBy("s_state").orderBy(F.desc("p"))))
              .filter(F.col("ranking") <= top_states).select(F.col("s_state").alias("top_state")))
    return base.join(B(ranked), base.s_state == ranked.top_state, "left_semi")


_Q70_COLS = ["total_sum", "s_state", "s_county", "lochierarchy", "rank_within_parent"]


@star_query("q70", month_seq=1176)
def q70(st, month_seq=1200, top_states=5):
    """Store profit ROLLUP(state, county) for top states, ranked within parent."""
    j = _q70_detail(st, month_seq, top_states)
    g = rollup(j, ["s_state", "s_county"], [
        F.sum("ss_net_profit").cast("double").alias("total_sum"),
        (F.grouping("s_state") + F.grouping("s_county")).cast("int").alias("lochierarchy"),
        F.grouping("s_county").alias("_g_sub")])
    return _finish_rank(_rank_within_parent(g, "s_state", "s_county", "total_sum", True), _Q70_COLS, "total_sum")


@star_query("q70a", month_seq=1176)
def q70a(st, month_seq=1200, top_states=5):
    """q70 with the levels written as UNION and a literal lochierarchy (one
    grouping-sets aggregate)."""
    j = _q70_detail(st, month_seq, top_states)
    ts = F.sum("ss_net_profit").cast("double").alias("total_sum")
    g = grouping_levels(j, ["s_state", "s_county"], [["s_state", "s_county"], ["s_state"], []],
                        _level_aggs(ts, "s_state", "s_county"))
    return _finish_rank(_rank_within_parent(g, "s_state", "s_county", "total_sum", True), _Q70_COLS, "total_sum")


def _q86_detail(st, month_seq):
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    ws = st.web_sales.select("ws_sold_date_sk", "ws_item_sk", "ws_net_paid")
    return (ws.join(B(dt), ws.ws_sold_date_sk == dt.d_date_sk)
              .join(st.item.select("i_item_sk", "i_category", "i_class"), ws.ws_item_sk == F.col("i_item_sk")))


_Q86_COLS = ["total_sum", "i_category", "i_class", "lochierarchy", "rank_within_parent"]


@star_query("q86", month_seq=1176)
def q86(st, month_seq=1200):
    """Web net paid ROLLUP(category, class), ranked within parent."""
    j = _q86_detail(st, month_seq)
    g = rollup(j, ["i_category", "i_class"], [
        F.sum("ws_net_paid").cast("double").alias("total_sum"),
        (F.grouping("i_category") + F.grouping("i_class")).cast("int").alias("lochierarchy"),
        F.grouping("i_class").alias("_g_sub")])
    return _finish_rank(_rank_within_parent(g, "i_category", "i_class", "total_sum", True), _Q86_COLS, "total_sum")


@star_query("q86a", month_seq=1176)
def q86a(st, month_seq=1200):
    """q86 with the levels written as UNION and a literal lochierarchy (one
    grouping-sets aggregate)."""
    j = _q86_detail(st, month_seq)
    ts = F.sum("ws_net_paid").cast("double").alias("total_sum")
    g = grouping_levels(j, ["i_category", "i_class"], [["i_category", "i_class"], ["i_category"], []],
                        _level_aggs(ts, "i_category", "i_class"))
    return _finish_rank(_rank_within_parent(g, "i_category", "i_class", "total_sum", True), _Q86_COLS, "total_sum")


# --------------------------------------------------------------------------- q44
@star_query("q44", store_sk=4)
def q44(st, store_sk=4):
    """Ten best and worst items of a store by average profit (global ranks)."""
    ss = st.store_sales.filter(F.col("ss_store_sk") == store_sk)
    base = ss.filter(F.col("ss_addr_sk").isNull()).agg(avg_exact("ss_net_profit").alias("base"))
    per_item = (ss.groupBy(F.col("ss_item_sk").alias("item_sk")).agg(avg_exact("ss_net_profit").alias("rank_col"))
                .crossJoin(base).filter(F.col("rank_col") > F.lit(0.9) * F.col("base")).select("item_sk", "rank_col"))
    # ranks over a per-item aggregate of one store: bounded by the item count
    asc = (per_item.withColumn("rnk", F.rank().over(Window.orderBy(F.asc("rank_col"))))
           .filter(F.col("rnk") < 11).select(F.col("item_sk").alias("a_item"), "rnk"))
    desc = (per_item.withColumn("rnk", F.rank().over(Window.orderBy(F.desc("rank_col"))))
            .filter(F.col("rnk") < 11).select(F.col("item_sk").alias("d_item"), F.col("rnk").alias("d_rnk")))
    i1 = st.item.select(F.col("i_item_sk").alias("i1_sk"), F.col("i_product_name").alias("best_performing"))
    i2 = st.item.select(F.col("i_item_sk").alias("i2_sk"), F.col("i_product_name").alias("worst_performing"))
    j = (asc.join(desc, asc.rnk == desc.d_rnk).join(i1, asc.a_item == i1.i1_sk).join(i2, desc.d_item == i2.i2_sk))
    return topk(j.select("rnk", "best_performing", "worst_performing"), 100, "rnk", "best_performing",
                "worst_performing")


# --------------------------------------------------------------------------- q47 / q57
def _monthly_with_neighbours(df, keys, year):
    """sum per (keys, year, month), avg of monthly sums per (keys, year), and
    the previous/next month's sum (lag/lead over the month sequence)."""
    g = df.groupBy(*keys, "d_year", "d_moy").agg(F.sum("price").alias("sum_sales"))
    wy = Window.partitionBy(*keys, "d_year")
    wk = Window.partitionBy(*keys).orderBy("d_year", "d_moy")
    g = (g.withColumn("avg_monthly_sales", F.sum("sum_sales").over(wy).cast("double") / F.count("sum_sales").over(wy))
          .withColumn("psum", F.lag("sum_sales").over(wk))
          .withColumn("nsum", F.lead("sum_sales").over(wk)))
    g = g.filter((F.col("d_year") == year) & F.col("psum").isNotNull() & F.col("nsum").isNotNull()
                 & (F.col("avg_monthly_sales") > 0)
                 & (F.abs(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales")) / F.col("avg_monthly_sales") > 0.1))
    return g.select(*keys, "d_year", "d_moy", "avg_monthly_sales", F.col("sum_sales").cast("double").alias("sum_sales"),
                    F.col("psum").cast("double").alias("psum"), F.col("nsum").cast("double").alias("nsum"))


def _three_years_dates(st, year):
    return st.date_dim.filter((F.col("d_year") == year) | ((F.col("d_year") == year - 1) & (F.col("d_moy") == 12))
                              | ((F.col("d_year") == year + 1) & (F.col("d_moy") == 1))).select("d_date_sk", "d_year", "d_moy")


@star_query("q47")
def q47(st, year=1999):
    """Store/brand months deviating >10% from their yearly monthly average, with neighbours."""
    dt = _three_years_dates(st, year)
    j = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
         .join(st.item.select("i_item_sk", "i_category", "i_brand"), F.col("ss_item_sk") == F.col("i_item_sk"))
         .join(B(st.store.select("s_store_sk", "s_store_name", "s_company_name")), F.col("ss_store_sk") == F.col("s_store_sk"))
         .select("i_category", "i_brand", "s_store_name", "s_company_name", "d_year", "d_moy",
                 F.col("ss_sales_price").alias("price")))
    keys = ["i_category", "i_brand", "s_store_name", "s_company_name"]
    g = _monthly_with_neighbours(j, keys, year).withColumn("_dev", F.col("sum_sales") - F.col("avg_monthly_sales"))
    return g.orderBy(*order("_dev", "s_store_name", *keys, "d_moy")).limit(100).drop("_dev")


@star_query("q57")
def q57(st, year=1999):
    """Call-center/brand months deviating >10% from their yearly monthly average."""
    dt = _three_years_dates(st, year)
    j = (st.catalog_sales.join(B(dt), F.col("cs_sold_date_sk") == dt.d_date_sk)
         .join(st.item.select("i_item_sk", "i_category", "i_brand"), F.col("cs_item_sk") == F.col("i_item_sk"))
         .join(B(st.call_center.select("cc_call_center_sk", "cc_name")), F.col("cs_call_center_sk") == F.col("cc_call_center_sk"))
         .select("i_category", "i_brand", "cc_name", "d_year", "d_moy", F.col("cs_sales_price").alias("price")))
    keys = ["i_category", "i_brand", "cc_name"]
    g = _monthly_with_neighbours(j, keys, year).withColumn("_dev", F.col("sum_sales") - F.col("avg_monthly_sales"))
    return g.orderBy(*order("_dev", "cc_name", *keys, "d_moy")).limit(100).drop("_dev")


# --------------------------------------------------------------------------- q51 / q51a
def _cume(st, fact, p, month_seq):
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", "d_date")
    daily = (st[fact].filter(F.col(f"{p}_item_sk").isNotNull())
             .join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
             .groupBy(F.col(f"{p}_item_sk").alias("item_sk"), "d_date").agg(F.sum(f"{p}_sales_price").alias("s")))
    w = Window.partitionBy("item_sk").orderBy("d_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("cume_sales", F.sum("s").over(w)).drop("s")


def _q51(st, month_seq):
    web = _cume(st, "web_sales", "ws", month_seq).select(F.col("item_sk").alias("w_item"), F.col("d_date").alias("w_date"),
                                                         F.col("cume_sales").alias("web_sales"))
    store = _cume(st, "store_sales", "ss", month_seq).select(F.col("item_sk").alias("s_item"),
                                                             F.col("d_date").alias("s_date"),
                                                             F.col("cume_sales").alias("store_sales"))
    x = web.join(store, (web.w_item == store.s_item) & (web.w_date == store.s_date), "full").select(
        F.coalesce("w_item", "s_item").alias("item_sk"), F.coalesce("w_date", "s_date").alias("d_date"),
        "web_sales", "store_sales")
    w = Window.partitionBy("item_sk").orderBy("d_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y = (x.withColumn("web_cumulative", F.max("web_sales").over(w))
          .withColumn("store_cumulative", F.max("store_sales").over(w))
          .filter(F.col("web_cumulative") > F.col("store_cumulative")))
    y = y.select("item_sk", "d_date", *[F.col(c).cast("double").alias(c) for c in
                                        ("web_sales", "store_sales", "web_cumulative", "store_cumulative")])
    return topk(y, 100, "item_sk", "d_date")


@star_query("q51", month_seq=1176)
def q51(st, month_seq=1200):
    """Days where an item's cumulative web sales overtake its cumulative store sales."""
    return _q51(st, month_seq)


@star_query("q51a", month_seq=1176)
def q51a(st, month_seq=1200):
    """Variant of q51 written with row numbers and a triangular self join in the
    benchmark text; it must return the same answer, which the running
    window frame computes without emitting the O(n^2) pairs per item."""
    return _q51(st, month_seq)


# --------------------------------------------------------------------------- q53 / q63 / q89
def _dev_from_avg(st, item_filter, group_key, period_col, months_cond, extra_keys=()):
    dt = st.date_dim.filter(months_cond).select("d_date_sk", period_col)
    it = st.item.filter(item_filter).select("i_item_sk", group_key, *extra_keys)
    j = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
         .join(it, F.col("ss_item_sk") == it.i_item_sk)
         .join(B(st.store.select("s_store_sk")), F.col("ss_store_sk") == F.col("s_store_sk")))
    return j


@star_query("q53", month_seq=1176)
def q53(st, month_seq=1200):
    """Manufacturers whose quarterly sales deviate >10% from their average quarter."""
    c, k, b = F.col("i_category"), F.col("i_class"), F.col("i_brand")
    filt = ((c.isin("ring", "bolt", "gear") & k.isin("economy", "large", "medium", "promo")
             & b.isin("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6", "Brand#7", "Brand#8"))
            | (c.isin("rod", "plate", "gizmo") & k.isin("small", "standard", "promo", "economy")
               & b.isin("Brand#9", "Brand#10", "Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15", "Brand#16")))
    j = _dev_from_avg(st, filt, "i_manufact_id", "d_qoy", F.col("d_month_seq").between(month_seq, month_seq + 11))
    g = j.groupBy("i_manufact_id", "d_qoy").agg(F.sum("ss_sales_price").alias("sum_sales"))
    w = Window.partitionBy("i_manufact_id")
    g = g.withColumn("avg_quarterly_sales", F.sum("sum_sales").over(w).cast("double") / F.count("sum_sales").over(w))
    g = g.filter(F.when(F.col("avg_quarterly_sales") > 0,
                        F.abs(F.col("sum_sales").cast("double") - F.col("avg_quarterly_sales"))
                        / F.col("avg_quarterly_sales")) > 0.1)
    g = g.select("i_manufact_id", F.col("sum_sales").cast("double").alias("sum_sales"), "avg_quarterly_sales")
    return topk(g, 100, "avg_quarterly_sales", "sum_sales", "i_manufact_id")


@star_query("q63", month_seq=1176)
def q63(st, month_seq=1200):
    """Managers whose monthly sales deviate >10% from their average month."""
    c, k, b = F.col("i_category"), F.col("i_class"), F.col("i_brand")
    filt = ((c.isin("ring", "bolt", "gear") & k.isin("economy", "large", "medium", "promo")
             & b.isin("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6", "Brand#7", "Brand#8"))
            | (c.isin("rod", "plate", "gizmo") & k.isin("small", "standard", "promo", "economy")
               & b.isin("Brand#9", "Brand#10", "Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15", "Brand#16")))
    j = _dev_from_avg(st, filt, "i_manager_id", "d_moy", F.col("d_month_seq").between(month_seq, month_seq + 11))
    g = j.groupBy("i_manager_id", "d_moy").agg(F.sum("ss_sales_price").alias("sum_sales"))
    w = Window.partitionBy("i_manager_id")
    g = g.withColumn("avg_monthly_sales", F.sum("sum_sales").over(w).cast("double") / F.count("sum_sales").over(w))
    g = g.filter(F.when(F.col("avg_monthly_sales") > 0,
                        F.abs(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales"))
                        / F.col("avg_monthly_sales")) > 0.1)
    g = g.select("i_manager_id", F.col("sum_sales").cast("double").alias("sum_sales"), "avg_monthly_sales")
    return topk(g, 100, "i_manager_id", "avg_monthly_sales", "sum_sales")


@star_query("q89")
def q89(st, year=1999):
    """Category/class/brand store months deviating >10% from the average month."""
    c, k = F.col("i_category"), F.col("i_class")
    filt = ((c.isin("ring", "bolt", "gear") & k.isin("economy", "large", "medium"))
            | (c.isin("rod", "plate", "gizmo") & k.isin("small", "standard", "promo")))
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk", "d_moy")
    it = st.item.filter(filt).select("i_item_sk", "i_category", "i_class", "i_brand")
    j = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
         .join(it, F.col("ss_item_sk") == it.i_item_sk)
         .join(B(st.store.select("s_store_sk", "s_store_name", "s_company_name")), F.col("ss_store_sk") == F.col("s_store_sk")))
    keys = ["i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy"]
    g = j.groupBy(*keys).agg(F.sum("ss_sales_price").alias("sum_sales"))
    w = Window.partitionBy("i_category", "i_brand", "s_store_name", "s_company_name")
    g = g.withColumn("avg_monthly_sales", F.sum("sum_sales").over(w).cast("double") / F.count("sum_sales").over(w))
    g = g.filter(F.when(F.col("avg_monthly_sales") != 0,
                        F.abs(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales"))
                        / F.col("avg_monthly_sales")) > 0.1)
    g = g.select(*keys, F.col("sum_sales").cast("double").alias("sum_sales"), "avg_monthly_sales") \
         .withColumn("_dev", F.col("sum_sales") - F.col("avg_monthly_sales"))
    return g.orderBy(*order("_dev", "s_store_name", *keys)).limit(100).drop("_dev")


# --------------------------------------------------------------------------- q65
@star_query("q65", month_seq=1176)
def q65(st, month_seq=1176):
    """Store items whose revenue is at most 10% of the store's average item revenue."""
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    sc = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
          .groupBy("ss_store_sk", "ss_item_sk").agg(F.sum("ss_sales_price").alias("revenue")))
    sb = sc.groupBy(F.col("ss_store_sk").alias("b_store")).agg(avg_exact("revenue").alias("ave"))
    j = (sc.join(B(sb), (sc.ss_store_sk == sb.b_store) & (sc.revenue.cast("double") <= F.lit(0.1) * sb.ave))
           .join(B(st.store.select("s_store_sk", "s_store_name")), sc.ss_store_sk == F.col("s_store_sk"))
           .join(st.item.select("i_item_sk", "i_item_desc", "i_current_price", "i_wholesale_cost", "i_brand"),
                 sc.ss_item_sk == F.col("i_item_sk")))
    out = j.select("s_store_name", "i_item_desc", F.col("revenue").cast("double").alias("revenue"),
                   F.col("i_current_price").cast("double").alias("i_current_price"),
                   F.col("i_wholesale_cost").cast("double").alias("i_wholesale_cost"), "i_brand")
    return topk(out, 100, "s_store_name", "i_item_desc", "revenue", "i_current_price", "i_wholesale_cost", "i_brand")


# --------------------------------------------------------------------------- q66
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_WH = ["w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country"]


@star_query("q66")
def q66(st, year=2001, carriers=("Carrier C", "Carrier K"), t_start=30838):
    """Monthly web+catalog sales and net per warehouse for two carriers (pivot)."""
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk", "d_year", "d_moy")
    t = st.time_dim.filter(F.col("t_time").between(t_start, t_start + 28800)).select("t_time_sk")
    sm = st.ship_mode.filter(F.col("sm_carrier").isin(*carriers)).select("sm_ship_mode_sk")
    wh = st.warehouse.select("w_warehouse_sk", *_WH)
    parts = []
    for fact, p, net in [("web_sales", "ws", "ws_net_paid"), ("catalog_sales", "cs", "cs_net_paid_inc_tax")]:
        j = (st[fact].join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
             .join(B(t), F.col(f"{p}_sold_time_sk") == t.t_time_sk)
             .join(B(sm), F.col(f"{p}_ship_mode_sk") == sm.sm_ship_mode_sk)
             .join(B(wh), F.col(f"{p}_warehouse_sk") == wh.w_warehouse_sk))
        price = "ws_ext_sales_price" if p == "ws" else "cs_sales_price"
        aggs = ([F.sum(F.when(F.col("d_moy") == i + 1, F.col(price) * F.col(f"{p}_quantity")).otherwise(0))
                 .alias(f"{m}_sales") for i, m in enumerate(_MONTHS)]
                + [F.sum(F.when(F.col("d_moy") == i + 1, F.col(net) * F.col(f"{p}_quantity")).otherwise(0))
                   .alias(f"{m}_net") for i, m in enumerate(_MONTHS)])
        parts.append(j.groupBy(*_WH, F.col("d_year").alias("year")).agg(*aggs)
                     .withColumn("ship_carriers", F.lit(",".join(carriers))))
    u = parts[0].unionByName(parts[1])
    g = u.groupBy(*_WH, "ship_carriers", "year").agg(
        *[F.sum(f"{m}_sales").cast("double").alias(f"{m}_sales") for m in _MONTHS],
        *[F.sum(F.col(f"{m}_sales").cast("double") / F.col("w_warehouse_sq_ft")).alias(f"{m}_sales_per_sq_foot")
          for m in _MONTHS],
        *[F.sum(f"{m}_net").cast("double").alias(f"{m}_net") for m in _MONTHS])
    return topk(g, 100, "w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country")


# --------------------------------------------------------------------------- q67 / q67a
_Q67_KEYS = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]


def _q67_detail(st, month_seq):
    dt = st.date_dim.filter(F.col("d_month_seq").between(month_seq, month_seq + 11)).select(
        "d_date_sk", "d_year", "d_qoy", "d_moy")
    # one row for each item, month and store before the roll-up expands its input nine times
    per = (st.store_sales.join(B(dt), F.col("ss_sold_date_sk") == dt.d_date_sk)
           .groupBy("ss_item_sk", "ss_store_sk", "d_year", "d_qoy", "d_moy")
           .agg(F.sum(F.coalesce(F.col("ss_sales_price") * F.col("ss_quantity"), F.lit(0))).alias("v")))
    return (per.join(B(st.store.select("s_store_sk", "s_store_id")), F.col("ss_store_sk") == F.col("s_store_sk"))
            .join(st.item.select("i_item_sk", "i_category", "i_class", "i_brand", "i_product_name"),
                  F.col("ss_item_sk") == F.col("i_item_sk"))
            .select(*_Q67_KEYS, "v"))


def _q67_rank(dw1):
    w = Window.partitionBy("i_category").orderBy(F.desc("sumsales"))
    dw2 = dw1.withColumn("rk", F.rank().over(w)).filter(F.col("rk") <= 100)
    return topk(dw2, 100, *_Q67_KEYS, "sumsales", "rk")


@star_query("q67", month_seq=1176)
def q67(st, month_seq=1200):
    """Top 100 roll-up cells per category by revenue (8-level ROLLUP + rank filter)."""
    d = _q67_detail(st, month_seq)
    dw1 = rollup(d, _Q67_KEYS, [F.sum("v").cast("double").alias("sumsales")])
    return _q67_rank(dw1)


@star_query("q67a", month_seq=1176)
def q67a(st, month_seq=1200):
    """q67 with the ROLLUP written as nine UNION ALL grouping levels (one
    grouping-sets aggregate over the detail rows)."""
    d = _q67_detail(st, month_seq)
    g = grouping_levels(d, _Q67_KEYS, [_Q67_KEYS[:n] for n in range(len(_Q67_KEYS), -1, -1)],
                        [F.sum("v").cast("double").alias("sumsales")])
    return _q67_rank(g)


# --------------------------------------------------------------------------- q77 / q77a
def _q77_x(st, start):
    dt = dates_between(st, start, 30)

    def agg(fact, date_col, key, cols, join_dim=None):
        df = st[fact].join(B(dt), F.col(date_col) == dt.d_date_sk)
        if join_dim is not None:
            df = df.join(B(join_dim), F.col(key) == join_dim[join_dim.columns[0]])
        return df.groupBy(F.col(key if join_dim is None else join_dim.columns[0]).alias("k")).agg(
            *[F.sum(c).alias(a) for c, a in cols])

    s_dim = st.store.select("s_store_sk")
    wp_dim = st.web_page.select("wp_web_page_sk")
    ss = agg("store_sales", "ss_sold_date_sk", "ss_store_sk", [("ss_ext_sales_price", "sales"), ("ss_net_profit", "profit")], s_dim)
    sr = agg("store_returns", "sr_returned_date_sk", "sr_store_sk", [("sr_return_amt", "returns_"), ("sr_net_loss", "profit_loss")], s_dim)
    cs = agg("catalog_sales", "cs_sold_date_sk", "cs_call_center_sk", [("cs_ext_sales_price", "sales"), ("cs_net_profit", "profit")])
    cr = agg("catalog_returns", "cr_returned_date_sk", "cr_call_center_sk", [("cr_return_amount", "returns_"), ("cr_net_loss", "profit_loss")])
    ws = agg("web_sales", "ws_sold_date_sk", "ws_web_page_sk", [("ws_ext_sales_price", "sales"), ("ws_net_profit", "profit")], wp_dim)
    wr = agg("web_returns", "wr_returned_date_sk", "wr_web_page_sk", [("wr_return_amt", "returns_"), ("wr_net_loss", "profit_loss")], wp_dim)
    z = F.lit(0)
    store = ss.join(sr.withColumnRenamed("k", "rk"), F.col("k") == F.col("rk"), "left").select(
        F.lit("store channel").alias("channel"), F.col("k").alias("id"), "sales",
        F.coalesce("returns_", z).alias("returns_"), (F.col("profit") - F.coalesce("profit_loss", z)).alias("profit"))
    # benchmark quirk kept: the catalog branch is a cross join of two per-call-center
    # aggregates (each bounded by the call-center dimension)
    catalog = cs.crossJoin(B(cr.drop("k"))).select(
        F.lit("catalog channel").alias("channel"), F.col("k").alias("id"), "sales", "returns_",
        (F.col("profit") - F.col("profit_loss")).alias("profit"))
    web = ws.join(wr.withColumnRenamed("k", "rk"), F.col("k") == F.col("rk"), "left").select(
        F.lit("web channel").alias("channel"), F.col("k").alias("id"), "sales",
        F.coalesce("returns_", z).alias("returns_"), (F.col("profit") - F.coalesce("profit_loss", z)).alias("profit"))
    return _union([store, catalog, web])


@star_query("q77")
def q77(st, start="2000-08-23"):
    """Sales/returns/profit per channel and outlet over 30 days, ROLLUP(channel, id)."""
    x = _q77_x(st, start)
    g = rollup(x, ["channel", "id"], _money_totals(x))
    return topk(g, 100, "channel", "id", "sales", "returns", "profit")


@star_query("q77a")
def q77a(st, start="2000-08-23"):
    """q77 with the levels as UNION (distinct) of detail, channel and total
    (the levels evaluated as one grouping-sets aggregate)."""
    x = _q77_x(st, start)
    g = grouping_levels(x, ["channel", "id"], _CHANNEL_ID_LEVELS, _money_totals(x))
    return topk(g.distinct(), 100, "channel", "id", "sales", "returns", "profit")
