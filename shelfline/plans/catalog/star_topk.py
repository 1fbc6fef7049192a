"""Star joins with a top-k report: fact x bounded dimensions -> group -> sort/limit."""

from __future__ import annotations

from shelfline.plans.catalog.common import (B, F, Window, avg_exact, dates_between, order,
                                             star_query, topk, zip5)


@star_query("q03")
def q03(st, manufact_id: int = 28, month: int = 11, agg_col: str = "ss_ext_sales_price"):
    """Brand revenue per year for one manufacturer in one calendar month."""
    dt = st.date_dim.filter(F.col("d_moy") == month).select("d_date_sk", "d_year")
    it = st.item.filter(F.col("i_manufact_id") == manufact_id).select("i_item_sk", "i_brand_id", "i_brand")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_item_sk", agg_col)
    j = (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk)
           .join(it, ss.ss_item_sk == it.i_item_sk))
    g = (j.groupBy("d_year", "i_brand", "i_brand_id")
          .agg(F.sum(agg_col).cast("double").alias("sum_agg"))
          .select("d_year", F.col("i_brand_id").alias("brand_id"),
                  F.col("i_brand").alias("brand"), "sum_agg"))
    return topk(g, 100, "d_year", "-sum_agg", "brand_id", "brand")


def _demo_promo_avgs(st, fact: str, p: str, cdemo: str, promo: str, gender, marital, education, year):
    cd = st.customer_demographics.filter(
        (F.col("cd_gender") == gender) & (F.col("cd_marital_status") == marital)
        & (F.col("cd_education_status") == education)).select("cd_demo_sk")
    pr = st.promotion.filter((F.col("p_channel_email") == "N") | (F.col("p_channel_event") == "N")) \
        .select("p_promo_sk")
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    f = st[fact].select(f"{p}_sold_date_sk", f"{p}_item_sk", cdemo, promo, f"{p}_quantity",
                        f"{p}_list_price", f"{p}_coupon_amt", f"{p}_sales_price")
    j = (f.join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
          .join(B(cd), F.col(cdemo) == cd.cd_demo_sk)
          .join(B(pr), F.col(promo) == pr.p_promo_sk)
          .join(st.item.select("i_item_sk", "i_item_id"), F.col(f"{p}_item_sk") == F.col("i_item_sk")))
    g = j.groupBy("i_item_id").agg(
        avg_exact(f"{p}_quantity").alias("agg1"), avg_exact(f"{p}_list_price").alias("agg2"),
        avg_exact(f"{p}_coupon_amt").alias("agg3"), avg_exact(f"{p}_sales_price").alias("agg4"))
    return topk(g, 100, "i_item_id")


@star_query("q07")
def q07(st, gender="M", marital="S", education="College", year=2000):
    """Average quantity/prices per item for one demographic, non-email/event promotions."""
    return _demo_promo_avgs(st, "store_sales", "ss", "ss_cdemo_sk", "ss_promo_sk",
                            gender, marital, education, year)


@star_query("q26")
def q26(st, gender="M", marital="S", education="College", year=2000):
    """Catalog version of q07 (bill-to demographics)."""
    return _demo_promo_avgs(st, "catalog_sales", "cs", "cs_bill_cdemo_sk", "cs_promo_sk",
                            gender, marital, education, year)


@star_query("q19")
def q19(st, manager_id=8, month=11, year=1998):
    """Brand revenue where the buyer's ZIP differs from the store's ZIP."""
    dt = st.date_dim.filter((F.col("d_moy") == month) & (F.col("d_year") == year)).select("d_date_sk")
    it = st.item.filter(F.col("i_manager_id") == manager_id).select(
        "i_item_sk", "i_brand_id", "i_brand", "i_manufact_id", "i_manufact")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_customer_sk", "ss_store_sk",
                               "ss_ext_sales_price")
    j = (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk)
           .join(it, ss.ss_item_sk == it.i_item_sk)
           .join(st.customer.select("c_customer_sk", "c_current_addr_sk"),
                 ss.ss_customer_sk == F.col("c_customer_sk"))
           .join(st.customer_address.select("ca_address_sk", "ca_zip"),
                 F.col("c_current_addr_sk") == F.col("ca_address_sk"))
           .join(B(st.store.select("s_store_sk", "s_zip")),
                 (ss.ss_store_sk == F.col("s_store_sk")) & (zip5("ca_zip") != zip5("s_zip"))))
    g = j.groupBy("i_brand", "i_brand_id", "i_manufact_id", "i_manufact").agg(
        F.sum("ss_ext_sales_price").cast("double").alias("ext_price"))
    g = g.select(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"),
                 "i_manufact_id", "i_manufact", "ext_price")
    return topk(g, 100, "-ext_price", "brand", "brand_id", "i_manufact_id", "i_manufact")


def _month_item_sales(st, month, year, manager_id):
    dt = st.date_dim.filter((F.col("d_moy") == month) & (F.col("d_year") == year)) \
        .select("d_date_sk", "d_year")
    it = st.item.filter(F.col("i_manager_id") == manager_id)
    ss = st.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_ext_sales_price")
    return (ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk)
              .join(it, ss.ss_item_sk == it.i_item_sk))


@star_query("q42")
def q42(st, month=11, year=2000, manager_id=1):
    """Category revenue for one manager's items in one month."""
    j = _month_item_sales(st, month, year, manager_id)
    g = j.groupBy("d_year", "i_category_id", "i_category").agg(
        F.sum("ss_ext_sales_price").cast("double").alias("sum_sales"))
    return topk(g, 100, "-sum_sales", "d_year", "i_category_id", "i_category")


@star_query("q52")
def q52(st, month=11, year=2000, manager_id=1):
    """Brand revenue for one manager's items in one month."""
    j = _month_item_sales(st, month, year, manager_id)
    g = j.groupBy("d_year", "i_brand", "i_brand_id").agg(
        F.sum("ss_ext_sales_price").cast("double").alias("ext_price"))
    g = g.select("d_year", F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"),
                 "ext_price")
    return topk(g, 100, "d_year", "-ext_price", "brand_id", "brand")


@star_query("q55")
def q55(st, month=11, year=1999, manager_id=28):
    """Brand revenue for one manager's items in one month (no year column)."""
    j = _month_item_sales(st, month, year, manager_id)
    g = j.groupBy("i_brand", "i_brand_id").agg(
        F.sum("ss_ext_sales_price").cast("double").alias("ext_price"))
    g = g.select(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"), "ext_price")
    return topk(g, 100, "-ext_price", "brand_id", "brand")


DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_DAY_COLS = ["sun_sales", "mon_sales", "tue_sales", "wed_sales", "thu_sales", "fri_sales", "sat_sales"]


@star_query("q43")
def q43(st, year=2000, gmt_offset=-5):
    """Store sales pivoted by weekday (conditional sums in one pass)."""
    dt = st.date_dim.filter(F.col("d_year") == year).select("d_date_sk", "d_day_name")
    s = st.store.filter(F.col("s_gmt_offset") == gmt_offset).select("s_store_sk", "s_store_name", "s_store_id")
    ss = st.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_sales_price")
    j = ss.join(B(dt), ss.ss_sold_date_sk == dt.d_date_sk).join(B(s), ss.ss_store_sk == s.s_store_sk)
    g = j.groupBy("s_store_name", "s_store_id").agg(*[
        F.sum(F.when(F.col("d_day_name") == d, F.col("ss_sales_price"))).cast("double").alias(c)
        for d, c in zip(DAYS, _DAY_COLS)])
    return topk(g, 100, "s_store_name", "s_store_id", *_DAY_COLS)


@star_query("q96")
def q96(st, hour=20, dep_count=7, store_name="meadow"):
    """Count of evening sales to one household size at one store name."""
    t = st.time_dim.filter((F.col("t_hour") == hour) & (F.col("t_minute") >= 30)).select("t_time_sk")
    hd = st.household_demographics.filter(F.col("hd_dep_count") == dep_count).select("hd_demo_sk")
    s = st.store.filter(F.col("s_store_name") == store_name).select("s_store_sk")
    ss = st.store_sales.select("ss_sold_time_sk", "ss_hdemo_sk", "ss_store_sk")
    j = (ss.join(B(t), ss.ss_sold_time_sk == t.t_time_sk)
           .join(B(hd), ss.ss_hdemo_sk == hd.hd_demo_sk)
           .join(B(s), ss.ss_store_sk == s.s_store_sk))
    return j.agg(F.count(F.lit(1)).alias("cnt"))


@star_query("q15")
def q15(st, zips=("10500", "10801", "11202", "11600", "12001"), states=("CA", "GA", "IL"),
        price=150, qoy=2, year=2001):
    """Catalog sales by ZIP for a ZIP list, some states, or expensive lines."""
    dt = st.date_dim.filter((F.col("d_qoy") == qoy) & (F.col("d_year") == year)).select("d_date_sk")
    cs = st.catalog_sales.select("cs_sold_date_sk", "cs_bill_customer_sk", "cs_sales_price")
    j = (cs.join(B(dt), cs.cs_sold_date_sk == dt.d_date_sk)
           .join(st.customer.select("c_customer_sk", "c_current_addr_sk"),
                 cs.cs_bill_customer_sk == F.col("c_customer_sk"))
           .join(st.customer_address.select("ca_address_sk", "ca_zip", "ca_state"),
                 F.col("c_current_addr_sk") == F.col("ca_address_sk"))
           .filter(zip5("ca_zip").isin(*zips) | F.col("ca_state").isin(*states)
                   | (F.col("cs_sales_price") > price)))
    g = j.groupBy("ca_zip").agg(F.sum("cs_sales_price").cast("double").alias("sum_sales"))
    return topk(g, 100, "ca_zip")


def _inventory_items(st, fact_item_col: str, fact: str, price_lo, manufacts, start):
    it = st.item.filter(F.col("i_current_price").between(price_lo, price_lo + 30)
                        & F.col("i_manufact_id").isin(*manufacts)) \
        .select("i_item_sk", "i_item_id", "i_item_desc", "i_current_price")
    inv = st.inventory.filter(F.col("inv_quantity_on_hand").between(100, 500)) \
        .select("inv_item_sk", "inv_date_sk")
    dt = dates_between(st, start, 60)
    in_stock = inv.join(B(dt), inv.inv_date_sk == dt.d_date_sk).select("inv_item_sk")
    sold = st[fact].select(F.col(fact_item_col).alias("sold_item_sk"))
    j = (it.join(in_stock, it.i_item_sk == in_stock.inv_item_sk, "left_semi")
           .join(sold, it.i_item_sk == sold.sold_item_sk, "left_semi"))
    g = j.select("i_item_id", "i_item_desc", "i_current_price").distinct() \
         .withColumn("i_current_price", F.col("i_current_price").cast("double"))
    return topk(g, 100, "i_item_id", "i_item_desc", "i_current_price")


@star_query("q37")
def q37(st, price_lo=20, manufacts=(1, 5, 9, 13, 17, 21, 25, 29, 33, 37), start="2000-02-01"):
    """Items in a price band, in stock within 60 days and sold through the catalog."""
    return _inventory_items(st, "cs_item_sk", "catalog_sales", price_lo, manufacts, start)


@star_query("q82")
def q82(st, price_lo=50, manufacts=(1, 5, 9, 13, 17, 21, 25, 29, 33, 37), start="2000-05-25"):
    """Items in a price band, in stock within 60 days and sold in stores."""
    return _inventory_items(st, "ss_item_sk", "store_sales", price_lo, manufacts, start)


def _class_share(st, fact: str, p: str, categories, start, limit):
    it = st.item.filter(F.col("i_category").isin(*categories)).select(
        "i_item_sk", "i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price")
    dt = dates_between(st, start, 30)
    f = st[fact].select(f"{p}_sold_date_sk", f"{p}_item_sk", f"{p}_ext_sales_price")
    j = (f.join(B(dt), F.col(f"{p}_sold_date_sk") == dt.d_date_sk)
          .join(it, F.col(f"{p}_item_sk") == it.i_item_sk))
    g = j.groupBy("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price").agg(
        F.sum(f"{p}_ext_sales_price").cast("double").alias("itemrevenue"))
    w = Window.partitionBy("i_class")
    g = g.withColumn("revenueratio", F.col("itemrevenue") * 100 / F.sum("itemrevenue").over(w)) \
         .withColumn("i_current_price", F.col("i_current_price").cast("double"))
    cols = ["i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio"]
    if limit:
        return topk(g, limit, *cols)
    return g.orderBy(*order(*cols))


@star_query("q12")
def q12(st, categories=("ring", "bolt", "gear"), start="1999-02-22"):
    """Web item revenue and its share of the item-class total over 30 days."""
    return _class_share(st, "web_sales", "ws", categories, start, 100)


@star_query("q20")
def q20(st, categories=("ring", "bolt", "gear"), start="1999-02-22"):
    """Catalog item revenue and its share of the item-class total over 30 days."""
    return _class_share(st, "catalog_sales", "cs", categories, start, 100)


@star_query("q98")
def q98(st, categories=("ring", "bolt", "gear"), start="1999-02-22"):
    """Store item revenue and its class share over 30 days (full ordered report)."""
    return _class_share(st, "store_sales", "ss", categories, start, None)


@star_query("q45")
def q45(st, zips=("10500", "10801", "11202", "11600", "12001"),
        item_sks=(2, 3, 5, 7, 11, 13, 17, 19, 23, 29), qoy=2, year=2001):
    """Web sales by ZIP/city where the ZIP is listed OR the item id is in a set (mark join)."""
    ids = st.item.filter(F.col("i_item_sk").isin(*item_sks)).select(
        F.col("i_item_id").alias("m_item_id")).distinct()
    dt = st.date_dim.filter((F.col("d_qoy") == qoy) & (F.col("d_year") == year)).select("d_date_sk")
    ws = st.web_sales.select("ws_sold_date_sk", "ws_bill_customer_sk", "ws_item_sk", "ws_sales_price")
    j = (ws.join(B(dt), ws.ws_sold_date_sk == dt.d_date_sk)
           .join(st.customer.select("c_customer_sk", "c_current_addr_sk"),
                 ws.ws_bill_customer_sk == F.col("c_customer_sk"))
           .join(st.customer_address.select("ca_address_sk", "ca_zip", "ca_city"),
                 F.col("c_current_addr_sk") == F.col("ca_address_sk"))
           .join(st.item.select("i_item_sk", "i_item_id"), ws.ws_item_sk == F.col("i_item_sk"))
           .join(ids, F.col("i_item_id") == ids.m_item_id, "left")
           .filter(zip5("ca_zip").isin(*zips) | F.col("m_item_id").isNotNull()))
    g = j.groupBy("ca_zip", "ca_city").agg(F.sum("ws_sales_price").cast("double").alias("sum_sales"))
    return topk(g, 100, "ca_zip", "ca_city")


@star_query("q91", year=1999, months=(9, 10, 11))
def q91(st, year=1998, months=(11,), gmt_offset=-7):
    """Catalog-return losses per call center for two marital/education profiles."""
    dt = st.date_dim.filter((F.col("d_year") == year) & F.col("d_moy").isin(*months)).select("d_date_sk")
    cd = st.customer_demographics.filter(
        ((F.col("cd_marital_status") == "M") & (F.col("cd_education_status") == "Unknown"))
        | ((F.col("cd_marital_status") == "W") & (F.col("cd_education_status") == "Advanced Degree"))) \
        .select("cd_demo_sk", "cd_marital_status", "cd_education_status")
    hd = st.household_demographics.filter(F.col("hd_buy_potential").like("Unknown%")).select("hd_demo_sk")
    ca = st.customer_address.filter(F.col("ca_gmt_offset") == gmt_offset).select("ca_address_sk")
    cr = st.catalog_returns.select("cr_call_center_sk", "cr_returned_date_sk",
                                   "cr_returning_customer_sk", "cr_net_loss")
    c = st.customer.select("c_customer_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_current_addr_sk")
    j = (cr.join(B(dt), cr.cr_returned_date_sk == dt.d_date_sk)
           .join(c, cr.cr_returning_customer_sk == c.c_customer_sk)
           .join(B(cd), c.c_current_cdemo_sk == cd.cd_demo_sk)
           .join(B(hd), c.c_current_hdemo_sk == hd.hd_demo_sk)
           .join(ca, c.c_current_addr_sk == ca.ca_address_sk)
           .join(B(st.call_center.select("cc_call_center_sk", "cc_call_center_id", "cc_name", "cc_manager")),
                 cr.cr_call_center_sk == F.col("cc_call_center_sk")))
    g = j.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status",
                  "cd_education_status").agg(F.sum("cr_net_loss").cast("double").alias("returns_loss"))
    g = g.select(F.col("cc_call_center_id").alias("call_center"),
                 F.col("cc_name").alias("call_center_name"), F.col("cc_manager").alias("manager"),
                 "returns_loss")
    return g.orderBy(F.desc("returns_loss"), "call_center", "call_center_name", "manager")
