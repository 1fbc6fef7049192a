"""Dataset building and profiling jobs (survey section 2.2).

These are the table-building rules of the star schema exposed as checkable
jobs over the loaded (or driver) tables: calendar and clock attributes,
demographic decoding, type-2 history, the pricing chain, returns derived
from sales, inventory snapshots, multi-line order generation, weighted
value assignment, seasonal apportioning, scale projections and quality
checks (primary/foreign keys, null rates, skew, checksums, statistics).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.grouping import bits_of, block_of, has_bit
from shelfline.functions.money import avg_exact, idiv, idiv_col
from shelfline.plans.catalog.common import demographics
from shelfline.plans.registry import raw_query, star_query
from shelfline.sources.tables import read_table

B = F.broadcast


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


@raw_query("dim_date")
def dim_date(spark, sf_dir):
    """Calendar over the order-date range with derived sequence numbers and flags."""
    o = read_table(spark, sf_dir, "orders")
    rng = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    cal = rng.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    days1900 = F.datediff("d", F.lit("1900-01-01").cast("date"))
    dow = F.pmod(days1900 + 1, F.lit(7))
    y, m, dom = F.year("d"), F.month("d"), F.dayofmonth("d")
    hol = ((m == 12) & (dom == 25)) | ((m == 1) & (dom == 1)) | ((m == 7) & (dom == 4))
    cal = cal.select(y.alias("d_year"), ((y - 1900) * 12 + m - 1).alias("month_seq"),
                     (idiv(days1900, 7) + 1).alias("week_seq"), ((y - 1900) * 4 + idiv(m - 1, 3) + 1).alias("quarter_seq"),
                     dow.isin(0, 6).alias("weekend"), hol.alias("holiday"))
    return cal.groupBy("d_year").agg(
        F.count(F.lit(1)).alias("days"), F.sum(F.col("weekend").cast("int")).alias("weekend_days"),
        F.sum(F.col("holiday").cast("int")).alias("holidays"), F.min("week_seq").alias("first_week_seq"),
        F.max("week_seq").alias("last_week_seq"), F.min("month_seq").alias("first_month_seq"),
        F.countDistinct("quarter_seq").alias("quarters"))


@star_query("dim_time")
def dim_time(st):
    """Store sales profiled by the clock dimension's shift / meal attributes."""
    j = st.store_sales.join(B(st.time_dim), F.col("ss_sold_time_sk") == F.col("t_time_sk"))
    return j.groupBy("t_am_pm", "t_shift", "t_sub_shift", "t_meal_time").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("ss_net_paid").cast("double").alias("net_paid"))


@star_query("dim_demographics")
def dim_demographics(st):
    """Customers by decoded customer and household demographics."""
    j = (st.customer.join(demographics(st), F.col("c_current_cdemo_sk") == F.col("cd_demo_sk"))
         .join(B(st.household_demographics), F.col("c_current_hdemo_sk") == F.col("hd_demo_sk")))
    return j.groupBy("cd_gender", "cd_marital_status", "cd_education_status", "hd_buy_potential").agg(
        F.count(F.lit(1)).alias("customers"))


@star_query("dim_income_band")
def dim_income_band(st):
    """Customers per fixed-width income band."""
    j = (st.customer.join(B(st.household_demographics), F.col("c_current_hdemo_sk") == F.col("hd_demo_sk"))
         .join(B(st.income_band), F.col("hd_income_band_sk") == F.col("ib_income_band_sk")))
    return j.groupBy("ib_lower_bound", "ib_upper_bound").agg(F.count(F.lit(1)).alias("customers"))


@star_query("dim_scd2")
def dim_scd2(st):
    """Type-2 history: validity ranges rebuilt per business key with lead(), and
    whether each revision changed the price (lag())."""
    w = Window.partitionBy("i_item_id").orderBy("i_rec_start_date")
    it = st.item.select("i_item_id", "i_item_sk", "i_rec_start_date", "i_rec_end_date", "i_current_price")
    h = it.select("i_item_id", "i_item_sk", "i_rec_start_date", "i_rec_end_date",
                  F.date_sub(F.lead("i_rec_start_date").over(w), 1).alias("derived_end"),
                  F.row_number().over(w).alias("revision"),
                  (F.lag("i_current_price").over(w) != F.col("i_current_price")).alias("price_changed"))
    return h.groupBy("revision", "price_changed").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("derived_end").eqNullSafe(F.col("i_rec_end_date")), 1).otherwise(0)).alias("end_matches"))


@star_query("sales_pricing")
def sales_pricing(st):
    """Pricing-chain totals per year and violations of its identities."""
    ss = st.store_sales.join(B(st.date_dim.select("d_date_sk", "d_year")), F.col("ss_sold_date_sk") == F.col("d_date_sk"))
    bad = ((F.col("ss_net_paid") != F.col("ss_ext_sales_price") - F.col("ss_coupon_amt"))
           | (F.col("ss_ext_discount_amt") != F.col("ss_ext_list_price") - F.col("ss_ext_sales_price"))
           | (F.col("ss_net_paid_inc_tax") != F.col("ss_net_paid") + F.col("ss_ext_tax"))
           | (F.col("ss_net_profit") != F.col("ss_net_paid") - F.col("ss_ext_wholesale_cost")))
    return ss.groupBy("d_year").agg(
        *[F.sum(c).cast("double").alias(c) for c in ("ss_ext_list_price", "ss_ext_sales_price", "ss_coupon_amt",
                                                      "ss_net_paid", "ss_ext_tax", "ss_net_profit")],
        F.sum(F.when(F.col("ss_coupon_amt") > 0, 1).otherwise(0)).alias("coupon_lines"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("violations"))


@star_query("returns_from_sales")
def returns_from_sales(st):
    """Returns of all channels joined to their sale: rate, lag and refund split,
    with the cash + charge + credit = amount identity checked."""
    out = []
    for channel, sales, p, rets, r, number, amount, credit in [
            ("store", "store_sales", "ss", "store_returns", "sr", "ticket_number", "return_amt", "store_credit"),
            ("catalog", "catalog_sales", "cs", "catalog_returns", "cr", "order_number", "return_amount", "store_credit"),
            ("web", "web_sales", "ws", "web_returns", "wr", "order_number", "return_amt", "account_credit")]:
        s = st[sales].select(*[F.col(f"{p}_{c}").alias(c) for c in ("item_sk", number, "sold_date_sk", "quantity")])
        b = st[rets].select(F.col(f"{r}_item_sk").alias("r_item"), F.col(f"{r}_{number}").alias("r_number"),
                            F.col(f"{r}_returned_date_sk").alias("r_date"), F.col(f"{r}_return_quantity").alias("r_qty"),
                            F.col(f"{r}_refunded_cash").alias("r_cash"), F.col(f"{r}_reversed_charge").alias("r_charge"),
                            F.col(f"{r}_{credit}").alias("r_credit"), F.col(f"{r}_{amount}").alias("r_amount"))
        j = s.join(b, (F.col("item_sk") == F.col("r_item")) & (F.col(number) == F.col("r_number")), "left")
        j = j.join(B(st.date_dim.select("d_date_sk", "d_year")), F.col("sold_date_sk") == F.col("d_date_sk"))
        split_bad = (F.col("r_cash") + F.col("r_charge") + F.col("r_credit")) != F.col("r_amount")
        out.append(j.groupBy("d_year").agg(
            F.count(F.lit(1)).alias("sales"), F.count("r_item").alias("returns"), F.sum("r_qty").alias("returned_qty"),
            avg_exact((F.col("r_date") - F.col("sold_date_sk")).cast("long")).alias("avg_lag_days"),
            F.sum("r_cash").cast("double").alias("cash"), F.sum("r_charge").cast("double").alias("charge"),
            F.sum("r_credit").cast("double").alias("credit"),
            F.sum(F.when(split_bad, 1).otherwise(0)).alias("split_violations"),
            F.sum(F.when(F.col("r_qty") > F.col("quantity"), 1).otherwise(0)).alias("qty_violations"))
            .select(F.lit(channel).alias("channel"), "*"))
    return _union(out)


@star_query("inventory_snapshot")
def inventory_snapshot(st):
    """Weekly inventory snapshots per warehouse and year."""
    j = st.inventory.join(B(st.date_dim.select("d_date_sk", "d_year", "d_dow")), F.col("inv_date_sk") == F.col("d_date_sk"))
    keys = ["inv_warehouse_sk", "d_year"]
    days = j.groupBy(*keys, "inv_date_sk").agg(F.sum("inv_quantity_on_hand").alias("on_hand"), F.count("inv_quantity_on_hand").alias("counted"),
                                               F.min("d_dow").alias("least"), F.max("d_dow").alias("most"))
    items = j.groupBy(*keys, block_of("inv_item_sk").alias("block")).agg(bits_of("inv_item_sk").alias("bits"))
    both = (days.select(*keys, F.lit(1).alias("snapshots"), F.lit(0).alias("items"), "on_hand", "counted", "least", "most")
            .unionByName(items.select(*keys, F.lit(0).alias("snapshots"), F.bit_count("bits").alias("items")), allowMissingColumns=True))
    return both.groupBy(*keys).agg(
        F.coalesce(F.sum("snapshots"), F.lit(0)).alias("snapshots"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"),
        (F.sum("on_hand").cast("double") / F.sum("counted")).alias("avg_on_hand"), F.min("least").alias("min_dow"),
        F.max("most").alias("max_dow"))


PK = {"date_dim": ["d_date_sk"], "time_dim": ["t_time_sk"], "item": ["i_item_sk"], "store": ["s_store_sk"],
      "customer": ["c_customer_sk"], "customer_address": ["ca_address_sk"],
      "customer_demographics": ["cd_demo_sk"], "household_demographics": ["hd_demo_sk"],
      "income_band": ["ib_income_band_sk"], "promotion": ["p_promo_sk"], "warehouse": ["w_warehouse_sk"],
      "ship_mode": ["sm_ship_mode_sk"], "reason": ["r_reason_sk"], "call_center": ["cc_call_center_sk"],
      "catalog_page": ["cp_catalog_page_sk"], "web_site": ["web_site_sk"], "web_page": ["wp_web_page_sk"],
      "store_sales": ["ss_item_sk", "ss_ticket_number"], "store_returns": ["sr_item_sk", "sr_ticket_number"],
      "catalog_sales": ["cs_item_sk", "cs_order_number"], "catalog_returns": ["cr_item_sk", "cr_order_number"],
      "web_sales": ["ws_item_sk", "ws_order_number"], "web_returns": ["wr_item_sk", "wr_order_number"],
      "inventory": ["inv_date_sk", "inv_item_sk", "inv_warehouse_sk"]}


# A snapshot holds nearly every item of its day and warehouse: its key is one bit of a block of items.
PACKED = {"inventory": "inv_item_sk"}


def key_counts(df: DataFrame, keys: list[str], packed: str | None = None) -> DataFrame:
    """One row: rows, and surplus rows of keys that come more than once. A null in a key is a value.

    ``packed`` names an integer key whose values lie close together beside equal other
    keys: groups are blocks of 64 of them, not single keys. The counts are the same."""
    by = [block_of(k).alias(k) if k == packed else F.col(k) for k in keys]
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *([bits_of(packed).alias("bits")] if packed else []))
    kinds = F.coalesce(F.bit_count("bits"), F.lit(1)) if packed else F.lit(1)       # no bits: the null key
    return g.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - kinds).alias("duplicate_rows"))


@star_query("dq_pk")
def dq_pk(st):
    """Primary-key uniqueness: rows and surplus rows of duplicated keys per table."""
    return _union([key_counts(st[t], keys, PACKED.get(t)).select(F.lit(t).alias("table_name"), "rows", "duplicate_rows")
                   for t, keys in PK.items()])


# The declared references: column stems of each child table; a stem's ending names the parent.
_PARENTS = {"date": ("date_dim", "d_date_sk"), "time": ("time_dim", "t_time_sk"), "item": ("item", "i_item_sk"),
            "customer": ("customer", "c_customer_sk"), "cdemo": ("customer_demographics", "cd_demo_sk"),
            "hdemo": ("household_demographics", "hd_demo_sk"), "addr": ("customer_address", "ca_address_sk"),
            "store": ("store", "s_store_sk"), "promo": ("promotion", "p_promo_sk"), "reason": ("reason", "r_reason_sk"),
            "call_center": ("call_center", "cc_call_center_sk"), "catalog_page": ("catalog_page", "cp_catalog_page_sk"),
            "ship_mode": ("ship_mode", "sm_ship_mode_sk"), "warehouse": ("warehouse", "w_warehouse_sk"),
            "web_page": ("web_page", "wp_web_page_sk"), "web_site": ("web_site", "web_site_sk"),
            "income_band": ("income_band", "ib_income_band_sk")}
_PEOPLE = ("customer", "cdemo", "hdemo", "addr")


def _both(first: str, second: str) -> str:
    return " ".join(f"{who}_{part}" for who in (first, second) for part in _PEOPLE)


_REFERENCES = {
    "store_sales": ("ss", "sold_date sold_time item customer cdemo hdemo addr store promo"),
    "store_returns": ("sr", "returned_date return_time item customer cdemo hdemo addr store reason"),
    "catalog_sales": ("cs", f"sold_date sold_time ship_date item {_both('bill', 'ship')} call_center catalog_page ship_mode warehouse promo"),
    "catalog_returns": ("cr", f"returned_date returned_time item {_both('refunded', 'returning')} call_center catalog_page ship_mode "
                              "warehouse reason"),
    "web_sales": ("ws", f"sold_date sold_time ship_date item {_both('bill', 'ship')} web_page web_site ship_mode warehouse promo"),
    "web_returns": ("wr", f"returned_date returned_time item {_both('refunded', 'returning')} web_page reason"),
    "inventory": ("inv", "date item warehouse"),
    "customer": ("c", "current_cdemo current_hdemo current_addr first_shipto_date first_sales_date"),
    "household_demographics": ("hd", "income_band"), "promotion": ("p", "start_date end_date item"),
    "call_center": ("cc", "open_date closed_date"), "catalog_page": ("cp", "start_date end_date"),
    "web_site": ("web", "open_date close_date"), "web_page": ("wp", "creation_date access_date customer"),
    "store": ("s", "closed_date")}
FK = [(t, f"{p}_{stem}_sk", *next(v for k, v in _PARENTS.items() if stem == k or stem.endswith("_" + k)))
      for t, (p, stems) in _REFERENCES.items() for stem in stems.split()]
#: every return names a sale line by item and ticket or order
RETURN_OF = [("store_returns", ("sr_item_sk", "sr_ticket_number"), "store_sales", ("ss_item_sk", "ss_ticket_number")),
             ("catalog_returns", ("cr_item_sk", "cr_order_number"), "catalog_sales", ("cs_item_sk", "cs_order_number")),
             ("web_returns", ("wr_item_sk", "wr_order_number"), "web_sales", ("ws_item_sk", "ws_order_number"))]


# bounded and small enough to send to every task for each of several references
_BOUNDED_DIMS = {"date_dim", "time_dim", "store", "household_demographics", "income_band", "promotion", "warehouse",
                 "ship_mode", "reason", "call_center", "catalog_page", "web_site", "web_page"}
# A parent's keys go to every task as bits of blocks if there are so many blocks at most (16 bytes each, 16 million
# neighbouring keys); else the child's keys are counted and shuffled.
_SENT_BLOCKS = 1 << 18
# References that one pass of a child checks: the JVM compiles no method of over 8,000 bytes of code.
_REFS_A_PASS = 6


def key_blocks(parent: DataFrame, key: str) -> DataFrame:
    """The keys of a parent as bits of blocks of 64."""
    return parent.filter(F.col(key).isNotNull()).groupBy(block_of(key).alias("block")).agg(bits_of(key).alias("bits"))


def orphans_by_pass(child: DataFrame, refs: list[tuple[str, DataFrame, str | None]], prefix: str) -> DataFrame:
    """Orphans of several references in one pass of the child, no row of which is shuffled.

    A reference is a column with its parent's key and the key's column, or with :func:`key_blocks` and None."""
    child, flags = child.select(*sorted({c for c, _, _ in refs})), []
    for i, (col, parent, key) in enumerate(refs):
        if key is None:
            sent = parent.select(F.col("block").alias(f"_p{i}"), F.col("bits").alias(f"_f{i}"))
            child, known = child.join(B(sent), block_of(col) == F.col(f"_p{i}"), "left"), has_bit(f"_f{i}", col)
        else:
            sent = parent.select(F.col(key).alias(f"_p{i}")).distinct().withColumn(f"_f{i}", F.lit(1))
            child, known = child.join(B(sent), F.col(col) == F.col(f"_p{i}"), "left"), F.col(f"_f{i}").isNotNull()
        flags.append(F.sum(F.when(F.col(col).isNotNull() & ~known, 1).otherwise(0)).alias(f"{prefix}.{col}"))
    return child.agg(*flags).unpivot([], [f"`{prefix}.{c}`" for c, _, _ in refs], "fk_name", "orphans")


def orphans_by_count(child: DataFrame, col: str, parent: DataFrame, key: str, prefix: str) -> DataFrame:
    """Orphans of one reference: the child's keys are counted before they are shuffled to those of the parent."""
    keys = child.groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(key).alias("_p")).distinct().withColumn("_f", F.lit(1))
    lost = F.when(F.col("_k").isNotNull() & F.col("_f").isNull(), F.col("_n")).otherwise(0)
    return (keys.join(known, F.col("_k") == F.col("_p"), "left").agg(F.sum(lost).alias("orphans"))
            .select(F.lit(f"{prefix}.{col}").alias("fk_name"), "orphans"))


@star_query("dq_fk")
def dq_fk(st):
    """Foreign-key orphans (non-NULL references without a parent).

    Few passes per child table: each parent key set is left-joined as a
    presence flag and the orphan counts of several references come out of a
    single aggregate, instead of one anti join -- one child scan -- per key. No
    row of a child is shuffled: parents bounded by construction are sent whole,
    the others as bits of blocks of their keys. If the keys of one lie in too
    many blocks, its references are checked by counts of the child's keys."""
    out = []
    blocks = {}
    for _, _, dim, key in FK:
        if dim not in _BOUNDED_DIMS and dim not in blocks:
            found = key_blocks(st[dim], key)
            blocks[dim] = found if found.count() <= _SENT_BLOCKS else None
    by_child: dict[str, list[tuple[str, str, str]]] = {}
    for t, col, dim, key in FK:
        by_child.setdefault(t, []).append((col, dim, key))
    for t, refs in by_child.items():
        sent = [(c, st[d], k) if d in _BOUNDED_DIMS else (c, blocks[d], None) for c, d, k in refs
                if d in _BOUNDED_DIMS or blocks[d] is not None]
        out += [orphans_by_pass(st[t], sent[i:i + _REFS_A_PASS], t) for i in range(0, len(sent), _REFS_A_PASS)]
        out += [orphans_by_count(st[t], c, st[d], k, t) for c, d, k in refs if d not in _BOUNDED_DIMS and blocks[d] is None]
    for t, cols, parent, keys in RETURN_OF:
        lost = st[t].join(st[parent].select(*keys), [F.col(c) == F.col(k) for c, k in zip(cols, keys)], "left_anti")
        out.append(lost.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(f"{t}.{cols[1]}").alias("fk_name"), "orphans"))
    return _union(out)


_NULLABLE = {t: [f"{p}_{stem}_sk" for stem in stems.split()] for t, (p, stems) in _REFERENCES.items()}


@star_query("profile_nulls")
def profile_nulls(st):
    """NULL count per nullable key column (one aggregate pass per table, unpivoted)."""
    out = []
    for t, cols in _NULLABLE.items():
        one = st[t].agg(F.count(F.lit(1)).alias("rows"),
                        *[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in cols])
        out.append(one.unpivot("rows", cols, "column_name", "nulls").select(
            F.lit(t).alias("table_name"), "column_name", "nulls", "rows"))
    return _union(out)


PLACED_BY = {"store_sales": "ss_item_sk", "store_returns": "sr_item_sk", "catalog_sales": "cs_item_sk",
             "catalog_returns": "cr_item_sk", "web_sales": "ws_item_sk", "web_returns": "wr_item_sk", "inventory": "inv_item_sk"}


@star_query("profile_skew")
def profile_skew(st, buckets=32, warn=1.2):
    """Rows per placement bucket of the item key: max/avg ratio, WARN at >= 1.2."""
    out = []
    for t, key in PLACED_BY.items():
        per = st[t].groupBy(F.pmod(F.col(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        s = per.agg(F.max("n").alias("max_rows"), F.sum("n").alias("rows"))
        s = s.select(F.lit(t).alias("table_name"), "max_rows", "rows",
                     F.when(F.col("rows") > 0, F.col("max_rows") * buckets / F.col("rows")).alias("skew"))
        out.append(s.withColumn("status", F.when(F.col("skew") >= warn, "WARN").otherwise("OK")))
    return _union(out)


_MEASURES = {"store_sales": ["ss_quantity"], "store_returns": ["sr_return_quantity"], "catalog_sales": ["cs_quantity"],
             "catalog_returns": ["cr_return_quantity"], "web_sales": ["ws_quantity"], "web_returns": ["wr_return_quantity"],
             "inventory": ["inv_quantity_on_hand"]}
CHECKED = {t: list(dict.fromkeys([*keys, *_NULLABLE.get(t, []), *_MEASURES.get(t, [])])) for t, keys in PK.items()}


@star_query("profile_checksum")
def profile_checksum(st):
    """Row count and an order-independent integer checksum of the keys and references of every table."""
    out = []
    for t, cols in CHECKED.items():
        h = sum((F.coalesce(F.col(c).cast("long"), F.lit(-1)) * (2 * i + 17) for i, c in enumerate(cols)), F.lit(0))
        out.append(st[t].agg(F.count(F.lit(1)).alias("rows"), F.sum(F.pmod(h, F.lit(1000003))).alias("checksum"))
                   .select(F.lit(t).alias("table_name"), "rows", "checksum"))
    return _union(out)


STATS_COLUMNS = [*_NULLABLE["store_sales"], "ss_ticket_number", "ss_quantity",
                 *[f"ss_{m}" for m in ("wholesale_cost", "list_price", "sales_price", "ext_discount_amt", "ext_sales_price",
                                       "ext_wholesale_cost", "ext_list_price", "ext_tax", "coupon_amt", "net_paid",
                                       "net_paid_inc_tax", "net_profit")]]


@star_query("profile_stats")
def profile_stats(st):
    """Column statistics of store_sales: count, nulls, distinct, min, max."""
    cols = STATS_COLUMNS
    # one scan: every row becomes one (column, value) row per profiled column
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("decimal(20,2)").alias("v")) for c in cols]))
    one = st.store_sales.select(pairs.alias("p")).select("p.column_name", "p.v")
    return one.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.count("v")).alias("nulls"),
        F.countDistinct("v").alias("distinct_values"), F.min("v").cast("double").alias("min_value"),
        F.max("v").cast("double").alias("max_value"))


@raw_query("orders_explode")
def orders_explode(spark, sf_dir):
    """Multi-line orders (8-16 lines of a store or web order, 4-14 of a catalog
    order), items taken by wrap-around from a per-order start position, hence
    unique within an order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    n_items = read_table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n_items"))
    catalog = F.pmod("o_orderkey", F.lit(3)) == 1
    o = o.crossJoin(B(n_items)).withColumn("catalog", catalog).withColumn(
        "n", F.when(catalog, 4 + F.pmod("o_orderkey", F.lit(11))).otherwise(8 + F.pmod("o_orderkey", F.lit(9))))
    lines = o.select("o_orderkey", "catalog", "n", "n_items", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    lines = lines.withColumn("item", F.pmod(F.pmod(F.col("o_orderkey") * 7919, F.col("n_items")) + F.col("i"),
                                            F.col("n_items")))
    return lines.groupBy("catalog", "n").agg(F.countDistinct("o_orderkey").alias("orders"), F.count(F.lit(1)).alias("lines"),
                                  F.countDistinct("o_orderkey", "item").alias("distinct_pairs"),
                                  F.min("item").alias("min_item"), F.max("item").alias("max_item"))


@star_query("sample_weighted")
def sample_weighted(st):
    """Weighted value assignment: each customer draws a category with
    probability proportional to the category's item count (cumulative weight
    table + range join; the weight table is bounded by the category count)."""
    w = st.item.groupBy("i_category").agg(F.count(F.lit(1)).alias("weight"))
    win = Window.orderBy("i_category").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w = w.withColumn("cum_hi", F.sum("weight").over(win)).withColumn("cum_lo", F.col("cum_hi") - F.col("weight"))
    total = w.agg(F.sum("weight").alias("total"))
    c = st.customer.select("c_customer_sk").crossJoin(B(total)).withColumn(
        "r", F.pmod(F.col("c_customer_sk").cast("long") * 7919 + 13, F.col("total")))
    j = c.join(B(w), (c.r >= w.cum_lo) & (c.r < w.cum_hi))
    return j.groupBy("i_category", "weight").agg(F.count(F.lit(1)).alias("customers"))


@star_query("volume_by_day")
def volume_by_day(st):
    """Yearly ticket counts apportioned to days by a seasonal weight
    (December x3, weekend x2), compared with actual tickets per month."""
    d = st.date_dim.select("d_date_sk", "d_year", "d_moy",
                           F.when(F.col("d_moy") == 12, 3).when(F.col("d_dow").isin(0, 6), 2).otherwise(1).alias("w"))
    tickets = (st.store_sales.select("ss_ticket_number", "ss_sold_date_sk").distinct()
               .join(B(d), F.col("ss_sold_date_sk") == F.col("d_date_sk")))
    per_year = tickets.groupBy("d_year").agg(F.count(F.lit(1)).alias("n_year"))
    wy = Window.partitionBy("d_year")
    days = d.join(B(per_year), "d_year").withColumn("w_year", F.sum("w").over(wy))
    # expected = round(n_year * w / w_year), half-up, in exact integer arithmetic
    num = F.col("n_year") * F.col("w") * 2 + F.col("w_year")
    days = days.withColumn("expected", idiv_col(num, F.col("w_year") * 2))
    exp = days.groupBy("d_year", "d_moy").agg(F.sum("expected").cast("long").alias("expected_tickets"))
    act = tickets.groupBy("d_year", "d_moy").agg(F.count(F.lit(1)).alias("actual_tickets"))
    return exp.join(act, ["d_year", "d_moy"], "left").select(
        "d_year", "d_moy", "expected_tickets", F.coalesce("actual_tickets", F.lit(0)).alias("actual_tickets"))


@raw_query("scale_rowcounts")
def scale_rowcounts(spark, sf_dir, targets=(1, 100, 1000)):
    """Row counts of the driver tables, the scale they imply, and projections
    (static tables stay fixed, the others scale linearly)."""
    static = {"region", "nation"}
    parts = []
    for name in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        parts.append(read_table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("table_name"), F.lit(name in static).alias("static"), "rows"))
    u = _union(parts)
    sf = u.filter(F.col("table_name") == "lineitem").select((F.col("rows") / 6000000.0).alias("sf"))
    u = u.crossJoin(B(sf))
    return u.select("table_name", "static", "rows", "sf", *[
        F.when(F.col("static"), F.col("rows")).otherwise(F.round(F.col("rows") * (t / F.col("sf")))).cast("long")
        .alias(f"rows_sf{t}") for t in targets])


@star_query("dim_item_hierarchy")
def dim_item_hierarchy(st):
    """Category -> class -> brand hierarchy of the item dimension."""
    return st.item.groupBy("i_category_id", "i_category", "i_class_id", "i_class").agg(
        F.countDistinct("i_brand_id").alias("brands"), F.count(F.lit(1)).alias("items"),
        F.countDistinct("i_item_id").alias("business_ids"))


@star_query("gift_orders")
def gift_orders(st):
    """Share of catalog/web order lines shipped to someone other than the buyer."""
    out = []
    for ch, t, p in [("catalog", "catalog_sales", "cs"), ("web", "web_sales", "ws")]:
        s = st[t].join(B(st.date_dim.select("d_date_sk", "d_year")), F.col(f"{p}_sold_date_sk") == F.col("d_date_sk"))
        gift = F.col(f"{p}_ship_customer_sk") != F.col(f"{p}_bill_customer_sk")
        out.append(s.groupBy("d_year").agg(F.count(F.lit(1)).alias("lines"),
                                           F.sum(F.when(gift, 1).otherwise(0)).alias("gift_lines"))
                   .select(F.lit(ch).alias("channel"), "*"))
    return _union(out)
