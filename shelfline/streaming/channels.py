"""Order and return feeds of the three sales channels, applied to stored facts.

An order feed has two levels: headers (one row per order: customers, date,
time, ship mode, outlet) and lines (item, promotion, warehouse, page, ship
date, quantity, price, coupon, ship cost), all by business id. Customers are
resolved on the headers, before these meet their lines; items are resolved as
of the order's date. The result is the whole fact row: every column of the fact
table must have a rule here, else the job fails.

What resolves to nothing goes to a side output, one row for each line and role.
A line without header, calendar date or item revision is not loaded
(``rejected``), nor is a second line of an item in an order (two business lines
can mean one revision; the least line number is loaded). Any other unknown id
loads as a null key. A role that the feed
leaves null is no fault. Dates that cannot be parsed count as unknown.

Appending looks only at the date buckets that the new rows fall in and leaves
out (order, item) pairs that are stored there, so a feed can be applied again
after a failure.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.money import idiv_col, to_money
from shelfline.plans.registry import star_query
from shelfline.plans.star import FRESH_PURCHASE, KINDS
from shelfline.sources.io import scratch_path
from shelfline.sources.versions import VersionedTable
from shelfline.streaming.refresh import FAR_FUTURE, _stored_copy

B = F.broadcast


@dataclass(frozen=True)
class Channel:
    name: str
    sales: str                    # column prefix of the sales
    returns: str                  # and of the returns
    number: str                   # order number, without prefix
    outlet: tuple[str, str, str, str]             # dimension, key, business id, tax rate
    page: tuple[str, str, tuple[str, ...]] | None = None   # dimension, key, business id

    @property
    def ships(self) -> bool:
        return self.page is not None

    @property
    def outlet_key(self) -> str:
        """The outlet's column of the facts, without prefix."""
        return self.outlet[1].removeprefix("s_").removeprefix("cc_")

    @property
    def page_key(self) -> str:
        return self.page[1][3:]

    def sale(self, c: str) -> Column:
        return F.col(f"{self.sales}_{c}")

    def back(self, c: str) -> Column:
        return F.col(f"{self.returns}_{c}")


CHANNELS = (Channel("store", "ss", "sr", "ticket_number", ("store", "s_store_sk", "s_store_id", "s_tax_precentage")),
            Channel("catalog", "cs", "cr", "order_number",
                    ("call_center", "cc_call_center_sk", "cc_call_center_id", "cc_tax_percentage"),
                    ("catalog_page", "cp_catalog_page_sk", ("cp_catalog_number", "cp_catalog_page_number"))),
            Channel("web", "ws", "wr", "order_number", ("web_site", "web_site_sk", "web_site_id", "web_tax_percentage"),
                    ("web_page", "wp_web_page_sk", ("wp_web_page_id",))))

#: A line without these is not loaded.
REQUIRED = ("header", "sold_date", "item", "repeated")


def _text(parts: list[Column]) -> Column:
    """Business id of one or more parts; null if a part is."""
    return F.concat(*[x for k, p in enumerate(parts) for x in ([F.lit("/")] if k else []) + [p.cast("string")]])


def _lookup(df: DataFrame, dim: DataFrame, feed_col: str, sk: str, ids: list[str], out: str, small: bool = True, more=()) -> DataFrame:
    """``out``: the surrogate key that belongs to the business id in ``feed_col``, or null."""
    d = dim.select(_text([F.col(c) for c in ids]).alias("_id"), F.col(sk).alias(out), *more)
    return df.join(B(d) if small else d, F.col(feed_col) == F.col("_id"), "left").drop("_id")


def _business(df: DataFrame, dim: DataFrame, sk_col: str, sk: str, ids: list[str], out: str, small: bool = True) -> DataFrame:
    """The way back: ``out`` is the business id of a surrogate key."""
    d = dim.select(F.col(sk).alias("_sk"), _text([F.col(c) for c in ids]).alias(out))
    return df.join(B(d) if small else d, F.col(sk_col) == F.col("_sk"), "left").drop("_sk")


def _recent(st, table: str, date_col: str, days: int) -> DataFrame:
    last = st[table].agg(F.max(date_col).alias("_last"))
    return st[table].crossJoin(B(last)).filter(F.col(date_col) > F.col("_last") - days).drop("_last")


def _dates(st) -> DataFrame:
    return st.date_dim.select("d_date_sk", F.date_format("d_date", "yyyy-MM-dd").alias("d_text"))


# --------------------------------------------------------------------------- U1: orders
def order_feed(st, ch: Channel, days: int = 60, flaws: bool = True) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of the last ``days`` days of a channel as fresh orders by business id.

    ``flaws``: some headers are missing, some customers, items and promotions
    are unknown, as a real feed has them.
    """
    rows = _recent(st, f"{ch.name}_sales", f"{ch.sales}_sold_date_sk", days)
    number = ch.sale(ch.number)
    rows = rows.withColumn("order_id", (number - F.pmod(number, F.lit(KINDS)) + FRESH_PURCHASE).cast("long"))
    who = {"bill_customer": "customer_sk"} if not ch.ships else {"bill_customer": "bill_customer_sk", "ship_customer": "ship_customer_sk"}
    outlet, out_sk, out_id, _ = ch.outlet
    heads = rows.groupBy("order_id").agg(
        F.min(ch.sale("sold_date_sk")).alias("_date"), F.min(ch.sale("sold_time_sk")).cast("int").alias("order_time"),
        F.min(ch.sale(ch.outlet_key)).alias("_outlet"),
        *[F.min(ch.sale(c)).alias(f"_{w}") for w, c in who.items()],
        *([F.min(ch.sale("ship_mode_sk")).alias("_ship_mode")] if ch.ships else []))
    heads = _business(heads, _dates(st), "_date", "d_date_sk", ["d_text"], "order_date")
    heads = _business(heads, st[outlet], "_outlet", out_sk, [out_id], "outlet_id")
    for w in who:
        heads = _business(heads, st.customer, f"_{w}", "c_customer_sk", ["c_customer_id"], f"{w}_id", small=False)
    if ch.ships:
        heads = _business(heads, st.ship_mode, "_ship_mode", "sm_ship_mode_sk", ["sm_ship_mode_id"], "ship_mode_id")
    heads = heads.drop(*[c for c in heads.columns if c.startswith("_")])

    lines = rows.select("order_id", ch.sale("item_sk").alias("line_number"), ch.sale("quantity").alias("quantity"),
                        ch.sale("sales_price").alias("sales_price"), ch.sale("coupon_amt").alias("coupon_amt"),
                        ch.sale("promo_sk").alias("_promo"),
                        *([ch.sale("ship_date_sk").alias("_ship_date"), ch.sale("warehouse_sk").alias("_warehouse"),
                           ch.sale(ch.page_key).alias("_page"),
                           to_money(idiv_col((ch.sale("ext_ship_cost") * 200).cast("long") + ch.sale("quantity"),
                                             ch.sale("quantity") * 2)).alias("ship_cost")] if ch.ships else []))
    lines = _business(lines, st.item, "line_number", "i_item_sk", ["i_item_id"], "item_id", small=False)
    lines = _business(lines, st.promotion, "_promo", "p_promo_sk", ["p_promo_id"], "promo_id")
    if ch.ships:
        lines = _business(lines, _dates(st), "_ship_date", "d_date_sk", ["d_text"], "ship_date")
        lines = _business(lines, st.warehouse, "_warehouse", "w_warehouse_sk", ["w_warehouse_id"], "warehouse_id")
        lines = _business(lines, st[ch.page[0]], "_page", ch.page[1], list(ch.page[2]), "page_id")
    lines = lines.drop(*[c for c in lines.columns if c.startswith("_")])
    if flaws:
        order, item = F.floor(F.col("order_id") / KINDS), F.col("line_number")
        heads = (heads.filter(F.pmod(order, F.lit(61)) != 9)
                 .withColumn("bill_customer_id", F.when(F.pmod(order, F.lit(41)) == 3, "CUST-UNKNOWN").otherwise(F.col("bill_customer_id"))))
        lines = (lines.withColumn("item_id", F.when(F.pmod(item, F.lit(53)) == 7, "ITEM-UNKNOWN").otherwise(F.col("item_id")))
                 .withColumn("promo_id", F.when(F.pmod(item, F.lit(37)) == 11, "PROMO-UNKNOWN").otherwise(F.col("promo_id"))))
    return heads, lines


def _customer(st, role: str) -> tuple[DataFrame, list[Column]]:
    return st.customer, [F.col(f"c_current_{k}").alias(f"{role}_{k}") for k in ("cdemo_sk", "hdemo_sk", "addr_sk")]


def _item_as_of(st, rows: DataFrame, item_id: str, day: str, more: list[Column]) -> DataFrame:
    it = st.item.select(F.col("i_item_id").alias("_item_id"), F.col("i_item_sk").alias("item_sk"), "i_rec_start_date",
                        F.coalesce("i_rec_end_date", F.lit(FAR_FUTURE).cast("date")).alias("_end"), *more)
    return (rows.join(it, (F.col(item_id) == F.col("_item_id")) & F.col(day).between(F.col("i_rec_start_date"), F.col("_end")), "left")
            .drop("_item_id", "i_rec_start_date", "_end"))


def resolve_orders(st, ch: Channel, heads: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per feed line: all surrogate keys and measures, and ``faults`` (role, value)."""
    outlet, out_sk, out_id, tax = ch.outlet
    h = heads.withColumn("_day", F.try_to_date(F.col("order_date"), "yyyy-MM-dd")).withColumn("_header", F.lit(True))
    h = _lookup(h, _dates(st), "order_date", "d_date_sk", ["d_text"], "sold_date_sk")
    h = _lookup(h.withColumn("_time", F.col("order_time").cast("string")), st.time_dim, "_time", "t_time_sk", ["t_time"], "sold_time_sk")
    h = _lookup(h, st[outlet], "outlet_id", out_sk, [out_id], "outlet_sk", more=[F.col(tax).alias("_rate")])
    for role in ["bill", "ship"] if ch.ships else ["bill"]:
        dim, more = _customer(st, role)
        h = _lookup(h, dim, f"{role}_customer_id", "c_customer_sk", ["c_customer_id"], f"{role}_customer_sk", small=False, more=more)
    r = lines
    r = _lookup(r, st.promotion, "promo_id", "p_promo_sk", ["p_promo_id"], "promo_sk")
    if ch.ships:
        h = _lookup(h, st.ship_mode, "ship_mode_id", "sm_ship_mode_sk", ["sm_ship_mode_id"], "ship_mode_sk")
        r = _lookup(r, _dates(st), "ship_date", "d_date_sk", ["d_text"], "ship_date_sk")
        r = _lookup(r, st.warehouse, "warehouse_id", "w_warehouse_sk", ["w_warehouse_id"], "warehouse_sk")
        r = _lookup(r, st[ch.page[0]], "page_id", ch.page[1], list(ch.page[2]), "page_sk")
    r = r.join(h, "order_id", "left")
    r = _item_as_of(st, r, "item_id", "_day", [F.col("i_wholesale_cost").alias("_whole"), F.col("i_current_price").alias("_list")])

    q, sale, coupon = F.col("quantity"), F.col("sales_price"), F.coalesce("coupon_amt", F.lit(0).cast("decimal(7,2)"))
    net = sale * q - coupon
    taxed = F.round(net * F.coalesce("_rate", F.lit(0).cast("decimal(5,2)")), 2)
    ship = F.col("ship_cost") * q if ch.ships else F.lit(0).cast("decimal(7,2)")
    money = {"wholesale_cost": F.col("_whole"), "list_price": F.col("_list"), "coupon_amt": coupon,
             "ext_discount_amt": (F.col("_list") - sale) * q, "ext_sales_price": sale * q, "ext_wholesale_cost": F.col("_whole") * q,
             "ext_list_price": F.col("_list") * q, "ext_tax": taxed, "ext_ship_cost": ship, "net_paid": net,
             "net_paid_inc_tax": net + taxed, "net_paid_inc_ship": net + ship, "net_paid_inc_ship_tax": net + ship + taxed,
             "net_profit": net - F.col("_whole") * q}
    r = r.select("*", *[m.cast("decimal(7,2)").alias(f"m_{n}") for n, m in money.items()])

    place = F.row_number().over(Window.partitionBy("order_id", F.coalesce("item_sk", -F.col("line_number")))
                                .orderBy("line_number", "item_id", "quantity", "sales_price"))
    r = r.withColumn("_place", place)
    known = F.col("_header").isNotNull()
    roles = [("header", F.col("order_id").cast("string"), ~known),
             ("sold_date", F.col("order_date"), known & F.col("sold_date_sk").isNull()),
             ("item", F.col("item_id"), known & F.col("item_sk").isNull()),
             ("repeated", F.col("item_id"), F.col("item_sk").isNotNull() & (F.col("_place") > 1))]
    optional = [("sold_time", "_time", "sold_time_sk"), ("bill_customer", "bill_customer_id", "bill_customer_sk"),
                ("outlet", "outlet_id", "outlet_sk"), ("promo", "promo_id", "promo_sk")]
    if ch.ships:
        optional += [("ship_customer", "ship_customer_id", "ship_customer_sk"), ("ship_mode", "ship_mode_id", "ship_mode_sk"),
                     ("ship_date", "ship_date", "ship_date_sk"), ("warehouse", "warehouse_id", "warehouse_sk"), ("page", "page_id", "page_sk")]
    roles += [(n, F.col(v), F.col(v).isNotNull() & F.col(sk).isNull()) for n, v, sk in optional]
    faults = F.filter(F.array(*[F.when(bad, F.struct(F.lit(n).alias("role"), v.alias("value"))) for n, v, bad in roles]),
                      lambda x: x.isNotNull())
    return r.withColumn("faults", faults)


def _loaded() -> Column:
    return ~F.exists("faults", lambda x: x["role"].isin(*REQUIRED))


def sales_rows(st, ch: Channel, resolved: DataFrame) -> DataFrame:
    """The fact rows of the lines that can be loaded, with the columns and types of the fact table."""
    rule = {"ticket_number": "order_id", "order_number": "order_id", "store_sk": "outlet_sk", "call_center_sk": "outlet_sk",
            "web_site_sk": "outlet_sk", "catalog_page_sk": "page_sk", "web_page_sk": "page_sk",
            **{k: f"bill_{k}" for k in ("customer_sk", "cdemo_sk", "hdemo_sk", "addr_sk")}}
    out = []
    for f in st[f"{ch.name}_sales"].schema:
        name = f.name[len(ch.sales) + 1:]
        source = rule.get(name, name)
        out.append(F.col(f"m_{name}" if f"m_{name}" in resolved.columns else source).cast(f.dataType).alias(f.name))
    return resolved.filter(_loaded()).select(*out)


def rejects(ch: Channel, resolved: DataFrame) -> DataFrame:
    """The side output: one row for each line and role that resolves to nothing."""
    return (resolved.select(F.lit(ch.name).alias("channel"), "order_id", "line_number", F.explode("faults").alias("f"))
            .select("channel", "order_id", "line_number", F.col("f.role").alias("role"), F.col("f.value").alias("value"),
                    F.col("f.role").isin(*REQUIRED).alias("rejected")))


def append_new(table: VersionedTable, rows: DataFrame, keys: list[str]) -> int:
    """Append the rows whose keys are not stored yet; only the date buckets of the rows are read."""
    touched = {r.b for r in rows.select(table.bucket().alias("b")).distinct().collect()}     # ranges of the calendar
    stored = table.read_buckets(touched).select(*[F.col(k).alias(f"_{k}") for k in keys])
    match = functools.reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in keys])
    fresh = rows.join(stored, match, "left_anti")
    return table.append(fresh) if not fresh.isEmpty() else table.version()


def _staged(df: DataFrame, label: str) -> DataFrame:
    """Written once and read by all that follows; a lost executor reads it again."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _common(ch: Channel, prefix: str, rows: DataFrame, names: list[str]) -> DataFrame:
    """Channel rows under common names; columns that a channel lacks are null."""
    def one(name):
        c = f"{prefix}_{name}"
        if c not in rows.columns:
            return F.lit(None).cast("double" if not name.endswith("_sk") else "long").alias(name)
        return F.col(c).cast("long" if name.endswith(("_sk", "_number")) or name.endswith("quantity") else "double").alias(name)
    return rows.select(F.lit(ch.name).alias("channel"), F.col(f"{prefix}_{ch.number}").cast("long").alias("order_id"),
                       *[one(n) for n in names])


SALE_NAMES = ["sold_date_sk", "sold_time_sk", "ship_date_sk", "item_sk", "customer_sk", "cdemo_sk", "hdemo_sk", "addr_sk",
              "bill_customer_sk", "bill_cdemo_sk", "bill_hdemo_sk", "bill_addr_sk", "ship_customer_sk", "ship_cdemo_sk",
              "ship_hdemo_sk", "ship_addr_sk", "store_sk", "call_center_sk", "web_site_sk", "catalog_page_sk", "web_page_sk",
              "ship_mode_sk", "warehouse_sk", "promo_sk", "quantity", "wholesale_cost", "list_price", "sales_price",
              "ext_discount_amt", "ext_sales_price", "ext_wholesale_cost", "ext_list_price", "ext_tax", "coupon_amt",
              "ext_ship_cost", "net_paid", "net_paid_inc_tax", "net_paid_inc_ship", "net_paid_inc_ship_tax", "net_profit"]


@star_query("refresh_orders")
def refresh_orders(st, days=60):
    """The fact rows that the order feeds of the three channels add, every column."""
    return functools.reduce(DataFrame.unionByName, [
        _common(ch, ch.sales, sales_rows(st, ch, resolve_orders(st, ch, *order_feed(st, ch, days))), SALE_NAMES) for ch in CHANNELS])


@star_query("refresh_orders_rejects")
def refresh_orders_rejects(st, days=60):
    """What the order feeds name and no dimension knows."""
    return functools.reduce(DataFrame.unionByName, [rejects(ch, resolve_orders(st, ch, *order_feed(st, ch, days))) for ch in CHANNELS])


def load_orders(st, ch: Channel, table: VersionedTable, heads: DataFrame, lines: DataFrame) -> DataFrame:
    """Apply an order feed to a stored fact table; the side output."""
    resolved = _staged(resolve_orders(st, ch, heads, lines), f"orders-{ch.name}")
    append_new(table, sales_rows(st, ch, resolved), [f"{ch.sales}_item_sk", f"{ch.sales}_{ch.number}"])
    return rejects(ch, resolved)


@star_query("refresh_orders_stored")
def refresh_orders_stored(st, days=60):
    """The order feeds written, each of them twice; the sales tables as a reader finds them after."""
    out = []
    for ch in CHANNELS:
        table = _stored_copy(st, f"{ch.name}_sales", f"{ch.sales}_sold_date_sk")
        feed = order_feed(st, ch, days)
        load_orders(st, ch, table, *feed)
        load_orders(st, ch, table, *feed)
        out.append(table.read().agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct(ch.sale(ch.number)).alias("orders"),
            *[F.sum(ch.sale(c)).cast("double").alias(c) for c in ("net_paid", "ext_tax", "ext_list_price", "net_profit")])
            .select(F.lit(f"{ch.name}_sales").alias("table_name"), "*"))
    return functools.reduce(DataFrame.unionByName, out)


# --------------------------------------------------------------------------- U2: returns
#: Money of a return: common name, and its column where a channel has another.
RETURN_MONEY = {"return_amt": {"catalog": "return_amount"}, "return_tax": {}, "fee": {}, "return_ship_cost": {},
                "refunded_cash": {}, "reversed_charge": {}, "store_credit": {"web": "account_credit"}}


def _who(ch: Channel) -> dict[str, str]:
    return {"returning": "returning_customer_sk", "refunded": "refunded_customer_sk"} if ch.ships else {"returning": "customer_sk"}


def _more_dims(ch: Channel) -> dict[str, tuple[str, str, list[str]]]:
    """Role: dimension, key and business id of what else a return names."""
    out = {"reason": ("reason", "r_reason_sk", ["r_reason_id"])}
    if ch.name != "web":
        out["outlet"] = (ch.outlet[0], ch.outlet[1], [ch.outlet[2]])
    if ch.ships:
        out["page"] = (ch.page[0], ch.page[1], list(ch.page[2]))
    if ch.name == "catalog":
        out |= {"ship_mode": ("ship_mode", "sm_ship_mode_sk", ["sm_ship_mode_id"]),
                "warehouse": ("warehouse", "w_warehouse_sk", ["w_warehouse_id"])}
    return out


def _return_time(ch: Channel) -> str:
    return "returned_time_sk" if ch.ships else "return_time_sk"


def return_feed(st, ch: Channel, days: int = 60, flaws: bool = True) -> DataFrame:
    """The last ``days`` days of returns by business id; ``flaws``: some name an order that was never placed."""
    rows = _recent(st, f"{ch.name}_returns", f"{ch.returns}_returned_date_sk", days)
    number = ch.back(ch.number)
    rows = rows.select(number.cast("long").alias("order_id"), ch.back("item_sk").alias("line_number"),
                       ch.back("returned_date_sk").alias("_date"), ch.back(_return_time(ch)).alias("return_time"),
                       ch.back("return_quantity").alias("return_qty"),
                       *[ch.back(o.get(ch.name, n)).alias(n) for n, o in RETURN_MONEY.items()],
                       *[ch.back(c).alias(f"_{w}") for w, c in _who(ch).items()],
                       *[ch.back(_return_column(ch, role)).alias(f"_{role}") for role in _more_dims(ch)])
    rows = _business(rows, st.item, "line_number", "i_item_sk", ["i_item_id"], "item_id", small=False)
    rows = _business(rows, _dates(st), "_date", "d_date_sk", ["d_text"], "return_date")
    for w in _who(ch):
        rows = _business(rows, st.customer, f"_{w}", "c_customer_sk", ["c_customer_id"], f"{w}_id", small=False)
    for role, (dim, sk, ids) in _more_dims(ch).items():
        rows = _business(rows, st[dim], f"_{role}", sk, ids, f"{role}_id")
    rows = rows.drop(*[c for c in rows.columns if c.startswith("_")])
    if flaws:
        rows = rows.withColumn("order_id", F.when(F.pmod("line_number", F.lit(59)) == 5, -F.col("order_id")).otherwise(F.col("order_id")))
    return rows


def _return_column(ch: Channel, role: str) -> str:
    return {"outlet": ch.outlet_key, "page": ch.page_key if ch.ships else "",
            "reason": "reason_sk", "ship_mode": "ship_mode_sk", "warehouse": "warehouse_sk"}[role]


def resolve_returns(st, ch: Channel, feed: DataFrame) -> DataFrame:
    """One row per feed row: keys, money and ``linked``, whether a sale of the order and the item's business id is known.

    The return takes the item key that was sold, not the revision of the day. If
    an order holds several revisions of one business id, its returns of that id
    take them in turn, by line number.
    """
    r = _lookup(feed, _dates(st), "return_date", "d_date_sk", ["d_text"], "returned_date_sk")
    r = _lookup(r.withColumn("_time", F.col("return_time").cast("string")), st.time_dim, "_time", "t_time_sk", ["t_time"], "time_sk")
    for w in _who(ch):
        more = [F.col(f"c_current_{k}").alias(f"{w}_{k}") for k in ("cdemo_sk", "hdemo_sk", "addr_sk")]
        r = _lookup(r, st.customer, f"{w}_id", "c_customer_sk", ["c_customer_id"], f"{w}_customer_sk", small=False, more=more)
    for role, (dim, sk, ids) in _more_dims(ch).items():
        r = _lookup(r, st[dim], f"{role}_id", sk, ids, f"{role}_sk")
    # the feed is small beside the sales: it meets them first, and only what met is numbered
    sold = (feed.select("order_id", "item_id").distinct()
            .join(st[f"{ch.name}_sales"].select(ch.sale(ch.number).alias("order_id"), ch.sale("item_sk").alias("_item")), "order_id")
            .join(st.item.select(F.col("i_item_sk").alias("_item"), F.col("i_item_id").alias("item_id")), ["_item", "item_id"])
            .select("order_id", "item_id", F.col("_item").alias("item_sk"), F.row_number().over(
                Window.partitionBy("order_id", "item_id").orderBy("_item")).alias("_turn")))
    r = r.withColumn("_turn", F.row_number().over(Window.partitionBy("order_id", "item_id").orderBy("line_number", "return_date", "return_qty")))
    r = r.join(sold, ["order_id", "item_id", "_turn"], "left")
    return (r.withColumn("linked", F.col("item_sk").isNotNull())
            .withColumn("return_amt_inc_tax", F.col("return_amt") + F.col("return_tax"))
            .withColumn("net_loss", F.col("return_amt") + F.col("return_tax") + F.col("fee") + F.col("return_ship_cost")
                        - F.col("refunded_cash") - F.col("reversed_charge") - F.col("store_credit")))


def return_rows(st, ch: Channel, resolved: DataFrame) -> DataFrame:
    """The fact rows of the returns whose sale and date are known; one for each (order, sold item)."""
    rule = {"ticket_number": "order_id", "order_number": "order_id", _return_time(ch): "time_sk", "return_quantity": "return_qty",
            **{o[ch.name]: n for n, o in RETURN_MONEY.items() if ch.name in o},
            **{_return_column(ch, role): f"{role}_sk" for role in _more_dims(ch)},
            **({k: f"returning_{k}" for k in ("customer_sk", "cdemo_sk", "hdemo_sk", "addr_sk")} if not ch.ships else {})}
    ok = resolved.filter(F.col("linked") & F.col("returned_date_sk").isNotNull())
    out = []
    for f in st[f"{ch.name}_returns"].schema:
        name = f.name[len(ch.returns) + 1:]
        out.append(F.col(rule.get(name, name)).cast(f.dataType).alias(f.name))
    return ok.select(*out)


RETURN_NAMES = ["returned_date_sk", "time_sk", "item_sk", "returning_customer_sk", "returning_cdemo_sk", "returning_hdemo_sk",
                "returning_addr_sk", "refunded_customer_sk", "refunded_cdemo_sk", "refunded_hdemo_sk", "refunded_addr_sk",
                "outlet_sk", "page_sk", "ship_mode_sk", "warehouse_sk", "reason_sk", "return_qty", "return_amt", "return_tax",
                "return_amt_inc_tax", "fee", "return_ship_cost", "refunded_cash", "reversed_charge", "store_credit", "net_loss"]


@star_query("refresh_returns")
def refresh_returns(st, days=60):
    """The return feeds of the three channels, resolved: every key and amount, and whether the sale is known."""
    out = []
    for ch in CHANNELS:
        r = resolve_returns(st, ch, return_feed(st, ch, days))
        out.append(r.select(F.lit(ch.name).alias("channel"), "order_id", "line_number", "linked",
                            *[(F.col(n) if n in r.columns else F.lit(None)).cast("long" if n.endswith(("_sk", "qty")) else "double").alias(n)
                              for n in RETURN_NAMES]))
    return functools.reduce(DataFrame.unionByName, out)


@star_query("refresh_returns_stored")
def refresh_returns_stored(st, days=60, before=60):
    """Returns tables without their last ``before`` days get the return feeds; the tables as a reader finds them after.

    Each feed is applied twice: the second run finds its rows and adds nothing.
    """
    out = []
    for ch in CHANNELS:
        date_col = f"{ch.returns}_returned_date_sk"
        table = VersionedTable(st.spark, scratch_path(st.spark, f"stored-{ch.name}_returns"), date_col)
        last = st[f"{ch.name}_returns"].agg(F.max(date_col).alias("_last"))
        table.create(st[f"{ch.name}_returns"].crossJoin(B(last)).filter(F.col(date_col) <= F.col("_last") - before).drop("_last"))
        rows = _staged(return_rows(st, ch, resolve_returns(st, ch, return_feed(st, ch, days))), f"returns-{ch.name}")
        for _ in range(2):
            append_new(table, rows, [f"{ch.returns}_item_sk", f"{ch.returns}_{ch.number}"])
        amounts = ("fee", "return_tax", "net_loss", "return_ship_cost")
        out.append(table.read().agg(F.count(F.lit(1)).alias("rows"),
                                    *[F.sum(ch.back(c)).cast("double").alias(c) for c in amounts])
                   .select(F.lit(f"{ch.name}_returns").alias("table_name"), "*"))
    return functools.reduce(DataFrame.unionByName, out)
