"""SQL of the order and return feeds of the three channels and what applying them adds."""

from __future__ import annotations

STAR_SQL: dict[str, tuple[str, str]] = {}

# channel: sales prefix, returns prefix, order number, outlet (table, key, id, rate, fact column), page (table, key, id, fact column)
_CH = {
    "store": ("ss", "sr", "ticket_number", ("store", "s_store_sk", "s_store_id", "s_tax_precentage", "store_sk"), None),
    "catalog": ("cs", "cr", "order_number",
                ("call_center", "cc_call_center_sk", "cc_call_center_id", "cc_tax_percentage", "call_center_sk"),
                ("catalog_page", "cp_catalog_page_sk", "cp_catalog_number || '/' || cp_catalog_page_number", "catalog_page_sk")),
    "web": ("ws", "wr", "order_number", ("web_site", "web_site_sk", "web_site_id", "web_tax_percentage", "web_site_sk"),
            ("web_page", "wp_web_page_sk", "wp_web_page_id", "web_page_sk")),
}
_TABLES = ("store_sales catalog_sales web_sales store_returns catalog_returns web_returns date_dim time_dim item customer store "
           "call_center catalog_page web_site web_page promotion ship_mode warehouse reason")


def _orders(ch: str) -> str:
    """CTEs <ch>_feed (flaws included) and <ch>_line (resolved) of a channel."""
    p, _, num, (out, osk, oid, rate, ocol), page = _CH[ch]
    ship = page is not None
    bill = f"{p}_bill_customer_sk" if ship else f"{p}_customer_sk"
    psk, pid, pcol = (page[1], page[2], page[3]) if ship else ("", "", "")
    return f"""
{ch}_recent AS (SELECT *, CAST({p}_{num} - {p}_{num} % 4 + 3 AS BIGINT) AS order_id FROM {ch}_sales
  WHERE {p}_sold_date_sk > (SELECT max({p}_sold_date_sk) FROM {ch}_sales) - 60),
{ch}_head AS (
  SELECT h.order_id, h.date_sk, dd.d_date, h.time_sk, o.{osk} AS outlet_sk, o.{rate} AS rate,
         CASE WHEN (h.order_id // 4) % 41 = 3 THEN 'CUST-UNKNOWN' END AS bad_customer,
         CASE WHEN (h.order_id // 4) % 41 <> 3 THEN h.bill END AS bill, {'h.ship' if ship else 'NULL'} AS ship, {'h.ship_mode' if ship else 'NULL'} AS ship_mode
  FROM (SELECT order_id, min({p}_sold_date_sk) AS date_sk, min({p}_sold_time_sk) AS time_sk, min({p}_{ocol}) AS outlet, min({bill}) AS bill
        {f', min({p}_ship_customer_sk) AS ship, min({p}_ship_mode_sk) AS ship_mode' if ship else ''}
        FROM {ch}_recent GROUP BY order_id) h
  JOIN date_dim dd ON dd.d_date_sk = h.date_sk LEFT JOIN {out} o ON o.{osk} = h.outlet
  WHERE (h.order_id // 4) % 61 <> 9),
{ch}_line0 AS (
  SELECT r.order_id, r.{p}_item_sk AS line_number, r.{p}_quantity AS quantity, r.{p}_sales_price AS sales_price, r.{p}_coupon_amt AS coupon_amt,
         CASE WHEN r.{p}_item_sk % 53 = 7 THEN 'ITEM-UNKNOWN' ELSE i.i_item_id END AS item_id,
         CASE WHEN r.{p}_item_sk % 37 <> 11 THEN r.{p}_promo_sk END AS promo_sk, r.{p}_item_sk % 37 = 11 AS bad_promo,
         {f'''CASE WHEN dd.d_date_sk IS NOT NULL THEN r.{p}_ship_date_sk END AS ship_date_sk, r.{p}_warehouse_sk AS warehouse_sk,
         r.{p}_{pcol} AS page_sk,
         CAST(CAST((CAST(r.{p}_ext_ship_cost * 200 AS BIGINT) + r.{p}_quantity) // (2 * r.{p}_quantity) AS DECIMAL(18,0)) / 100 AS DECIMAL(7,2)) AS ship_cost'''
          if ship else 'NULL AS ship_date_sk, NULL AS warehouse_sk, NULL AS page_sk, CAST(0 AS DECIMAL(7,2)) AS ship_cost'}
  FROM {ch}_recent r JOIN item i ON i.i_item_sk = r.{p}_item_sk
  {f'LEFT JOIN date_dim dd ON dd.d_date_sk = r.{p}_ship_date_sk' if ship else ''}),
{ch}_line AS (
  SELECT l.*, h.order_id IS NOT NULL AS has_head, h.date_sk, h.time_sk, h.outlet_sk, h.rate, h.bad_customer, h.bill, h.ship, h.ship_mode,
         it.i_item_sk AS item_sk, it.i_wholesale_cost AS whole, it.i_current_price AS list,
         bc.c_current_cdemo_sk AS bill_cdemo, bc.c_current_hdemo_sk AS bill_hdemo, bc.c_current_addr_sk AS bill_addr,
         sc.c_current_cdemo_sk AS ship_cdemo, sc.c_current_hdemo_sk AS ship_hdemo, sc.c_current_addr_sk AS ship_addr,
         l.sales_price * l.quantity - l.coupon_amt AS net,
         round((l.sales_price * l.quantity - l.coupon_amt) * coalesce(h.rate, 0), 2) AS taxed,
         row_number() OVER (PARTITION BY l.order_id, it.i_item_sk ORDER BY l.line_number) AS place
  FROM {ch}_line0 l LEFT JOIN {ch}_head h ON h.order_id = l.order_id
       LEFT JOIN item it ON it.i_item_id = l.item_id AND h.d_date >= it.i_rec_start_date
                         AND h.d_date <= coalesce(it.i_rec_end_date, DATE '9999-12-31')
       LEFT JOIN customer bc ON bc.c_customer_sk = h.bill LEFT JOIN customer sc ON sc.c_customer_sk = h.ship)"""


def _sale_row(ch: str) -> str:
    p, _, num, out, page = _CH[ch]
    ship = page is not None

    def keys(role, names):
        return ", ".join(f"CAST({v} AS BIGINT) AS {n}" for n, v in names.items()) if role else ", ".join(
            f"CAST(NULL AS BIGINT) AS {n}" for n in names)
    single = {"customer_sk": "bill", "cdemo_sk": "bill_cdemo", "hdemo_sk": "bill_hdemo", "addr_sk": "bill_addr"}
    double = {"bill_customer_sk": "bill", "bill_cdemo_sk": "bill_cdemo", "bill_hdemo_sk": "bill_hdemo", "bill_addr_sk": "bill_addr",
              "ship_customer_sk": "ship", "ship_cdemo_sk": "ship_cdemo", "ship_hdemo_sk": "ship_hdemo", "ship_addr_sk": "ship_addr",
              "ship_date_sk": "ship_date_sk", "ship_mode_sk": "ship_mode", "warehouse_sk": "warehouse_sk"}
    outlets = ", ".join(f"CAST({'outlet_sk' if out[4] == c else 'NULL'} AS BIGINT) AS {c}" for c in ("store_sk", "call_center_sk", "web_site_sk"))
    pages = ", ".join(f"CAST({'page_sk' if ship and page[3] == c else 'NULL'} AS BIGINT) AS {c}" for c in ("catalog_page_sk", "web_page_sk"))
    money = {"wholesale_cost": "whole", "list_price": "list", "sales_price": "sales_price", "ext_discount_amt": "(list - sales_price) * quantity",
             "ext_sales_price": "sales_price * quantity", "ext_wholesale_cost": "whole * quantity", "ext_list_price": "list * quantity",
             "ext_tax": "taxed", "coupon_amt": "coupon_amt", "ext_ship_cost": "ship_cost * quantity" if ship else "NULL", "net_paid": "net",
             "net_paid_inc_tax": "net + taxed", "net_paid_inc_ship": "net + ship_cost * quantity" if ship else "NULL",
             "net_paid_inc_ship_tax": "net + ship_cost * quantity + taxed" if ship else "NULL", "net_profit": "net - whole * quantity"}
    amounts = ", ".join(f"CAST(CAST({v} AS DECIMAL(7,2)) AS DOUBLE) AS {n}" for n, v in money.items())
    return f"""SELECT '{ch}' AS channel, order_id, CAST(date_sk AS BIGINT) AS sold_date_sk, CAST(time_sk AS BIGINT) AS sold_time_sk,
  CAST(item_sk AS BIGINT) AS item_sk, CAST(promo_sk AS BIGINT) AS promo_sk, CAST(quantity AS BIGINT) AS quantity,
  {keys(not ship, single)}, {keys(ship, double)}, {outlets}, {pages}, {amounts}
FROM {ch}_line WHERE has_head AND item_sk IS NOT NULL AND place = 1"""


def _reject_rows(ch: str) -> str:
    def one(role, value, cond, rejected="false"):
        return f"SELECT '{ch}' AS channel, order_id, line_number, '{role}' AS role, {value} AS value, {rejected} AS rejected FROM {ch}_line WHERE {cond}"
    return "\nUNION ALL ".join([
        one("header", "CAST(order_id AS VARCHAR)", "NOT has_head", "true"),
        one("item", "item_id", "has_head AND item_sk IS NULL", "true"),
        one("repeated", "item_id", "item_sk IS NOT NULL AND place > 1", "true"),
        one("bill_customer", "bad_customer", "bad_customer IS NOT NULL"),
        one("promo", "'PROMO-UNKNOWN'", "bad_promo")])


_FEEDS = "WITH " + ",".join(_orders(c) for c in _CH)
STAR_SQL["refresh_orders"] = (_TABLES, _FEEDS + "\n" + "\nUNION ALL BY NAME ".join(_sale_row(c) for c in _CH))
STAR_SQL["refresh_orders_rejects"] = (_TABLES, _FEEDS + "\n" + "\nUNION ALL ".join(_reject_rows(c) for c in _CH))


def _after(ch: str) -> str:
    p, _, num, _, _ = _CH[ch]
    cols = ("net_paid", "ext_tax", "ext_list_price", "net_profit")
    old = ", ".join(f"CAST({p}_{c} AS DECIMAL(18,2)) AS {c}" for c in cols)
    new = ", ".join(f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in cols)
    return f"""SELECT '{ch}_sales' AS table_name, count(*) AS rows, count(DISTINCT order_id) AS orders,
  {', '.join(f'CAST(sum({c}) AS DOUBLE) AS {c}' for c in cols)}
FROM (SELECT {p}_{num} AS order_id, {old} FROM {ch}_sales UNION ALL SELECT order_id, {new} FROM ({_sale_row(ch)}))"""


STAR_SQL["refresh_orders_stored"] = (_TABLES, _FEEDS + "\n" + "\nUNION ALL ".join(_after(c) for c in _CH))


# ---------------------------------------------------------------- returns
_MONEY = ("return_amt", "return_tax", "fee", "return_ship_cost", "refunded_cash", "reversed_charge", "store_credit")


def _returns(ch: str) -> str:
    p, r, num, out, page = _CH[ch]
    ship = page is not None
    amt = {"return_amt": "return_amount" if ch == "catalog" else "return_amt", "store_credit": "account_credit" if ch == "web" else "store_credit"}
    who = [("returning", "returning_customer_sk"), ("refunded", "refunded_customer_sk")] if ship else [("returning", "customer_sk")]
    keys = [f"{r}_{c} AS {w}_customer_sk" for w, c in who] + [f"{r}_reason_sk AS reason_sk"]
    keys.append(f"{r}_{out[4]} AS outlet_sk" if ch != "web" else "NULL AS outlet_sk")
    keys.append(f"{r}_{page[3]} AS page_sk" if ship else "NULL AS page_sk")
    keys += [f"{r}_{c} AS {c}" if ch == "catalog" else f"NULL AS {c}" for c in ("ship_mode_sk", "warehouse_sk")]
    if not ship:
        keys.append("NULL AS refunded_customer_sk")
    time = "returned_time_sk" if ship else "return_time_sk"
    return f"""
{ch}_back0 AS (
  SELECT CAST(CASE WHEN {r}_item_sk % 59 = 5 THEN -{r}_{num} ELSE {r}_{num} END AS BIGINT) AS order_id, {r}_item_sk AS line_number,
         dd.d_date_sk AS returned_date_sk, {r}_{time} AS time_sk, {r}_return_quantity AS return_qty, i.i_item_id AS item_id,
         {', '.join(keys)}, {', '.join(f'{r}_{amt.get(m, m)} AS {m}' for m in _MONEY)}
  FROM {ch}_returns LEFT JOIN date_dim dd ON dd.d_date_sk = {r}_returned_date_sk JOIN item i ON i.i_item_sk = {r}_item_sk
  WHERE {r}_returned_date_sk > (SELECT max({r}_returned_date_sk) FROM {ch}_returns) - 60),
{ch}_sold AS (SELECT {p}_{num} AS order_id, i_item_id AS item_id, {p}_item_sk AS item_sk,
                     row_number() OVER (PARTITION BY {p}_{num}, i_item_id ORDER BY {p}_item_sk) AS turn
              FROM {ch}_sales JOIN item ON i_item_sk = {p}_item_sk),
{ch}_back AS (
  SELECT b.*, s.item_sk, rc.c_current_cdemo_sk AS returning_cdemo_sk, rc.c_current_hdemo_sk AS returning_hdemo_sk, rc.c_current_addr_sk AS returning_addr_sk,
         fc.c_current_cdemo_sk AS refunded_cdemo_sk, fc.c_current_hdemo_sk AS refunded_hdemo_sk, fc.c_current_addr_sk AS refunded_addr_sk
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, item_id ORDER BY line_number) AS turn FROM {ch}_back0) b
  LEFT JOIN {ch}_sold s ON s.order_id = b.order_id AND s.item_id = b.item_id AND s.turn = b.turn
  LEFT JOIN customer rc ON rc.c_customer_sk = b.returning_customer_sk LEFT JOIN customer fc ON fc.c_customer_sk = b.refunded_customer_sk)"""


_BACK_KEYS = ("returned_date_sk", "time_sk", "item_sk", "returning_customer_sk", "returning_cdemo_sk", "returning_hdemo_sk", "returning_addr_sk",
              "refunded_customer_sk", "refunded_cdemo_sk", "refunded_hdemo_sk", "refunded_addr_sk", "outlet_sk", "page_sk", "ship_mode_sk",
              "warehouse_sk", "reason_sk", "return_qty")
_BACK = "WITH " + ",".join(_returns(c) for c in _CH)
_LOSS = "return_tax + fee + return_ship_cost"
STAR_SQL["refresh_returns"] = (_TABLES, _BACK + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS channel, order_id, line_number, item_sk IS NOT NULL AS linked, {', '.join(f'CAST({k} AS BIGINT) AS {k}' for k in _BACK_KEYS)},
  {', '.join(f'CAST({m} AS DOUBLE) AS {m}' for m in _MONEY)}, CAST(return_amt + return_tax AS DOUBLE) AS return_amt_inc_tax,
  CAST({_LOSS} AS DOUBLE) AS net_loss FROM {c}_back""" for c in _CH))


def _back_after(ch: str) -> str:
    r = _CH[ch][1]
    cols = {"fee": "fee", "return_tax": "return_tax", "net_loss": _LOSS, "return_ship_cost": "return_ship_cost"}
    return f"""SELECT '{ch}_returns' AS table_name, count(*) AS rows, {', '.join(f'CAST(sum({c}) AS DOUBLE) AS {c}' for c in cols)}
FROM (SELECT {', '.join(f'CAST({r}_{c} AS DECIMAL(18,2)) AS {c}' for c in cols)} FROM {ch}_returns
      WHERE {r}_returned_date_sk <= (SELECT max({r}_returned_date_sk) FROM {ch}_returns) - 60
      UNION ALL SELECT {', '.join(f'CAST({v} AS DECIMAL(18,2)) AS {c}' for c, v in cols.items())} FROM {ch}_back
      WHERE item_sk IS NOT NULL AND returned_date_sk IS NOT NULL)"""


STAR_SQL["refresh_returns_stored"] = (_TABLES, _BACK + "\n" + "\nUNION ALL ".join(_back_after(c) for c in _CH))
