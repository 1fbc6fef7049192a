"""The star-schema derivation written independently as DuckDB SQL.

Each query oracle is ``WITH <the star tables it needs> SELECT ...`` over the
driver's pre-registered views. Rules are the same integer rules as
``shelfline.plans.star`` (see its docstring), written out in SQL.
"""

from __future__ import annotations

from oracle import values as S


def _lst(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list[str], idx: str) -> str:
    return f"({_lst(values)})[({idx}) + 1]"


def rdiv(num: str, den: int) -> str:
    return f"((2 * ({num}) + {den}) // {2 * den})"


def money(c: str, p: int = 7) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,0)) / 100 AS DECIMAL({p},2))"


def nullk(v: str, i: int, kind: str = "INTEGER") -> str:
    return f"CASE WHEN (onum * 13 + pk * 7 + {i}) % 25 = 0 THEN NULL ELSE CAST({v} AS {kind}) END"


def cdemo(ck: str) -> str:
    return f"((({ck}) * {S.CDEMO_STEP}) % {S.N_CDEMO} + 1)"


def hdemo(ck: str) -> str:
    return f"((({ck}) * {S.HDEMO_STEP}) % {S.N_HDEMO} + 1)"


def jd(d: str) -> str:
    return f"CAST({S.JD_1998} + date_diff('day', DATE '1998-01-01', {d}) AS INTEGER)"


def pad(prefix: str, v: str, w: int = 10) -> str:
    x = f"CAST({v} AS VARCHAR)"
    return f"('{prefix}' || lpad({x}, CAST(greatest({w}, length({x})) AS INTEGER), '0'))"


_PRICED = f"""
  lp AS list_price,
  {rdiv('lp * 6', 10)} AS wholesale_cost,
  {rdiv('lp * (100 - disc)', 100)} AS sales_price,
  q * lp AS ext_list_price,
  q * sales_price AS ext_sales_price,
  q * wholesale_cost AS ext_wholesale_cost,
  ext_list_price - ext_sales_price AS ext_discount_amt,
  CASE WHEN (onum + ln) % 5 = 0 THEN {rdiv('ext_sales_price', 10)} ELSE 0 END AS coupon_amt,
  ext_sales_price - coupon_amt AS net_paid,
  {rdiv('net_paid * tax', 100)} AS ext_tax,
  {rdiv('lp * q * ln', 20)} AS ext_ship_cost,
  net_paid + ext_tax AS net_paid_inc_tax,
  net_paid + ext_ship_cost AS net_paid_inc_ship,
  net_paid + ext_ship_cost + ext_tax AS net_paid_inc_ship_tax,
  net_paid - ext_wholesale_cost AS net_profit"""

_RETURNED = f"""
  CAST(sold + 4 + (pk * 17 + ln * 31) % 177 AS INTEGER) AS r_date,
  CAST((onum * 7919 + ln * 1047 + 3600) % 86400 AS INTEGER) AS r_time,
  CAST((pk + ln) % {S.N_REASON} + 1 AS INTEGER) AS r_reason,
  CAST(pk % q + 1 AS INTEGER) AS r_qty,
  r_qty * sales_price AS r_amt,
  {rdiv('r_amt * tax', 100)} AS r_tax,
  r_amt + r_tax AS r_amt_inc_tax,
  50 + ln * 700 AS r_fee,
  {rdiv('lp * r_qty * ln', 20)} AS r_ship,
  {rdiv('r_amt * ((pk * 3) % 101)', 100)} AS r_cash,
  {rdiv('(r_amt - r_cash) * ((onum * 7) % 100 + 1)', 100)} AS r_charge,
  r_amt - r_cash - r_charge AS r_credit,
  r_tax + r_fee + r_ship AS r_loss"""

_SRC_COLS = "onum, pk, sk, ln, q, ck, sold, lp, disc, tax, n_cust"

_STORE_MONEY = [c for c in S.MONEY_COLS if c not in ("ext_ship_cost", "net_paid_inc_ship",
                                                     "net_paid_inc_ship_tax")]


def _money_list(prefix: str, cols: list[str]) -> str:
    return ",\n  ".join(f"{money(c)} AS {prefix}{c}" for c in cols)


def _ret_money(prefix: str, names: list[str]) -> str:
    src = ["r_amt", "r_tax", "r_amt_inc_tax", "r_fee", "r_ship", "r_cash", "r_charge",
           "r_credit", "r_loss"]
    return ",\n  ".join(f"{money(s)} AS {prefix}{n}" for s, n in zip(src, names))


def _channel_keys(channel: int) -> str:
    outlet = S.N_CALL_CENTER if channel == 1 else S.N_WEB_SITE
    page = S.N_CATALOG_PAGE if channel == 1 else S.N_WEB_PAGE
    sck = f"(CASE WHEN onum % 100 < {10 if channel == 1 else 7} THEN (ck * 7 + onum) % n_cust ELSE ck END)"
    if channel == 1:
        rep = (f"SELECT ok * {S.KINDS} + {S.CATALOG_REPURCHASE} AS num, "
               f"onum + {S.RULE_SHIFT[S.CATALOG_REPURCHASE]} AS onum, pk, sk, ln, q, ck, "
               f"r_date + 10 AS sold, lp, disc, tax, n_cust FROM _store_returned")
    else:
        rep = (f"SELECT ok * {S.KINDS} + {S.WEB_REPURCHASE} AS num, "
               f"onum + {S.RULE_SHIFT[S.WEB_REPURCHASE]} AS onum, pk, sk, ln, q, ck, sold + 15 AS sold, "
               f"lp, disc, tax, n_cust FROM _store_src WHERE (pk + onum) % 4 = 1")
    return f"""SELECT *, {_PRICED},
  CAST((onum * 7919 + ln * 1047) % 86400 AS INTEGER) AS k_time,
  CAST(sold + 2 + (ln * 17 + pk) % 129 AS INTEGER) AS k_ship_date,
  CAST(pk + 1 AS BIGINT) AS k_item,
  {nullk('ck + 1', 1, 'BIGINT')} AS k_bill_customer,
  {nullk(cdemo('ck'), 2)} AS k_bill_cdemo,
  {nullk(hdemo('ck'), 3)} AS k_bill_hdemo,
  {nullk('ck + 1', 4, 'BIGINT')} AS k_bill_addr,
  {nullk(sck + ' + 1', 5, 'BIGINT')} AS k_ship_customer,
  {nullk(cdemo(sck), 6)} AS k_ship_cdemo,
  {nullk(hdemo(sck), 7)} AS k_ship_hdemo,
  {nullk(sck + ' + 1', 8, 'BIGINT')} AS k_ship_addr,
  {nullk(f'sk % {outlet} + 1', 9)} AS k_outlet,
  {nullk(f'pk % {page} + 1', 10)} AS k_page,
  {nullk(f'(pk + ln) % {S.N_SHIP_MODE} + 1', 11)} AS k_ship_mode,
  {nullk(f'(pk * 7 + ln) % {S.N_WAREHOUSE} + 1', 12)} AS k_warehouse,
  {nullk(f'pk % {S.N_PROMO} + 1', 13)} AS k_promo
FROM (SELECT ok * {S.KINDS} + {S.BASE_ORDER} AS num, ok AS onum, pk, sk, ln, q, ck, sold, lp, disc, tax, n_cust FROM lines WHERE ok % 3 = {channel}
      UNION ALL {rep}) src"""


def _yn(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'Y' ELSE 'N' END"


_PCDEMO = cdemo("ck + CASE WHEN onum % 7 = 0 THEN onum % 13 + 1 ELSE 0 END")
_ADDR = "((CASE WHEN onum % 4 = 0 THEN (ck * 31 + onum) % n_cust ELSE ck END) + 1)"

# name -> (SQL body, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {}

CTES["_base_customer"] = ("SELECT * FROM customer", [])
CTES["lines"] = (f"""SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln,
  CAST(l_quantity AS INTEGER) AS q, o_custkey AS ck,
  {jd('CAST(o_orderdate AS DATE)')} AS sold,
  {rdiv('CAST(round(l_extendedprice * 100) AS BIGINT)', 525)} AS lp,
  CAST(round(l_discount * 100) AS BIGINT) AS disc,
  CAST(round(l_tax * 100) AS BIGINT) AS tax,
  (SELECT count(*) FROM _base_customer) AS n_cust
FROM (SELECT l.*, o.o_custkey, o.o_orderdate,
        row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_quantity,
                           l_extendedprice, l_suppkey, l_discount, l_tax) AS rn_
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) x
WHERE rn_ = 1""", ["_base_customer"])
CTES["_store_src"] = (f"SELECT *, ok * {S.KINDS} + {S.BASE_ORDER} AS num, ok AS onum FROM lines WHERE ok % 3 = 0", ["lines"])
CTES["_store_priced"] = (f"SELECT *, {_PRICED} FROM _store_src", ["_store_src"])
CTES["_store_returned"] = (f"SELECT *, {_RETURNED} FROM _store_priced WHERE (pk + ok) % 4 = 0",
                           ["_store_priced"])
CTES["store_sales"] = (f"""SELECT sold AS ss_sold_date_sk,
  CAST((onum * 7919 + ln * 1047) % 86400 AS INTEGER) AS ss_sold_time_sk,
  CAST(pk + 1 AS BIGINT) AS ss_item_sk,
  {nullk('ck + 1', 1, 'BIGINT')} AS ss_customer_sk,
  {nullk(_PCDEMO, 2)} AS ss_cdemo_sk,
  {nullk(hdemo('ck'), 3)} AS ss_hdemo_sk,
  {nullk(_ADDR, 4, 'BIGINT')} AS ss_addr_sk,
  {nullk(f'sk % {S.N_STORE} + 1', 5)} AS ss_store_sk,
  {nullk(f'pk % {S.N_PROMO} + 1', 6)} AS ss_promo_sk,
  num AS ss_ticket_number, q AS ss_quantity,
  {_money_list('ss_', _STORE_MONEY)}
FROM _store_priced""", ["_store_priced"])
CTES["store_returns"] = (f"""SELECT r_date AS sr_returned_date_sk, r_time AS sr_return_time_sk,
  CAST(pk + 1 AS BIGINT) AS sr_item_sk,
  {nullk('ck + 1', 1, 'BIGINT')} AS sr_customer_sk,
  {nullk(_PCDEMO, 2)} AS sr_cdemo_sk,
  {nullk(hdemo('ck'), 3)} AS sr_hdemo_sk,
  {nullk(_ADDR, 4, 'BIGINT')} AS sr_addr_sk,
  {nullk(f'sk % {S.N_STORE} + 1', 5)} AS sr_store_sk,
  r_reason AS sr_reason_sk, num AS sr_ticket_number, r_qty AS sr_return_quantity,
  {_ret_money('sr_', ['return_amt', 'return_tax', 'return_amt_inc_tax', 'fee', 'return_ship_cost',
                      'refunded_cash', 'reversed_charge', 'store_credit', 'net_loss'])}
FROM _store_returned""", ["_store_returned"])
CTES["_cat_keys"] = (_channel_keys(1), ["lines", "_store_returned"])
CTES["_web_keys"] = (_channel_keys(2), ["lines", "_store_src"])


def _sales_select(p: str, keys: str) -> str:
    if p == "cs":
        mid = """k_outlet AS cs_call_center_sk, k_page AS cs_catalog_page_sk,
  k_ship_mode AS cs_ship_mode_sk, k_warehouse AS cs_warehouse_sk, k_item AS cs_item_sk,
  k_promo AS cs_promo_sk"""
    else:
        mid = """k_page AS ws_web_page_sk, k_outlet AS ws_web_site_sk,
  k_ship_mode AS ws_ship_mode_sk, k_warehouse AS ws_warehouse_sk, k_promo AS ws_promo_sk"""
    item_first = "" if p == "cs" else f"k_item AS {p}_item_sk,\n  "
    return f"""SELECT sold AS {p}_sold_date_sk, k_time AS {p}_sold_time_sk,
  k_ship_date AS {p}_ship_date_sk, {item_first}k_bill_customer AS {p}_bill_customer_sk,
  k_bill_cdemo AS {p}_bill_cdemo_sk, k_bill_hdemo AS {p}_bill_hdemo_sk,
  k_bill_addr AS {p}_bill_addr_sk, k_ship_customer AS {p}_ship_customer_sk,
  k_ship_cdemo AS {p}_ship_cdemo_sk, k_ship_hdemo AS {p}_ship_hdemo_sk,
  k_ship_addr AS {p}_ship_addr_sk, {mid},
  num AS {p}_order_number, q AS {p}_quantity,
  {_money_list(p + '_', S.MONEY_COLS)}
FROM {keys}"""


CTES["catalog_sales"] = (_sales_select("cs", "_cat_keys"), ["_cat_keys"])
CTES["web_sales"] = (_sales_select("ws", "_web_keys"), ["_web_keys"])
CTES["catalog_returns"] = (f"""SELECT r_date AS cr_returned_date_sk, r_time AS cr_returned_time_sk,
  k_item AS cr_item_sk, k_bill_customer AS cr_refunded_customer_sk,
  k_bill_cdemo AS cr_refunded_cdemo_sk, k_bill_hdemo AS cr_refunded_hdemo_sk,
  k_bill_addr AS cr_refunded_addr_sk, k_ship_customer AS cr_returning_customer_sk,
  k_ship_cdemo AS cr_returning_cdemo_sk, k_ship_hdemo AS cr_returning_hdemo_sk,
  k_ship_addr AS cr_returning_addr_sk, k_outlet AS cr_call_center_sk,
  k_page AS cr_catalog_page_sk, k_ship_mode AS cr_ship_mode_sk, k_warehouse AS cr_warehouse_sk,
  r_reason AS cr_reason_sk, num AS cr_order_number, r_qty AS cr_return_quantity,
  {_ret_money('cr_', ['return_amount', 'return_tax', 'return_amt_inc_tax', 'fee', 'return_ship_cost',
                      'refunded_cash', 'reversed_charge', 'store_credit', 'net_loss'])}
FROM (SELECT *, {_RETURNED} FROM _cat_keys WHERE (pk + onum + ln) % 4 = 0) r""", ["_cat_keys"])
CTES["web_returns"] = (f"""SELECT r_date AS wr_returned_date_sk, r_time AS wr_returned_time_sk,
  k_item AS wr_item_sk, k_bill_customer AS wr_refunded_customer_sk,
  k_bill_cdemo AS wr_refunded_cdemo_sk, k_bill_hdemo AS wr_refunded_hdemo_sk,
  k_bill_addr AS wr_refunded_addr_sk, k_ship_customer AS wr_returning_customer_sk,
  k_ship_cdemo AS wr_returning_cdemo_sk, k_ship_hdemo AS wr_returning_hdemo_sk,
  k_ship_addr AS wr_returning_addr_sk, k_page AS wr_web_page_sk,
  r_reason AS wr_reason_sk, num AS wr_order_number, r_qty AS wr_return_quantity,
  {_ret_money('wr_', ['return_amt', 'return_tax', 'return_amt_inc_tax', 'fee', 'return_ship_cost',
                      'refunded_cash', 'reversed_charge', 'account_credit', 'net_loss'])}
FROM (SELECT *, {_RETURNED} FROM _web_keys WHERE (pk + onum + ln) % 4 = 0) r""", ["_web_keys"])
CTES["inventory"] = (f"""SELECT CAST({S.JD_1998} + (i // {S.N_WAREHOUSE}) * 7 AS INTEGER) AS inv_date_sk,
  CAST(p_partkey + CASE WHEN p_partkey % 6 = 4 AND {S.JD_1998} + (i // {S.N_WAREHOUSE}) * 7 >= {S.JD_2000}
                         AND p_partkey + 1 < n_parts THEN 2 ELSE 1 END AS BIGINT) AS inv_item_sk,
  CAST(i % {S.N_WAREHOUSE} + 1 AS INTEGER) AS inv_warehouse_sk,
  CAST((p_partkey * 37 + (i % {S.N_WAREHOUSE} + 1) * 101 + (i // {S.N_WAREHOUSE}) * 53) % 1000 AS INTEGER)
    AS inv_quantity_on_hand
FROM part, (SELECT count(*) AS n_parts FROM part) np, range(0, {S.N_WAREHOUSE * S.INV_WEEKS}) g(i)
WHERE p_partkey % 6 <> 5""", [])
_D1900 = "date_diff('day', DATE '1900-01-01', d)"
CTES["date_dim"] = (f"""SELECT {jd('d')} AS d_date_sk, 'D' || CAST({jd('d')} AS VARCHAR) AS d_date_id,
  d AS d_date,
  CAST((year(d) - 1900) * 12 + month(d) - 1 AS INTEGER) AS d_month_seq,
  CAST({_D1900} // 7 + 1 AS INTEGER) AS d_week_seq,
  CAST((year(d) - 1900) * 4 + (month(d) - 1) // 3 + 1 AS INTEGER) AS d_quarter_seq,
  year(d) AS d_year, CAST(({_D1900} + 1) % 7 AS INTEGER) AS d_dow, month(d) AS d_moy,
  day(d) AS d_dom, CAST((month(d) - 1) // 3 + 1 AS INTEGER) AS d_qoy, year(d) AS d_fy_year,
  CAST((year(d) - 1900) * 4 + (month(d) - 1) // 3 + 1 AS INTEGER) AS d_fy_quarter_seq,
  CAST({_D1900} // 7 + 1 AS INTEGER) AS d_fy_week_seq,
  {pick(S.DAY_NAMES, f'({_D1900} + 1) % 7')} AS d_day_name,
  CAST(year(d) AS VARCHAR) || 'Q' || CAST((month(d) - 1) // 3 + 1 AS VARCHAR) AS d_quarter_name,
  {_yn("(month(d) = 12 AND day(d) = 25) OR (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4)")} AS d_holiday,
  {_yn(f"({_D1900} + 1) % 7 IN (0, 6)")} AS d_weekend,
  {_yn("(month(d) = 12 AND day(d) = 26) OR (month(d) = 1 AND day(d) = 2) OR (month(d) = 7 AND day(d) = 5)")} AS d_following_holiday,
  CAST({jd('d')} - day(d) + 1 AS INTEGER) AS d_first_dom,
  {jd('last_day(d)')} AS d_last_dom,
  CAST({jd('d')} - 365 AS INTEGER) AS d_same_day_ly,
  CAST({jd('d')} - 91 AS INTEGER) AS d_same_day_lq,
  'N' AS d_current_day, 'N' AS d_current_week, 'N' AS d_current_month,
  'N' AS d_current_quarter, 'N' AS d_current_year
FROM (SELECT CAST(unnest(generate_series(
        make_date(least(lo - {S.YEARS_BEFORE}, {S.YEAR_LO}), 1, 1),
        make_date(greatest(hi + {S.YEARS_AFTER}, {S.YEAR_HI}), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT year(min(CAST(o_orderdate AS DATE))) AS lo, year(max(CAST(o_orderdate AS DATE))) AS hi FROM orders) span) x""", [])
CTES["time_dim"] = (f"""SELECT CAST(s AS INTEGER) AS t_time_sk, {pad('T', 's', 8)} AS t_time_id,
  CAST(s AS INTEGER) AS t_time, CAST(s // 3600 AS INTEGER) AS t_hour,
  CAST((s // 60) % 60 AS INTEGER) AS t_minute, CAST(s % 60 AS INTEGER) AS t_second,
  CASE WHEN s // 3600 < 12 THEN 'AM' ELSE 'PM' END AS t_am_pm,
  CASE WHEN s // 3600 < 8 THEN 'third' WHEN s // 3600 < 16 THEN 'first' ELSE 'second' END AS t_shift,
  CASE WHEN s // 3600 < 6 THEN 'night' WHEN s // 3600 < 12 THEN 'morning'
       WHEN s // 3600 < 18 THEN 'afternoon' ELSE 'evening' END AS t_sub_shift,
  CASE WHEN s // 3600 >= 6 AND s // 3600 < 9 THEN 'breakfast'
       WHEN s // 3600 >= 11 AND s // 3600 < 14 THEN 'lunch'
       WHEN s // 3600 >= 17 AND s // 3600 < 20 THEN 'dinner' END AS t_meal_time
FROM range(0, 86400) g(s)""", [])
CTES["item"] = (f"""SELECT CAST(p_partkey + 1 AS BIGINT) AS i_item_sk,
  {pad('ITEM', 'CASE WHEN p_partkey % 6 = 5 THEN p_partkey - 1 ELSE p_partkey END', 8)} AS i_item_id,
  CASE WHEN p_partkey % 6 = 5 THEN DATE '2000-01-01' ELSE DATE '1997-10-27' END AS i_rec_start_date,
  CASE WHEN p_partkey % 6 = 4 THEN DATE '1999-12-31' END AS i_rec_end_date,
  'The ' || p_name || ' by ' || p_brand AS i_item_desc,
  {money('(CAST(round(p_retailprice * 100) AS BIGINT) - 89000)')} AS i_current_price,
  {money(rdiv('(CAST(round(p_retailprice * 100) AS BIGINT) - 89000) * 6', 10))} AS i_wholesale_cost,
  CAST(substr(p_brand, 7, 4) AS INTEGER) AS i_brand_id, p_brand AS i_brand,
  CAST(list_position({_lst(S.CLASSES)}, p_type) AS INTEGER) AS i_class_id, lower(p_type) AS i_class,
  CAST(list_position({_lst(S.CATEGORIES)}, split_part(p_name, ' ', 2)) AS INTEGER) AS i_category_id,
  split_part(p_name, ' ', 2) AS i_category,
  CAST(p_partkey % 100 + 1 AS INTEGER) AS i_manufact_id,
  'manufact#' || CAST(p_partkey % 100 + 1 AS VARCHAR) AS i_manufact,
  {pick(S.SIZES, 'p_size % 7')} AS i_size,
  lower(p_type) || '-' || CAST(p_size AS VARCHAR) AS i_formulation,
  split_part(p_name, ' ', 1) AS i_color,
  {pick(S.UNITS, 'p_partkey % 8')} AS i_units, 'Unknown' AS i_container,
  CAST(p_partkey % 50 + 1 AS INTEGER) AS i_manager_id,
  p_name || ' ' || CAST(p_partkey AS VARCHAR) AS i_product_name
FROM part""", [])
CTES["store"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS s_store_sk, {pad('STORE', 'k', 8)} AS s_store_id,
  DATE '1997-03-13' AS s_rec_start_date, CAST(NULL AS DATE) AS s_rec_end_date,
  CAST(NULL AS INTEGER) AS s_closed_date_sk,
  {pick(S.STORE_NAMES, 'k % 6')} AS s_store_name,
  CAST(200 + (k * 37) % 100 AS INTEGER) AS s_number_employees,
  CAST(5000000 + k * 10007 AS INTEGER) AS s_floor_space,
  {pick(['8AM-4PM', '8AM-8PM', '8AM-12AM'], 'k % 3')} AS s_hours,
  'Manager ' || CAST(k AS VARCHAR) AS s_manager,
  CAST(k % 10 + 1 AS INTEGER) AS s_market_id, 'Unknown' AS s_geography_class,
  'Market of ' || 'NATION_' || CAST((k * 2) % 25 AS VARCHAR) AS s_market_desc,
  'Market manager ' || CAST(k AS VARCHAR) AS s_market_manager,
  1 AS s_division_id, 'Unknown' AS s_division_name, 1 AS s_company_id, 'Unknown' AS s_company_name,
  CAST(100 + k * 7 AS VARCHAR) AS s_street_number,
  {pick(S.STREETS, 'k % 8')} AS s_street_name,
  {pick(S.STREET_TYPES, 'k % 5')} AS s_street_type,
  'Suite ' || CAST(k * 10 AS VARCHAR) AS s_suite_number,
  {pick(S.CITIES, '((k * 2) % 25) % 10')} AS s_city, 'NATION_' || CAST((k * 2) % 25 AS VARCHAR) || ' County' AS s_county,
  {pick(S.STATES, '((k * 2) % 25)')} AS s_state, CAST(10000 + ((k * 2) % 25) * 100 AS VARCHAR) AS s_zip,
  'United States' AS s_country, CAST(-(5 + ((k * 2) % 25) % 4) AS DECIMAL(5,2)) AS s_gmt_offset,
  {money('k % 12', 5)} AS s_tax_precentage
FROM range(0, {S.N_STORE}) g(k)""", [])
_FIRST = pick(S.FIRST_NAMES, "c_custkey % 20")
_LAST = pick(S.LAST_NAMES, "(c_custkey * 7 + c_custkey // 20) % 20")
CTES["customer_address"] = (f"""SELECT CAST(c_custkey + 1 AS BIGINT) AS ca_address_sk,
  {pad('ADDR', 'c_custkey')} AS ca_address_id,
  CAST(c_custkey % 1000 + 1 AS VARCHAR) AS ca_street_number,
  {pick(S.STREETS, 'c_custkey % 8')} AS ca_street_name,
  {pick(S.STREET_TYPES, 'c_custkey % 5')} AS ca_street_type,
  'Suite ' || CAST(c_custkey % 100 AS VARCHAR) AS ca_suite_number,
  {pick(S.CITIES, '(c_custkey + n_nationkey) % 10')} AS ca_city,
  n_name || ' County' AS ca_county, {pick(S.STATES, 'n_nationkey')} AS ca_state,
  CAST(10000 + n_nationkey * 100 + c_custkey % 3 AS VARCHAR) AS ca_zip,
  'United States' AS ca_country, CAST(-(5 + n_nationkey % 4) AS DECIMAL(5,2)) AS ca_gmt_offset,
  {pick(S.LOCATION_TYPES, 'c_custkey % 3')} AS ca_location_type
FROM _base_customer JOIN nation ON c_nationkey = n_nationkey""", ["_base_customer"])
CTES["customer"] = (f"""SELECT CAST(c_custkey + 1 AS BIGINT) AS c_customer_sk,
  {pad('CUST', 'c_custkey')} AS c_customer_id,
  CAST({cdemo('c_custkey')} AS INTEGER) AS c_current_cdemo_sk,
  CAST({hdemo('c_custkey')} AS INTEGER) AS c_current_hdemo_sk,
  CAST(c_custkey + 1 AS BIGINT) AS c_current_addr_sk,
  CAST({S.JD_1998} - 1000 + (c_custkey * 11) % 1500 AS INTEGER) AS c_first_shipto_date_sk,
  CAST({S.JD_1998} - 1030 + (c_custkey * 11) % 1500 AS INTEGER) AS c_first_sales_date_sk,
  {pick(S.SALUTATIONS, 'c_custkey % 4')} AS c_salutation,
  {_FIRST} AS c_first_name, {_LAST} AS c_last_name,
  CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
  CAST(c_custkey % 28 + 1 AS INTEGER) AS c_birth_day,
  CAST(c_custkey % 12 + 1 AS INTEGER) AS c_birth_month,
  CAST(1930 + c_custkey % 63 AS INTEGER) AS c_birth_year,
  r_name AS c_birth_country, CAST(NULL AS VARCHAR) AS c_login,
  lower({_FIRST}) || '.' || lower({_LAST}) || '@' || lower(c_mktsegment) || '.com' AS c_email_address,
  CAST({S.JD_1998} + 1000 + c_custkey % 700 AS VARCHAR) AS c_last_review_date
FROM _base_customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
                    ["_base_customer"])
CTES["customer_demographics"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS cd_demo_sk,
  {pick(S.GENDERS, 'k % 2')} AS cd_gender,
  {pick(S.MARITAL, '(k // 2) % 5')} AS cd_marital_status,
  {pick(S.EDUCATION, '(k // 10) % 7')} AS cd_education_status,
  CAST(500 * ((k // 70) % 20 + 1) AS INTEGER) AS cd_purchase_estimate,
  {pick(S.CREDIT, '(k // 1400) % 4')} AS cd_credit_rating,
  CAST((k // 5600) % 7 AS INTEGER) AS cd_dep_count, CAST((k // 39200) % 7 AS INTEGER) AS cd_dep_employed_count,
  CAST((k // 274400) % 7 AS INTEGER) AS cd_dep_college_count
FROM range(0, {S.N_CDEMO}) g(k)""", [])
CTES["household_demographics"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS hd_demo_sk,
  CAST(k % {S.N_INCOME} + 1 AS INTEGER) AS hd_income_band_sk,
  {pick(S.BUY_POTENTIAL, f'(k // 20) % {S.N_BUY}')} AS hd_buy_potential,
  CAST((k // 120) % {S.N_DEP} AS INTEGER) AS hd_dep_count, CAST((k // 1200) % {S.N_VEHICLE} - 1 AS INTEGER) AS hd_vehicle_count
FROM range(0, {S.N_HDEMO}) g(k)""", [])
CTES["income_band"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS ib_income_band_sk,
  CAST(k * 10000 + CASE WHEN k > 0 THEN 1 ELSE 0 END AS INTEGER) AS ib_lower_bound,
  CAST((k + 1) * 10000 AS INTEGER) AS ib_upper_bound
FROM range(0, {S.N_INCOME}) g(k)""", [])


def _ynm(m: int) -> str:
    return f"CASE WHEN k % {m} = 0 THEN 'Y' ELSE 'N' END"


CTES["promotion"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS p_promo_sk, {pad('PROMO', 'k', 8)} AS p_promo_id,
  CAST({S.JD_1998} + k * 30 AS INTEGER) AS p_start_date_sk,
  CAST({S.JD_1998} + k * 30 + 60 AS INTEGER) AS p_end_date_sk,
  CAST(k * 7 + 1 AS INTEGER) AS p_item_sk, CAST(1000 AS DECIMAL(15,2)) AS p_cost,
  1 AS p_response_target, {pick(S.PROMO_NAMES, 'k % 10')} AS p_promo_name,
  {_ynm(2)} AS p_channel_dmail, {_ynm(3)} AS p_channel_email, {_ynm(4)} AS p_channel_catalog,
  {_ynm(4)} AS p_channel_tv, {_ynm(5)} AS p_channel_radio, {_ynm(6)} AS p_channel_press,
  {_ynm(5)} AS p_channel_event, {_ynm(7)} AS p_channel_demo,
  'Promotion ' || CAST(k AS VARCHAR) AS p_channel_details, 'Unknown' AS p_purpose,
  {_ynm(2)} AS p_discount_active
FROM range(0, {S.N_PROMO}) g(k)""", [])
CTES["warehouse"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS w_warehouse_sk, {pad('WH', 'k', 8)} AS w_warehouse_id,
  {pick(S.WAREHOUSES, 'k')} AS w_warehouse_name,
  CAST(100000 + k * 25000 AS INTEGER) AS w_warehouse_sq_ft,
  CAST(k * 11 + 1 AS VARCHAR) AS w_street_number, {pick(S.STREETS, 'k')} AS w_street_name,
  {pick(S.STREET_TYPES, 'k')} AS w_street_type, 'Suite ' || CAST(k AS VARCHAR) AS w_suite_number,
  {pick(S.CITIES, 'k')} AS w_city, 'NATION_' || CAST(k * 5 AS VARCHAR) || ' County' AS w_county,
  {pick(S.STATES, 'k * 5')} AS w_state, CAST(10000 + k * 500 AS VARCHAR) AS w_zip,
  'United States' AS w_country, CAST(-(5 + (k * 5) % 4) AS DECIMAL(5,2)) AS w_gmt_offset
FROM range(0, {S.N_WAREHOUSE}) g(k)""", [])
CTES["ship_mode"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS sm_ship_mode_sk, {pad('SM', 'k', 8)} AS sm_ship_mode_id,
  {pick(S.SHIP_TYPES, 'k % 6')} AS sm_type, {pick(S.SHIP_CODES, '(k // 6) % 3')} AS sm_code,
  {pick(S.CARRIERS, 'k')} AS sm_carrier, 'contract-' || CAST(k AS VARCHAR) AS sm_contract
FROM range(0, {S.N_SHIP_MODE}) g(k)""", [])
CTES["reason"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS r_reason_sk, {pad('R', 'k', 8)} AS r_reason_id,
  'reason ' || CAST(k + 1 AS VARCHAR) AS r_reason_desc
FROM range(0, {S.N_REASON}) g(k)""", [])
CTES["call_center"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS cc_call_center_sk, {pad('CC', 'k', 8)} AS cc_call_center_id,
  DATE '1998-01-01' AS cc_rec_start_date, CAST(NULL AS DATE) AS cc_rec_end_date,
  CAST(NULL AS INTEGER) AS cc_closed_date_sk, CAST({S.JD_1998} - 500 + k * 10 AS INTEGER) AS cc_open_date_sk,
  {pick(S.CALL_CENTERS, 'k')} AS cc_name, {pick(['small', 'medium', 'large'], 'k % 3')} AS cc_class,
  CAST(100 + k * 50 AS INTEGER) AS cc_employees, CAST(10000 + k * 2500 AS INTEGER) AS cc_sq_ft,
  {pick(['8AM-4PM', '8AM-8PM', '8AM-12AM'], 'k % 3')} AS cc_hours,
  'Manager ' || CAST(k AS VARCHAR) AS cc_manager, CAST(k % 3 + 1 AS INTEGER) AS cc_mkt_id,
  'Unknown' AS cc_mkt_class, 'Unknown' AS cc_mkt_desc,
  'Market manager ' || CAST(k AS VARCHAR) AS cc_market_manager,
  CAST(k % 2 + 1 AS INTEGER) AS cc_division, 'Unknown' AS cc_division_name,
  CAST(k % 2 + 1 AS INTEGER) AS cc_company, 'Unknown' AS cc_company_name,
  CAST(k * 13 + 1 AS VARCHAR) AS cc_street_number, {pick(S.STREETS, 'k')} AS cc_street_name,
  {pick(S.STREET_TYPES, 'k % 5')} AS cc_street_type, 'Suite ' || CAST(k AS VARCHAR) AS cc_suite_number,
  {pick(S.CITIES, 'k')} AS cc_city, 'NATION_' || CAST(k * 4 AS VARCHAR) || ' County' AS cc_county,
  {pick(S.STATES, 'k * 4')} AS cc_state, CAST(10000 + k * 400 AS VARCHAR) AS cc_zip,
  'United States' AS cc_country, CAST(-(5 + (k * 4) % 4) AS DECIMAL(5,2)) AS cc_gmt_offset,
  {money('k % 12', 5)} AS cc_tax_percentage
FROM range(0, {S.N_CALL_CENTER}) g(k)""", [])
CTES["catalog_page"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS cp_catalog_page_sk, {pad('CP', 'k', 8)} AS cp_catalog_page_id,
  CAST({S.JD_1998} + (k // 10) * 91 AS INTEGER) AS cp_start_date_sk,
  CAST({S.JD_1998} + (k // 10) * 91 + 90 AS INTEGER) AS cp_end_date_sk,
  'DEPARTMENT' AS cp_department, CAST(k // 10 + 1 AS INTEGER) AS cp_catalog_number,
  CAST(k % 10 + 1 AS INTEGER) AS cp_catalog_page_number,
  'Catalog page ' || CAST(k AS VARCHAR) AS cp_description,
  {pick(['bi-annual', 'quarterly', 'monthly'], 'k % 3')} AS cp_type
FROM range(0, {S.N_CATALOG_PAGE}) g(k)""", [])
CTES["web_site"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS web_site_sk, {pad('SITE', 'k', 8)} AS web_site_id,
  DATE '1997-08-16' AS web_rec_start_date, CAST(NULL AS DATE) AS web_rec_end_date,
  'site_' || CAST(k AS VARCHAR) AS web_name, CAST({S.JD_1998} - 700 + k AS INTEGER) AS web_open_date_sk,
  CAST(NULL AS INTEGER) AS web_close_date_sk, 'Unknown' AS web_class,
  'Manager ' || CAST(k AS VARCHAR) AS web_manager, CAST(k % 6 + 1 AS INTEGER) AS web_mkt_id,
  'Unknown' AS web_mkt_class, 'Unknown' AS web_mkt_desc,
  'Market manager ' || CAST(k AS VARCHAR) AS web_market_manager,
  CAST(k % 6 + 1 AS INTEGER) AS web_company_id, {pick(S.SITE_COMPANIES, 'k % 6')} AS web_company_name,
  CAST(k * 17 + 1 AS VARCHAR) AS web_street_number, {pick(S.STREETS, 'k % 8')} AS web_street_name,
  {pick(S.STREET_TYPES, 'k % 5')} AS web_street_type, 'Suite ' || CAST(k AS VARCHAR) AS web_suite_number,
  {pick(S.CITIES, 'k % 10')} AS web_city,
  'NATION_' || CAST((k * 3) % 25 AS VARCHAR) || ' County' AS web_county,
  {pick(S.STATES, '(k * 3) % 25')} AS web_state, CAST(10000 + ((k * 3) % 25) * 100 AS VARCHAR) AS web_zip,
  'United States' AS web_country, CAST(-(5 + ((k * 3) % 25) % 4) AS DECIMAL(5,2)) AS web_gmt_offset,
  {money('k % 12', 5)} AS web_tax_percentage
FROM range(0, {S.N_WEB_SITE}) g(k)""", [])
CTES["web_page"] = (f"""SELECT CAST(k + 1 AS INTEGER) AS wp_web_page_sk, {pad('WP', 'k', 8)} AS wp_web_page_id,
  DATE '1997-09-03' AS wp_rec_start_date, CAST(NULL AS DATE) AS wp_rec_end_date,
  CAST({S.JD_1998} - 300 + k AS INTEGER) AS wp_creation_date_sk,
  CAST({S.JD_1998} + 1000 + k AS INTEGER) AS wp_access_date_sk,
  CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS wp_autogen_flag,
  CASE WHEN k % 3 = 0 THEN CAST(k * 17 + 1 AS INTEGER) END AS wp_customer_sk,
  'http://www.example.com' AS wp_url, {pick(S.WEB_PAGE_TYPES, 'k % 7')} AS wp_type,
  CAST(1000 + (k * 97) % 7000 AS INTEGER) AS wp_char_count,
  CAST(2 + k % 24 AS INTEGER) AS wp_link_count, CAST(1 + k % 7 AS INTEGER) AS wp_image_count,
  CAST(k % 5 AS INTEGER) AS wp_max_ad_count
FROM range(0, {S.N_WEB_PAGE}) g(k)""", [])

# Emission order: helpers that read base tables first, then anything that
# redefines a driver table name (``customer``) last.
_ORDER = ["_base_customer", "lines", "_store_src", "_store_priced", "_store_returned",
          "_cat_keys", "_web_keys"] + [t for t in S.TABLES if t != "customer"] + ["customer"]


def with_star(tables: list[str] | tuple[str, ...]) -> str:
    """``WITH`` clause defining the given star tables and their helpers."""
    need: set[str] = set()

    def add(name: str) -> None:
        if name in need:
            return
        need.add(name)
        for dep in CTES[name][1]:
            add(dep)

    for t in tables:
        add(t)
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in _ORDER if n in need]
    return "WITH " + ",\n".join(parts) + "\n"


def star_query(tables: list[str] | tuple[str, ...], body: str) -> str:
    head = with_star(tables)
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        return head.rstrip() + ",\n" + stripped[4:].lstrip()
    return head + body
