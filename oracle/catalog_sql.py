"""Oracle SQL (DuckDB) for the query catalogue: key -> (star tables, body)."""

from __future__ import annotations

SQL: dict[str, tuple[list[str], str]] = {}


def q(key: str, tables: str, body: str) -> None:
    SQL[key] = (tables.split(), body)


q("q03", "date_dim store_sales item", """
SELECT d_year, i_brand_id AS brand_id, i_brand AS brand,
       CAST(sum(ss_ext_sales_price) AS DOUBLE) AS sum_agg
FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
     JOIN item ON ss_item_sk = i_item_sk
WHERE i_manufact_id = 28 AND d_moy = 11
GROUP BY d_year, i_brand, i_brand_id
ORDER BY d_year, sum_agg DESC, brand_id, brand
LIMIT 100""")


def _demo_promo(fact, p, cdemo, promo):
    return f"""
SELECT i_item_id,
       CAST(sum({p}_quantity) AS DOUBLE) / count({p}_quantity) AS agg1,
       CAST(sum({p}_list_price) AS DOUBLE) / count({p}_list_price) AS agg2,
       CAST(sum({p}_coupon_amt) AS DOUBLE) / count({p}_coupon_amt) AS agg3,
       CAST(sum({p}_sales_price) AS DOUBLE) / count({p}_sales_price) AS agg4
FROM {fact}, customer_demographics, date_dim, item, promotion
WHERE {p}_sold_date_sk = d_date_sk AND {p}_item_sk = i_item_sk AND {cdemo} = cd_demo_sk
  AND {promo} = p_promo_sk AND cd_gender = 'M' AND cd_marital_status = 'S'
  AND cd_education_status = 'College' AND (p_channel_email = 'N' OR p_channel_event = 'N')
  AND d_year = 2000
GROUP BY i_item_id ORDER BY i_item_id LIMIT 100"""


q("q07", "store_sales customer_demographics date_dim item promotion",
  _demo_promo("store_sales", "ss", "ss_cdemo_sk", "ss_promo_sk"))
q("q26", "catalog_sales customer_demographics date_dim item promotion",
  _demo_promo("catalog_sales", "cs", "cs_bill_cdemo_sk", "cs_promo_sk"))

q("q19", "date_dim store_sales item customer customer_address store", """
SELECT i_brand_id AS brand_id, i_brand AS brand, i_manufact_id, i_manufact,
       CAST(sum(ss_ext_sales_price) AS DOUBLE) AS ext_price
FROM date_dim, store_sales, item, customer, customer_address, store
WHERE d_date_sk = ss_sold_date_sk AND ss_item_sk = i_item_sk AND i_manager_id = 8
  AND d_moy = 11 AND d_year = 1998 AND ss_customer_sk = c_customer_sk
  AND c_current_addr_sk = ca_address_sk AND substr(ca_zip, 1, 5) <> substr(s_zip, 1, 5)
  AND ss_store_sk = s_store_sk
GROUP BY i_brand, i_brand_id, i_manufact_id, i_manufact
ORDER BY ext_price DESC, brand, brand_id, i_manufact_id, i_manufact LIMIT 100""")

q("q42", "date_dim store_sales item", """
SELECT d_year, i_category_id, i_category, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS sum_sales
FROM date_dim, store_sales, item
WHERE d_date_sk = ss_sold_date_sk AND ss_item_sk = i_item_sk AND i_manager_id = 1
  AND d_moy = 11 AND d_year = 2000
GROUP BY d_year, i_category_id, i_category
ORDER BY sum_sales DESC, d_year, i_category_id, i_category LIMIT 100""")

q("q52", "date_dim store_sales item", """
SELECT d_year, i_brand_id AS brand_id, i_brand AS brand, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS ext_price
FROM date_dim, store_sales, item
WHERE d_date_sk = ss_sold_date_sk AND ss_item_sk = i_item_sk AND i_manager_id = 1
  AND d_moy = 11 AND d_year = 2000
GROUP BY d_year, i_brand, i_brand_id
ORDER BY d_year, ext_price DESC, brand_id, brand LIMIT 100""")

q("q55", "date_dim store_sales item", """
SELECT i_brand_id AS brand_id, i_brand AS brand, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS ext_price
FROM date_dim, store_sales, item
WHERE d_date_sk = ss_sold_date_sk AND ss_item_sk = i_item_sk AND i_manager_id = 28
  AND d_moy = 11 AND d_year = 1999
GROUP BY i_brand, i_brand_id
ORDER BY ext_price DESC, brand_id, brand LIMIT 100""")

_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_DCOLS = ["sun_sales", "mon_sales", "tue_sales", "wed_sales", "thu_sales", "fri_sales", "sat_sales"]
q("q43", "date_dim store_sales store", f"""
SELECT s_store_name, s_store_id,
  {", ".join(f"CAST(sum(CASE WHEN d_day_name = '{d}' THEN ss_sales_price END) AS DOUBLE) AS {c}" for d, c in zip(_DAYS, _DCOLS))}
FROM date_dim, store_sales, store
WHERE d_date_sk = ss_sold_date_sk AND s_store_sk = ss_store_sk AND s_gmt_offset = -5 AND d_year = 2000
GROUP BY s_store_name, s_store_id
ORDER BY s_store_name, s_store_id, {", ".join(_DCOLS)} LIMIT 100""")

q("q96", "store_sales household_demographics time_dim store", """
SELECT count(*) AS cnt
FROM store_sales, household_demographics, time_dim, store
WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
  AND t_hour = 20 AND t_minute >= 30 AND hd_dep_count = 7 AND s_store_name = 'meadow'""")

q("q15", "catalog_sales customer customer_address date_dim", """
SELECT ca_zip, CAST(sum(cs_sales_price) AS DOUBLE) AS sum_sales
FROM catalog_sales, customer, customer_address, date_dim
WHERE cs_bill_customer_sk = c_customer_sk AND c_current_addr_sk = ca_address_sk
  AND (substr(ca_zip, 1, 5) IN ('10500', '10801', '11202', '11600', '12001')
       OR ca_state IN ('CA', 'GA', 'IL') OR cs_sales_price > 150)
  AND cs_sold_date_sk = d_date_sk AND d_qoy = 2 AND d_year = 2001
GROUP BY ca_zip ORDER BY ca_zip LIMIT 100""")


def _inv_items(fact, item_col, lo, start):
    return f"""
SELECT i_item_id, i_item_desc, CAST(i_current_price AS DOUBLE) AS i_current_price
FROM item, inventory, date_dim, {fact}
WHERE i_current_price BETWEEN {lo} AND {lo} + 30 AND inv_item_sk = i_item_sk
  AND d_date_sk = inv_date_sk AND d_date BETWEEN DATE '{start}' AND DATE '{start}' + 60
  AND i_manufact_id IN (1, 5, 9, 13, 17, 21, 25, 29, 33, 37)
  AND inv_quantity_on_hand BETWEEN 100 AND 500 AND {item_col} = i_item_sk
GROUP BY i_item_id, i_item_desc, i_current_price
ORDER BY i_item_id, i_item_desc, i_current_price LIMIT 100"""


q("q37", "item inventory date_dim catalog_sales", _inv_items("catalog_sales", "cs_item_sk", 20, "2000-02-01"))
q("q82", "item inventory date_dim store_sales", _inv_items("store_sales", "ss_item_sk", 50, "2000-05-25"))


def _class_share(fact, p, limit):
    lim = f" LIMIT {limit}" if limit else ""
    return f"""
SELECT i_item_id, i_item_desc, i_category, i_class, CAST(i_current_price AS DOUBLE) AS i_current_price,
       CAST(sum({p}_ext_sales_price) AS DOUBLE) AS itemrevenue,
       CAST(sum({p}_ext_sales_price) AS DOUBLE) * 100
         / sum(CAST(sum({p}_ext_sales_price) AS DOUBLE)) OVER (PARTITION BY i_class) AS revenueratio
FROM {fact}, item, date_dim
WHERE {p}_item_sk = i_item_sk AND i_category IN ('ring', 'bolt', 'gear') AND {p}_sold_date_sk = d_date_sk
  AND d_date BETWEEN DATE '1999-02-22' AND DATE '1999-02-22' + 30
GROUP BY i_item_id, i_item_desc, i_category, i_class, i_current_price
ORDER BY i_category, i_class, i_item_id, i_item_desc, revenueratio{lim}"""


q("q12", "web_sales item date_dim", _class_share("web_sales", "ws", 100))
q("q20", "catalog_sales item date_dim", _class_share("catalog_sales", "cs", 100))
q("q98", "store_sales item date_dim", _class_share("store_sales", "ss", None))

q("q45", "web_sales customer customer_address date_dim item", """
SELECT ca_zip, ca_city, CAST(sum(ws_sales_price) AS DOUBLE) AS sum_sales
FROM web_sales, customer, customer_address, date_dim, item
WHERE ws_bill_customer_sk = c_customer_sk AND c_current_addr_sk = ca_address_sk
  AND ws_item_sk = i_item_sk
  AND (substr(ca_zip, 1, 5) IN ('10500', '10801', '11202', '11600', '12001')
       OR i_item_id IN (SELECT i_item_id FROM item WHERE i_item_sk IN (2, 3, 5, 7, 11, 13, 17, 19, 23, 29)))
  AND ws_sold_date_sk = d_date_sk AND d_qoy = 2 AND d_year = 2001
GROUP BY ca_zip, ca_city ORDER BY ca_zip, ca_city LIMIT 100""")

q("q91", "call_center catalog_returns date_dim customer customer_address customer_demographics household_demographics", """
SELECT cc_call_center_id AS call_center, cc_name AS call_center_name, cc_manager AS manager,
       CAST(sum(cr_net_loss) AS DOUBLE) AS returns_loss
FROM call_center, catalog_returns, date_dim, customer, customer_address,
     customer_demographics, household_demographics
WHERE cr_call_center_sk = cc_call_center_sk AND cr_returned_date_sk = d_date_sk
  AND cr_returning_customer_sk = c_customer_sk AND cd_demo_sk = c_current_cdemo_sk
  AND hd_demo_sk = c_current_hdemo_sk AND ca_address_sk = c_current_addr_sk
  AND d_year = 1999 AND d_moy IN (9, 10, 11)
  AND ((cd_marital_status = 'M' AND cd_education_status = 'Unknown')
       OR (cd_marital_status = 'W' AND cd_education_status = 'Advanced Degree'))
  AND hd_buy_potential LIKE 'Unknown%' AND ca_gmt_offset = -7
GROUP BY cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status
ORDER BY returns_loss DESC""")

q("q01", "store_returns date_dim store customer", """
WITH ctr AS (
  SELECT sr_customer_sk AS ctr_customer_sk, sr_store_sk AS ctr_store_sk, sum(sr_fee) AS ctr_total_return
  FROM store_returns, date_dim WHERE sr_returned_date_sk = d_date_sk AND d_year = 2000
  GROUP BY sr_customer_sk, sr_store_sk)
SELECT c_customer_id
FROM ctr ctr1, store, customer
WHERE CAST(ctr1.ctr_total_return AS DOUBLE) > (
        SELECT CAST(sum(ctr_total_return) AS DOUBLE) / count(ctr_total_return) * 1.2
        FROM ctr ctr2 WHERE ctr1.ctr_store_sk = ctr2.ctr_store_sk)
  AND s_store_sk = ctr1.ctr_store_sk AND s_state = 'MA' AND ctr1.ctr_customer_sk = c_customer_sk
ORDER BY c_customer_id LIMIT 100""")

q("q06", "customer_address customer store_sales date_dim item", """
SELECT a.ca_state AS state, count(*) AS cnt
FROM customer_address a, customer c, store_sales s, date_dim d, item i
WHERE a.ca_address_sk = c.c_current_addr_sk AND c.c_customer_sk = s.ss_customer_sk
  AND s.ss_sold_date_sk = d.d_date_sk AND s.ss_item_sk = i.i_item_sk
  AND d.d_month_seq = (SELECT DISTINCT d_month_seq FROM date_dim WHERE d_year = 2001 AND d_moy = 1)
  AND CAST(i.i_current_price AS DOUBLE) > (SELECT CAST(sum(j.i_current_price) AS DOUBLE) / count(j.i_current_price) * 1.2
                             FROM item j WHERE j.i_category = i.i_category)
GROUP BY a.ca_state HAVING count(*) >= 1
ORDER BY cnt, state LIMIT 100""")


def _above_state(returns, p, amt, cols):
    return f"""
WITH ctr AS (
  SELECT {p}_returning_customer_sk AS ctr_customer_sk, ca_state AS ctr_state, sum({amt}) AS ctr_total_return
  FROM {returns}, date_dim, customer_address
  WHERE {p}_returned_date_sk = d_date_sk AND d_year = 2000 AND {p}_returning_addr_sk = ca_address_sk
  GROUP BY {p}_returning_customer_sk, ca_state)
SELECT {cols}, CAST(ctr_total_return AS DOUBLE) AS ctr_total_return
FROM ctr ctr1, customer_address, customer
WHERE CAST(ctr1.ctr_total_return AS DOUBLE) > (
        SELECT CAST(sum(ctr_total_return) AS DOUBLE) / count(ctr_total_return) * 1.2
        FROM ctr ctr2 WHERE ctr1.ctr_state = ctr2.ctr_state)
  AND ca_address_sk = c_current_addr_sk AND ca_state = 'GA' AND ctr1.ctr_customer_sk = c_customer_sk
ORDER BY {cols}, ctr_total_return LIMIT 100"""


q("q30", "web_returns date_dim customer_address customer", _above_state(
    "web_returns", "wr", "wr_return_amt",
    "c_customer_id, c_salutation, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_day, "
    "c_birth_month, c_birth_year, c_birth_country, c_login, c_email_address, c_last_review_date"))
q("q81", "catalog_returns date_dim customer_address customer", _above_state(
    "catalog_returns", "cr", "cr_return_amt_inc_tax",
    "c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, "
    "ca_street_type, ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, "
    "CAST(ca_gmt_offset AS DOUBLE) AS ca_gmt_offset, ca_location_type").replace(
    "ORDER BY c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, "
    "ca_street_type, ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, "
    "CAST(ca_gmt_offset AS DOUBLE) AS ca_gmt_offset, ca_location_type",
    "ORDER BY c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, "
    "ca_street_type, ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, "
    "ca_gmt_offset, ca_location_type"))


def _excess(fact, p, manu):
    return f"""
SELECT CAST(sum({p}_ext_discount_amt) AS DOUBLE) AS excess_discount_amount
FROM {fact}, item, date_dim
WHERE i_manufact_id = {manu} AND i_item_sk = {p}_item_sk
  AND d_date BETWEEN DATE '2000-01-27' AND DATE '2000-01-27' + 90 AND d_date_sk = {p}_sold_date_sk
  AND CAST({p}_ext_discount_amt AS DOUBLE) > (
        SELECT 1.3 * (CAST(sum({p}_ext_discount_amt) AS DOUBLE) / count({p}_ext_discount_amt))
        FROM {fact} f2, date_dim d2
        WHERE f2.{p}_item_sk = i_item_sk AND d2.d_date BETWEEN DATE '2000-01-27' AND DATE '2000-01-27' + 90
          AND d2.d_date_sk = f2.{p}_sold_date_sk)"""


q("q32", "catalog_sales item date_dim", _excess("catalog_sales", "cs", 77))
q("q92", "web_sales item date_dim", _excess("web_sales", "ws", 50))

q("q41", "item", """
SELECT DISTINCT i_product_name
FROM item i1
WHERE i_manufact_id BETWEEN 38 AND 38 + 40
  AND (SELECT count(*) FROM item
       WHERE i_manufact = i1.i_manufact AND (
         (i_category = 'ring' AND i_color IN ('blue', 'red') AND i_units IN ('Each', 'Box') AND i_size IN ('small', 'medium'))
      OR (i_category = 'ring' AND i_color IN ('cold', 'hot') AND i_units IN ('Dozen', 'Case') AND i_size IN ('large', 'petite'))
      OR (i_category = 'gear' AND i_color IN ('new', 'old') AND i_units IN ('Lb', 'Oz') AND i_size IN ('small', 'medium'))
      OR (i_category = 'gear' AND i_color IN ('small', 'large') AND i_units IN ('Gram', 'Pallet') AND i_size IN ('large', 'petite'))
      OR (i_category = 'bolt' AND i_color IN ('blue', 'cold') AND i_units IN ('Each', 'Oz') AND i_size IN ('economy', 'N/A'))
      OR (i_category = 'rod' AND i_color IN ('red', 'hot') AND i_units IN ('Box', 'Lb') AND i_size IN ('extra large', 'small')))) > 0
ORDER BY i_product_name LIMIT 100""")


def _q09():
    th = [3000, 5000, 4000, 9000, 2000]
    parts = []
    for b in range(5):
        lo, hi = 20 * b + 1, 20 * b + 20
        parts.append(f"""CASE WHEN (SELECT count(*) FROM store_sales WHERE ss_quantity BETWEEN {lo} AND {hi}) > {th[b]}
  THEN (SELECT CAST(sum(ss_ext_discount_amt) AS DOUBLE) / count(ss_ext_discount_amt) FROM store_sales WHERE ss_quantity BETWEEN {lo} AND {hi})
  ELSE (SELECT CAST(sum(ss_net_paid) AS DOUBLE) / count(ss_net_paid) FROM store_sales WHERE ss_quantity BETWEEN {lo} AND {hi}) END AS bucket{b + 1}""")
    return "\nSELECT " + ",\n".join(parts) + "\nFROM reason WHERE r_reason_sk = 1"


q("q09", "store_sales reason", _q09())


def _q28():
    bs = [(0, 5, 8, 459, 57), (6, 10, 90, 2323, 31), (11, 15, 142, 12214, 79),
          (16, 20, 135, 6071, 38), (21, 25, 122, 836, 17), (26, 30, 154, 7326, 7)]
    subs = []
    for i, (qlo, qhi, lp, cp, wc) in enumerate(bs, 1):
        subs.append(f"""(SELECT CAST(sum(ss_list_price) AS DOUBLE) / count(ss_list_price) AS b{i}_lp,
        count(ss_list_price) AS b{i}_cnt, count(DISTINCT ss_list_price) AS b{i}_cntd
 FROM store_sales WHERE ss_quantity BETWEEN {qlo} AND {qhi}
   AND (ss_list_price BETWEEN {lp} AND {lp + 10} OR ss_coupon_amt BETWEEN {cp} AND {cp + 1000}
        OR ss_wholesale_cost BETWEEN {wc} AND {wc + 20})) b{i}""")
    return "\nSELECT * FROM " + ",\n".join(subs)


q("q28", "store_sales", _q28())


def _q88():
    names = ["h8_30_to_9", "h9_to_9_30", "h9_30_to_10", "h10_to_10_30", "h10_30_to_11",
             "h11_to_11_30", "h11_30_to_12", "h12_to_12_30"]
    subs = []
    for i, n in enumerate(names):
        h, m = divmod(8 * 60 + 30 + 30 * i, 60)
        mcond = "t_minute >= 30" if m == 30 else "t_minute < 30"
        subs.append(f"""(SELECT count(*) AS {n} FROM store_sales, household_demographics, time_dim, store
 WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
   AND t_hour = {h} AND {mcond}
   AND ((hd_dep_count = 4 AND hd_vehicle_count <= 4 + 2) OR (hd_dep_count = 2 AND hd_vehicle_count <= 2 + 2)
        OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2))
   AND s_store_name = 'meadow') s{i}""")
    return "\nSELECT * FROM " + ",\n".join(subs)


q("q88", "store_sales household_demographics time_dim store", _q88())

q("q90", "web_sales household_demographics time_dim web_page", """
SELECT CASE WHEN pmc > 0 THEN CAST(amc AS DOUBLE) / pmc END AS am_pm_ratio
FROM (SELECT count(*) AS amc FROM web_sales, household_demographics, time_dim, web_page
      WHERE ws_sold_time_sk = t_time_sk AND ws_ship_hdemo_sk = hd_demo_sk AND ws_web_page_sk = wp_web_page_sk
        AND t_hour BETWEEN 8 AND 8 + 1 AND hd_dep_count = 6 AND wp_char_count BETWEEN 4000 AND 5200) at_,
     (SELECT count(*) AS pmc FROM web_sales, household_demographics, time_dim, web_page
      WHERE ws_sold_time_sk = t_time_sk AND ws_ship_hdemo_sk = hd_demo_sk AND ws_web_page_sk = wp_web_page_sk
        AND t_hour BETWEEN 19 AND 19 + 1 AND hd_dep_count = 6 AND wp_char_count BETWEEN 4000 AND 5200) pt""")

q("q61", "store_sales store promotion date_dim customer customer_address item", """
SELECT CAST(promotions AS DOUBLE) AS promotions, CAST(total AS DOUBLE) AS total,
       CAST(promotions AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS pct
FROM (SELECT sum(ss_ext_sales_price) AS promotions
      FROM store_sales, store, promotion, date_dim, customer, customer_address, item
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_promo_sk = p_promo_sk
        AND ss_customer_sk = c_customer_sk AND ca_address_sk = c_current_addr_sk AND ss_item_sk = i_item_sk
        AND ca_gmt_offset = -5 AND i_category = 'ring'
        AND (p_channel_dmail = 'Y' OR p_channel_email = 'Y' OR p_channel_tv = 'Y')
        AND s_gmt_offset = -5 AND d_year = 1998 AND d_moy IN (10, 11)) promotional_sales,
     (SELECT sum(ss_ext_sales_price) AS total
      FROM store_sales, store, date_dim, customer, customer_address, item
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_customer_sk = c_customer_sk
        AND ca_address_sk = c_current_addr_sk AND ss_item_sk = i_item_sk
        AND ca_gmt_offset = -5 AND i_category = 'ring' AND s_gmt_offset = -5
        AND d_year = 1998 AND d_moy IN (10, 11)) all_sales""")

_SH = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]


def _wk_pivot(amount):
    return ", ".join(f"CAST(sum(CASE WHEN d_day_name = '{d}' THEN {amount} END) AS DOUBLE) AS {s}_sales"
                     for d, s in zip(_DAYS, _SH))


q("q02", "web_sales catalog_sales date_dim", f"""
WITH wscs AS (
  SELECT ws_sold_date_sk AS sold_date_sk, ws_ext_sales_price AS sales_price FROM web_sales
  UNION ALL SELECT cs_sold_date_sk, cs_ext_sales_price FROM catalog_sales),
wswscs AS (SELECT d_week_seq, {_wk_pivot('sales_price')} FROM wscs, date_dim
           WHERE d_date_sk = sold_date_sk GROUP BY d_week_seq)
SELECT d_week_seq1,
  {", ".join(f"round(CASE WHEN {s}_sales2 <> 0 THEN {s}_sales1 / {s}_sales2 END, 2) AS r_{s}" for s in _SH)}
FROM (SELECT wswscs.d_week_seq AS d_week_seq1, {", ".join(f"{s}_sales AS {s}_sales1" for s in _SH)}
      FROM wswscs, date_dim WHERE date_dim.d_week_seq = wswscs.d_week_seq AND d_year = 2001) y,
     (SELECT wswscs.d_week_seq AS d_week_seq2, {", ".join(f"{s}_sales AS {s}_sales2" for s in _SH)}
      FROM wswscs, date_dim WHERE date_dim.d_week_seq = wswscs.d_week_seq AND d_year = 2002) z
WHERE d_week_seq1 = d_week_seq2 - 53
ORDER BY d_week_seq1""")


def _year_total_branch(fact, p, cust, expr, tag):
    return f"""SELECT c_customer_id AS customer_id, c_first_name AS customer_first_name,
         c_last_name AS customer_last_name, c_preferred_cust_flag AS customer_preferred_cust_flag,
         c_birth_country, c_login, c_email_address, d_year AS dyear,
         CAST(sum({expr.format(p=p)}) AS DOUBLE) AS year_total, '{tag}' AS sale_type
  FROM customer, {fact}, date_dim WHERE c_customer_sk = {cust} AND {p}_sold_date_sk = d_date_sk
  GROUP BY c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country,
           c_login, c_email_address, d_year"""


def _ratio_sql(a, b):
    return f"CASE WHEN {b}.year_total > 0 THEN {a}.year_total / {b}.year_total END"


_Q4E = "(({p}_ext_list_price - {p}_ext_wholesale_cost - {p}_ext_discount_amt) + {p}_ext_sales_price)"
q("q04", "customer store_sales catalog_sales web_sales date_dim", f"""
WITH year_total AS (
  {_year_total_branch('store_sales', 'ss', 'ss_customer_sk', _Q4E, 's')}
  UNION ALL {_year_total_branch('catalog_sales', 'cs', 'cs_bill_customer_sk', _Q4E, 'c')}
  UNION ALL {_year_total_branch('web_sales', 'ws', 'ws_bill_customer_sk', _Q4E, 'w')})
SELECT t_s_secyear.customer_id AS c_customer_id, t_s_secyear.customer_first_name AS c_first_name,
       t_s_secyear.customer_last_name AS c_last_name,
       t_s_secyear.customer_preferred_cust_flag AS c_preferred_cust_flag
FROM year_total t_s_firstyear, year_total t_s_secyear, year_total t_c_firstyear,
     year_total t_c_secyear, year_total t_w_firstyear, year_total t_w_secyear
WHERE t_s_secyear.customer_id = t_s_firstyear.customer_id
  AND t_s_firstyear.customer_id = t_c_secyear.customer_id
  AND t_s_firstyear.customer_id = t_c_firstyear.customer_id
  AND t_s_firstyear.customer_id = t_w_firstyear.customer_id
  AND t_s_firstyear.customer_id = t_w_secyear.customer_id
  AND t_s_firstyear.sale_type = 's' AND t_c_firstyear.sale_type = 'c' AND t_w_firstyear.sale_type = 'w'
  AND t_s_secyear.sale_type = 's' AND t_c_secyear.sale_type = 'c' AND t_w_secyear.sale_type = 'w'
  AND t_s_firstyear.dyear = 2000 AND t_s_secyear.dyear = 2001
  AND t_c_firstyear.dyear = 2000 AND t_c_secyear.dyear = 2001
  AND t_w_firstyear.dyear = 2000 AND t_w_secyear.dyear = 2001
  AND t_s_firstyear.year_total > 0 AND t_c_firstyear.year_total > 0 AND t_w_firstyear.year_total > 0
  AND {_ratio_sql('t_c_secyear', 't_c_firstyear')} > {_ratio_sql('t_s_secyear', 't_s_firstyear')}
  AND {_ratio_sql('t_c_secyear', 't_c_firstyear')} > {_ratio_sql('t_w_secyear', 't_w_firstyear')}
ORDER BY 1, 2, 3, 4 LIMIT 100""")


def _two_channel(expr, agg_cols, out_sql, order_sql, agg="sum"):
    br = [_year_total_branch('store_sales', 'ss', 'ss_customer_sk', expr, 's'),
          _year_total_branch('web_sales', 'ws', 'ws_bill_customer_sk', expr, 'w')]
    if agg != "sum":
        br = [b.replace("CAST(sum(", f"CAST({agg}(") for b in br]
    return f"""
WITH year_total AS ({br[0]} UNION ALL {br[1]})
SELECT {out_sql}
FROM year_total t_s_firstyear, year_total t_s_secyear, year_total t_w_firstyear, year_total t_w_secyear
WHERE t_s_secyear.customer_id = t_s_firstyear.customer_id
  AND t_s_firstyear.customer_id = t_w_secyear.customer_id
  AND t_s_firstyear.customer_id = t_w_firstyear.customer_id
  AND t_s_firstyear.sale_type = 's' AND t_w_firstyear.sale_type = 'w'
  AND t_s_secyear.sale_type = 's' AND t_w_secyear.sale_type = 'w'
  AND t_s_firstyear.dyear = 2000 AND t_s_secyear.dyear = 2001
  AND t_w_firstyear.dyear = 2000 AND t_w_secyear.dyear = 2001
  AND t_s_firstyear.year_total > 0 AND t_w_firstyear.year_total > 0
  AND {_ratio_sql('t_w_secyear', 't_w_firstyear')} > {_ratio_sql('t_s_secyear', 't_s_firstyear')}
ORDER BY {order_sql} LIMIT 100"""


q("q11", "customer store_sales web_sales date_dim", _two_channel(
    "{p}_ext_list_price - {p}_ext_discount_amt", None,
    "t_s_secyear.customer_id AS c_customer_id, t_s_secyear.customer_first_name AS c_first_name, "
    "t_s_secyear.customer_last_name AS c_last_name, "
    "t_s_secyear.customer_preferred_cust_flag AS c_preferred_cust_flag", "1, 2, 3, 4"))
q("q74", "customer store_sales web_sales date_dim", _two_channel(
    "{p}_net_paid", None,
    "t_s_secyear.customer_id AS c_customer_id, t_s_secyear.customer_first_name AS c_first_name, "
    "t_s_secyear.customer_last_name AS c_last_name", "1, 2, 3"))

q("q31", "store_sales web_sales date_dim customer_address", """
WITH ss AS (SELECT ca_county, d_qoy, d_year, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS store_sales
            FROM store_sales, date_dim, customer_address
            WHERE ss_sold_date_sk = d_date_sk AND ss_addr_sk = ca_address_sk GROUP BY ca_county, d_qoy, d_year),
     ws AS (SELECT ca_county, d_qoy, d_year, CAST(sum(ws_ext_sales_price) AS DOUBLE) AS web_sales
            FROM web_sales, date_dim, customer_address
            WHERE ws_sold_date_sk = d_date_sk AND ws_bill_addr_sk = ca_address_sk GROUP BY ca_county, d_qoy, d_year)
SELECT ss1.ca_county, ss1.d_year,
       CASE WHEN ws1.web_sales <> 0 THEN ws2.web_sales / ws1.web_sales END AS web_q1_q2_increase,
       CASE WHEN ss1.store_sales <> 0 THEN ss2.store_sales / ss1.store_sales END AS store_q1_q2_increase,
       CASE WHEN ws2.web_sales <> 0 THEN ws3.web_sales / ws2.web_sales END AS web_q2_q3_increase,
       CASE WHEN ss2.store_sales <> 0 THEN ss3.store_sales / ss2.store_sales END AS store_q2_q3_increase
FROM ss ss1, ss ss2, ss ss3, ws ws1, ws ws2, ws ws3
WHERE ss1.d_qoy = 1 AND ss1.d_year = 2000 AND ss1.ca_county = ss2.ca_county AND ss2.d_qoy = 2
  AND ss2.d_year = 2000 AND ss2.ca_county = ss3.ca_county AND ss3.d_qoy = 3 AND ss3.d_year = 2000
  AND ss1.ca_county = ws1.ca_county AND ws1.d_qoy = 1 AND ws1.d_year = 2000
  AND ws1.ca_county = ws2.ca_county AND ws2.d_qoy = 2 AND ws2.d_year = 2000
  AND ws1.ca_county = ws3.ca_county AND ws3.d_qoy = 3 AND ws3.d_year = 2000
  AND CASE WHEN ws1.web_sales > 0 THEN ws2.web_sales / ws1.web_sales END
      > CASE WHEN ss1.store_sales > 0 THEN ss2.store_sales / ss1.store_sales END
  AND CASE WHEN ws2.web_sales > 0 THEN ws3.web_sales / ws2.web_sales END
      > CASE WHEN ss2.store_sales > 0 THEN ss3.store_sales / ss2.store_sales END
ORDER BY ss1.ca_county""")


def _three(key, item_filter, year, month, order_sql):
    br = []
    for fact, p, addr in [("store_sales", "ss", "ss_addr_sk"), ("catalog_sales", "cs", "cs_bill_addr_sk"),
                          ("web_sales", "ws", "ws_bill_addr_sk")]:
        br.append(f"""SELECT {key}, sum({p}_ext_sales_price) AS total_sales
  FROM {fact}, date_dim, customer_address, item
  WHERE {key} IN (SELECT {key} FROM item WHERE {item_filter})
    AND {p}_item_sk = i_item_sk AND {p}_sold_date_sk = d_date_sk AND d_year = {year} AND d_moy = {month}
    AND {addr} = ca_address_sk AND ca_gmt_offset = -5
  GROUP BY {key}""")
    return f"""
SELECT {key}, CAST(sum(total_sales) AS DOUBLE) AS total_sales
FROM ({br[0]} UNION ALL {br[1]} UNION ALL {br[2]}) tmp1
GROUP BY {key} ORDER BY {order_sql} LIMIT 100"""


_T3 = "store_sales catalog_sales web_sales date_dim customer_address item"
q("q33", _T3, _three("i_manufact_id", "i_category IN ('ring')", 1998, 5, "total_sales, i_manufact_id"))
q("q56", _T3, _three("i_item_id", "i_color IN ('blue', 'red', 'cold')", 2001, 2, "total_sales, i_item_id"))
q("q60", _T3, _three("i_item_id", "i_category IN ('gear')", 1998, 9, "i_item_id, total_sales"))


def _q58():
    items = []
    for fact, p in [("store_sales", "ss"), ("catalog_sales", "cs"), ("web_sales", "ws")]:
        items.append(f"""{p}_items AS (
  SELECT i_item_id AS item_id, CAST(sum({p}_ext_sales_price) AS DOUBLE) AS {p}_item_rev
  FROM {fact}, item, date_dim
  WHERE {p}_item_sk = i_item_sk AND d_date IN (
          SELECT d_date FROM date_dim WHERE d_week_seq >= (SELECT d_week_seq FROM date_dim WHERE d_date = DATE '2000-01-03')
                                        AND d_week_seq < (SELECT d_week_seq FROM date_dim WHERE d_date = DATE '2000-01-03') + 26)
    AND {p}_sold_date_sk = d_date_sk
  GROUP BY i_item_id)""")
    return "\nWITH " + ",\n".join(items) + """
SELECT ss_items.item_id, ss_item_rev,
       ss_item_rev / ((ss_item_rev + cs_item_rev + ws_item_rev) / 3) * 100 AS ss_dev,
       cs_item_rev, cs_item_rev / ((ss_item_rev + cs_item_rev + ws_item_rev) / 3) * 100 AS cs_dev,
       ws_item_rev, ws_item_rev / ((ss_item_rev + cs_item_rev + ws_item_rev) / 3) * 100 AS ws_dev,
       (ss_item_rev + cs_item_rev + ws_item_rev) / 3 AS average
FROM ss_items, cs_items, ws_items
WHERE ss_items.item_id = cs_items.item_id AND ss_items.item_id = ws_items.item_id
  AND ss_item_rev BETWEEN 0.4 * cs_item_rev AND 1.6 * cs_item_rev
  AND ss_item_rev BETWEEN 0.4 * ws_item_rev AND 1.6 * ws_item_rev
  AND cs_item_rev BETWEEN 0.4 * ss_item_rev AND 1.6 * ss_item_rev
  AND cs_item_rev BETWEEN 0.4 * ws_item_rev AND 1.6 * ws_item_rev
  AND ws_item_rev BETWEEN 0.4 * ss_item_rev AND 1.6 * ss_item_rev
  AND ws_item_rev BETWEEN 0.4 * cs_item_rev AND 1.6 * cs_item_rev
ORDER BY item_id, ss_item_rev LIMIT 100"""


q("q58", "store_sales catalog_sales web_sales item date_dim", _q58())

q("q59", "store_sales date_dim store", f"""
WITH wss AS (SELECT d_week_seq, ss_store_sk, {_wk_pivot('ss_sales_price')}
             FROM store_sales, date_dim WHERE d_date_sk = ss_sold_date_sk GROUP BY d_week_seq, ss_store_sk)
SELECT s_store_name1, s_store_id1, d_week_seq1,
  {", ".join(f"CASE WHEN {s}_sales2 <> 0 THEN {s}_sales1 / {s}_sales2 END AS r_{s}" for s in _SH)}
FROM (SELECT s_store_name AS s_store_name1, wss.d_week_seq AS d_week_seq1, s_store_id AS s_store_id1,
             {", ".join(f"{s}_sales AS {s}_sales1" for s in _SH)}
      FROM wss, store, date_dim d
      WHERE d.d_week_seq = wss.d_week_seq AND ss_store_sk = s_store_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11) y,
     (SELECT s_store_name AS s_store_name2, wss.d_week_seq AS d_week_seq2, s_store_id AS s_store_id2,
             {", ".join(f"{s}_sales AS {s}_sales2" for s in _SH)}
      FROM wss, store, date_dim d
      WHERE d.d_week_seq = wss.d_week_seq AND ss_store_sk = s_store_sk AND d_month_seq BETWEEN 1176 + 12 AND 1176 + 23) x
WHERE s_store_id1 = s_store_id2 AND d_week_seq1 = d_week_seq2 - 52
ORDER BY s_store_name1, s_store_id1, d_week_seq1, {", ".join(f"r_{s}" for s in _SH)} LIMIT 100""")

q("q71", "item web_sales catalog_sales store_sales date_dim time_dim", """
SELECT i_brand_id AS brand_id, i_brand AS brand, t_hour, t_minute, CAST(sum(ext_price) AS DOUBLE) AS ext_price
FROM item,
     (SELECT ws_ext_sales_price AS ext_price, ws_sold_date_sk AS sold_date_sk, ws_item_sk AS sold_item_sk,
             ws_sold_time_sk AS time_sk FROM web_sales, date_dim
      WHERE d_date_sk = ws_sold_date_sk AND d_moy = 11 AND d_year = 1999
      UNION ALL
      SELECT cs_ext_sales_price, cs_sold_date_sk, cs_item_sk, cs_sold_time_sk FROM catalog_sales, date_dim
      WHERE d_date_sk = cs_sold_date_sk AND d_moy = 11 AND d_year = 1999
      UNION ALL
      SELECT ss_ext_sales_price, ss_sold_date_sk, ss_item_sk, ss_sold_time_sk FROM store_sales, date_dim
      WHERE d_date_sk = ss_sold_date_sk AND d_moy = 11 AND d_year = 1999) tmp, time_dim
WHERE sold_item_sk = i_item_sk AND i_manager_id = 1 AND time_sk = t_time_sk
  AND (t_meal_time = 'breakfast' OR t_meal_time = 'dinner')
GROUP BY i_brand, i_brand_id, t_hour, t_minute
ORDER BY ext_price DESC, brand_id, brand, t_hour, t_minute""")

q("q76", "store_sales web_sales catalog_sales item date_dim", """
SELECT channel, col_name, d_year, d_qoy, i_category, count(*) AS sales_cnt,
       CAST(sum(ext_sales_price) AS DOUBLE) AS sales_amt
FROM (SELECT 'store' AS channel, 'ss_store_sk' AS col_name, d_year, d_qoy, i_category,
             ss_ext_sales_price AS ext_sales_price
      FROM store_sales, item, date_dim
      WHERE ss_store_sk IS NULL AND ss_sold_date_sk = d_date_sk AND ss_item_sk = i_item_sk
      UNION ALL
      SELECT 'web', 'ws_ship_customer_sk', d_year, d_qoy, i_category, ws_ext_sales_price
      FROM web_sales, item, date_dim
      WHERE ws_ship_customer_sk IS NULL AND ws_sold_date_sk = d_date_sk AND ws_item_sk = i_item_sk
      UNION ALL
      SELECT 'catalog', 'cs_ship_addr_sk', d_year, d_qoy, i_category, cs_ext_sales_price
      FROM catalog_sales, item, date_dim
      WHERE cs_ship_addr_sk IS NULL AND cs_sold_date_sk = d_date_sk AND cs_item_sk = i_item_sk) foo
GROUP BY channel, col_name, d_year, d_qoy, i_category
ORDER BY channel, col_name, d_year, d_qoy, i_category LIMIT 100""")


def _q83():
    items = []
    for fact, p, qty in [("store_returns", "sr", "sr_return_quantity"), ("catalog_returns", "cr", "cr_return_quantity"),
                         ("web_returns", "wr", "wr_return_quantity")]:
        items.append(f"""{p}_items AS (
  SELECT i_item_id AS item_id, sum({qty}) AS {p}_item_qty
  FROM {fact}, item, date_dim
  WHERE {p}_item_sk = i_item_sk
    AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq IN (
          SELECT d_week_seq FROM date_dim WHERE d_date IN ({", ".join(f"DATE '2000-{m:02d}-{d:02d}'" for m in (2, 5, 8, 11) for d in (3, 10, 17))})))
    AND {p}_returned_date_sk = d_date_sk
  GROUP BY i_item_id)""")
    return "\nWITH " + ",\n".join(items) + """
SELECT sr_items.item_id, sr_item_qty,
       sr_item_qty / CAST(sr_item_qty + cr_item_qty + wr_item_qty AS DOUBLE) / 3.0 * 100 AS sr_dev,
       cr_item_qty, cr_item_qty / CAST(sr_item_qty + cr_item_qty + wr_item_qty AS DOUBLE) / 3.0 * 100 AS cr_dev,
       wr_item_qty, wr_item_qty / CAST(sr_item_qty + cr_item_qty + wr_item_qty AS DOUBLE) / 3.0 * 100 AS wr_dev,
       CAST(sr_item_qty + cr_item_qty + wr_item_qty AS DOUBLE) / 3.0 AS average
FROM sr_items, cr_items, wr_items
WHERE sr_items.item_id = cr_items.item_id AND sr_items.item_id = wr_items.item_id
ORDER BY sr_items.item_id, sr_item_qty LIMIT 100"""


q("q83", "store_returns catalog_returns web_returns item date_dim", _q83())


def _sd(c):
    n = f"count({c})"
    return (f"CASE WHEN {n} > 1 THEN sqrt(CAST({n} * sum(CAST({c} AS BIGINT) * {c}) - sum({c}) * sum({c}) AS DOUBLE)"
            f" / CAST({n} * ({n} - 1) AS DOUBLE)) END")


def _av(c):
    return f"(CAST(sum({c}) AS DOUBLE) / count({c}))"


_Q17_SEL = ",\n  ".join(
    f"count({c}) AS {n}count, {_av(c)} AS {n}ave, {_sd(c)} AS {n}stdev, {_sd(c)} / {_av(c)} AS {n}cov"
    for c, n in [("ss_quantity", "store_sales_quantity"), ("sr_return_quantity", "store_returns_quantity"),
                 ("cs_quantity", "catalog_sales_quantity")])
q("q17", "store_sales store_returns catalog_sales date_dim store item", f"""
SELECT i_item_id, i_item_desc, s_state,
  {_Q17_SEL}
FROM store_sales, store_returns, catalog_sales, date_dim d1, date_dim d2, date_dim d3, store, item
WHERE d1.d_quarter_name = '1999Q1' AND d1.d_date_sk = ss_sold_date_sk AND i_item_sk = ss_item_sk
  AND s_store_sk = ss_store_sk AND ss_customer_sk = sr_customer_sk AND ss_item_sk = sr_item_sk
  AND ss_ticket_number = sr_ticket_number AND sr_returned_date_sk = d2.d_date_sk
  AND d2.d_quarter_name IN ('1999Q1', '1999Q2', '1999Q3') AND sr_customer_sk = cs_bill_customer_sk
  AND sr_item_sk = cs_item_sk AND cs_sold_date_sk = d3.d_date_sk
  AND d3.d_quarter_name IN ('1999Q1', '1999Q2', '1999Q3')
GROUP BY i_item_id, i_item_desc, s_state
ORDER BY i_item_id, i_item_desc, s_state LIMIT 100""")


def _chain(sel, d1, d2, d3):
    return f"""
SELECT i_item_id, i_item_desc, s_store_id, s_store_name, {sel}
FROM store_sales, store_returns, catalog_sales, date_dim d1, date_dim d2, date_dim d3, store, item
WHERE {d1} AND d1.d_date_sk = ss_sold_date_sk AND i_item_sk = ss_item_sk AND s_store_sk = ss_store_sk
  AND ss_customer_sk = sr_customer_sk AND ss_item_sk = sr_item_sk AND ss_ticket_number = sr_ticket_number
  AND sr_returned_date_sk = d2.d_date_sk AND {d2}
  AND sr_customer_sk = cs_bill_customer_sk AND sr_item_sk = cs_item_sk
  AND cs_sold_date_sk = d3.d_date_sk AND {d3}
GROUP BY i_item_id, i_item_desc, s_store_id, s_store_name
ORDER BY i_item_id, i_item_desc, s_store_id, s_store_name LIMIT 100"""


_TCH = "store_sales store_returns catalog_sales date_dim store item"
q("q25", _TCH, _chain(
    "CAST(sum(ss_net_profit) AS DOUBLE) AS store_sales_profit, CAST(sum(sr_net_loss) AS DOUBLE) AS store_returns_loss, "
    "CAST(sum(cs_net_profit) AS DOUBLE) AS catalog_sales_profit",
    "d1.d_moy = 4 AND d1.d_year = 1999", "d2.d_moy BETWEEN 4 AND 10 AND d2.d_year = 1999",
    "d3.d_moy BETWEEN 4 AND 10 AND d3.d_year = 1999"))
q("q29", _TCH, _chain(
    "CAST(sum(ss_quantity) AS BIGINT) AS store_sales_quantity, CAST(sum(sr_return_quantity) AS BIGINT) AS store_returns_quantity, "
    "CAST(sum(cs_quantity) AS BIGINT) AS catalog_sales_quantity",
    "d1.d_moy = 9 AND d1.d_year = 1999", "d2.d_moy BETWEEN 9 AND 9 + 3 AND d2.d_year = 1999",
    "d3.d_year IN (1999, 2000, 2001)"))


def _q24(color, market):
    return f"""
WITH ssales AS (
  SELECT c_last_name, c_first_name, s_store_name, ca_state, s_state, i_color, i_current_price, i_manager_id,
         i_units, i_size, sum(ss_net_paid) AS netpaid
  FROM store_sales, store_returns, store, item, customer, customer_address
  WHERE ss_ticket_number = sr_ticket_number AND ss_item_sk = sr_item_sk AND ss_customer_sk = c_customer_sk
    AND ss_item_sk = i_item_sk AND ss_store_sk = s_store_sk AND c_current_addr_sk = ca_address_sk
    AND c_birth_country <> upper(ca_country) AND s_zip = ca_zip AND s_market_id = {market}
  GROUP BY c_last_name, c_first_name, s_store_name, ca_state, s_state, i_color, i_current_price,
           i_manager_id, i_units, i_size)
SELECT c_last_name, c_first_name, s_store_name, CAST(sum(netpaid) AS DOUBLE) AS paid
FROM ssales WHERE i_color = '{color}'
GROUP BY c_last_name, c_first_name, s_store_name
HAVING CAST(sum(netpaid) AS DOUBLE) > (SELECT 0.05 * (CAST(sum(netpaid) AS DOUBLE) / count(netpaid)) FROM ssales)
ORDER BY c_last_name, c_first_name, s_store_name"""


q("q24_1", "store_sales store_returns store item customer customer_address", _q24("red", 2))
q("q24_2", "store_sales store_returns store item customer customer_address", _q24("cold", 5))

q("q40", "catalog_sales catalog_returns warehouse item date_dim", """
SELECT w_state, i_item_id,
  CAST(sum(CASE WHEN d_date < DATE '2000-03-11' THEN cs_sales_price - coalesce(cr_refunded_cash, 0) ELSE 0 END) AS DOUBLE) AS sales_before,
  CAST(sum(CASE WHEN d_date >= DATE '2000-03-11' THEN cs_sales_price - coalesce(cr_refunded_cash, 0) ELSE 0 END) AS DOUBLE) AS sales_after
FROM catalog_sales LEFT OUTER JOIN catalog_returns
       ON (cs_order_number = cr_order_number AND cs_item_sk = cr_item_sk), warehouse, item, date_dim
WHERE i_current_price BETWEEN 10.0 AND 40.0 AND i_item_sk = cs_item_sk AND cs_warehouse_sk = w_warehouse_sk
  AND cs_sold_date_sk = d_date_sk AND d_date BETWEEN DATE '2000-03-11' - 30 AND DATE '2000-03-11' + 30
GROUP BY w_state, i_item_id ORDER BY w_state, i_item_id LIMIT 100""")


def _q49_branch(ch, sales, rets, p, r, on_s, on_r, ramt):
    return f"""SELECT '{ch}' AS channel, item, return_ratio, return_rank, currency_rank FROM (
    SELECT item, return_ratio, currency_ratio,
           rank() OVER (ORDER BY return_ratio) AS return_rank,
           rank() OVER (ORDER BY currency_ratio) AS currency_rank
    FROM (SELECT s.{p}_item_sk AS item,
                 CAST(sum(coalesce(r.{r}_return_quantity, 0)) AS DOUBLE) / CAST(sum(coalesce(s.{p}_quantity, 0)) AS DOUBLE) AS return_ratio,
                 CAST(sum(coalesce(r.{ramt}, 0)) AS DOUBLE) / CAST(sum(coalesce(s.{p}_net_paid, 0)) AS DOUBLE) AS currency_ratio
          FROM {sales} s LEFT OUTER JOIN {rets} r ON (s.{on_s} = r.{on_r} AND s.{p}_item_sk = r.{r}_item_sk), date_dim
          WHERE r.{ramt} > 100 AND s.{p}_net_profit > 1 AND s.{p}_net_paid > 0 AND s.{p}_quantity > 0
            AND {p}_sold_date_sk = d_date_sk AND d_year = 2001 AND d_moy = 12
          GROUP BY s.{p}_item_sk) x) y
  WHERE return_rank <= 10 OR currency_rank <= 10"""


q("q49", "web_sales web_returns catalog_sales catalog_returns store_sales store_returns date_dim", f"""
SELECT channel, item, return_ratio, return_rank, currency_rank FROM (
  {_q49_branch('web', 'web_sales', 'web_returns', 'ws', 'wr', 'ws_order_number', 'wr_order_number', 'wr_return_amt')}
  UNION
  {_q49_branch('catalog', 'catalog_sales', 'catalog_returns', 'cs', 'cr', 'cs_order_number', 'cr_order_number', 'cr_return_amount')}
  UNION
  {_q49_branch('store', 'store_sales', 'store_returns', 'ss', 'sr', 'ss_ticket_number', 'sr_ticket_number', 'sr_return_amt')}
) t
ORDER BY channel, return_rank, currency_rank, item, return_ratio LIMIT 100""")

q("q50", "store_sales store_returns store date_dim", """
SELECT s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number, s_city,
       s_county, s_state, s_zip,
  sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk <= 30 THEN 1 ELSE 0 END) AS days_30,
  sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 30 AND sr_returned_date_sk - ss_sold_date_sk <= 60 THEN 1 ELSE 0 END) AS days_31_60,
  sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 60 AND sr_returned_date_sk - ss_sold_date_sk <= 90 THEN 1 ELSE 0 END) AS days_61_90,
  sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 90 AND sr_returned_date_sk - ss_sold_date_sk <= 120 THEN 1 ELSE 0 END) AS days_91_120,
  sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 120 THEN 1 ELSE 0 END) AS days_over_120
FROM store_sales, store_returns, store, date_dim d1, date_dim d2
WHERE d2.d_year = 1999 AND d2.d_moy = 8 AND ss_ticket_number = sr_ticket_number AND ss_item_sk = sr_item_sk
  AND ss_sold_date_sk = d1.d_date_sk AND sr_returned_date_sk = d2.d_date_sk
  AND ss_customer_sk = sr_customer_sk AND ss_store_sk = s_store_sk
GROUP BY s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number,
         s_city, s_county, s_state, s_zip
ORDER BY s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number,
         s_city, s_county, s_state, s_zip LIMIT 100""")

q("q72", "catalog_sales inventory warehouse item customer_demographics household_demographics date_dim promotion catalog_returns", """
SELECT i_item_desc, w_warehouse_name, d1.d_week_seq AS d_week_seq,
       sum(CASE WHEN p_promo_sk IS NULL THEN 1 ELSE 0 END) AS no_promo,
       sum(CASE WHEN p_promo_sk IS NOT NULL THEN 1 ELSE 0 END) AS promo,
       count(*) AS total_cnt
FROM catalog_sales
JOIN inventory ON (cs_item_sk = inv_item_sk)
JOIN warehouse ON (w_warehouse_sk = inv_warehouse_sk)
JOIN item ON (i_item_sk = cs_item_sk)
JOIN customer_demographics ON (cs_bill_cdemo_sk = cd_demo_sk)
JOIN household_demographics ON (cs_bill_hdemo_sk = hd_demo_sk)
JOIN date_dim d1 ON (cs_sold_date_sk = d1.d_date_sk)
JOIN date_dim d2 ON (inv_date_sk = d2.d_date_sk)
JOIN date_dim d3 ON (cs_ship_date_sk = d3.d_date_sk)
LEFT OUTER JOIN promotion ON (cs_promo_sk = p_promo_sk)
LEFT OUTER JOIN catalog_returns ON (cr_item_sk = cs_item_sk AND cr_order_number = cs_order_number)
WHERE d1.d_week_seq = d2.d_week_seq AND inv_quantity_on_hand < cs_quantity AND d3.d_date > d1.d_date + 5
  AND hd_buy_potential = '>10000' AND d1.d_year = 1999 AND cd_marital_status = 'D'
GROUP BY i_item_desc, w_warehouse_name, d1.d_week_seq
ORDER BY total_cnt DESC, i_item_desc, w_warehouse_name, d_week_seq LIMIT 100""")


def _q75_branch(sales, rets, p, r, on_s, on_r, ramt):
    return f"""SELECT d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
         {p}_quantity - coalesce({r}_return_quantity, 0) AS sales_cnt,
         {p}_ext_sales_price - coalesce({ramt}, 0.0) AS sales_amt
  FROM {sales} JOIN item ON i_item_sk = {p}_item_sk JOIN date_dim ON d_date_sk = {p}_sold_date_sk
       LEFT JOIN {rets} ON ({on_s} = {on_r} AND {p}_item_sk = {r}_item_sk)
  WHERE i_category = 'gear'"""


q("q75", "catalog_sales catalog_returns store_sales store_returns web_sales web_returns item date_dim", f"""
WITH all_sales AS (
  SELECT d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
         sum(sales_cnt) AS sales_cnt, sum(sales_amt) AS sales_amt
  FROM ({_q75_branch('catalog_sales', 'catalog_returns', 'cs', 'cr', 'cs_order_number', 'cr_order_number', 'cr_return_amount')}
        UNION
        {_q75_branch('store_sales', 'store_returns', 'ss', 'sr', 'ss_ticket_number', 'sr_ticket_number', 'sr_return_amt')}
        UNION
        {_q75_branch('web_sales', 'web_returns', 'ws', 'wr', 'ws_order_number', 'wr_order_number', 'wr_return_amt')}) sales_detail
  GROUP BY d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id)
SELECT prev_yr.d_year AS prev_year, curr_yr.d_year AS year, curr_yr.i_brand_id, curr_yr.i_class_id,
       curr_yr.i_category_id, curr_yr.i_manufact_id, prev_yr.sales_cnt AS prev_yr_cnt,
       curr_yr.sales_cnt AS curr_yr_cnt, curr_yr.sales_cnt - prev_yr.sales_cnt AS sales_cnt_diff,
       CAST(curr_yr.sales_amt - prev_yr.sales_amt AS DOUBLE) AS sales_amt_diff
FROM all_sales curr_yr, all_sales prev_yr
WHERE curr_yr.i_brand_id = prev_yr.i_brand_id AND curr_yr.i_class_id = prev_yr.i_class_id
  AND curr_yr.i_category_id = prev_yr.i_category_id AND curr_yr.i_manufact_id = prev_yr.i_manufact_id
  AND curr_yr.d_year = 2000 AND prev_yr.d_year = 2000 - 1
  AND CASE WHEN prev_yr.sales_cnt <> 0 THEN CAST(curr_yr.sales_cnt AS DOUBLE) / CAST(prev_yr.sales_cnt AS DOUBLE) END < 0.9
ORDER BY sales_cnt_diff, sales_amt_diff, i_brand_id, i_class_id, i_category_id, i_manufact_id LIMIT 100""")


def _q78_cte(name, sales, rets, p, r, on_s, on_r, cust):
    return f"""{name} AS (
  SELECT d_year AS {p}_sold_year, {p}_item_sk, {cust} AS {p}_customer_sk, sum({p}_quantity) AS {p}_qty,
         sum({p}_wholesale_cost) AS {p}_wc, sum({p}_sales_price) AS {p}_sp
  FROM {sales} LEFT JOIN {rets} ON {on_r} = {on_s} AND {p}_item_sk = {r}_item_sk
       JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  WHERE {on_r} IS NULL
  GROUP BY d_year, {p}_item_sk, {cust})"""


q("q78", "store_sales store_returns web_sales web_returns catalog_sales catalog_returns date_dim", f"""
WITH {_q78_cte('ws', 'web_sales', 'web_returns', 'ws', 'wr', 'ws_order_number', 'wr_order_number', 'ws_bill_customer_sk')},
{_q78_cte('cs', 'catalog_sales', 'catalog_returns', 'cs', 'cr', 'cs_order_number', 'cr_order_number', 'cs_bill_customer_sk')},
{_q78_cte('ss', 'store_sales', 'store_returns', 'ss', 'sr', 'ss_ticket_number', 'sr_ticket_number', 'ss_customer_sk')}
SELECT ss_sold_year, ss_item_sk, ss_customer_sk,
  CASE WHEN coalesce(ws_qty, 0) + coalesce(cs_qty, 0) > 0
       THEN ((ss_qty * 200 + coalesce(ws_qty, 0) + coalesce(cs_qty, 0)) // ((coalesce(ws_qty, 0) + coalesce(cs_qty, 0)) * 2)) / 100.0 END AS ratio,
  ss_qty AS store_qty, CAST(ss_wc AS DOUBLE) AS store_wholesale_cost, CAST(ss_sp AS DOUBLE) AS store_sales_price,
  coalesce(ws_qty, 0) + coalesce(cs_qty, 0) AS other_chan_qty,
  CAST(coalesce(ws_wc, 0) + coalesce(cs_wc, 0) AS DOUBLE) AS other_chan_wholesale_cost,
  CAST(coalesce(ws_sp, 0) + coalesce(cs_sp, 0) AS DOUBLE) AS other_chan_sales_price
FROM ss LEFT JOIN ws ON (ws_sold_year = ss_sold_year AND ws_item_sk = ss_item_sk AND ws_customer_sk = ss_customer_sk)
        LEFT JOIN cs ON (cs_sold_year = ss_sold_year AND cs_item_sk = ss_item_sk AND cs_customer_sk = ss_customer_sk)
WHERE (coalesce(ws_qty, 0) > 0 OR coalesce(cs_qty, 0) > 0) AND ss_sold_year = 2000
ORDER BY ss_sold_year, ss_item_sk, ss_customer_sk, store_qty DESC, store_wholesale_cost DESC, store_sales_price DESC,
         other_chan_qty, other_chan_wholesale_cost, other_chan_sales_price, ratio LIMIT 100""")


def _q80_cte(name, sales, rets, p, r, on_s, on_r, ramt, rloss, outlet, okey, oid, fk):
    return f"""{name} AS (
  SELECT {oid} AS oid, sum({p}_ext_sales_price) AS sales, sum(coalesce({ramt}, 0)) AS returns_,
         sum({p}_net_profit - coalesce({rloss}, 0)) AS profit
  FROM {sales} LEFT OUTER JOIN {rets} ON ({p}_item_sk = {r}_item_sk AND {on_s} = {on_r}),
       date_dim, {outlet}, item, promotion
  WHERE {p}_sold_date_sk = d_date_sk AND d_date BETWEEN DATE '2000-08-23' AND DATE '2000-08-23' + 30
    AND {fk} = {okey} AND {p}_item_sk = i_item_sk AND i_current_price > 20
    AND {p}_promo_sk = p_promo_sk AND p_channel_tv = 'N'
  GROUP BY {oid})"""


q("q80", "store_sales store_returns catalog_sales catalog_returns web_sales web_returns date_dim store catalog_page web_site item promotion", f"""
WITH {_q80_cte('ssr', 'store_sales', 'store_returns', 'ss', 'sr', 'ss_ticket_number', 'sr_ticket_number', 'sr_return_amt', 'sr_net_loss', 'store', 's_store_sk', 's_store_id', 'ss_store_sk')},
{_q80_cte('csr', 'catalog_sales', 'catalog_returns', 'cs', 'cr', 'cs_order_number', 'cr_order_number', 'cr_return_amount', 'cr_net_loss', 'catalog_page', 'cp_catalog_page_sk', 'cp_catalog_page_id', 'cs_catalog_page_sk')},
{_q80_cte('wsr', 'web_sales', 'web_returns', 'ws', 'wr', 'ws_order_number', 'wr_order_number', 'wr_return_amt', 'wr_net_loss', 'web_site', 'web_site_sk', 'web_site_id', 'ws_web_site_sk')}
SELECT channel, id, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(returns_) AS DOUBLE) AS returns,
       CAST(sum(profit) AS DOUBLE) AS profit
FROM (SELECT 'store channel' AS channel, 'store' || oid AS id, sales, returns_, profit FROM ssr
      UNION ALL SELECT 'catalog channel', 'catalog_page' || oid, sales, returns_, profit FROM csr
      UNION ALL SELECT 'web channel', 'web_site' || oid, sales, returns_, profit FROM wsr) x
GROUP BY ROLLUP (channel, id)
ORDER BY channel, id, sales, returns, profit LIMIT 100""")

q("q85", "web_sales web_returns web_page customer_demographics customer_address date_dim reason", """
SELECT substr(r_reason_desc, 1, 20) AS reason,
       CAST(sum(ws_quantity) AS DOUBLE) / count(ws_quantity) AS avg_qty,
       CAST(sum(wr_refunded_cash) AS DOUBLE) / count(wr_refunded_cash) AS avg_refund,
       CAST(sum(wr_fee) AS DOUBLE) / count(wr_fee) AS avg_fee
FROM web_sales, web_returns, web_page, customer_demographics cd1, customer_demographics cd2,
     customer_address, date_dim, reason
WHERE ws_web_page_sk = wp_web_page_sk AND ws_item_sk = wr_item_sk AND ws_order_number = wr_order_number
  AND ws_sold_date_sk = d_date_sk AND d_year = 2000 AND cd1.cd_demo_sk = wr_refunded_cdemo_sk
  AND cd2.cd_demo_sk = wr_returning_cdemo_sk AND ca_address_sk = wr_refunded_addr_sk AND r_reason_sk = wr_reason_sk
  AND ((cd1.cd_marital_status = 'M' AND cd1.cd_marital_status = cd2.cd_marital_status
        AND cd1.cd_education_status = 'Advanced Degree' AND cd1.cd_education_status = cd2.cd_education_status
        AND ws_sales_price BETWEEN 100.00 AND 150.00)
    OR (cd1.cd_marital_status = 'S' AND cd1.cd_marital_status = cd2.cd_marital_status
        AND cd1.cd_education_status = 'College' AND cd1.cd_education_status = cd2.cd_education_status
        AND ws_sales_price BETWEEN 50.00 AND 100.00)
    OR (cd1.cd_marital_status = 'W' AND cd1.cd_marital_status = cd2.cd_marital_status
        AND cd1.cd_education_status = '2 yr Degree' AND cd1.cd_education_status = cd2.cd_education_status
        AND ws_sales_price BETWEEN 150.00 AND 200.00))
  AND ((ca_country = 'United States' AND ca_state IN ('IN', 'IL', 'KY') AND ws_net_profit BETWEEN 100 AND 200)
    OR (ca_country = 'United States' AND ca_state IN ('CT', 'MA', 'MD') AND ws_net_profit BETWEEN 150 AND 300)
    OR (ca_country = 'United States' AND ca_state IN ('LA', 'IA', 'AR') AND ws_net_profit BETWEEN 50 AND 250))
GROUP BY r_reason_desc
ORDER BY reason, avg_qty, avg_refund, avg_fee LIMIT 100""")

q("q93", "store_sales store_returns reason", """
SELECT ss_customer_sk, CAST(sum(act_sales) AS DOUBLE) AS sumsales
FROM (SELECT ss_item_sk, ss_ticket_number, ss_customer_sk,
             CASE WHEN sr_return_quantity IS NOT NULL THEN (ss_quantity - sr_return_quantity) * ss_sales_price
                  ELSE (ss_quantity * ss_sales_price) END AS act_sales
      FROM store_sales LEFT OUTER JOIN store_returns ON (sr_item_sk = ss_item_sk AND sr_ticket_number = ss_ticket_number),
           reason
      WHERE sr_reason_sk = r_reason_sk AND r_reason_desc = 'reason 28') t
GROUP BY ss_customer_sk ORDER BY sumsales, ss_customer_sk LIMIT 100""")

_Q8Z = ", ".join(f"'{z}'" for z in sorted({str(10000 + 100 * n + k) for n in range(25) for k in range(3)}
                                         | {str(z) for z in range(20000, 20325)}))
q("q08", "store_sales date_dim store customer_address customer", f"""
SELECT s_store_name, CAST(sum(ss_net_profit) AS DOUBLE) AS net_profit
FROM store_sales, date_dim, store,
     (SELECT ca_zip FROM (
        SELECT substr(ca_zip, 1, 5) AS ca_zip FROM customer_address WHERE substr(ca_zip, 1, 5) IN ({_Q8Z})
        INTERSECT
        SELECT ca_zip FROM (SELECT substr(ca_zip, 1, 5) AS ca_zip, count(*) AS cnt
                            FROM customer_address, customer
                            WHERE ca_address_sk = c_current_addr_sk AND c_preferred_cust_flag = 'Y'
                            GROUP BY ca_zip HAVING count(*) > 3) a1) a2) v1
WHERE ss_store_sk = s_store_sk AND ss_sold_date_sk = d_date_sk AND d_qoy = 2 AND d_year = 1998
  AND substr(s_zip, 1, 2) = substr(v1.ca_zip, 1, 2)
GROUP BY s_store_name ORDER BY s_store_name LIMIT 100""")


def _exists(fact, p, cust, period):
    return f"EXISTS (SELECT * FROM {fact}, date_dim WHERE c.c_customer_sk = {cust} AND {p}_sold_date_sk = d_date_sk AND {period})"


_Q10_SEL = """cd_gender, cd_marital_status, cd_education_status, count(*) AS cnt1, cd_purchase_estimate,
       count(*) AS cnt2, cd_credit_rating, count(*) AS cnt3, cd_dep_count, count(*) AS cnt4,
       cd_dep_employed_count, count(*) AS cnt5, cd_dep_college_count, count(*) AS cnt6"""
_Q10_GRP = """cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating,
         cd_dep_count, cd_dep_employed_count, cd_dep_college_count"""
_Q10_P = "d_year = 1999 AND d_moy BETWEEN 1 AND 4"
_Q10_C = "('NATION_1 County', 'NATION_5 County', 'NATION_9 County', 'NATION_13 County', 'NATION_17 County')"
q("q10", "customer customer_address customer_demographics store_sales web_sales catalog_sales date_dim", f"""
SELECT {_Q10_SEL}
FROM customer c, customer_address ca, customer_demographics
WHERE c.c_current_addr_sk = ca.ca_address_sk AND ca_county IN {_Q10_C} AND cd_demo_sk = c.c_current_cdemo_sk
  AND {_exists('store_sales', 'ss', 'ss_customer_sk', _Q10_P)}
  AND ({_exists('web_sales', 'ws', 'ws_bill_customer_sk', _Q10_P)}
       OR {_exists('catalog_sales', 'cs', 'cs_ship_customer_sk', _Q10_P)})
GROUP BY {_Q10_GRP}
ORDER BY {_Q10_GRP} LIMIT 100""")
q("q10a", "customer customer_address customer_demographics store_sales web_sales catalog_sales date_dim", f"""
SELECT {_Q10_SEL}
FROM customer c, customer_address ca, customer_demographics
WHERE c.c_current_addr_sk = ca.ca_address_sk AND ca_county IN {_Q10_C} AND cd_demo_sk = c.c_current_cdemo_sk
  AND {_exists('store_sales', 'ss', 'ss_customer_sk', _Q10_P)}
  AND EXISTS (SELECT * FROM (SELECT ws_bill_customer_sk AS customer_sk, d_year, d_moy FROM web_sales, date_dim
                              WHERE ws_sold_date_sk = d_date_sk AND {_Q10_P}
                             UNION ALL
                             SELECT cs_ship_customer_sk AS customer_sk, d_year, d_moy FROM catalog_sales, date_dim
                              WHERE cs_sold_date_sk = d_date_sk AND {_Q10_P}) x
              WHERE c.c_customer_sk = x.customer_sk)
GROUP BY {_Q10_GRP}
ORDER BY {_Q10_GRP} LIMIT 100""")

_Q35_SEL = """ca_state, cd_gender, cd_marital_status, cd_dep_count, count(*) AS cnt1,
       CAST(sum(cd_dep_count) AS DOUBLE) / count(cd_dep_count) AS avg1, max(cd_dep_count) AS max1, sum(cd_dep_count) AS sum1,
       cd_dep_employed_count, count(*) AS cnt2,
       CAST(sum(cd_dep_employed_count) AS DOUBLE) / count(cd_dep_employed_count) AS avg2, max(cd_dep_employed_count) AS max2,
       sum(cd_dep_employed_count) AS sum2, cd_dep_college_count, count(*) AS cnt3,
       CAST(sum(cd_dep_college_count) AS DOUBLE) / count(cd_dep_college_count) AS avg3, max(cd_dep_college_count) AS max3,
       sum(cd_dep_college_count) AS sum3"""
_Q35_GRP = "ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count"
_Q35_P = "d_year = 1999 AND d_qoy < 4"
q("q35", "customer customer_address customer_demographics store_sales web_sales catalog_sales date_dim", f"""
SELECT {_Q35_SEL}
FROM customer c, customer_address ca, customer_demographics
WHERE c.c_current_addr_sk = ca.ca_address_sk AND cd_demo_sk = c.c_current_cdemo_sk
  AND {_exists('store_sales', 'ss', 'ss_customer_sk', _Q35_P)}
  AND ({_exists('web_sales', 'ws', 'ws_bill_customer_sk', _Q35_P)}
       OR {_exists('catalog_sales', 'cs', 'cs_ship_customer_sk', _Q35_P)})
GROUP BY {_Q35_GRP}
ORDER BY {_Q35_GRP} LIMIT 100""")
q("q35a", "customer customer_address customer_demographics store_sales web_sales catalog_sales date_dim", f"""
SELECT {_Q35_SEL}
FROM customer c, customer_address ca, customer_demographics
WHERE c.c_current_addr_sk = ca.ca_address_sk AND cd_demo_sk = c.c_current_cdemo_sk
  AND {_exists('store_sales', 'ss', 'ss_customer_sk', _Q35_P)}
  AND EXISTS (SELECT * FROM (SELECT ws_bill_customer_sk AS customer_sk FROM web_sales, date_dim
                              WHERE ws_sold_date_sk = d_date_sk AND {_Q35_P}
                             UNION ALL
                             SELECT cs_ship_customer_sk AS customer_sk FROM catalog_sales, date_dim
                              WHERE cs_sold_date_sk = d_date_sk AND {_Q35_P}) x
              WHERE c.c_customer_sk = x.customer_sk)
GROUP BY {_Q35_GRP}
ORDER BY {_Q35_GRP} LIMIT 100""")

_Q69_P = "d_year = 2001 AND d_moy BETWEEN 4 AND 4 + 2"
q("q69", "customer customer_address customer_demographics store_sales web_sales catalog_sales date_dim", f"""
SELECT cd_gender, cd_marital_status, cd_education_status, count(*) AS cnt1, cd_purchase_estimate,
       count(*) AS cnt2, cd_credit_rating, count(*) AS cnt3
FROM customer c, customer_address ca, customer_demographics
WHERE c.c_current_addr_sk = ca.ca_address_sk AND ca_state IN ('KS', 'KY', 'MA', 'MD', 'IA')
  AND cd_demo_sk = c.c_current_cdemo_sk
  AND {_exists('store_sales', 'ss', 'ss_customer_sk', _Q69_P)}
  AND (NOT {_exists('web_sales', 'ws', 'ws_bill_customer_sk', _Q69_P)}
       AND NOT {_exists('catalog_sales', 'cs', 'cs_ship_customer_sk', _Q69_P)})
GROUP BY cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating
ORDER BY cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating LIMIT 100""")


def _named(fact, p, cust, month_seq=1176):
    return f"""SELECT DISTINCT c_last_name, c_first_name, d_date FROM {fact}, date_dim, customer
  WHERE {p}_sold_date_sk = d_date_sk AND {cust} = c_customer_sk AND d_month_seq BETWEEN {month_seq} AND {month_seq} + 11"""


_TN = "store_sales catalog_sales web_sales date_dim customer"
q("q38", _TN, f"""
SELECT count(*) AS cnt FROM (
  {_named('store_sales', 'ss', 'ss_customer_sk', 1164)}
  INTERSECT {_named('catalog_sales', 'cs', 'cs_bill_customer_sk', 1164)}
  INTERSECT {_named('web_sales', 'ws', 'ws_bill_customer_sk', 1164)}) hot_cust""")
q("q87", _TN, f"""
SELECT count(*) AS cnt FROM (
  ({_named('store_sales', 'ss', 'ss_customer_sk')})
  EXCEPT ({_named('catalog_sales', 'cs', 'cs_bill_customer_sk')})
  EXCEPT ({_named('web_sales', 'ws', 'ws_bill_customer_sk')})) cool_cust""")

q("q16", "catalog_sales date_dim customer_address call_center catalog_returns", """
SELECT count(DISTINCT cs_order_number) AS order_count, CAST(sum(cs_ext_ship_cost) AS DOUBLE) AS total_shipping_cost,
       CAST(sum(cs_net_profit) AS DOUBLE) AS total_net_profit
FROM catalog_sales cs1, date_dim, customer_address, call_center
WHERE d_date BETWEEN DATE '2000-02-01' AND DATE '2000-02-01' + 60 AND cs1.cs_ship_date_sk = d_date_sk
  AND cs1.cs_ship_addr_sk = ca_address_sk AND ca_state = 'IL' AND cs1.cs_call_center_sk = cc_call_center_sk
  AND cc_county IN ('NATION_0 County', 'NATION_4 County', 'NATION_8 County', 'NATION_12 County',
                    'NATION_16 County', 'NATION_20 County')
  AND EXISTS (SELECT * FROM catalog_sales cs2
              WHERE cs1.cs_order_number = cs2.cs_order_number AND cs1.cs_warehouse_sk <> cs2.cs_warehouse_sk)
  AND NOT EXISTS (SELECT * FROM catalog_returns cr1 WHERE cs1.cs_order_number = cr1.cr_order_number)""")

q("q94", "web_sales date_dim customer_address web_site web_returns", """
SELECT count(DISTINCT ws_order_number) AS order_count, CAST(sum(ws_ext_ship_cost) AS DOUBLE) AS total_shipping_cost,
       CAST(sum(ws_net_profit) AS DOUBLE) AS total_net_profit
FROM web_sales ws1, date_dim, customer_address, web_site
WHERE d_date BETWEEN DATE '1999-02-01' AND DATE '1999-02-01' + 60 AND ws1.ws_ship_date_sk = d_date_sk
  AND ws1.ws_ship_addr_sk = ca_address_sk AND ca_state = 'IL' AND ws1.ws_web_site_sk = web_site_sk
  AND web_company_name = 'company 2'
  AND EXISTS (SELECT * FROM web_sales ws2
              WHERE ws1.ws_order_number = ws2.ws_order_number AND ws1.ws_warehouse_sk <> ws2.ws_warehouse_sk)
  AND NOT EXISTS (SELECT * FROM web_returns wr1 WHERE ws1.ws_order_number = wr1.wr_order_number)""")

q("q95", "web_sales date_dim customer_address web_site web_returns", """
WITH ws_wh AS (SELECT ws1.ws_order_number, ws1.ws_warehouse_sk AS wh1, ws2.ws_warehouse_sk AS wh2
               FROM web_sales ws1, web_sales ws2
               WHERE ws1.ws_order_number = ws2.ws_order_number AND ws1.ws_warehouse_sk <> ws2.ws_warehouse_sk)
SELECT count(DISTINCT ws_order_number) AS order_count, CAST(sum(ws_ext_ship_cost) AS DOUBLE) AS total_shipping_cost,
       CAST(sum(ws_net_profit) AS DOUBLE) AS total_net_profit
FROM web_sales ws1, date_dim, customer_address, web_site
WHERE d_date BETWEEN DATE '1999-02-01' AND DATE '1999-02-01' + 60 AND ws1.ws_ship_date_sk = d_date_sk
  AND ws1.ws_ship_addr_sk = ca_address_sk AND ca_state = 'IL' AND ws1.ws_web_site_sk = web_site_sk
  AND web_company_name = 'company 2'
  AND ws1.ws_order_number IN (SELECT ws_order_number FROM ws_wh)
  AND ws1.ws_order_number IN (SELECT wr_order_number FROM web_returns, ws_wh WHERE wr_order_number = ws_wh.ws_order_number)""")

q("q97", "store_sales catalog_sales date_dim", """
WITH ssci AS (SELECT ss_customer_sk AS customer_sk, ss_item_sk AS item_sk FROM store_sales, date_dim
              WHERE ss_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11
              GROUP BY ss_customer_sk, ss_item_sk),
     csci AS (SELECT cs_bill_customer_sk AS customer_sk, cs_item_sk AS item_sk FROM catalog_sales, date_dim
              WHERE cs_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11
              GROUP BY cs_bill_customer_sk, cs_item_sk)
SELECT sum(CASE WHEN ssci.customer_sk IS NOT NULL AND csci.customer_sk IS NULL THEN 1 ELSE 0 END) AS store_only,
       sum(CASE WHEN ssci.customer_sk IS NULL AND csci.customer_sk IS NOT NULL THEN 1 ELSE 0 END) AS catalog_only,
       sum(CASE WHEN ssci.customer_sk IS NOT NULL AND csci.customer_sk IS NOT NULL THEN 1 ELSE 0 END) AS store_and_catalog
FROM ssci FULL OUTER JOIN csci ON (ssci.customer_sk = csci.customer_sk AND ssci.item_sk = csci.item_sk)""")

q("q54", "catalog_sales web_sales item date_dim customer store_sales customer_address store", """
WITH my_customers AS (
  SELECT DISTINCT c_customer_sk, c_current_addr_sk
  FROM (SELECT cs_sold_date_sk AS sold_date_sk, cs_bill_customer_sk AS customer_sk, cs_item_sk AS item_sk FROM catalog_sales
        UNION ALL SELECT ws_sold_date_sk, ws_bill_customer_sk, ws_item_sk FROM web_sales) cs_or_ws_sales,
       item, date_dim, customer
  WHERE sold_date_sk = d_date_sk AND item_sk = i_item_sk AND i_category = 'gear' AND i_class = 'economy'
    AND c_customer_sk = cs_or_ws_sales.customer_sk AND d_moy = 12 AND d_year = 1998),
my_revenue AS (
  SELECT c_customer_sk, sum(ss_ext_sales_price) AS revenue
  FROM my_customers, store_sales, customer_address, store, date_dim
  WHERE c_current_addr_sk = ca_address_sk AND ca_county = s_county AND ca_state = s_state
    AND ss_sold_date_sk = d_date_sk AND c_customer_sk = ss_customer_sk
    AND d_month_seq BETWEEN (SELECT DISTINCT d_month_seq + 1 FROM date_dim WHERE d_year = 1998 AND d_moy = 12)
                        AND (SELECT DISTINCT d_month_seq + 3 FROM date_dim WHERE d_year = 1998 AND d_moy = 12)
  GROUP BY c_customer_sk),
segments AS (SELECT (2 * CAST(revenue * 100 AS BIGINT) + 5000) // 10000 AS segment FROM my_revenue)
SELECT segment, count(*) AS num_customers, segment * 50 AS segment_base
FROM segments GROUP BY segment ORDER BY segment, num_customers LIMIT 100""")


def _q14_ctes(y0):
    def ks(fact, p):
        return (f"SELECT i_brand_id AS brand_id, i_class_id AS class_id, i_category_id AS category_id "
                f"FROM {fact}, item, date_dim WHERE {p}_item_sk = i_item_sk AND {p}_sold_date_sk = d_date_sk "
                f"AND d_year BETWEEN {y0} AND {y0} + 2")
    return f"""
WITH cross_items AS (
  SELECT i_item_sk AS ss_item_sk FROM item,
    ({ks('store_sales', 'ss')} INTERSECT {ks('catalog_sales', 'cs')} INTERSECT {ks('web_sales', 'ws')}) x
  WHERE i_brand_id = brand_id AND i_class_id = class_id AND i_category_id = category_id),
avg_sales AS (
  SELECT CAST(sum(quantity * list_price) AS DOUBLE) / count(quantity * list_price) AS average_sales
  FROM (SELECT ss_quantity AS quantity, ss_list_price AS list_price FROM store_sales, date_dim
        WHERE ss_sold_date_sk = d_date_sk AND d_year BETWEEN {y0} AND {y0} + 2
        UNION ALL SELECT cs_quantity, cs_list_price FROM catalog_sales, date_dim
        WHERE cs_sold_date_sk = d_date_sk AND d_year BETWEEN {y0} AND {y0} + 2
        UNION ALL SELECT ws_quantity, ws_list_price FROM web_sales, date_dim
        WHERE ws_sold_date_sk = d_date_sk AND d_year BETWEEN {y0} AND {y0} + 2) x)"""


def _q14_branch(ch, fact, p, date_cond):
    return f"""SELECT '{ch}' AS channel, i_brand_id, i_class_id, i_category_id,
         sum({p}_quantity * {p}_list_price) AS sales, count(*) AS number_sales
  FROM {fact}, item, date_dim
  WHERE {p}_item_sk IN (SELECT ss_item_sk FROM cross_items) AND {p}_item_sk = i_item_sk
    AND {p}_sold_date_sk = d_date_sk AND {date_cond}
  GROUP BY i_brand_id, i_class_id, i_category_id
  HAVING CAST(sum({p}_quantity * {p}_list_price) AS DOUBLE) > (SELECT average_sales FROM avg_sales)"""


_Q14_D = "d_year = 1998 + 2 AND d_moy = 11"
_Q14_Y = f"""({_q14_branch('store', 'store_sales', 'ss', _Q14_D)}
  UNION ALL {_q14_branch('catalog', 'catalog_sales', 'cs', _Q14_D)}
  UNION ALL {_q14_branch('web', 'web_sales', 'ws', _Q14_D)}) y"""
_T14 = "store_sales catalog_sales web_sales item date_dim"
q("q14_1", _T14, _q14_ctes(1998) + f"""
SELECT channel, i_brand_id, i_class_id, i_category_id, CAST(sum(sales) AS DOUBLE) AS sum_sales,
       sum(number_sales) AS sum_number_sales
FROM {_Q14_Y}
GROUP BY ROLLUP (channel, i_brand_id, i_class_id, i_category_id)
ORDER BY channel, i_brand_id, i_class_id, i_category_id, sum_sales, sum_number_sales LIMIT 100""")
q("q14a", _T14, _q14_ctes(1998) + f""",
y AS (SELECT * FROM {_Q14_Y})
SELECT * FROM (
  SELECT channel, i_brand_id, i_class_id, i_category_id, CAST(sum(sales) AS DOUBLE) AS sum_sales, sum(number_sales) AS sum_number_sales
  FROM y GROUP BY channel, i_brand_id, i_class_id, i_category_id
  UNION ALL SELECT channel, i_brand_id, i_class_id, NULL, CAST(sum(sales) AS DOUBLE), sum(number_sales)
  FROM y GROUP BY channel, i_brand_id, i_class_id
  UNION ALL SELECT channel, i_brand_id, NULL, NULL, CAST(sum(sales) AS DOUBLE), sum(number_sales)
  FROM y GROUP BY channel, i_brand_id
  UNION ALL SELECT channel, NULL, NULL, NULL, CAST(sum(sales) AS DOUBLE), sum(number_sales) FROM y GROUP BY channel
  UNION ALL SELECT NULL, NULL, NULL, NULL, CAST(sum(sales) AS DOUBLE), sum(number_sales) FROM y) z
ORDER BY channel, i_brand_id, i_class_id, i_category_id, sum_sales, sum_number_sales LIMIT 100""")

_WK = lambda y: f"d_week_seq = (SELECT d_week_seq FROM date_dim WHERE d_year = {y} AND d_moy = 12 AND d_dom = 11)"
q("q14_2", _T14, _q14_ctes(1998) + f"""
SELECT this_year.channel AS ty_channel, this_year.i_brand_id AS ty_brand, this_year.i_class_id AS ty_class,
       this_year.i_category_id AS ty_category, CAST(this_year.sales AS DOUBLE) AS ty_sales,
       this_year.number_sales AS ty_number_sales, last_year.channel AS ly_channel, last_year.i_brand_id AS ly_brand,
       last_year.i_class_id AS ly_class, last_year.i_category_id AS ly_category,
       CAST(last_year.sales AS DOUBLE) AS ly_sales, last_year.number_sales AS ly_number_sales
FROM ({_q14_branch('store', 'store_sales', 'ss', _WK(1999))}) this_year,
     ({_q14_branch('store', 'store_sales', 'ss', _WK(1998))}) last_year
WHERE this_year.i_brand_id = last_year.i_brand_id AND this_year.i_class_id = last_year.i_class_id
  AND this_year.i_category_id = last_year.i_category_id
ORDER BY ty_channel, ty_brand, ty_class, ty_category LIMIT 100""")


_Q23_CTES = """
WITH frequent_ss_items AS (
  SELECT substr(i_item_desc, 1, 30) AS itemdesc, i_item_sk AS item_sk, d_date AS solddate, count(*) AS cnt
  FROM store_sales, date_dim, item
  WHERE ss_sold_date_sk = d_date_sk AND ss_item_sk = i_item_sk AND d_year IN (2000, 2000 + 1, 2000 + 2, 2000 + 3)
  GROUP BY substr(i_item_desc, 1, 30), i_item_sk, d_date HAVING count(*) > 1),
max_store_sales AS (
  SELECT max(csales) AS best_csales
  FROM (SELECT c_customer_sk, sum(ss_quantity * ss_sales_price) AS csales FROM store_sales, customer, date_dim
        WHERE ss_customer_sk = c_customer_sk AND ss_sold_date_sk = d_date_sk AND d_year IN (2000, 2000 + 1, 2000 + 2, 2000 + 3)
        GROUP BY c_customer_sk) x),
best_ss_customer AS (
  SELECT c_customer_sk, sum(ss_quantity * ss_sales_price) AS ssales FROM store_sales, customer
  WHERE ss_customer_sk = c_customer_sk GROUP BY c_customer_sk
  HAVING CAST(sum(ss_quantity * ss_sales_price) AS DOUBLE) > 0.3 * CAST((SELECT * FROM max_store_sales) AS DOUBLE))"""


def _q23_branch(fact, p, extra_from="", extra_where="", sel=None):
    sel = sel or f"{p}_quantity * {p}_list_price AS sales"
    return f"""SELECT {sel} FROM {fact}, date_dim{extra_from}
  WHERE d_year = 2000 AND d_moy = 2 AND {p}_sold_date_sk = d_date_sk
    AND {p}_item_sk IN (SELECT item_sk FROM frequent_ss_items)
    AND {p}_bill_customer_sk IN (SELECT c_customer_sk FROM best_ss_customer){extra_where}"""


_T23 = "store_sales catalog_sales web_sales date_dim item customer"
q("q23_1", _T23, _Q23_CTES + f"""
SELECT CAST(sum(sales) AS DOUBLE) AS sum_sales
FROM ({_q23_branch('catalog_sales', 'cs')} UNION ALL {_q23_branch('web_sales', 'ws')}) x""")
q("q23_2", _T23, _Q23_CTES + f"""
SELECT c_last_name, c_first_name, sales FROM (
  SELECT c_last_name, c_first_name, CAST(sum(cs_quantity * cs_list_price) AS DOUBLE) AS sales
  FROM catalog_sales, customer, date_dim
  WHERE d_year = 2000 AND d_moy = 2 AND cs_sold_date_sk = d_date_sk
    AND cs_item_sk IN (SELECT item_sk FROM frequent_ss_items)
    AND cs_bill_customer_sk IN (SELECT c_customer_sk FROM best_ss_customer) AND cs_bill_customer_sk = c_customer_sk
  GROUP BY c_last_name, c_first_name
  UNION ALL
  SELECT c_last_name, c_first_name, CAST(sum(ws_quantity * ws_list_price) AS DOUBLE) AS sales
  FROM web_sales, customer, date_dim
  WHERE d_year = 2000 AND d_moy = 2 AND ws_sold_date_sk = d_date_sk
    AND ws_item_sk IN (SELECT item_sk FROM frequent_ss_items)
    AND ws_bill_customer_sk IN (SELECT c_customer_sk FROM best_ss_customer) AND ws_bill_customer_sk = c_customer_sk
  GROUP BY c_last_name, c_first_name) y
ORDER BY c_last_name, c_first_name, sales LIMIT 100""")


def _q05_body(group_sql):
    return f"""
WITH ssr AS (
  SELECT s_store_id, sum(sales_price) AS sales, sum(profit) AS profit, sum(return_amt) AS returns_, sum(net_loss) AS profit_loss
  FROM (SELECT ss_store_sk AS store_sk, ss_sold_date_sk AS date_sk, ss_ext_sales_price AS sales_price,
               ss_net_profit AS profit, CAST(0 AS DECIMAL(7,2)) AS return_amt, CAST(0 AS DECIMAL(7,2)) AS net_loss
        FROM store_sales
        UNION ALL
        SELECT sr_store_sk, sr_returned_date_sk, CAST(0 AS DECIMAL(7,2)), CAST(0 AS DECIMAL(7,2)), sr_return_amt, sr_net_loss
        FROM store_returns) salesreturns, date_dim, store
  WHERE date_sk = d_date_sk AND d_date BETWEEN DATE '2000-08-23' AND DATE '2000-08-23' + 14 AND store_sk = s_store_sk
  GROUP BY s_store_id),
csr AS (
  SELECT cp_catalog_page_id, sum(sales_price) AS sales, sum(profit) AS profit, sum(return_amt) AS returns_, sum(net_loss) AS profit_loss
  FROM (SELECT cs_catalog_page_sk AS page_sk, cs_sold_date_sk AS date_sk, cs_ext_sales_price AS sales_price,
               cs_net_profit AS profit, CAST(0 AS DECIMAL(7,2)) AS return_amt, CAST(0 AS DECIMAL(7,2)) AS net_loss
        FROM catalog_sales
        UNION ALL
        SELECT cr_catalog_page_sk, cr_returned_date_sk, CAST(0 AS DECIMAL(7,2)), CAST(0 AS DECIMAL(7,2)), cr_return_amount, cr_net_loss
        FROM catalog_returns) salesreturns, date_dim, catalog_page
  WHERE date_sk = d_date_sk AND d_date BETWEEN DATE '2000-08-23' AND DATE '2000-08-23' + 14 AND page_sk = cp_catalog_page_sk
  GROUP BY cp_catalog_page_id),
wsr AS (
  SELECT web_site_id, sum(sales_price) AS sales, sum(profit) AS profit, sum(return_amt) AS returns_, sum(net_loss) AS profit_loss
  FROM (SELECT ws_web_site_sk AS wsr_web_site_sk, ws_sold_date_sk AS date_sk, ws_ext_sales_price AS sales_price,
               ws_net_profit AS profit, CAST(0 AS DECIMAL(7,2)) AS return_amt, CAST(0 AS DECIMAL(7,2)) AS net_loss
        FROM web_sales
        UNION ALL
        SELECT ws_web_site_sk, wr_returned_date_sk, CAST(0 AS DECIMAL(7,2)), CAST(0 AS DECIMAL(7,2)), wr_return_amt, wr_net_loss
        FROM web_returns LEFT OUTER JOIN web_sales ON (wr_item_sk = ws_item_sk AND wr_order_number = ws_order_number)
       ) salesreturns, date_dim, web_site
  WHERE date_sk = d_date_sk AND d_date BETWEEN DATE '2000-08-23' AND DATE '2000-08-23' + 14 AND wsr_web_site_sk = web_site_sk
  GROUP BY web_site_id),
x AS (SELECT 'store channel' AS channel, 'store' || s_store_id AS id, sales, returns_, profit - profit_loss AS profit FROM ssr
      UNION ALL SELECT 'catalog channel', 'catalog_page' || cp_catalog_page_id, sales, returns_, profit - profit_loss FROM csr
      UNION ALL SELECT 'web channel', 'web_site' || web_site_id, sales, returns_, profit - profit_loss FROM wsr)
{group_sql}
ORDER BY channel, id, sales, returns, profit LIMIT 100"""


_MT = "CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(returns_) AS DOUBLE) AS returns, CAST(sum(profit) AS DOUBLE) AS profit"
_T5 = "store_sales store_returns catalog_sales catalog_returns web_sales web_returns date_dim store catalog_page web_site"
q("q05", _T5, _q05_body(f"SELECT channel, id, {_MT} FROM x GROUP BY ROLLUP (channel, id)"))
q("q05a", _T5, _q05_body(f"""SELECT * FROM (
  SELECT channel, id, {_MT} FROM x GROUP BY channel, id
  UNION ALL SELECT channel, NULL, {_MT} FROM x GROUP BY channel
  UNION ALL SELECT NULL, NULL, {_MT} FROM x) r"""))

_Q18_AV = ", ".join(f"CAST(sum({c}) AS DOUBLE) / count({c}) AS {a}" for c, a in
                    [("cs_quantity", "agg1"), ("cs_list_price", "agg2"), ("cs_coupon_amt", "agg3"),
                     ("cs_sales_price", "agg4"), ("cs_net_profit", "agg5"), ("c_birth_year", "agg6"),
                     ("cd1.cd_dep_count", "agg7")])
_Q18_FROM = """FROM catalog_sales, customer_demographics cd1, customer_demographics cd2, customer, customer_address, date_dim, item
WHERE cs_sold_date_sk = d_date_sk AND cs_item_sk = i_item_sk AND cs_bill_cdemo_sk = cd1.cd_demo_sk
  AND cs_bill_customer_sk = c_customer_sk AND cd1.cd_gender = 'F' AND cd1.cd_education_status = 'Unknown'
  AND c_current_cdemo_sk = cd2.cd_demo_sk AND c_current_addr_sk = ca_address_sk
  AND c_birth_month IN (1, 6, 8, 9, 12, 2) AND d_year = 1999
  AND ca_state IN ('IN', 'KS', 'KY', 'MA', 'MD', 'IA', 'ME')"""
_Q18_ORD = "ORDER BY ca_country, ca_state, ca_county, i_item_id, agg1, agg2, agg3, agg4, agg5, agg6, agg7 LIMIT 100"
_T18 = "catalog_sales customer_demographics customer customer_address date_dim item"
q("q18", _T18, f"""
SELECT i_item_id, ca_country, ca_state, ca_county, {_Q18_AV}
{_Q18_FROM}
GROUP BY ROLLUP (i_item_id, ca_country, ca_state, ca_county)
{_Q18_ORD}""")
q("q18a", _T18, f"""
SELECT * FROM (
  SELECT i_item_id, ca_country, ca_state, ca_county, {_Q18_AV} {_Q18_FROM} GROUP BY i_item_id, ca_country, ca_state, ca_county
  UNION ALL SELECT i_item_id, ca_country, ca_state, NULL, {_Q18_AV} {_Q18_FROM} GROUP BY i_item_id, ca_country, ca_state
  UNION ALL SELECT i_item_id, ca_country, NULL, NULL, {_Q18_AV} {_Q18_FROM} GROUP BY i_item_id, ca_country
  UNION ALL SELECT i_item_id, NULL, NULL, NULL, {_Q18_AV} {_Q18_FROM} GROUP BY i_item_id
  UNION ALL SELECT NULL, NULL, NULL, NULL, {_Q18_AV} {_Q18_FROM}) r
{_Q18_ORD}""")

_Q22_FROM = """FROM inventory, date_dim, item
WHERE inv_date_sk = d_date_sk AND inv_item_sk = i_item_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11"""
q("q22", "inventory date_dim item", f"""
SELECT i_product_name, i_brand, i_class, i_category,
       CAST(sum(inv_quantity_on_hand) AS DOUBLE) / count(inv_quantity_on_hand) AS qoh
{_Q22_FROM}
GROUP BY ROLLUP (i_product_name, i_brand, i_class, i_category)
ORDER BY qoh, i_product_name, i_brand, i_class, i_category LIMIT 100""")
q("q22a", "inventory date_dim item", f"""
WITH results AS (
  SELECT i_product_name, i_brand, i_class, i_category,
         CAST(sum(inv_quantity_on_hand) AS DOUBLE) / count(inv_quantity_on_hand) AS qoh
  {_Q22_FROM}
  GROUP BY i_product_name, i_brand, i_class, i_category),
results_rollup AS (
  SELECT i_product_name, i_brand, i_class, i_category, qoh FROM results
  UNION ALL SELECT i_product_name, i_brand, i_class, NULL, avg(qoh) FROM results GROUP BY i_product_name, i_brand, i_class
  UNION ALL SELECT i_product_name, i_brand, NULL, NULL, avg(qoh) FROM results GROUP BY i_product_name, i_brand
  UNION ALL SELECT i_product_name, NULL, NULL, NULL, avg(qoh) FROM results GROUP BY i_product_name
  UNION ALL SELECT NULL, NULL, NULL, NULL, avg(qoh) FROM results)
SELECT i_product_name, i_brand, i_class, i_category, qoh FROM results_rollup
ORDER BY qoh, i_product_name, i_brand, i_class, i_category LIMIT 100""")

_Q27_AV = ", ".join(f"CAST(sum({c}) AS DOUBLE) / count({c}) AS {a}" for c, a in
                    [("ss_quantity", "agg1"), ("ss_list_price", "agg2"), ("ss_coupon_amt", "agg3"), ("ss_sales_price", "agg4")])
_Q27_FROM = """FROM store_sales, customer_demographics, date_dim, store, item
WHERE ss_sold_date_sk = d_date_sk AND ss_item_sk = i_item_sk AND ss_store_sk = s_store_sk AND ss_cdemo_sk = cd_demo_sk
  AND cd_gender = 'M' AND cd_marital_status = 'S' AND cd_education_status = 'College' AND d_year = 2000
  AND s_state IN ('KS', 'MA', 'KY', 'IA', 'ID', 'CT')"""
_T27 = "store_sales customer_demographics date_dim store item"
q("q27", _T27, f"""
SELECT i_item_id, s_state, CAST(grouping(s_state) AS INTEGER) AS g_state, {_Q27_AV}
{_Q27_FROM}
GROUP BY ROLLUP (i_item_id, s_state)
ORDER BY i_item_id, s_state, g_state, agg1, agg2, agg3, agg4 LIMIT 100""")
q("q27a", _T27, f"""
SELECT * FROM (
  SELECT i_item_id, s_state, 0 AS g_state, {_Q27_AV} {_Q27_FROM} GROUP BY i_item_id, s_state
  UNION ALL SELECT i_item_id, NULL AS s_state, 1 AS g_state, {_Q27_AV} {_Q27_FROM} GROUP BY i_item_id
  UNION ALL SELECT NULL AS i_item_id, NULL AS s_state, 1 AS g_state, {_Q27_AV} {_Q27_FROM}) foo
ORDER BY i_item_id, s_state, g_state, agg1, agg2, agg3, agg4 LIMIT 100""")

_Q36_FROM = """FROM store_sales, date_dim d1, item, store
WHERE d1.d_year = 2001 AND d1.d_date_sk = ss_sold_date_sk AND i_item_sk = ss_item_sk AND s_store_sk = ss_store_sk
  AND s_state IN ('KS', 'MA', 'KY', 'IA', 'ID', 'CT', 'DE', 'ME')"""
_GM = "CAST(sum(ss_net_profit) AS DOUBLE) / CAST(sum(ss_ext_sales_price) AS DOUBLE)"
q("q36", "store_sales date_dim item store", f"""
SELECT {_GM} AS gross_margin, i_category, i_class,
       CAST(grouping(i_category) + grouping(i_class) AS INTEGER) AS lochierarchy,
       rank() OVER (PARTITION BY grouping(i_category) + grouping(i_class),
                    CASE WHEN grouping(i_class) = 0 THEN i_category END
                    ORDER BY {_GM} ASC) AS rank_within_parent
{_Q36_FROM}
GROUP BY ROLLUP (i_category, i_class)
ORDER BY lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN i_category END, rank_within_parent,
         gross_margin, i_category, i_class LIMIT 100""")
q("q36a", "store_sales date_dim item store", f"""
WITH results AS (SELECT sum(ss_net_profit) AS ss_net_profit, sum(ss_ext_sales_price) AS ss_ext_sales_price,
                        i_category, i_class {_Q36_FROM} GROUP BY i_category, i_class),
results_rollup AS (
  SELECT CAST(ss_net_profit AS DOUBLE) / CAST(ss_ext_sales_price AS DOUBLE) AS gross_margin, i_category, i_class,
         0 AS t_category, 0 AS t_class, 0 AS lochierarchy FROM results
  UNION SELECT CAST(sum(ss_net_profit) AS DOUBLE) / CAST(sum(ss_ext_sales_price) AS DOUBLE), i_category, NULL, 0, 1, 1
        FROM results GROUP BY i_category
  UNION SELECT CAST(sum(ss_net_profit) AS DOUBLE) / CAST(sum(ss_ext_sales_price) AS DOUBLE), NULL, NULL, 1, 1, 2 FROM results)
SELECT gross_margin, i_category, i_class, lochierarchy,
       rank() OVER (PARTITION BY lochierarchy, CASE WHEN t_class = 0 THEN i_category END
                    ORDER BY gross_margin ASC) AS rank_within_parent
FROM results_rollup
ORDER BY lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN i_category END, rank_within_parent,
         gross_margin, i_category, i_class LIMIT 100""")

_Q70_FROM = """FROM store_sales, date_dim d1, store
WHERE d1.d_month_seq BETWEEN 1176 AND 1176 + 11 AND d1.d_date_sk = ss_sold_date_sk AND s_store_sk = ss_store_sk
  AND s_state IN (SELECT s_state FROM (
        SELECT s_state AS s_state, rank() OVER (PARTITION BY s_state ORDER BY sum(ss_net_profit) DESC) AS ranking
        FROM store_sales, store, date_dim
        WHERE d_month_seq BETWEEN 1176 AND 1176 + 11 AND d_date_sk = ss_sold_date_sk AND s_store_sk = ss_store_sk
        GROUP BY s_state) tmp1 WHERE ranking <= 5)"""
q("q70", "store_sales date_dim store", f"""
SELECT CAST(sum(ss_net_profit) AS DOUBLE) AS total_sum, s_state, s_county,
       CAST(grouping(s_state) + grouping(s_county) AS INTEGER) AS lochierarchy,
       rank() OVER (PARTITION BY grouping(s_state) + grouping(s_county),
                    CASE WHEN grouping(s_county) = 0 THEN s_state END
                    ORDER BY CAST(sum(ss_net_profit) AS DOUBLE) DESC) AS rank_within_parent
{_Q70_FROM}
GROUP BY ROLLUP (s_state, s_county)
ORDER BY lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN s_state END, rank_within_parent,
         total_sum, s_state, s_county LIMIT 100""")
q("q70a", "store_sales date_dim store", f"""
WITH results AS (SELECT sum(ss_net_profit) AS total_sum, s_state, s_county {_Q70_FROM} GROUP BY s_state, s_county),
results_rollup AS (
  SELECT CAST(total_sum AS DOUBLE) AS total_sum, s_state, s_county, 0 AS g_state, 0 AS g_county, 0 AS lochierarchy FROM results
  UNION SELECT CAST(sum(total_sum) AS DOUBLE), s_state, NULL, 0, 1, 1 FROM results GROUP BY s_state
  UNION SELECT CAST(sum(total_sum) AS DOUBLE), NULL, NULL, 1, 1, 2 FROM results)
SELECT total_sum, s_state, s_county, lochierarchy,
       rank() OVER (PARTITION BY lochierarchy, CASE WHEN g_county = 0 THEN s_state END
                    ORDER BY total_sum DESC) AS rank_within_parent
FROM results_rollup
ORDER BY lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN s_state END, rank_within_parent,
         total_sum, s_state, s_county LIMIT 100""")

_Q86_FROM = """FROM web_sales, date_dim d1, item
WHERE d1.d_month_seq BETWEEN 1176 AND 1176 + 11 AND d1.d_date_sk = ws_sold_date_sk AND i_item_sk = ws_item_sk"""
q("q86", "web_sales date_dim item", f"""
SELECT CAST(sum(ws_net_paid) AS DOUBLE) AS total_sum, i_category, i_class,
       CAST(grouping(i_category) + grouping(i_class) AS INTEGER) AS lochierarchy,
       rank() OVER (PARTITION BY grouping(i_category) + grouping(i_class),
                    CASE WHEN grouping(i_class) = 0 THEN i_category END
                    ORDER BY CAST(sum(ws_net_paid) AS DOUBLE) DESC) AS rank_within_parent
{_Q86_FROM}
GROUP BY ROLLUP (i_category, i_class)
ORDER BY lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN i_category END, rank_within_parent,
         total_sum, i_category, i_class LIMIT 100""")
q("q86a", "web_sales date_dim item", f"""
WITH results AS (SELECT sum(ws_net_paid) AS total_sum, i_category, i_class {_Q86_FROM} GROUP BY i_category, i_class),
results_rollup AS (
  SELECT CAST(total_sum AS DOUBLE) AS total_sum, i_category, i_class, 0 AS g_category, 0 AS g_class, 0 AS lochierarchy FROM results
  UNION SELECT CAST(sum(total_sum) AS DOUBLE), i_category, NULL, 0, 1, 1 FROM results GROUP BY i_category
  UNION SELECT CAST(sum(total_sum) AS DOUBLE), NULL, NULL, 1, 1, 2 FROM results)
SELECT total_sum, i_category, i_class, lochierarchy,
       rank() OVER (PARTITION BY lochierarchy, CASE WHEN g_class = 0 THEN i_category END
                    ORDER BY total_sum DESC) AS rank_within_parent
FROM results_rollup
ORDER BY lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN i_category END, rank_within_parent,
         total_sum, i_category, i_class LIMIT 100""")

q("q44", "store_sales item", """
SELECT asceding.rnk, i1.i_product_name AS best_performing, i2.i_product_name AS worst_performing
FROM (SELECT * FROM (SELECT item_sk, rank() OVER (ORDER BY rank_col ASC) AS rnk
                     FROM (SELECT ss_item_sk AS item_sk, CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) AS rank_col
                           FROM store_sales ss1 WHERE ss_store_sk = 4 GROUP BY ss_item_sk
                           HAVING CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) > 0.9 * (
                             SELECT CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) FROM store_sales
                             WHERE ss_store_sk = 4 AND ss_addr_sk IS NULL GROUP BY ss_store_sk)) v1) v11
      WHERE rnk < 11) asceding,
     (SELECT * FROM (SELECT item_sk, rank() OVER (ORDER BY rank_col DESC) AS rnk
                     FROM (SELECT ss_item_sk AS item_sk, CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) AS rank_col
                           FROM store_sales ss1 WHERE ss_store_sk = 4 GROUP BY ss_item_sk
                           HAVING CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) > 0.9 * (
                             SELECT CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) FROM store_sales
                             WHERE ss_store_sk = 4 AND ss_addr_sk IS NULL GROUP BY ss_store_sk)) v2) v21
      WHERE rnk < 11) descending,
     item i1, item i2
WHERE asceding.rnk = descending.rnk AND i1.i_item_sk = asceding.item_sk AND i2.i_item_sk = descending.item_sk
ORDER BY asceding.rnk, best_performing, worst_performing LIMIT 100""")


def _q47(fact, p, outlet_cols, outlet_join, outlet_tbl, ord_col):
    oc = ", ".join(outlet_cols)
    eq = " AND ".join(f"v1.{c} = v1_{{x}}.{c}" for c in ["i_category", "i_brand"] + outlet_cols)
    return f"""
WITH v1 AS (
  SELECT i_category, i_brand, {oc}, d_year, d_moy, sum({p}_sales_price) AS sum_sales,
         CAST(sum(sum({p}_sales_price)) OVER (PARTITION BY i_category, i_brand, {oc}, d_year) AS DOUBLE)
           / count(sum({p}_sales_price)) OVER (PARTITION BY i_category, i_brand, {oc}, d_year) AS avg_monthly_sales,
         rank() OVER (PARTITION BY i_category, i_brand, {oc} ORDER BY d_year, d_moy) AS rn
  FROM item, {fact}, date_dim, {outlet_tbl}
  WHERE {p}_item_sk = i_item_sk AND {p}_sold_date_sk = d_date_sk AND {outlet_join}
    AND (d_year = 1999 OR (d_year = 1999 - 1 AND d_moy = 12) OR (d_year = 1999 + 1 AND d_moy = 1))
  GROUP BY i_category, i_brand, {oc}, d_year, d_moy),
v2 AS (
  SELECT v1.i_category, v1.i_brand, {", ".join("v1." + c for c in outlet_cols)}, v1.d_year, v1.d_moy,
         v1.avg_monthly_sales, CAST(v1.sum_sales AS DOUBLE) AS sum_sales, CAST(v1_lag.sum_sales AS DOUBLE) AS psum,
         CAST(v1_lead.sum_sales AS DOUBLE) AS nsum
  FROM v1, v1 v1_lag, v1 v1_lead
  WHERE {eq.format(x='lag')} AND {eq.format(x='lead')} AND v1.rn = v1_lag.rn + 1 AND v1.rn = v1_lead.rn - 1)
SELECT * FROM v2
WHERE d_year = 1999 AND avg_monthly_sales > 0
  AND CASE WHEN avg_monthly_sales > 0 THEN abs(sum_sales - avg_monthly_sales) / avg_monthly_sales END > 0.1
ORDER BY sum_sales - avg_monthly_sales, {ord_col}, i_category, i_brand, {oc}, d_moy LIMIT 100"""


q("q47", "item store_sales date_dim store", _q47("store_sales", "ss", ["s_store_name", "s_company_name"],
                                                 "ss_store_sk = s_store_sk", "store", "s_store_name"))
q("q57", "item catalog_sales date_dim call_center", _q47("catalog_sales", "cs", ["cc_name"],
                                                         "cs_call_center_sk = cc_call_center_sk", "call_center", "cc_name"))


def _q51_body():
    def v1(fact, p):
        return f"""SELECT {p}_item_sk AS item_sk, d_date,
         sum(sum({p}_sales_price)) OVER (PARTITION BY {p}_item_sk ORDER BY d_date
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cume_sales
  FROM {fact}, date_dim
  WHERE {p}_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11 AND {p}_item_sk IS NOT NULL
  GROUP BY {p}_item_sk, d_date"""
    return f"""
WITH web_v1 AS ({v1('web_sales', 'ws')}),
store_v1 AS ({v1('store_sales', 'ss')})
SELECT item_sk, d_date, CAST(web_sales AS DOUBLE) AS web_sales, CAST(store_sales AS DOUBLE) AS store_sales,
       CAST(web_cumulative AS DOUBLE) AS web_cumulative, CAST(store_cumulative AS DOUBLE) AS store_cumulative
FROM (SELECT item_sk, d_date, web_sales, store_sales,
             max(web_sales) OVER (PARTITION BY item_sk ORDER BY d_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS web_cumulative,
             max(store_sales) OVER (PARTITION BY item_sk ORDER BY d_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS store_cumulative
      FROM (SELECT CASE WHEN web.item_sk IS NOT NULL THEN web.item_sk ELSE store.item_sk END AS item_sk,
                   CASE WHEN web.d_date IS NOT NULL THEN web.d_date ELSE store.d_date END AS d_date,
                   web.cume_sales AS web_sales, store.cume_sales AS store_sales
            FROM web_v1 web FULL OUTER JOIN store_v1 store ON (web.item_sk = store.item_sk AND web.d_date = store.d_date)) x) y
WHERE web_cumulative > store_cumulative
ORDER BY item_sk, d_date LIMIT 100"""


q("q51", "web_sales store_sales date_dim", _q51_body())
q("q51a", "web_sales store_sales date_dim", """
WITH web_tv AS (
  SELECT ws_item_sk AS item_sk, d_date, sum(ws_sales_price) AS sales,
         row_number() OVER (PARTITION BY ws_item_sk ORDER BY d_date) AS rk
  FROM web_sales, date_dim
  WHERE ws_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11 AND ws_item_sk IS NOT NULL
  GROUP BY ws_item_sk, d_date),
web_v1 AS (SELECT v1.item_sk, v1.d_date, v1.sales, sum(v2.sales) AS cume_sales
           FROM web_tv v1, web_tv v2 WHERE v1.item_sk = v2.item_sk AND v1.rk >= v2.rk
           GROUP BY v1.item_sk, v1.d_date, v1.sales),
store_tv AS (
  SELECT ss_item_sk AS item_sk, d_date, sum(ss_sales_price) AS sales,
         row_number() OVER (PARTITION BY ss_item_sk ORDER BY d_date) AS rk
  FROM store_sales, date_dim
  WHERE ss_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11 AND ss_item_sk IS NOT NULL
  GROUP BY ss_item_sk, d_date),
store_v1 AS (SELECT v1.item_sk, v1.d_date, v1.sales, sum(v2.sales) AS cume_sales
             FROM store_tv v1, store_tv v2 WHERE v1.item_sk = v2.item_sk AND v1.rk >= v2.rk
             GROUP BY v1.item_sk, v1.d_date, v1.sales),
v AS (SELECT CASE WHEN web.item_sk IS NOT NULL THEN web.item_sk ELSE store.item_sk END AS item_sk,
             CASE WHEN web.d_date IS NOT NULL THEN web.d_date ELSE store.d_date END AS d_date,
             web.cume_sales AS web_sales, store.cume_sales AS store_sales,
             row_number() OVER (PARTITION BY CASE WHEN web.item_sk IS NOT NULL THEN web.item_sk ELSE store.item_sk END
                                ORDER BY CASE WHEN web.d_date IS NOT NULL THEN web.d_date ELSE store.d_date END) AS rk
      FROM web_v1 web FULL OUTER JOIN store_v1 store ON (web.item_sk = store.item_sk AND web.d_date = store.d_date))
SELECT item_sk, d_date, CAST(web_sales AS DOUBLE) AS web_sales, CAST(store_sales AS DOUBLE) AS store_sales,
       CAST(web_cumulative AS DOUBLE) AS web_cumulative, CAST(store_cumulative AS DOUBLE) AS store_cumulative
FROM (SELECT v1.item_sk, v1.d_date, v1.web_sales, v1.store_sales, max(v2.web_sales) AS web_cumulative,
             max(v2.store_sales) AS store_cumulative
      FROM v v1, v v2 WHERE v1.item_sk = v2.item_sk AND v1.rk >= v2.rk
      GROUP BY v1.item_sk, v1.d_date, v1.web_sales, v1.store_sales) x
WHERE web_cumulative > store_cumulative
ORDER BY item_sk, d_date LIMIT 100""")

_Q53_ITEM = """((i_category IN ('ring', 'bolt', 'gear') AND i_class IN ('economy', 'large', 'medium', 'promo')
        AND i_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8'))
    OR (i_category IN ('rod', 'plate', 'gizmo') AND i_class IN ('small', 'standard', 'promo', 'economy')
        AND i_brand IN ('Brand#9', 'Brand#10', 'Brand#11', 'Brand#12', 'Brand#13', 'Brand#14', 'Brand#15', 'Brand#16')))"""
q("q53", "item store_sales date_dim store", f"""
SELECT * FROM (
  SELECT i_manufact_id, CAST(sum(ss_sales_price) AS DOUBLE) AS sum_sales,
         CAST(sum(sum(ss_sales_price)) OVER (PARTITION BY i_manufact_id) AS DOUBLE)
           / count(sum(ss_sales_price)) OVER (PARTITION BY i_manufact_id) AS avg_quarterly_sales
  FROM item, store_sales, date_dim, store
  WHERE ss_item_sk = i_item_sk AND ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk
    AND d_month_seq BETWEEN 1176 AND 1176 + 11 AND {_Q53_ITEM}
  GROUP BY i_manufact_id, d_qoy) tmp1
WHERE CASE WHEN avg_quarterly_sales > 0 THEN abs(sum_sales - avg_quarterly_sales) / avg_quarterly_sales END > 0.1
ORDER BY avg_quarterly_sales, sum_sales, i_manufact_id LIMIT 100""")
q("q63", "item store_sales date_dim store", f"""
SELECT * FROM (
  SELECT i_manager_id, CAST(sum(ss_sales_price) AS DOUBLE) AS sum_sales,
         CAST(sum(sum(ss_sales_price)) OVER (PARTITION BY i_manager_id) AS DOUBLE)
           / count(sum(ss_sales_price)) OVER (PARTITION BY i_manager_id) AS avg_monthly_sales
  FROM item, store_sales, date_dim, store
  WHERE ss_item_sk = i_item_sk AND ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk
    AND d_month_seq BETWEEN 1176 AND 1176 + 11 AND {_Q53_ITEM}
  GROUP BY i_manager_id, d_moy) tmp1
WHERE CASE WHEN avg_monthly_sales > 0 THEN abs(sum_sales - avg_monthly_sales) / avg_monthly_sales END > 0.1
ORDER BY i_manager_id, avg_monthly_sales, sum_sales LIMIT 100""")
q("q89", "item store_sales date_dim store", """
SELECT * FROM (
  SELECT i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, CAST(sum(ss_sales_price) AS DOUBLE) AS sum_sales,
         CAST(sum(sum(ss_sales_price)) OVER (PARTITION BY i_category, i_brand, s_store_name, s_company_name) AS DOUBLE)
           / count(sum(ss_sales_price)) OVER (PARTITION BY i_category, i_brand, s_store_name, s_company_name) AS avg_monthly_sales
  FROM item, store_sales, date_dim, store
  WHERE ss_item_sk = i_item_sk AND ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND d_year IN (1999)
    AND ((i_category IN ('ring', 'bolt', 'gear') AND i_class IN ('economy', 'large', 'medium'))
      OR (i_category IN ('rod', 'plate', 'gizmo') AND i_class IN ('small', 'standard', 'promo')))
  GROUP BY i_category, i_class, i_brand, s_store_name, s_company_name, d_moy) tmp1
WHERE CASE WHEN avg_monthly_sales <> 0 THEN abs(sum_sales - avg_monthly_sales) / avg_monthly_sales END > 0.1
ORDER BY sum_sales - avg_monthly_sales, s_store_name, i_category, i_class, i_brand, s_company_name, d_moy LIMIT 100""")

q("q65", "store item store_sales date_dim", """
SELECT s_store_name, i_item_desc, CAST(sc.revenue AS DOUBLE) AS revenue, CAST(i_current_price AS DOUBLE) AS i_current_price,
       CAST(i_wholesale_cost AS DOUBLE) AS i_wholesale_cost, i_brand
FROM store, item,
     (SELECT ss_store_sk, CAST(sum(revenue) AS DOUBLE) / count(revenue) AS ave
      FROM (SELECT ss_store_sk, ss_item_sk, sum(ss_sales_price) AS revenue FROM store_sales, date_dim
            WHERE ss_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11
            GROUP BY ss_store_sk, ss_item_sk) sa
      GROUP BY ss_store_sk) sb,
     (SELECT ss_store_sk, ss_item_sk, sum(ss_sales_price) AS revenue FROM store_sales, date_dim
      WHERE ss_sold_date_sk = d_date_sk AND d_month_seq BETWEEN 1176 AND 1176 + 11
      GROUP BY ss_store_sk, ss_item_sk) sc
WHERE sb.ss_store_sk = sc.ss_store_sk AND CAST(sc.revenue AS DOUBLE) <= 0.1 * sb.ave
  AND s_store_sk = sc.ss_store_sk AND i_item_sk = sc.ss_item_sk
ORDER BY s_store_name, i_item_desc, revenue, i_current_price, i_wholesale_cost, i_brand LIMIT 100""")

_MO = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _q66_branch(fact, p, price, net):
    s = ", ".join(f"sum(CASE WHEN d_moy = {i + 1} THEN {price} * {p}_quantity ELSE 0 END) AS {m}_sales"
                  for i, m in enumerate(_MO))
    n = ", ".join(f"sum(CASE WHEN d_moy = {i + 1} THEN {net} * {p}_quantity ELSE 0 END) AS {m}_net"
                  for i, m in enumerate(_MO))
    return f"""SELECT w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country,
         'Carrier C' || ',' || 'Carrier K' AS ship_carriers, d_year AS year, {s}, {n}
  FROM {fact}, warehouse, date_dim, time_dim, ship_mode
  WHERE {p}_warehouse_sk = w_warehouse_sk AND {p}_sold_date_sk = d_date_sk AND {p}_sold_time_sk = t_time_sk
    AND {p}_ship_mode_sk = sm_ship_mode_sk AND d_year = 2001 AND t_time BETWEEN 30838 AND 30838 + 28800
    AND sm_carrier IN ('Carrier C', 'Carrier K')
  GROUP BY w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, d_year"""


q("q66", "web_sales catalog_sales warehouse date_dim time_dim ship_mode", f"""
SELECT w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, ship_carriers, year,
  {", ".join(f"CAST(sum({m}_sales) AS DOUBLE) AS {m}_sales" for m in _MO)},
  {", ".join(f"sum(CAST({m}_sales AS DOUBLE) / w_warehouse_sq_ft) AS {m}_sales_per_sq_foot" for m in _MO)},
  {", ".join(f"CAST(sum({m}_net) AS DOUBLE) AS {m}_net" for m in _MO)}
FROM ({_q66_branch('web_sales', 'ws', 'ws_ext_sales_price', 'ws_net_paid')}
      UNION ALL {_q66_branch('catalog_sales', 'cs', 'cs_sales_price', 'cs_net_paid_inc_tax')}) x
GROUP BY w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, ship_carriers, year
ORDER BY w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country LIMIT 100""")

_Q67_K = "i_category, i_class, i_brand, i_product_name, d_year, d_qoy, d_moy, s_store_id"
_Q67_FROM = """FROM store_sales, date_dim, store, item
WHERE ss_sold_date_sk = d_date_sk AND ss_item_sk = i_item_sk AND ss_store_sk = s_store_sk
  AND d_month_seq BETWEEN 1176 AND 1176 + 11"""
_Q67_SUM = "CAST(sum(coalesce(ss_sales_price * ss_quantity, 0)) AS DOUBLE) AS sumsales"
q("q67", "store_sales date_dim store item", f"""
SELECT * FROM (
  SELECT {_Q67_K}, sumsales, rank() OVER (PARTITION BY i_category ORDER BY sumsales DESC) AS rk
  FROM (SELECT {_Q67_K}, {_Q67_SUM} {_Q67_FROM}
        GROUP BY ROLLUP ({_Q67_K})) dw1) dw2
WHERE rk <= 100
ORDER BY {_Q67_K}, sumsales, rk LIMIT 100""")


def _q67a_levels():
    keys = _Q67_K.split(", ")
    parts = []
    for n in range(len(keys), -1, -1):
        sel = ", ".join(keys[:n] + ["NULL"] * (len(keys) - n))
        grp = f" GROUP BY {', '.join(keys[:n])}" if n else ""
        parts.append(f"SELECT {sel}, {_Q67_SUM} {_Q67_FROM}{grp}")
    return "\n  UNION ALL ".join(parts)


q("q67a", "store_sales date_dim store item", f"""
WITH results_rollup AS (
  {_q67a_levels()})
SELECT * FROM (
  SELECT {_Q67_K}, sumsales, rank() OVER (PARTITION BY i_category ORDER BY sumsales DESC) AS rk
  FROM results_rollup) dw2
WHERE rk <= 100
ORDER BY {_Q67_K}, sumsales, rk LIMIT 100""")


def _q77_x():
    dd = "d_date BETWEEN DATE '2000-08-23' AND DATE '2000-08-23' + 30"
    return f"""
WITH ss AS (SELECT s_store_sk, sum(ss_ext_sales_price) AS sales, sum(ss_net_profit) AS profit
            FROM store_sales, date_dim, store WHERE ss_sold_date_sk = d_date_sk AND {dd} AND ss_store_sk = s_store_sk
            GROUP BY s_store_sk),
sr AS (SELECT s_store_sk, sum(sr_return_amt) AS returns_, sum(sr_net_loss) AS profit_loss
       FROM store_returns, date_dim, store WHERE sr_returned_date_sk = d_date_sk AND {dd} AND sr_store_sk = s_store_sk
       GROUP BY s_store_sk),
cs AS (SELECT cs_call_center_sk, sum(cs_ext_sales_price) AS sales, sum(cs_net_profit) AS profit
       FROM catalog_sales, date_dim WHERE cs_sold_date_sk = d_date_sk AND {dd} GROUP BY cs_call_center_sk),
cr AS (SELECT cr_call_center_sk, sum(cr_return_amount) AS returns_, sum(cr_net_loss) AS profit_loss
       FROM catalog_returns, date_dim WHERE cr_returned_date_sk = d_date_sk AND {dd} GROUP BY cr_call_center_sk),
ws AS (SELECT wp_web_page_sk, sum(ws_ext_sales_price) AS sales, sum(ws_net_profit) AS profit
       FROM web_sales, date_dim, web_page WHERE ws_sold_date_sk = d_date_sk AND {dd} AND ws_web_page_sk = wp_web_page_sk
       GROUP BY wp_web_page_sk),
wr AS (SELECT wp_web_page_sk, sum(wr_return_amt) AS returns_, sum(wr_net_loss) AS profit_loss
       FROM web_returns, date_dim, web_page WHERE wr_returned_date_sk = d_date_sk AND {dd} AND wr_web_page_sk = wp_web_page_sk
       GROUP BY wp_web_page_sk),
x AS (SELECT 'store channel' AS channel, ss.s_store_sk AS id, sales, coalesce(returns_, 0) AS returns_,
             profit - coalesce(profit_loss, 0) AS profit
      FROM ss LEFT JOIN sr ON ss.s_store_sk = sr.s_store_sk
      UNION ALL
      SELECT 'catalog channel', cs_call_center_sk, sales, returns_, profit - profit_loss FROM cs, cr
      UNION ALL
      SELECT 'web channel', ws.wp_web_page_sk, sales, coalesce(returns_, 0), profit - coalesce(profit_loss, 0)
      FROM ws LEFT JOIN wr ON ws.wp_web_page_sk = wr.wp_web_page_sk)"""


_T77 = "store_sales store_returns catalog_sales catalog_returns web_sales web_returns date_dim store web_page"
q("q77", _T77, _q77_x() + f"""
SELECT channel, id, {_MT} FROM x GROUP BY ROLLUP (channel, id)
ORDER BY channel, id, sales, returns, profit LIMIT 100""")
q("q77a", _T77, _q77_x() + f"""
SELECT * FROM (
  SELECT channel, id, {_MT} FROM x GROUP BY channel, id
  UNION SELECT channel, NULL, {_MT} FROM x GROUP BY channel
  UNION SELECT NULL, NULL, {_MT} FROM x) r
ORDER BY channel, id, sales, returns, profit LIMIT 100""")

q("q13", "store_sales store customer_demographics household_demographics customer_address date_dim", """
SELECT CAST(sum(ss_quantity) AS DOUBLE) / count(ss_quantity) AS avg_qty,
       CAST(sum(ss_ext_sales_price) AS DOUBLE) / count(ss_ext_sales_price) AS avg_ext_sales_price,
       CAST(sum(ss_ext_wholesale_cost) AS DOUBLE) / count(ss_ext_wholesale_cost) AS avg_ext_wholesale_cost,
       CAST(sum(ss_ext_wholesale_cost) AS DOUBLE) AS sum_ext_wholesale_cost
FROM store_sales, store, customer_demographics, household_demographics, customer_address, date_dim
WHERE s_store_sk = ss_store_sk AND ss_sold_date_sk = d_date_sk AND d_year = 1999
  AND ((ss_hdemo_sk = hd_demo_sk AND cd_demo_sk = ss_cdemo_sk AND cd_marital_status = 'D'
        AND cd_education_status = '2 yr Degree' AND ss_sales_price BETWEEN 100.00 AND 150.00 AND hd_dep_count = 3)
    OR (ss_hdemo_sk = hd_demo_sk AND cd_demo_sk = ss_cdemo_sk AND cd_marital_status = 'W'
        AND cd_education_status = 'Secondary' AND ss_sales_price BETWEEN 50.00 AND 100.00 AND hd_dep_count = 1)
    OR (ss_hdemo_sk = hd_demo_sk AND cd_demo_sk = ss_cdemo_sk AND cd_marital_status = 'S'
        AND cd_education_status = 'College' AND ss_sales_price BETWEEN 150.00 AND 200.00 AND hd_dep_count = 1))
  AND ((ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ('IN', 'KS', 'KY')
        AND ss_net_profit BETWEEN 100 AND 200)
    OR (ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ('MA', 'MD', 'IA')
        AND ss_net_profit BETWEEN 150 AND 300)
    OR (ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ('ME', 'CT', 'ID')
        AND ss_net_profit BETWEEN 50 AND 250))""")

q("q48", "store_sales store customer_demographics customer_address date_dim", """
SELECT sum(ss_quantity) AS sum_quantity
FROM store_sales, store, customer_demographics, customer_address, date_dim
WHERE s_store_sk = ss_store_sk AND ss_sold_date_sk = d_date_sk AND d_year = 1999
  AND ((cd_demo_sk = ss_cdemo_sk AND cd_marital_status = 'M' AND cd_education_status = '4 yr Degree'
        AND ss_sales_price BETWEEN 100.00 AND 150.00)
    OR (cd_demo_sk = ss_cdemo_sk AND cd_marital_status = 'D' AND cd_education_status = '2 yr Degree'
        AND ss_sales_price BETWEEN 50.00 AND 100.00)
    OR (cd_demo_sk = ss_cdemo_sk AND cd_marital_status = 'S' AND cd_education_status = 'College'
        AND ss_sales_price BETWEEN 150.00 AND 200.00))
  AND ((ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ('CO', 'IN', 'KS')
        AND ss_net_profit BETWEEN 0 AND 2000)
    OR (ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ('MA', 'MD', 'KY')
        AND ss_net_profit BETWEEN 150 AND 3000)
    OR (ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ('IA', 'CT', 'ME')
        AND ss_net_profit BETWEEN 50 AND 25000))""")

q("q21", "inventory warehouse item date_dim", """
SELECT * FROM (
  SELECT w_warehouse_name, i_item_id,
         sum(CASE WHEN d_date < DATE '2000-03-11' THEN inv_quantity_on_hand ELSE 0 END) AS inv_before,
         sum(CASE WHEN d_date >= DATE '2000-03-11' THEN inv_quantity_on_hand ELSE 0 END) AS inv_after
  FROM inventory, warehouse, item, date_dim
  WHERE i_current_price BETWEEN 10.0 AND 40.0 AND i_item_sk = inv_item_sk AND inv_warehouse_sk = w_warehouse_sk
    AND inv_date_sk = d_date_sk AND d_date BETWEEN DATE '2000-03-11' - 30 AND DATE '2000-03-11' + 30
  GROUP BY w_warehouse_name, i_item_id) x
WHERE (CASE WHEN inv_before > 0 THEN CAST(inv_after AS DOUBLE) / inv_before END) BETWEEN 2.0 / 3.0 AND 3.0 / 2.0
ORDER BY w_warehouse_name, i_item_id LIMIT 100""")

_ALLC = ", ".join(f"'NATION_{n} County'" for n in (0, 1, 4, 5, 8, 12, 16, 20))


def _tickets(dom, ratio, cnt, order_sql):
    return f"""
SELECT c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, cnt
FROM (SELECT ss_ticket_number, ss_customer_sk, count(*) AS cnt
      FROM store_sales, date_dim, store, household_demographics
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND ({dom}) AND (hd_buy_potential = '>10000' OR hd_buy_potential = 'Unknown') AND hd_vehicle_count > 0
        AND (CASE WHEN hd_vehicle_count > 0 THEN CAST(hd_dep_count AS DOUBLE) / hd_vehicle_count END) > {ratio}
        AND d_year IN (1999, 1999 + 1, 1999 + 2) AND s_county IN ({_ALLC})
      GROUP BY ss_ticket_number, ss_customer_sk) dn, customer
WHERE ss_customer_sk = c_customer_sk AND cnt BETWEEN {cnt}
ORDER BY {order_sql}"""


q("q34", "store_sales date_dim store household_demographics customer", _tickets(
    "d_dom BETWEEN 1 AND 3 OR d_dom BETWEEN 25 AND 28", 1.2, "2 AND 20",
    "c_last_name, c_first_name, c_salutation, c_preferred_cust_flag DESC, ss_ticket_number, cnt"))
q("q73", "store_sales date_dim store household_demographics customer", _tickets(
    "d_dom BETWEEN 1 AND 2", 1.0, "1 AND 5",
    "cnt DESC, c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number"))


def _q39(extra):
    n = "count(inv_quantity_on_hand)"
    sd = (f"CASE WHEN {n} > 1 THEN sqrt(CAST({n} * sum(CAST(inv_quantity_on_hand AS BIGINT) * inv_quantity_on_hand)"
          f" - sum(inv_quantity_on_hand) * sum(inv_quantity_on_hand) AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE)) END")
    return f"""
WITH inv AS (
  SELECT w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy, stdev, mean,
         CASE mean WHEN 0 THEN NULL ELSE stdev / mean END AS cov
  FROM (SELECT w_warehouse_name, w_warehouse_sk, inv_item_sk AS i_item_sk, d_moy, {sd} AS stdev,
               CAST(sum(inv_quantity_on_hand) AS DOUBLE) / {n} AS mean
        FROM inventory, warehouse, date_dim
        WHERE inv_warehouse_sk = w_warehouse_sk AND inv_date_sk = d_date_sk AND d_year = 2000
        GROUP BY w_warehouse_name, w_warehouse_sk, inv_item_sk, d_moy) foo
  WHERE CASE mean WHEN 0 THEN 0 ELSE stdev / mean END > 0.5)
SELECT inv1.w_warehouse_sk AS w_warehouse_sk1, inv1.i_item_sk AS i_item_sk1, inv1.d_moy AS d_moy1, inv1.mean AS mean1,
       inv1.cov AS cov1, inv2.w_warehouse_sk AS w_warehouse_sk2, inv2.i_item_sk AS i_item_sk2, inv2.d_moy AS d_moy2,
       inv2.mean AS mean2, inv2.cov AS cov2
FROM inv inv1, inv inv2
WHERE inv1.i_item_sk = inv2.i_item_sk AND inv1.w_warehouse_sk = inv2.w_warehouse_sk AND inv1.d_moy = 1
  AND inv2.d_moy = 1 + 1{extra}
ORDER BY w_warehouse_sk1, i_item_sk1, d_moy1, mean1, cov1, d_moy2, mean2, cov2"""


q("q39_1", "inventory warehouse date_dim", _q39(""))
q("q39_2", "inventory warehouse date_dim", _q39(" AND inv1.cov > 0.6"))


def _moved(date_cond, hd_cond, store_cond, sums, sel, order_sql):
    return f"""
SELECT c_last_name, c_first_name, current_addr.ca_city, bought_city, ss_ticket_number, {sel}
FROM (SELECT ss_ticket_number, ss_customer_sk, ca_city AS bought_city, {sums}
      FROM store_sales, date_dim, store, household_demographics, customer_address
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND ss_addr_sk = ca_address_sk AND ({hd_cond}) AND {date_cond} AND {store_cond}
      GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city) dn, customer, customer_address current_addr
WHERE ss_customer_sk = c_customer_sk AND c_current_addr_sk = current_addr.ca_address_sk
  AND current_addr.ca_city <> bought_city
ORDER BY {order_sql} LIMIT 100"""


_CITIES5 = "s_city IN ('Ambervale', 'Elkhaven', 'Inkwell')"
_TM = "store_sales date_dim store household_demographics customer_address customer"
q("q46", _TM, _moved("d_dow IN (6, 0) AND d_year IN (1999, 1999 + 1, 1999 + 2)",
                     "hd_dep_count = 4 OR hd_vehicle_count = 3", _CITIES5,
                     "CAST(sum(ss_coupon_amt) AS DOUBLE) AS amt, CAST(sum(ss_net_profit) AS DOUBLE) AS profit",
                     "amt, profit", "c_last_name, c_first_name, ca_city, bought_city, ss_ticket_number, amt, profit"))
q("q68", _TM, _moved("d_dom BETWEEN 1 AND 2 AND d_year IN (1999, 1999 + 1, 1999 + 2)",
                     "hd_dep_count = 4 OR hd_vehicle_count = 3", _CITIES5,
                     "CAST(sum(ss_ext_sales_price) AS DOUBLE) AS extended_price, "
                     "CAST(sum(ss_ext_list_price) AS DOUBLE) AS list_price, CAST(sum(ss_ext_tax) AS DOUBLE) AS extended_tax",
                     "extended_price, extended_tax, list_price",
                     "c_last_name, ss_ticket_number, c_first_name, ca_city, bought_city, extended_price, extended_tax, list_price"))

q("q79", "store_sales date_dim store household_demographics customer", """
SELECT c_last_name, c_first_name, substr(s_city, 1, 30) AS city, ss_ticket_number, amt, profit
FROM (SELECT ss_ticket_number, ss_customer_sk, s_city, CAST(sum(ss_coupon_amt) AS DOUBLE) AS amt,
             CAST(sum(ss_net_profit) AS DOUBLE) AS profit
      FROM store_sales, date_dim, store, household_demographics
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND (hd_dep_count = 6 OR hd_vehicle_count > 2) AND d_dow = 1 AND d_year IN (1999, 1999 + 1, 1999 + 2)
        AND s_number_employees BETWEEN 200 AND 295
      GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, s_city) ms, customer
WHERE ss_customer_sk = c_customer_sk
ORDER BY c_last_name, c_first_name, city, profit, ss_ticket_number, amt LIMIT 100""")


def _lat(fact, p, outlet, okey, fk, oname):
    lag = f"{p}_ship_date_sk - {p}_sold_date_sk"
    return f"""
SELECT substr(w_warehouse_name, 1, 20) AS warehouse, sm_type, {oname},
  sum(CASE WHEN {lag} <= 30 THEN 1 ELSE 0 END) AS days_30,
  sum(CASE WHEN {lag} > 30 AND {lag} <= 60 THEN 1 ELSE 0 END) AS days_31_60,
  sum(CASE WHEN {lag} > 60 AND {lag} <= 90 THEN 1 ELSE 0 END) AS days_61_90,
  sum(CASE WHEN {lag} > 90 AND {lag} <= 120 THEN 1 ELSE 0 END) AS days_91_120,
  sum(CASE WHEN {lag} > 120 THEN 1 ELSE 0 END) AS days_over_120
FROM {fact}, warehouse, ship_mode, {outlet}, date_dim
WHERE d_month_seq BETWEEN 1176 AND 1176 + 11 AND {p}_ship_date_sk = d_date_sk AND {p}_warehouse_sk = w_warehouse_sk
  AND {p}_ship_mode_sk = sm_ship_mode_sk AND {fk} = {okey}
GROUP BY substr(w_warehouse_name, 1, 20), sm_type, {oname}
ORDER BY warehouse, sm_type, {oname} LIMIT 100"""


q("q62", "web_sales warehouse ship_mode web_site date_dim",
  _lat("web_sales", "ws", "web_site", "web_site_sk", "ws_web_site_sk", "web_name"))
q("q99", "catalog_sales warehouse ship_mode call_center date_dim",
  _lat("catalog_sales", "cs", "call_center", "cc_call_center_sk", "cs_call_center_sk", "cc_name"))

q("q84", "customer customer_address customer_demographics household_demographics income_band store_returns", """
SELECT c_customer_id AS customer_id, coalesce(c_last_name, '') || ', ' || coalesce(c_first_name, '') AS customername
FROM customer, customer_address, customer_demographics, household_demographics, income_band, store_returns
WHERE ca_city = 'Ambervale' AND c_current_addr_sk = ca_address_sk AND ib_lower_bound >= 20000
  AND ib_upper_bound <= 20000 + 50000 AND ib_income_band_sk = hd_income_band_sk AND cd_demo_sk = c_current_cdemo_sk
  AND hd_demo_sk = c_current_hdemo_sk AND sr_cdemo_sk = cd_demo_sk
ORDER BY customer_id, customername LIMIT 100""")

q("q64", "catalog_sales catalog_returns store_sales store_returns date_dim store customer customer_demographics promotion household_demographics customer_address income_band item", """
WITH cs_ui AS (
  SELECT cs_item_sk, sum(cs_ext_list_price) AS sale, sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit) AS refund
  FROM catalog_sales, catalog_returns
  WHERE cs_item_sk = cr_item_sk AND cs_order_number = cr_order_number
  GROUP BY cs_item_sk
  HAVING sum(cs_ext_list_price) > 2 * sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit)),
cross_sales AS (
  SELECT i_product_name AS product_name, i_item_sk AS item_sk, s_store_name AS store_name, s_zip AS store_zip,
         ad1.ca_street_number AS b_street_number, ad1.ca_street_name AS b_street_name, ad1.ca_city AS b_city,
         ad1.ca_zip AS b_zip, ad2.ca_street_number AS c_street_number, ad2.ca_street_name AS c_street_name,
         ad2.ca_city AS c_city, ad2.ca_zip AS c_zip, d1.d_year AS syear, d2.d_year AS fsyear, d3.d_year AS s2year,
         count(*) AS cnt, sum(ss_wholesale_cost) AS s1, sum(ss_list_price) AS s2, sum(ss_coupon_amt) AS s3
  FROM store_sales, store_returns, cs_ui, date_dim d1, date_dim d2, date_dim d3, store, customer,
       customer_demographics cd1, customer_demographics cd2, promotion, household_demographics hd1,
       household_demographics hd2, customer_address ad1, customer_address ad2, income_band ib1, income_band ib2, item
  WHERE ss_store_sk = s_store_sk AND ss_sold_date_sk = d1.d_date_sk AND ss_customer_sk = c_customer_sk
    AND ss_cdemo_sk = cd1.cd_demo_sk AND ss_hdemo_sk = hd1.hd_demo_sk AND ss_addr_sk = ad1.ca_address_sk
    AND ss_item_sk = i_item_sk AND ss_item_sk = sr_item_sk AND ss_ticket_number = sr_ticket_number
    AND ss_item_sk = cs_ui.cs_item_sk AND c_current_cdemo_sk = cd2.cd_demo_sk AND c_current_hdemo_sk = hd2.hd_demo_sk
    AND c_current_addr_sk = ad2.ca_address_sk AND c_first_sales_date_sk = d2.d_date_sk
    AND c_first_shipto_date_sk = d3.d_date_sk AND ss_promo_sk = p_promo_sk
    AND hd1.hd_income_band_sk = ib1.ib_income_band_sk AND hd2.hd_income_band_sk = ib2.ib_income_band_sk
    AND cd1.cd_marital_status <> cd2.cd_marital_status
    AND i_color IN ('blue', 'red', 'cold', 'hot', 'new', 'old')
    AND i_current_price BETWEEN 20 AND 20 + 10 AND i_current_price BETWEEN 20 + 1 AND 20 + 15
  GROUP BY i_product_name, i_item_sk, s_store_name, s_zip, ad1.ca_street_number, ad1.ca_street_name, ad1.ca_city,
           ad1.ca_zip, ad2.ca_street_number, ad2.ca_street_name, ad2.ca_city, ad2.ca_zip, d1.d_year, d2.d_year, d3.d_year)
SELECT cs1.product_name, cs1.store_name, cs1.store_zip, cs1.b_street_number, cs1.b_street_name, cs1.b_city, cs1.b_zip,
       cs1.c_street_number, cs1.c_street_name, cs1.c_city, cs1.c_zip, cs1.syear, cs1.cnt,
       CAST(cs1.s1 AS DOUBLE) AS s11, CAST(cs1.s2 AS DOUBLE) AS s21, CAST(cs1.s3 AS DOUBLE) AS s31,
       CAST(cs2.s1 AS DOUBLE) AS s12, CAST(cs2.s2 AS DOUBLE) AS s22, CAST(cs2.s3 AS DOUBLE) AS s32,
       cs2.syear AS syear2, cs2.cnt AS cnt2
FROM cross_sales cs1, cross_sales cs2
WHERE cs1.item_sk = cs2.item_sk AND cs1.syear = 1999 AND cs2.syear = 1999 + 1 AND cs2.cnt <= cs1.cnt
  AND cs1.store_name = cs2.store_name AND cs1.store_zip = cs2.store_zip
ORDER BY cs1.product_name, cs1.store_name, cnt2, s11, s12""")

q("q80a", "store_sales store_returns catalog_sales catalog_returns web_sales web_returns date_dim store catalog_page web_site item promotion",
  SQL["q80"][1].replace("""GROUP BY ROLLUP (channel, id)""", "GROUP BY channel, id").replace(
      """SELECT channel, id, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(returns_) AS DOUBLE) AS returns,
       CAST(sum(profit) AS DOUBLE) AS profit
FROM (""", """, x AS (""").replace(
      """) x
GROUP BY channel, id
ORDER BY""", f""")
SELECT * FROM (
  SELECT channel, id, {_MT} FROM x GROUP BY channel, id
  UNION SELECT channel, NULL, {_MT} FROM x GROUP BY channel
  UNION SELECT NULL, NULL, {_MT} FROM x) r
ORDER BY"""))
