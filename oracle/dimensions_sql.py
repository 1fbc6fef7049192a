"""SQL of the dimension feeds and of the dimensions after them."""

from __future__ import annotations

STAR_SQL: dict[str, tuple[str, str]] = {}
_DAY = "DATE '2002-01-01'"

_FEEDS = """
item_feed AS (
  SELECT i_item_id AS id, CASE WHEN i_item_sk % 5 = 1 THEN i_manager_id % 50 + 1 END AS i_manager_id, NULL AS i_container,
         CASE WHEN i_item_sk % 5 = 0 THEN CAST(CAST((2 * (CAST(i_current_price * 100 AS BIGINT) * 110) + 100) // 200 AS DECIMAL(18,0)) / 100 AS DECIMAL(7,2)) END AS i_current_price,
         CAST(NULL AS DECIMAL(7,2)) AS i_wholesale_cost, CASE WHEN i_item_sk % 5 = 0 THEN i_color END AS i_color
  FROM item WHERE i_rec_end_date IS NULL AND i_item_sk % 5 < 2
  UNION ALL SELECT 'NEW' || i_item_id, i_manager_id, 'Box', i_current_price, i_wholesale_cost, i_color
  FROM item WHERE i_rec_end_date IS NULL AND i_item_sk % 50 = 3),
store_feed AS (
  SELECT s_store_id AS id, CASE WHEN s_store_sk % 3 = 1 THEN '9AM-9PM' END AS s_hours, CAST(NULL AS INTEGER) AS s_floor_space,
         CASE WHEN s_store_sk % 3 = 0 THEN 'New ' || s_manager END AS s_manager, CAST(NULL AS INTEGER) AS s_number_employees
  FROM store WHERE s_rec_end_date IS NULL AND s_store_sk % 3 < 2),
customer_feed AS (
  SELECT c_customer_id AS id, 'new.' || c_email_address AS c_email_address, NULL AS c_last_name, 'N' AS c_preferred_cust_flag
  FROM customer WHERE c_customer_sk % 7 = 0
  UNION ALL SELECT 'NEW' || c_customer_id, NULL, c_last_name, 'Y' FROM customer WHERE c_customer_sk % 40 = 1)"""

_DIMS = {"item": ("i_item_sk", "i_item_id", ("i_manager_id", "i_container"), ("i_current_price", "i_wholesale_cost", "i_color"), "i_rec_"),
         "store": ("s_store_sk", "s_store_id", ("s_hours", "s_floor_space"), ("s_manager", "s_number_employees"), "s_rec_"),
         "customer": ("c_customer_sk", "c_customer_id", ("c_email_address", "c_last_name", "c_preferred_cust_flag"), (), None)}


def _text(cols) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols)


def _after(t: str) -> str:
    """CTE <t>_after: all rows after the feed, with their status."""
    sk, bid, over, hist, rec = _DIMS[t]
    start, end = (f"d.{rec}start_date", f"d.{rec}end_date") if rec else ("CAST(NULL AS DATE)", "CAST(NULL AS DATE)")
    moved = f"{end} IS NULL AND (" + " OR ".join(f"f.{c} IS NOT NULL AND f.{c} IS DISTINCT FROM d.{c}" for c in hist) + ")" if hist else "false"
    fixed = " OR ".join(f"f.{c} IS NOT NULL AND f.{c} IS DISTINCT FROM d.{c}" for c in over)
    over_now = [f"coalesce(f.{c}, d.{c})" for c in over]
    all_new = over_now + [f"coalesce(f.{c}, d.{c})" for c in hist]
    kept = over_now + [f"d.{c}" for c in hist]
    return f"""
{t}_both AS (SELECT d.{bid} AS business_id, CAST(d.{sk} AS BIGINT) AS sk, {start} AS s, {end} AS e, {_text(kept)} AS kept, {_text(all_new)} AS opened,
                    f.id IS NOT NULL AND ({moved}) AS moved, f.id IS NOT NULL AND ({fixed}) AS fixed
             FROM {t} d LEFT JOIN {t}_feed f ON f.id = d.{bid}),
{t}_new AS (SELECT business_id, opened AS tracked, 'opened' AS status FROM {t}_both WHERE moved
            UNION ALL SELECT id, {_text(over + hist)}, 'inserted' FROM {t}_feed WHERE id NOT IN (SELECT {bid} FROM {t})),
{t}_after AS (
  SELECT business_id, sk, s, CASE WHEN moved THEN {_DAY} - 1 ELSE e END AS e, kept AS tracked,
         CASE WHEN moved THEN 'closed' WHEN fixed THEN 'overwritten' ELSE 'unchanged' END AS status FROM {t}_both
  UNION ALL
  SELECT business_id, (SELECT max({sk}) FROM {t}) + row_number() OVER (ORDER BY substring(md5(business_id), 1, 3), business_id),
         {_DAY if rec else 'CAST(NULL AS DATE)'}, CAST(NULL AS DATE), tracked, status FROM {t}_new)"""


_WITH = "WITH " + _FEEDS.strip() + "," + ",".join(_after(t) for t in _DIMS)
STAR_SQL["refresh_dimensions"] = ("item store customer", _WITH + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, business_id, CAST(sk AS BIGINT) AS sk, strftime(s, '%Y-%m-%d') AS start_date,
       strftime(e, '%Y-%m-%d') AS end_date, tracked, status FROM {t}_after WHERE status <> 'unchanged'""" for t in _DIMS))
STAR_SQL["refresh_dimensions_stored"] = ("item store customer", _WITH + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS rows, count(DISTINCT business_id) AS ids, count(DISTINCT sk) AS keys,
       CAST(sum(CASE WHEN e IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS current_rows, CAST(max(sk) AS BIGINT) AS largest_sk,
       CAST(sum(length(tracked)) AS BIGINT) AS tracked_chars, count(DISTINCT tracked) AS tracked_values, CAST(2 AS BIGINT) AS version
FROM {t}_after""" for t in _DIMS))
