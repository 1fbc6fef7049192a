"""SQL of the whole-table profiles and of the as-of merge."""

from __future__ import annotations

STAR_SQL: dict[str, tuple[str, str]] = {}
_TABLES = ("date_dim time_dim item store customer customer_address customer_demographics household_demographics income_band promotion "
           "warehouse ship_mode reason call_center catalog_page web_site web_page "
           "store_sales store_returns catalog_sales catalog_returns web_sales web_returns inventory")


def _per_column(t: str, what: str, name: str) -> str:
    return f"(UNPIVOT (SELECT {what} AS '\\1' FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE {name})"


def _columns(t: str) -> str:
    low = _per_column(t, "coalesce(CAST(min(COLUMNS('(.*)')) AS VARCHAR), '~')", "low")
    high = _per_column(t, "coalesce(CAST(max(COLUMNS('(.*)')) AS VARCHAR), '~')", "high")
    n = _per_column(t, "count(COLUMNS('(.*)'))", "n")
    return f"""SELECT '{t}' AS table_name, column_name, (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM {t}) - n AS nulls,
  CASE WHEN n > 0 THEN low END AS min_value, CASE WHEN n > 0 THEN high END AS max_value
FROM {low} JOIN {high} USING (column_name) JOIN {n} USING (column_name)"""


def _checksum(t: str) -> str:
    part = "CAST(coalesce(sum(CAST(CAST('0x' || substring(d, {}, 8) AS BIGINT) AS HUGEINT)), 0) AS VARCHAR)"
    return f"""SELECT '{t}' AS table_name, count(*) AS rows, {part.format(1)} AS checksum_1, {part.format(9)} AS checksum_2
FROM (SELECT md5(concat_ws('|', *COLUMNS(*))) AS d FROM (SELECT coalesce(CAST(COLUMNS('(.*)') AS VARCHAR), '~') AS '\\1' FROM {t}))"""


STAR_SQL["profile_columns"] = (_TABLES, "\nUNION ALL ".join(_columns(t) for t in _TABLES.split()))
STAR_SQL["profile_row_checksum"] = (_TABLES, "\nUNION ALL ".join(_checksum(t) for t in _TABLES.split()))
STAR_SQL["join_asof_merge"] = ("store_sales catalog_sales date_dim", """
WITH q AS (SELECT cs_item_sk, cs_sold_date_sk, max(cs_list_price) AS quoted FROM catalog_sales GROUP BY cs_item_sk, cs_sold_date_sk)
SELECT d_year, count(*) AS lines, count(quoted) AS quoted_lines, CAST(sum(ss_quantity * (quoted - ss_sales_price)) AS DOUBLE) AS gap,
       CAST(sum(ss_sold_date_sk - cs_sold_date_sk) AS BIGINT) AS lag_days
FROM store_sales LEFT JOIN q ON cs_item_sk = ss_item_sk
     AND cs_sold_date_sk = (SELECT max(x.cs_sold_date_sk) FROM q x WHERE x.cs_item_sk = ss_item_sk AND x.cs_sold_date_sk <= ss_sold_date_sk)
JOIN date_dim ON ss_sold_date_sk = d_date_sk GROUP BY d_year""")
