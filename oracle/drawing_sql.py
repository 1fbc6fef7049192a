"""SQL of drawn values and of row counts by scale."""

from __future__ import annotations

STAR_SQL: dict[str, tuple[str, str]] = {}
STAR_SQL["sample_value_sets"] = ("item customer", """
WITH e AS (SELECT i_category, i_class, count(*) AS items, CAST(sum(CAST(coalesce(i_current_price, 0) * 100 AS BIGINT)) AS BIGINT) AS value,
                  CAST(sum(CASE WHEN i_rec_end_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS current_items
           FROM item WHERE i_category IS NOT NULL AND i_class IS NOT NULL GROUP BY i_category, i_class),
w AS (SELECT i_category, i_class, weight_set, weight FROM (UNPIVOT e ON items, value, current_items INTO NAME weight_set VALUE weight)),
c AS (SELECT *, sum(weight) OVER (PARTITION BY weight_set ORDER BY i_category, i_class ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi,
             sum(weight) OVER (PARTITION BY weight_set) AS total FROM w),
p AS (SELECT (CAST(c_customer_sk AS BIGINT) % 1000003) * 2654435761 + 13 AS place FROM customer)
SELECT weight_set, i_category, i_class, weight,
       (SELECT count(*) FROM p WHERE place % total >= hi - weight AND place % total < hi) AS customers
FROM c""")

_SCALES = "1 10 100 300 1000 3000 10000 30000 100000"
_LISTED = """
call_center 3 12 15 18 21 24 27 30 30
customer 100 500 2000 5000 12000 30000 65000 80000 100000
customer_address 50 250 1000 2500 6000 15000 32500 40000 50000
item 9 51 102 132 150 180 201 231 251
promotion 300 500 1000 1300 1500 1800 2000 2300 2500
store 6 51 201 402 501 675 750 852 951
warehouse 5 10 15 17 20 22 25 27 30
web_page 30 100 1020 1302 1500 1800 2001 2301 2502
web_site 15 21 12 21 27 33 39 42 48"""
_LINEAR = "store_sales store_returns catalog_sales catalog_returns web_sales web_returns"
_STATIC = "customer_demographics household_demographics income_band ship_mode time_dim reason"
_TARGETS = (1, 5, 100, 200, 2000, 100000)


def _listed() -> str:
    scales = _SCALES.split()
    return ",\n".join(f"('{t}', {i}, CAST({s} AS DOUBLE), CAST({n} AS DOUBLE))" for t, *counts in map(str.split, _LISTED.strip().splitlines())
                      for i, (s, n) in enumerate(zip(scales, counts)))


def _at(scale: str) -> str:
    """The count of table t at a scale: on the line from the last listed scale that is not above it."""
    return f"""(SELECT CASE WHEN {scale} < 1 THEN {scale} * min(count) FILTER (no = 0)
      ELSE max_by(line, no) FILTER (scale <= {scale}) END
    FROM (SELECT no, scale, count, count + ({scale} - scale) * (lead(count) OVER (ORDER BY no) - count) / (lead(scale) OVER (ORDER BY no) - scale) AS line
          FROM listed WHERE listed.t = u.t) WHERE line IS NOT NULL)"""


_UNION = "\nUNION ALL ".join(f"SELECT '{t}' AS t, '{m}' AS model, count(*) AS rows FROM {t}" for m, names in (
    ("static", _STATIC.split()), ("linear", _LINEAR.split()), ("logarithmic", [x.split()[0] for x in _LISTED.strip().splitlines()])) for t in names)
STAR_SQL["scale_projection"] = (" ".join([_STATIC, _LINEAR, *(x.split()[0] for x in _LISTED.strip().splitlines())]), f"""
WITH listed(t, no, scale, count) AS (VALUES {_listed()}),
u AS (SELECT *, (SELECT count(*) FROM store_sales) / 2880404.0 AS loaded FROM ({_UNION}))
SELECT t AS table_name, model, rows, {', '.join(f'''CAST(CASE model WHEN 'static' THEN rows WHEN 'linear' THEN floor(rows * (CAST({x} AS DOUBLE) / loaded) + 0.5)
  ELSE floor(rows * ({_at(f'CAST({x} AS DOUBLE)')} / {_at('loaded')}) + 0.5) END AS BIGINT) AS rows_{x}''' for x in _TARGETS)}
FROM u""")
