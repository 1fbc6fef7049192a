"""Oracle SQL (DuckDB) for operator showcases over the driver tables."""

from __future__ import annotations

SQL: dict[str, str] = {}
STAR_SQL: dict[str, tuple[str, str]] = {}   # key -> (star tables, body)

DEC = "CAST({} AS DECIMAL(12,2))".format
REV = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
YR = "year(CAST({} AS DATE))".format

SQL["join_star"] = f"""
SELECT n_name, p_brand, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS revenue, count(*) AS lines
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN part ON l_partkey = p_partkey
WHERE {YR('l_shipdate')} = 1997 GROUP BY n_name, p_brand"""
SQL["join_fact_fact"] = f"""
SELECT o_orderpriority, l_returnflag, count(*) AS lines, CAST(sum({REV}) AS DOUBLE) AS revenue,
       count(DISTINCT o_orderkey) AS orders
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority, l_returnflag"""
SQL["join_left"] = f"""
SELECT c_count, count(*) AS custdist
FROM (SELECT c_custkey, count(o_orderkey) AS c_count
      FROM customer LEFT OUTER JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE {YR('o_orderdate')} = 1998) o
           ON c_custkey = o_custkey
      GROUP BY c_custkey) c
GROUP BY c_count"""
SQL["join_full"] = f"""
SELECT coalesce(a.o_custkey, b.o_custkey) AS custkey, coalesce(a.n1, 0) AS orders_y1, coalesce(b.n2, 0) AS orders_y2
FROM (SELECT o_custkey, count(*) AS n1 FROM orders WHERE {YR('o_orderdate')} = 1996 GROUP BY o_custkey) a
FULL OUTER JOIN (SELECT o_custkey, count(*) AS n2 FROM orders WHERE {YR('o_orderdate')} = 1997 GROUP BY o_custkey) b
  ON a.o_custkey = b.o_custkey"""
SQL["join_semi"] = """
SELECT c_mktsegment, count(*) AS customers FROM customer c
WHERE EXISTS (SELECT * FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 300000.0)
GROUP BY c_mktsegment"""
SQL["join_anti"] = f"""
SELECT p_brand, count(*) AS parts FROM part p
WHERE NOT EXISTS (SELECT * FROM lineitem l WHERE l.l_partkey = p.p_partkey AND {YR('l_shipdate')} = 1998)
GROUP BY p_brand"""
SQL["join_anti_null"] = """
SELECT o_orderstatus, count(*) AS orders
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') r ON o_orderkey = r.l_orderkey
WHERE r.l_orderkey IS NULL GROUP BY o_orderstatus"""
SQL["join_mark"] = """
SELECT c_nationkey, count(*) AS customers FROM customer c
WHERE EXISTS (SELECT * FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT')
   OR c_acctbal > 9000.0
GROUP BY c_nationkey"""
SQL["join_semi_theta"] = """
SELECT l_returnflag, count(*) AS lines FROM lineitem l1
WHERE EXISTS (SELECT * FROM lineitem l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
GROUP BY l_returnflag"""
SQL["join_theta"] = f"""
SELECT {YR('o_orderdate')} AS order_year, count(*) AS early_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)
GROUP BY order_year"""
SQL["join_cross"] = f"""
SELECT avg_r, avg_n, avg_r / avg_n AS ratio
FROM (SELECT CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) / count(*) AS avg_r FROM lineitem WHERE l_returnflag = 'R') r,
     (SELECT CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) / count(*) AS avg_n FROM lineitem WHERE l_returnflag = 'N') n"""
SQL["join_self_offset"] = f"""
WITH y AS (SELECT s_nationkey, {YR('l_shipdate')} AS yr, sum({DEC('l_extendedprice')}) AS rev
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, yr)
SELECT cur.s_nationkey, cur.yr, CAST(cur.rev AS DOUBLE) AS revenue, CAST(prev.rev AS DOUBLE) AS prev_revenue
FROM y cur JOIN y prev ON cur.s_nationkey = prev.s_nationkey AND cur.yr = prev.yr + 1"""
STAR_SQL["join_asof_scd"] = ("store_sales item date_dim", """
SELECT i.i_rec_start_date, count(*) AS sales, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS revenue
FROM store_sales JOIN item sold ON ss_item_sk = sold.i_item_sk
     JOIN date_dim ON ss_sold_date_sk = d_date_sk
     JOIN item i ON sold.i_item_id = i.i_item_id AND d_date >= i.i_rec_start_date
                AND d_date <= coalesce(i.i_rec_end_date, DATE '9999-12-31')
GROUP BY i.i_rec_start_date""")
SQL["join_triangular"] = f"""
WITH o AS (SELECT o_custkey, o_orderkey, {DEC('o_totalprice')} AS tp FROM orders)
SELECT a.o_custkey, a.o_orderkey, count(*) AS n_so_far, CAST(sum(b.tp) AS DOUBLE) AS spent_so_far
FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey >= b.o_orderkey
GROUP BY a.o_custkey, a.o_orderkey"""
SQL["join_roles"] = f"""
SELECT n1.n_name AS cust_nation, n2.n_name AS supp_nation, CAST(sum({REV}) AS DOUBLE) AS revenue
FROM lineitem, orders, customer, nation n1, region, supplier, nation n2
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n1.n_nationkey
  AND n1.n_regionkey = r_regionkey AND r_name = 'EUROPE' AND l_suppkey = s_suppkey
  AND s_nationkey = n2.n_nationkey AND n1.n_name <> n2.n_name
GROUP BY cust_nation, supp_nation"""
SQL["join_or_factored"] = f"""
SELECT CAST(sum({REV}) AS DOUBLE) AS revenue, count(*) AS lines
FROM lineitem, part
WHERE (p_partkey = l_partkey AND p_brand = 'Brand#12' AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 5)
   OR (p_partkey = l_partkey AND p_brand = 'Brand#23' AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 10)
   OR (p_partkey = l_partkey AND p_brand = 'Brand#3' AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 15)"""

SQL["filter_predicates"] = f"""
SELECT l_returnflag, count(*) AS lines, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS price
FROM lineitem
WHERE l_quantity BETWEEN 10 AND 30 AND l_returnflag IN ('A', 'R') AND (l_discount >= 0.05 OR l_tax = 0.0)
  AND NOT (l_linestatus = 'O')
GROUP BY l_returnflag"""
SQL["filter_like"] = "SELECT p_brand, count(*) AS parts FROM part WHERE p_name LIKE 'blue%' GROUP BY p_brand"
STAR_SQL["filter_null"] = ("store_sales", """
SELECT ss_store_sk IS NULL AS store_missing, count(*) AS lines,
       sum(CASE WHEN ss_customer_sk IS NULL THEN 1 ELSE 0 END) AS customer_missing,
       sum(CASE WHEN ss_promo_sk IS NOT NULL THEN 1 ELSE 0 END) AS promo_present
FROM store_sales GROUP BY store_missing""")
SQL["subq_scalar"] = f"""
SELECT o_orderpriority, count(*) AS orders FROM orders
WHERE CAST({DEC('o_totalprice')} AS DOUBLE) > (SELECT CAST(sum({DEC('o_totalprice')}) AS DOUBLE) / count(*) FROM orders)
GROUP BY o_orderpriority"""
SQL["subq_corr_agg"] = f"""
SELECT count(*) AS lines, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS price FROM lineitem l1
WHERE l_quantity > (SELECT 1.5 * (CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(l_quantity))
                    FROM lineitem l2 WHERE l2.l_partkey = l1.l_partkey)"""
SQL["subq_corr_count"] = """
SELECT p_type, count(*) AS parts FROM part
WHERE (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey
         AND ((l_discount >= 0.09 AND l_quantity > 45) OR (l_tax = 0.0 AND l_returnflag = 'R'))) > 0
GROUP BY p_type"""
SQL["subq_nested_in"] = """
SELECT c_mktsegment, count(*) AS customers FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey IN (
        SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45))
GROUP BY c_mktsegment"""


def _subq_case():
    th = (11000, 13000, 11500, 12500, 12000)
    parts = []
    for b in range(5):
        lo, hi = 10 * b + 1, 10 * b + 10
        w = f"FROM lineitem WHERE l_quantity BETWEEN {lo} AND {hi}"
        parts.append(f"""CASE WHEN (SELECT count(*) {w}) > {th[b]}
  THEN (SELECT CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) {w})
  ELSE (SELECT CAST(sum(CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) / count(*) {w}) END AS bucket{b + 1}""")
    return "SELECT " + ",\n".join(parts)


SQL["subq_case"] = _subq_case()
SQL["cte_reuse"] = f"""
WITH spend AS (SELECT o_custkey, sum({DEC('o_totalprice')}) AS spend FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(spend AS DOUBLE) AS spend FROM spend
WHERE CAST(spend AS DOUBLE) > 2 * (SELECT CAST(sum(spend) AS DOUBLE) / count(spend) FROM spend)
ORDER BY spend DESC, o_custkey LIMIT 100"""
SQL["filter_guarded_ratio"] = """
SELECT l_partkey, ret_qty, qty, CASE WHEN qty > 0 THEN CAST(ret_qty AS DOUBLE) / qty END AS ratio
FROM (SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS ret_qty,
             sum(CAST(l_quantity AS BIGINT)) AS qty
      FROM lineitem GROUP BY l_partkey) g
WHERE CASE WHEN qty > 0 THEN CAST(ret_qty AS DOUBLE) / qty END > 0.3"""

SQL["agg_basic"] = f"""
SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS BIGINT)) AS sum_qty,
       CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS sum_base_price, CAST(sum({REV}) AS DOUBLE) AS sum_disc_price,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS avg_qty,
       CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) / count(*) AS avg_price,
       CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1998-09-02'
GROUP BY l_returnflag, l_linestatus"""
SQL["agg_global"] = f"""
SELECT count(*) AS lines, CAST(sum({REV}) AS DOUBLE) AS revenue, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty
FROM lineitem WHERE {YR('l_shipdate')} = 1996"""
SQL["agg_count_distinct"] = """
SELECT c_nationkey, count(DISTINCT o_custkey) AS customers, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey"""
_N = "count(l_quantity)"
_SD = (f"CASE WHEN {_N} > 1 THEN sqrt(CAST({_N} * sum(CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT))"
       f" - sum(CAST(l_quantity AS BIGINT)) * sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / CAST({_N} * ({_N} - 1) AS DOUBLE)) END")
_AV = f"(CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / {_N})"
SQL["agg_stddev"] = f"""
SELECT p_brand, {_SD} AS stdev, {_AV} AS mean, {_SD} / {_AV} AS cov
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""
SQL["agg_pivot"] = f"""
SELECT r_name, {", ".join(f"CAST(sum(CASE WHEN yr = {y} THEN rev END) AS DOUBLE) AS y{y}" for y in (1995, 1996, 1997, 1998))}
FROM (SELECT r_name, {YR('l_shipdate')} AS yr, {DEC('l_extendedprice')} AS rev
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey) x
GROUP BY r_name"""
_LAG = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"
SQL["agg_buckets"] = f"""
SELECT o_orderpriority,
       sum(CASE WHEN {_LAG} < 0 THEN 1 ELSE 0 END) AS before_order,
       sum(CASE WHEN {_LAG} >= 0 AND {_LAG} <= 30 THEN 1 ELSE 0 END) AS days_0_30,
       sum(CASE WHEN {_LAG} > 30 AND {_LAG} <= 120 THEN 1 ELSE 0 END) AS days_31_120,
       sum(CASE WHEN {_LAG} > 120 THEN 1 ELSE 0 END) AS days_over_120
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority"""
SQL["agg_having"] = f"""
SELECT l_suppkey, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS value FROM lineitem GROUP BY l_suppkey
HAVING CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) > (SELECT CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) * 0.01 FROM lineitem)"""
_NR = f"""(SELECT r_name, n_name, {DEC('l_extendedprice')} AS rev
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey) x"""
SQL["agg_rollup"] = f"""
SELECT r_name, n_name, CAST(sum(rev) AS DOUBLE) AS revenue, count(*) AS lines FROM {_NR}
GROUP BY ROLLUP (r_name, n_name)"""
SQL["agg_grouping"] = f"""
SELECT r_name, n_name, CAST(sum(rev) AS DOUBLE) AS revenue, CAST(grouping(r_name) AS INTEGER) AS g_region,
       CAST(grouping(n_name) AS INTEGER) AS g_nation, CAST(grouping(r_name) + grouping(n_name) AS INTEGER) AS lvl,
       CAST(grouping(r_name, n_name) AS INTEGER) AS gid
FROM {_NR} GROUP BY ROLLUP (r_name, n_name)"""
SQL["agg_rollup_union"] = f"""
SELECT r_name, n_name, CAST(sum(rev) AS DOUBLE) AS revenue, count(*) AS lines FROM {_NR} GROUP BY r_name, n_name
UNION ALL SELECT r_name, NULL, CAST(sum(rev) AS DOUBLE), count(*) FROM {_NR} GROUP BY r_name
UNION ALL SELECT NULL, NULL, CAST(sum(rev) AS DOUBLE), count(*) FROM {_NR}"""
SQL["agg_distinct"] = """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"""
SQL["agg_two_level"] = f"""
SELECT c_mktsegment, CAST(sum(spend) AS DOUBLE) / count(spend) AS avg_spend, CAST(max(spend) AS DOUBLE) AS max_spend
FROM (SELECT c_mktsegment, o_custkey, sum({DEC('o_totalprice')}) AS spend
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_custkey) x
GROUP BY c_mktsegment"""
SQL["agg_param"] = f"""
SELECT p_brand, CAST(max({DEC('l_extendedprice')}) AS DOUBLE) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""
SQL["agg_multi_filter"] = f"""
SELECT count(*) FILTER (WHERE l_discount < 0.03) AS low_disc,
       count(*) FILTER (WHERE l_discount BETWEEN 0.03 AND 0.07) AS mid_disc,
       count(*) FILTER (WHERE l_discount > 0.07) AS high_disc,
       CAST(sum({DEC('l_extendedprice')}) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS returned_value,
       count(DISTINCT l_partkey) FILTER (WHERE l_quantity > 45) AS parts_big_qty
FROM lineitem"""

SQL["win_share"] = f"""
SELECT p_type, p_brand, CAST(rev AS DOUBLE) AS revenue,
       CAST(rev AS DOUBLE) * 100 / CAST(sum(rev) OVER (PARTITION BY p_type) AS DOUBLE) AS share
FROM (SELECT p_type, p_brand, sum({DEC('l_extendedprice')}) AS rev
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_brand) g"""
SQL["win_avg"] = f"""
SELECT s_nationkey, mon, CAST(rev AS DOUBLE) AS revenue,
       CAST(sum(rev) OVER (PARTITION BY s_nationkey) AS DOUBLE) / count(rev) OVER (PARTITION BY s_nationkey) AS avg_month
FROM (SELECT s_nationkey, month(CAST(l_shipdate AS DATE)) AS mon, sum({DEC('l_extendedprice')}) AS rev
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE {YR('l_shipdate')} = 1997
      GROUP BY s_nationkey, mon) g"""
_BPR = f"""(SELECT p_type, p_brand, p_partkey, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS rev
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_brand, p_partkey) g"""
SQL["win_rank"] = f"SELECT p_brand, p_partkey, rev, rank() OVER (PARTITION BY p_brand ORDER BY rev DESC) AS rk FROM {_BPR}"
SQL["win_rank_global"] = f"""
SELECT s_nationkey, rev, rank() OVER (ORDER BY rev DESC) AS rk
FROM (SELECT s_nationkey, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS rev
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey) g"""
SQL["win_rank_rollup"] = f"""
SELECT r_name, n_name, CAST(grouping(r_name) + grouping(n_name) AS INTEGER) AS lvl, CAST(sum(rev) AS DOUBLE) AS rev,
       rank() OVER (PARTITION BY grouping(r_name) + grouping(n_name), CASE WHEN grouping(n_name) = 0 THEN r_name END
                    ORDER BY CAST(sum(rev) AS DOUBLE) DESC) AS rank_within_parent
FROM {_NR} GROUP BY ROLLUP (r_name, n_name)"""
SQL["win_running_sum"] = f"""
SELECT o_custkey, yr, CAST(sum(spend) OVER (PARTITION BY o_custkey ORDER BY yr
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cume_spend
FROM (SELECT o_custkey, {YR('o_orderdate')} AS yr, sum({DEC('o_totalprice')}) AS spend FROM orders GROUP BY o_custkey, yr) g"""
SQL["win_running_max"] = """
SELECT o_custkey, o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_so_far
FROM orders"""
SQL["win_row_number"] = """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS first_order_date
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) x
WHERE rn = 1"""
SQL["win_lag_lead"] = f"""
SELECT s_nationkey, yr, rev, lag(rev) OVER (PARTITION BY s_nationkey ORDER BY yr) AS prev_rev,
       lead(rev) OVER (PARTITION BY s_nationkey ORDER BY yr) AS next_rev
FROM (SELECT s_nationkey, {YR('l_shipdate')} AS yr, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS rev
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, yr) g"""
SQL["win_topn"] = f"""
SELECT p_brand, p_partkey, rev, rk FROM (
  SELECT p_brand, p_partkey, rev, rank() OVER (PARTITION BY p_brand ORDER BY rev DESC) AS rk FROM {_BPR}) x
WHERE rk <= 3"""

SQL["sort_multi"] = f"""
SELECT o_orderpriority, o_orderstatus, CAST(sum({DEC('o_totalprice')}) AS DOUBLE) AS total
FROM orders GROUP BY o_orderpriority, o_orderstatus
ORDER BY o_orderpriority ASC, total DESC, length(o_orderstatus), o_orderstatus"""
SQL["sort_topk"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"
STAR_SQL["sort_nulls"] = ("store_sales", """
SELECT ss_store_sk, ss_promo_sk, count(*) AS lines FROM store_sales GROUP BY ss_store_sk, ss_promo_sk
ORDER BY ss_store_sk ASC NULLS FIRST, ss_promo_sk DESC NULLS LAST LIMIT 40""")
SQL["set_union_all"] = """
SELECT nk, count(*) AS n FROM (
  SELECT c_nationkey AS nk FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT s_nationkey FROM supplier) u GROUP BY nk"""
SQL["set_union"] = """
SELECT c_nationkey AS nk FROM customer WHERE c_mktsegment = 'BUILDING'
UNION SELECT c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY'"""
SQL["set_intersect"] = f"""
SELECT l_partkey FROM lineitem WHERE {YR('l_shipdate')} = 1996
INTERSECT SELECT l_partkey FROM lineitem WHERE {YR('l_shipdate')} = 1997"""
SQL["set_except"] = f"""
SELECT l_partkey FROM lineitem WHERE {YR('l_shipdate')} = 1996
EXCEPT SELECT l_partkey FROM lineitem WHERE {YR('l_shipdate')} = 1997"""

SQL["fn_substr"] = "SELECT substr(p_name, 1, 3) AS prefix, count(*) AS n FROM part GROUP BY prefix"
SQL["fn_concat"] = "SELECT p_brand || '/' || p_type AS brand_type, count(*) AS n FROM part GROUP BY brand_type"
SQL["fn_upper"] = "SELECT upper(split_part(p_name, ' ', 2)) AS noun, count(*) AS n FROM part GROUP BY noun"
SQL["fn_coalesce"] = """
SELECT coalesce(n_orders, 0) AS n_orders, count(*) AS customers, count(nullif(coalesce(n_orders, 0), 0)) AS nonzero
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey
GROUP BY coalesce(n_orders, 0)"""
SQL["fn_math"] = """
SELECT CAST(round(CAST(c_acctbal AS DECIMAL(12,2)) / 1000, 0) AS INTEGER) AS k_bucket, count(*) AS n,
       CAST(sum(abs(CAST(c_acctbal AS DECIMAL(12,2)))) AS DOUBLE) AS sum_abs,
       CAST(max(round(CAST(c_acctbal AS DECIMAL(12,2)) * CAST(1.1 AS DECIMAL(2,1)), 1)) AS DOUBLE) AS max_scaled
FROM customer GROUP BY k_bucket"""
SQL["fn_cast"] = """
SELECT CAST(substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 4) AS INTEGER) AS yr,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total, count(*) AS n
FROM orders GROUP BY yr"""
SQL["fn_date_add"] = """
SELECT year(CAST(o_orderdate AS DATE) + 30) AS due_year, count(*) AS lines,
       sum(CASE WHEN CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 30
                THEN 1 ELSE 0 END) AS on_time
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY due_year"""
SQL["fn_date_diff"] = f"""
SELECT CAST(sign({_LAG}) AS INTEGER) AS sign, count(*) AS lines, min({_LAG}) AS min_days, max({_LAG}) AS max_days,
       sum({_LAG}) AS sum_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY sign"""
SQL["fn_case"] = """
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 40 THEN 'medium' ELSE 'large' END AS size,
       CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'none' END AS state, count(*) AS n
FROM lineitem GROUP BY size, state"""
SQL["fn_lit"] = """
SELECT 'customer' AS kind, c_nationkey AS nk, count(*) AS n, 1 AS weight FROM customer GROUP BY c_nationkey
UNION ALL SELECT 'supplier', s_nationkey, count(*), 2 FROM supplier GROUP BY s_nationkey"""

# ---------------------------------------------------------------- dataset building and profiling
SQL["dim_date"] = """
WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
cal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM r),
x AS (SELECT year(d) AS d_year, (year(d) - 1900) * 12 + month(d) - 1 AS month_seq,
             date_diff('day', DATE '1900-01-01', d) // 7 + 1 AS week_seq,
             (year(d) - 1900) * 4 + (month(d) - 1) // 3 + 1 AS quarter_seq,
             (date_diff('day', DATE '1900-01-01', d) + 1) % 7 IN (0, 6) AS weekend,
             (month(d) = 12 AND day(d) = 25) OR (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) AS holiday
      FROM cal)
SELECT d_year, count(*) AS days, sum(CAST(weekend AS INTEGER)) AS weekend_days, sum(CAST(holiday AS INTEGER)) AS holidays,
       min(week_seq) AS first_week_seq, max(week_seq) AS last_week_seq, min(month_seq) AS first_month_seq,
       count(DISTINCT quarter_seq) AS quarters
FROM x GROUP BY d_year"""
STAR_SQL["dim_time"] = ("store_sales time_dim", """
SELECT t_am_pm, t_shift, t_sub_shift, t_meal_time, count(*) AS lines, CAST(sum(ss_net_paid) AS DOUBLE) AS net_paid
FROM store_sales JOIN time_dim ON ss_sold_time_sk = t_time_sk
GROUP BY t_am_pm, t_shift, t_sub_shift, t_meal_time""")
STAR_SQL["dim_demographics"] = ("customer customer_demographics household_demographics", """
SELECT cd_gender, cd_marital_status, cd_education_status, hd_buy_potential, count(*) AS customers
FROM customer JOIN customer_demographics ON c_current_cdemo_sk = cd_demo_sk
     JOIN household_demographics ON c_current_hdemo_sk = hd_demo_sk
GROUP BY cd_gender, cd_marital_status, cd_education_status, hd_buy_potential""")
STAR_SQL["dim_income_band"] = ("customer household_demographics income_band", """
SELECT ib_lower_bound, ib_upper_bound, count(*) AS customers
FROM customer JOIN household_demographics ON c_current_hdemo_sk = hd_demo_sk
     JOIN income_band ON hd_income_band_sk = ib_income_band_sk
GROUP BY ib_lower_bound, ib_upper_bound""")
STAR_SQL["dim_scd2"] = ("item", """
SELECT revision, price_changed, count(*) AS rows,
       sum(CASE WHEN derived_end IS NOT DISTINCT FROM i_rec_end_date THEN 1 ELSE 0 END) AS end_matches
FROM (SELECT i_item_id, i_rec_end_date,
             CAST(lead(i_rec_start_date) OVER (PARTITION BY i_item_id ORDER BY i_rec_start_date) - 1 AS DATE) AS derived_end,
             row_number() OVER (PARTITION BY i_item_id ORDER BY i_rec_start_date) AS revision,
             lag(i_current_price) OVER (PARTITION BY i_item_id ORDER BY i_rec_start_date) <> i_current_price AS price_changed
      FROM item) h
GROUP BY revision, price_changed""")
STAR_SQL["sales_pricing"] = ("store_sales date_dim", """
SELECT d_year, CAST(sum(ss_ext_list_price) AS DOUBLE) AS ss_ext_list_price,
       CAST(sum(ss_ext_sales_price) AS DOUBLE) AS ss_ext_sales_price, CAST(sum(ss_coupon_amt) AS DOUBLE) AS ss_coupon_amt,
       CAST(sum(ss_net_paid) AS DOUBLE) AS ss_net_paid, CAST(sum(ss_ext_tax) AS DOUBLE) AS ss_ext_tax,
       CAST(sum(ss_net_profit) AS DOUBLE) AS ss_net_profit,
       sum(CASE WHEN ss_coupon_amt > 0 THEN 1 ELSE 0 END) AS coupon_lines,
       sum(CASE WHEN ss_net_paid <> ss_ext_sales_price - ss_coupon_amt
                  OR ss_ext_discount_amt <> ss_ext_list_price - ss_ext_sales_price
                  OR ss_net_paid_inc_tax <> ss_net_paid + ss_ext_tax
                  OR ss_net_profit <> ss_net_paid - ss_ext_wholesale_cost THEN 1 ELSE 0 END) AS violations
FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk GROUP BY d_year""")
STAR_SQL["returns_from_sales"] = ("store_sales store_returns catalog_sales catalog_returns web_sales web_returns date_dim", "\nUNION ALL ".join(f"""
SELECT '{ch}' AS channel, d_year, count(*) AS sales, sum(CASE WHEN {r}_item_sk IS NOT NULL THEN 1 ELSE 0 END) AS returns,
       sum({r}_return_quantity) AS returned_qty,
       CAST(sum(CAST({r}_returned_date_sk - {p}_sold_date_sk AS BIGINT)) AS DOUBLE) / count({r}_returned_date_sk - {p}_sold_date_sk) AS avg_lag_days,
       CAST(sum({r}_refunded_cash) AS DOUBLE) AS cash, CAST(sum({r}_reversed_charge) AS DOUBLE) AS charge,
       CAST(sum({r}_{credit}) AS DOUBLE) AS credit,
       sum(CASE WHEN {r}_refunded_cash + {r}_reversed_charge + {r}_{credit} <> {r}_{amt} THEN 1 ELSE 0 END) AS split_violations,
       sum(CASE WHEN {r}_return_quantity > {p}_quantity THEN 1 ELSE 0 END) AS qty_violations
FROM {ch}_sales LEFT JOIN {ch}_returns ON {p}_item_sk = {r}_item_sk AND {p}_{num} = {r}_{num}
     JOIN date_dim ON {p}_sold_date_sk = d_date_sk
GROUP BY d_year""" for ch, p, r, num, amt, credit in [
    ("store", "ss", "sr", "ticket_number", "return_amt", "store_credit"),
    ("catalog", "cs", "cr", "order_number", "return_amount", "store_credit"),
    ("web", "ws", "wr", "order_number", "return_amt", "account_credit")]))
STAR_SQL["inventory_snapshot"] = ("inventory date_dim", """
SELECT inv_warehouse_sk, d_year, count(DISTINCT inv_date_sk) AS snapshots, count(DISTINCT inv_item_sk) AS items,
       CAST(sum(inv_quantity_on_hand) AS DOUBLE) / count(inv_quantity_on_hand) AS avg_on_hand,
       min(d_dow) AS min_dow, max(d_dow) AS max_dow
FROM inventory JOIN date_dim ON inv_date_sk = d_date_sk GROUP BY inv_warehouse_sk, d_year""")


def _dq_pk():
    from shelfline.plans.building import PK
    parts = [f"""SELECT '{t}' AS table_name, sum(n) AS rows, sum(n - 1) AS duplicate_rows
  FROM (SELECT count(*) AS n FROM {t} GROUP BY {", ".join(k)}) g""" for t, k in PK.items()]
    return " ".join(PK), "\nUNION ALL ".join(parts)


def _dq_fk():
    from shelfline.plans.building import FK
    tabs = sorted({t for t, _, d, _ in FK} | {d for _, _, d, _ in FK})
    parts = [f"""SELECT '{t}.{c}' AS fk_name, count(*) AS orphans FROM {t}
  WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d} WHERE {k} = {t}.{c})""" for t, c, d, k in FK]
    for p, r, sales, rets, num in [("ss", "sr", "store_sales", "store_returns", "ticket_number"),
                                   ("cs", "cr", "catalog_sales", "catalog_returns", "order_number"),
                                   ("ws", "wr", "web_sales", "web_returns", "order_number")]:
        parts.append(f"""SELECT '{rets}.{r}_{num}' AS fk_name, count(*) AS orphans FROM {rets}
  WHERE NOT EXISTS (SELECT 1 FROM {sales} WHERE {p}_item_sk = {r}_item_sk AND {p}_{num} = {r}_{num})""")
    return " ".join(tabs), "\nUNION ALL ".join(parts)


STAR_SQL["dq_pk"] = _dq_pk()
STAR_SQL["dq_fk"] = _dq_fk()


def _nulls():
    from shelfline.plans.building import _NULLABLE
    parts = []
    for t, cols in _NULLABLE.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS nulls, "
                         f"count(*) AS rows FROM {t}")
    return " ".join(_NULLABLE), "\nUNION ALL ".join(parts)


STAR_SQL["profile_nulls"] = _nulls()
STAR_SQL["profile_skew"] = ("store_sales store_returns catalog_sales catalog_returns web_sales web_returns inventory", "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, max(n) AS max_rows, sum(n) AS rows, max(n) * 32 / CAST(sum(n) AS DOUBLE) AS skew,
       CASE WHEN max(n) * 32 / CAST(sum(n) AS DOUBLE) >= 1.2 THEN 'WARN' ELSE 'OK' END AS status
  FROM (SELECT {k} % 32 AS b, count(*) AS n FROM {t} GROUP BY b) g"""
    for t, k in [("store_sales", "ss_item_sk"), ("store_returns", "sr_item_sk"), ("catalog_sales", "cs_item_sk"),
                 ("catalog_returns", "cr_item_sk"), ("web_sales", "ws_item_sk"), ("web_returns", "wr_item_sk"),
                 ("inventory", "inv_item_sk")]))


def _checksums():
    from shelfline.plans.building import CHECKED
    def term(i, c):
        return f"coalesce(CAST({c} AS BIGINT), -1) * {2 * i + 17}"
    return " ".join(CHECKED), "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS rows,
       sum((((({' + '.join(term(i, c) for i, c in enumerate(cols))}) % 1000003) + 1000003) % 1000003)) AS checksum FROM {t}"""
        for t, cols in CHECKED.items())


def _stats():
    from shelfline.plans.building import STATS_COLUMNS
    return "store_sales", "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values,
       CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM store_sales""" for c in STATS_COLUMNS)


STAR_SQL["profile_checksum"] = _checksums()
STAR_SQL["profile_stats"] = _stats()
SQL["orders_explode"] = """
WITH n AS (SELECT count(*) AS n_items FROM part),
o AS (SELECT o_orderkey, o_orderkey % 3 = 1 AS catalog,
             CASE WHEN o_orderkey % 3 = 1 THEN 4 + o_orderkey % 11 ELSE 8 + o_orderkey % 9 END AS n, n_items FROM orders, n),
lines AS (SELECT o_orderkey, catalog, o.n, ((o_orderkey * 7919) % n_items + i) % n_items AS item
          FROM o, LATERAL (SELECT unnest(range(0, o.n)) AS i) g)
SELECT catalog, n, count(DISTINCT o_orderkey) AS orders, count(*) AS lines,
       count(DISTINCT (o_orderkey, item)) AS distinct_pairs, min(item) AS min_item, max(item) AS max_item
FROM lines GROUP BY catalog, n"""
STAR_SQL["sample_weighted"] = ("item customer", """
WITH w AS (SELECT i_category, count(*) AS weight FROM item GROUP BY i_category),
c AS (SELECT i_category, weight, sum(weight) OVER (ORDER BY i_category ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hi
      FROM w),
t AS (SELECT sum(weight) AS total FROM w),
r AS (SELECT c_customer_sk, (CAST(c_customer_sk AS BIGINT) * 7919 + 13) % total AS r FROM customer, t)
SELECT i_category, weight, count(*) AS customers
FROM r JOIN c ON r.r >= c.cum_hi - c.weight AND r.r < c.cum_hi
GROUP BY i_category, weight""")
STAR_SQL["volume_by_day"] = ("store_sales date_dim", """
WITH d AS (SELECT d_date_sk, d_year, d_moy, CASE WHEN d_moy = 12 THEN 3 WHEN d_dow IN (0, 6) THEN 2 ELSE 1 END AS w
           FROM date_dim),
tickets AS (SELECT DISTINCT ss_ticket_number, ss_sold_date_sk FROM store_sales),
td AS (SELECT * FROM tickets JOIN d ON ss_sold_date_sk = d_date_sk),
per_year AS (SELECT d_year, count(*) AS n_year FROM td GROUP BY d_year),
days AS (SELECT d.*, n_year, sum(w) OVER (PARTITION BY d.d_year) AS w_year FROM d JOIN per_year USING (d_year)),
exp AS (SELECT d_year, d_moy, CAST(sum((n_year * w * 2 + w_year) // (w_year * 2)) AS BIGINT) AS expected_tickets
        FROM days GROUP BY d_year, d_moy),
act AS (SELECT d_year, d_moy, count(*) AS actual_tickets FROM td GROUP BY d_year, d_moy)
SELECT exp.d_year, exp.d_moy, expected_tickets, coalesce(actual_tickets, 0) AS actual_tickets
FROM exp LEFT JOIN act ON exp.d_year = act.d_year AND exp.d_moy = act.d_moy""")
SQL["scale_rowcounts"] = """
WITH u AS (
  SELECT 'region' AS table_name, true AS static, count(*) AS rows FROM region
  UNION ALL SELECT 'nation', true, count(*) FROM nation
  UNION ALL SELECT 'customer', false, count(*) FROM customer
  UNION ALL SELECT 'supplier', false, count(*) FROM supplier
  UNION ALL SELECT 'part', false, count(*) FROM part
  UNION ALL SELECT 'orders', false, count(*) FROM orders
  UNION ALL SELECT 'lineitem', false, count(*) FROM lineitem),
s AS (SELECT rows / 6000000.0 AS sf FROM u WHERE table_name = 'lineitem')
SELECT table_name, static, rows, sf,
       CAST(CASE WHEN static THEN rows ELSE round(rows * (1 / sf)) END AS BIGINT) AS rows_sf1,
       CAST(CASE WHEN static THEN rows ELSE round(rows * (100 / sf)) END AS BIGINT) AS rows_sf100,
       CAST(CASE WHEN static THEN rows ELSE round(rows * (1000 / sf)) END AS BIGINT) AS rows_sf1000
FROM u, s"""
STAR_SQL["dim_item_hierarchy"] = ("item", """
SELECT i_category_id, i_category, i_class_id, i_class, count(DISTINCT i_brand_id) AS brands, count(*) AS items,
       count(DISTINCT i_item_id) AS business_ids
FROM item GROUP BY i_category_id, i_category, i_class_id, i_class""")
STAR_SQL["gift_orders"] = ("catalog_sales web_sales date_dim", """
SELECT 'catalog' AS channel, d_year, count(*) AS lines,
       sum(CASE WHEN cs_ship_customer_sk <> cs_bill_customer_sk THEN 1 ELSE 0 END) AS gift_lines
FROM catalog_sales JOIN date_dim ON cs_sold_date_sk = d_date_sk GROUP BY d_year
UNION ALL
SELECT 'web', d_year, count(*), sum(CASE WHEN ws_ship_customer_sk <> ws_bill_customer_sk THEN 1 ELSE 0 END)
FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk GROUP BY d_year""")

# ---------------------------------------------------------------- sources and sinks
STAR_SQL["src_delimited"] = ("store_returns", """
SELECT sr_reason_sk, count(*) AS returns, count(*) - count(sr_customer_sk) AS null_customers,
       CAST(sum(sr_return_amt) AS DOUBLE) AS return_amt, CAST(sum(sr_net_loss) AS DOUBLE) AS net_loss
FROM store_returns GROUP BY sr_reason_sk""")
STAR_SQL["load_overwrite"] = ("customer", """
SELECT c_preferred_cust_flag, c_birth_country, count(*) AS customers FROM customer
GROUP BY c_preferred_cust_flag, c_birth_country""")
STAR_SQL["scan_partition_pruned"] = ("store_sales", """
SELECT ss_store_sk, count(*) AS lines, CAST(sum(ss_net_paid) AS DOUBLE) AS net_paid FROM store_sales
WHERE ss_sold_date_sk BETWEEN 2451180 AND 2451269 GROUP BY ss_store_sk""")

# ---------------------------------------------------------------- incremental refresh
_ASOF = ("{d} >= it.i_rec_start_date AND {d} <= coalesce(it.i_rec_end_date, DATE '9999-12-31')")
STAR_SQL["refresh_insert_sales"] = ("store_sales date_dim item customer store", f"""
WITH last AS (SELECT max(ss_sold_date_sk) AS last_sk FROM store_sales),
feed AS (
  SELECT ss_ticket_number + 50000000 AS purchase_id, i_item_id AS item_id, c_customer_id AS customer_id,
         s_store_id AS store_id, strftime(d_date, '%Y-%m-%d') AS purchase_date, ss_quantity AS quantity,
         ss_sales_price AS sale_price, ss_coupon_amt AS coupon_amt
  FROM store_sales CROSS JOIN last JOIN date_dim ON ss_sold_date_sk = d_date_sk
       JOIN item ON ss_item_sk = i_item_sk
       LEFT JOIN customer ON ss_customer_sk = c_customer_sk LEFT JOIN store ON ss_store_sk = s_store_sk
  WHERE ss_sold_date_sk > last_sk - 60),
r AS (
  SELECT f.*, dd.d_date_sk, it.i_item_sk, it.i_wholesale_cost, c.c_customer_sk, s.s_store_sk
  FROM feed f LEFT JOIN date_dim dd ON CAST(f.purchase_date AS DATE) = dd.d_date
       LEFT JOIN item it ON f.item_id = it.i_item_id AND {_ASOF.format(d='CAST(f.purchase_date AS DATE)')}
       LEFT JOIN customer c ON f.customer_id = c.c_customer_id
       LEFT JOIN store s ON f.store_id = s.s_store_id)
SELECT count(*) AS rows, sum(CASE WHEN i_item_sk IS NULL THEN 1 ELSE 0 END) AS unresolved_items,
       sum(CASE WHEN d_date_sk IS NULL THEN 1 ELSE 0 END) AS unresolved_dates,
       count(c_customer_sk) AS resolved_customers,
       CAST(sum(CAST(sale_price * quantity - coupon_amt AS DECIMAL(7,2))) AS DOUBLE) AS net_paid,
       CAST(sum(CAST(sale_price * quantity - coupon_amt - i_wholesale_cost * quantity AS DECIMAL(7,2))) AS DOUBLE) AS net_profit
FROM r""")
STAR_SQL["refresh_insert_returns"] = ("store_returns store_sales date_dim item reason", f"""
WITH last AS (SELECT max(sr_returned_date_sk) AS last_sk FROM store_returns),
feed AS (
  SELECT sr_ticket_number AS purchase_id, i_item_id AS item_id, strftime(d_date, '%Y-%m-%d') AS return_date,
         sr_return_quantity AS return_qty, sr_return_amt AS return_amt, r_reason_id AS reason_id
  FROM store_returns CROSS JOIN last JOIN date_dim ON sr_returned_date_sk = d_date_sk
       JOIN item ON sr_item_sk = i_item_sk LEFT JOIN reason ON sr_reason_sk = r_reason_sk
  WHERE sr_returned_date_sk > last_sk - 60),
sale AS (SELECT ss_ticket_number, ss_item_sk, ss_quantity, si.i_item_id AS s_item_id
         FROM store_sales JOIN item si ON ss_item_sk = si.i_item_sk),
r AS (
  SELECT f.*, rs.r_reason_sk, sale.ss_item_sk, sale.ss_quantity
  FROM feed f LEFT JOIN date_dim dd ON CAST(f.return_date AS DATE) = dd.d_date
       LEFT JOIN item it ON f.item_id = it.i_item_id AND {_ASOF.format(d='CAST(f.return_date AS DATE)')}
       LEFT JOIN reason rs ON f.reason_id = rs.r_reason_id
       LEFT JOIN sale ON f.purchase_id = sale.ss_ticket_number AND f.item_id = sale.s_item_id)
SELECT count(*) AS rows, count(ss_item_sk) AS linked_to_sale, count(r_reason_sk) AS resolved_reasons,
       sum(CASE WHEN return_qty > ss_quantity THEN 1 ELSE 0 END) AS over_returned,
       CAST(sum(return_amt) AS DOUBLE) AS return_amt
FROM r""")
STAR_SQL["refresh_inventory"] = ("inventory date_dim item warehouse", f"""
WITH last AS (SELECT max(inv_date_sk) AS last_sk FROM inventory),
feed AS (
  SELECT w_warehouse_id AS warehouse_id, i_item_id AS item_id, strftime(d_date + 28, '%Y-%m-%d') AS inv_date,
         inv_quantity_on_hand AS qty_on_hand
  FROM inventory CROSS JOIN last JOIN date_dim ON inv_date_sk = d_date_sk JOIN item ON inv_item_sk = i_item_sk
       JOIN warehouse ON inv_warehouse_sk = w_warehouse_sk
  WHERE inv_date_sk > last_sk - 28),
r AS (
  SELECT f.*, it.i_item_sk, w.w_warehouse_sk
  FROM feed f LEFT JOIN date_dim dd ON CAST(f.inv_date AS DATE) = dd.d_date
       LEFT JOIN item it ON f.item_id = it.i_item_id AND {_ASOF.format(d='CAST(f.inv_date AS DATE)')}
       LEFT JOIN warehouse w ON f.warehouse_id = w.w_warehouse_id)
SELECT w_warehouse_sk AS inv_warehouse_sk, count(*) AS rows, count(i_item_sk) AS resolved_items, sum(qty_on_hand) AS qty
FROM r GROUP BY w_warehouse_sk""")
def _in(col, ranges):
    return " OR ".join(f"{col} BETWEEN {lo} AND {hi}" for lo, hi in ranges)


_DEL = [(2451180, 2451181), (2451300, 2451301), (2451420, 2451421)]
_DEL_INV = [(2451179, 2451185), (2451298, 2451304), (2451417, 2451423)]
STAR_SQL["refresh_delete"] = ("store_sales store_returns catalog_sales catalog_returns web_sales web_returns inventory", "\nUNION ALL ".join(
    [f"""SELECT '{ch}_sales' AS table_name, count(*) AS rows, CAST(sum({p}_net_paid) AS DOUBLE) AS total FROM {ch}_sales
WHERE {p}_sold_date_sk IS NULL OR NOT ({_in(f'{p}_sold_date_sk', _DEL)})
UNION ALL
SELECT '{ch}_returns', count(*), CAST(sum({r}_{amt}) AS DOUBLE) FROM {ch}_returns
WHERE NOT EXISTS (SELECT 1 FROM {ch}_sales WHERE {p}_item_sk = {r}_item_sk AND {p}_{num} = {r}_{num} AND ({_in(f'{p}_sold_date_sk', _DEL)}))"""
     for ch, p, r, num, amt in [("store", "ss", "sr", "ticket_number", "return_amt"),
                                ("catalog", "cs", "cr", "order_number", "return_amount"),
                                ("web", "ws", "wr", "order_number", "return_amt")]]
    + [f"""SELECT 'inventory', count(*), CAST(sum(inv_quantity_on_hand) AS DOUBLE) FROM inventory WHERE NOT ({_in('inv_date_sk', _DEL_INV)})"""]))
STAR_SQL["refresh_delete_stored"] = STAR_SQL["refresh_delete"]
STAR_SQL["refresh_inventory_stored"] = (STAR_SQL["refresh_inventory"][0], f"""
SELECT inv_warehouse_sk, sum(rows)::BIGINT AS rows, sum(resolved_items)::BIGINT AS resolved_items, sum(qty)::BIGINT AS qty
FROM (SELECT inv_warehouse_sk, count(*) AS rows, count(inv_item_sk) AS resolved_items, sum(inv_quantity_on_hand) AS qty
      FROM inventory GROUP BY inv_warehouse_sk UNION ALL ({STAR_SQL["refresh_inventory"][1]})) GROUP BY inv_warehouse_sk""")
STAR_SQL["refresh_scd2"] = ("item", """
WITH ch AS (SELECT i_item_id AS item_id,
                   CAST(CAST((2 * (CAST(i_current_price * 100 AS BIGINT) * 110) + 100) // 200 AS DECIMAL(18,0)) / 100 AS DECIMAL(7,2)) AS new_price
            FROM item WHERE i_rec_end_date IS NULL AND i_item_sk % 5 = 0),
mx AS (SELECT max(i_item_sk) AS max_sk FROM item),
t AS (SELECT item.*, ch.item_id, ch.new_price, i_rec_end_date IS NULL AND ch.item_id IS NOT NULL AS changed
      FROM item LEFT JOIN ch ON item.i_item_id = ch.item_id),
u AS (SELECT i_item_sk, i_item_id, i_current_price, CASE WHEN changed THEN 'closed' ELSE 'unchanged' END AS status FROM t
      UNION ALL
      SELECT max_sk + row_number() OVER (ORDER BY i_item_sk), i_item_id, new_price, 'opened' FROM t, mx WHERE changed)
SELECT status, count(*) AS rows, count(DISTINCT i_item_id) AS business_ids, CAST(sum(i_current_price) AS DOUBLE) AS price_sum,
       min(i_item_sk) AS min_sk, max(i_item_sk) AS max_sk
FROM u GROUP BY status""")
