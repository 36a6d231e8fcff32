"""SQL texts: acceptance queries (run as-is by Spark and DuckDB) and the
DuckDB form of the event fixture used by the oracles."""

from __future__ import annotations

# The event fixture in DuckDB SQL: the same rows the Spark adapter builds,
# plus ``ts`` and the derived hour.
FIXTURE_CTE = """
fx AS (
  SELECT e.event_id,
         e.ts,
         strftime(e.ts, '%Y%m%d') AS event_date,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time,
         e.event_type,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id,
         coalesce(CAST(p.p_size AS BIGINT), 0) AS category_id,
         coalesce(lower(p.p_type), '') AS category_code,
         coalesce(p.p_brand, '') AS brand,
         CAST(e.value AS FLOAT) AS price,
         e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') AS user_session,
         CAST(hour(e.ts) AS INTEGER) AS event_hour
  FROM events e
  LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
)"""

FX_COLS = (
    "event_id, event_date, event_time, event_type, product_id, category_id, "
    "category_code, brand, price, user_id, user_session"
)
LANDED_COLS = FX_COLS + ", event_hour"


def with_fixture(body: str) -> str:
    return f"WITH {FIXTURE_CTE}\n{body}"


# Money is summed as decimals: the sum doesn't depend on the order of addition.
_PRICE = "CAST({t}l_extendedprice AS DECIMAL(12, 2))"
_DISC = "CAST({t}l_discount AS DECIMAL(4, 2))"


def _net(t: str = "") -> str:
    return f"{_PRICE.format(t=t)} * (1 - {_DISC.format(t=t)})"


def _sum(expression: str, digits: int = 2) -> str:
    return f"round(CAST(sum({expression}) AS DOUBLE), {digits})"


def _avg(column: str, digits: int) -> str:
    return f"round(CAST(sum(CAST({column} AS DECIMAL(12, 2))) AS DOUBLE) / count({column}), {digits})"


S1 = f"""
SELECT l_returnflag, l_linestatus,
       {_sum("CAST(l_quantity AS DECIMAL(12, 2))")} AS sum_qty,
       {_sum(_PRICE.format(t=""))} AS sum_base_price,
       {_sum(_net())} AS sum_disc_price,
       {_sum(_net() + " * (1 + CAST(l_tax AS DECIMAL(4, 2)))")} AS sum_charge,
       {_avg("l_quantity", 4)} AS avg_qty,
       {_avg("l_extendedprice", 4)} AS avg_price,
       {_avg("l_discount", 6)} AS avg_disc,
       count(*) AS count_order
FROM lineitem
WHERE l_shipdate <= DATE '1998-09-02'
GROUP BY l_returnflag, l_linestatus
ORDER BY l_returnflag, l_linestatus
"""

S2 = f"""
SELECT l.l_orderkey,
       {_sum(_net("l."))} AS revenue,
       CAST(o.o_orderdate AS DATE) AS orderdate,
       o.o_orderpriority
FROM customer c
JOIN orders o ON c.c_custkey = o.o_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE c.c_mktsegment = 'BUILDING'
  AND o.o_orderdate < DATE '1997-03-15'
  AND l.l_shipdate > DATE '1997-03-15'
GROUP BY l.l_orderkey, o.o_orderdate, o.o_orderpriority
ORDER BY revenue DESC, orderdate, l_orderkey
LIMIT 10
"""

S3 = f"""
SELECT n.n_name,
       {_sum(_net("l."))} AS revenue,
       count(*) AS n_lines
FROM customer c
JOIN orders o ON c.c_custkey = o.o_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey AND c.c_nationkey = s.s_nationkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'ASIA'
  AND o.o_orderdate >= DATE '1996-01-01'
  AND o.o_orderdate < DATE '1997-01-01'
GROUP BY n.n_name
ORDER BY revenue DESC
"""

S4 = f"""
SELECT {_sum(_PRICE.format(t="") + " * " + _DISC.format(t=""))} AS revenue,
       count(*) AS n_rows
FROM lineitem
WHERE l_shipdate >= DATE '1996-01-01'
  AND l_shipdate < DATE '1997-01-01'
  AND l_discount BETWEEN 0.05 AND 0.07
  AND l_quantity < 24
"""

# Landed-table report; ``{table}`` is the landed table or view.
S5_TEMPLATE = """
SELECT event_date, event_hour, event_type,
       count(*) AS events,
       count(DISTINCT user_id) AS users,
       round(CAST(sum(CAST(CAST(price AS DOUBLE) AS DECIMAL(18, 6))) AS DOUBLE), 2) AS revenue
FROM {table}
GROUP BY event_date, event_hour, event_type
"""

# Plan shapes beyond S1-S5, run as they are by Spark and DuckDB.

# Grouping sets: Expand below one aggregate.
S6 = f"""
SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       CAST(grouping(l_returnflag) AS INTEGER) AS g_flag, CAST(grouping(l_linestatus) AS INTEGER) AS g_status, CAST(grouping(year(l_shipdate)) AS INTEGER) AS g_year,
       count(*) AS n_lines, {_sum(_net())} AS revenue
FROM lineitem
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus, year(l_shipdate)), (l_returnflag, l_linestatus), (year(l_shipdate)), ())
"""

# Rollup over a join, from order to region.
S7 = f"""
SELECT r.r_name, n.n_name, o.o_orderpriority, count(*) AS n_orders, {_sum("CAST(o.o_totalprice AS DECIMAL(12, 2))")} AS total
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name, o.o_orderpriority)
"""

# The first orders of each group: a limit per group below the window.
S8 = """
SELECT c_nationkey, rank, o_orderkey, CAST(total AS DOUBLE) AS total
FROM (
  SELECT c.c_nationkey, o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(12, 2)) AS total,
         CAST(row_number() OVER (PARTITION BY c.c_nationkey ORDER BY CAST(o.o_totalprice AS DECIMAL(12, 2)) DESC, o.o_orderkey) AS INTEGER) AS rank
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey) ranked
WHERE rank <= 5
"""

# Correlated EXISTS and NOT EXISTS: semi and anti joins.
S9 = """
SELECT o.o_orderpriority, count(*) AS n_orders
FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_discount >= 0.05 AND l.l_shipdate >= o.o_orderdate)
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R' AND l.l_quantity > 45)
GROUP BY o.o_orderpriority
"""

# A correlated scalar subquery: an aggregate by the correlated key, joined.
S10 = f"""
SELECT l.l_suppkey, count(*) AS n_lines, {_sum(_net("l."))} AS revenue
FROM lineitem l
WHERE l.l_quantity < (SELECT 0.2 * avg(i.l_quantity) FROM lineitem i WHERE i.l_partkey = l.l_partkey)
GROUP BY l.l_suppkey
"""

# Set operations, of sets and of bags.
S11 = """
SELECT 'both' AS part, k AS custkey, count(*) AS n FROM (
  SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') x GROUP BY k
UNION ALL
SELECT 'customer only', k, count(*) FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) x GROUP BY k
UNION ALL
SELECT 'both, as bags', k, count(*) FROM (
  SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT' INTERSECT ALL SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH') x GROUP BY k
UNION ALL
SELECT 'more urgent than high', k, count(*) FROM (
  SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH') x GROUP BY k
"""

# NOT IN over a column that may hold nulls, and IN with several columns.
S12 = """
SELECT s.s_suppkey, s.s_nationkey
FROM supplier s
WHERE s.s_suppkey NOT IN (SELECT CASE WHEN l.l_discount >= 0 THEN l.l_suppkey END FROM lineitem l WHERE l.l_shipdate >= DATE '1998-06-01' AND l.l_quantity >= 50 AND l.l_discount >= 0.1)
  AND (s.s_suppkey, s.s_nationkey) IN (SELECT l.l_suppkey, c.c_nationkey FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey)
"""
