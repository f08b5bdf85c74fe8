"""DuckDB reference SQL for the registered queries.

Each statement recomputes a query's result straight from the driver's
tables (views ``customer supplier part orders lineitem events`` ...), with
the same surrogate-id rule (row number in natural-key order), the same
decimal casts and the same fixed values, so the Spark pipeline
(feeds -> dds -> marts) can be compared value for value.
"""

from __future__ import annotations

# --- shared building blocks -----------------------------------------------------

# Surrogate ids: 1-based row number in natural-key (text) order.
REST = """rest AS (
  SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS rkey, s_name,
         row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS rid
  FROM supplier)"""

USERS = """usr AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS ukey, c_name, lower(c_name) AS login,
         row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS uid
  FROM customer)"""

NSUPP = "(SELECT count(*) FROM supplier)"

PRODUCTS = f"""prod AS (
  SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS pkey, p_name,
         CAST(p_retailprice AS DECIMAL(19,5)) AS product_price,
         p_partkey % {NSUPP} AS rsupp,
         row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS pid
  FROM part)"""

ORDER_KEYS = """okeys AS (
  SELECT k.l_orderkey, k.l_suppkey,
         CAST(k.l_orderkey AS VARCHAR) || '-' || CAST(k.l_suppkey AS VARCHAR) AS order_key,
         o.o_custkey, o.o_orderdate,
         CASE o.o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'CANCELLED'
              WHEN 'P' THEN 'DELIVERING' END AS order_status
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) k
  JOIN orders o ON o.o_orderkey = k.l_orderkey)"""

CALENDAR = """cal AS (
  SELECT ts, row_number() OVER (ORDER BY ts) AS tid
  FROM (SELECT DISTINCT o_orderdate AS ts FROM okeys WHERE order_status IN ('CLOSED', 'CANCELLED')))"""

DM_ORDERS = """dmo AS (
  SELECT row_number() OVER (ORDER BY k.order_key) AS oid, k.*, r.rid, c.tid, u.uid
  FROM okeys k
  JOIN rest r ON r.s_suppkey = k.l_suppkey
  JOIN usr u ON u.c_custkey = k.o_custkey
  LEFT JOIN cal c ON c.ts = k.o_orderdate)"""

SALES = """sales AS (
  SELECT l.l_orderkey, l.l_suppkey, l.l_partkey,
         CAST(l.l_quantity AS INTEGER) AS cnt,
         CAST(p.p_retailprice AS DECIMAL(19,5)) AS price,
         CAST(l.l_extendedprice AS DECIMAL(19,5)) AS total_sum,
         CAST(CAST(l.l_extendedprice AS DECIMAL(19,5)) * CAST(l.l_discount AS DECIMAL(19,5))
              AS DECIMAL(19,5)) AS bonus_payment,
         CAST(CAST(l.l_extendedprice AS DECIMAL(19,5)) * CAST(l.l_tax AS DECIMAL(19,5))
              AS DECIMAL(19,5)) AS bonus_grant
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

SALES_POS = """s2 AS (
  SELECT s.*, row_number() OVER (
           PARTITION BY s.l_orderkey, s.l_suppkey
           ORDER BY CAST(s.l_partkey AS VARCHAR), s.price, s.cnt, s.total_sum, s.bonus_payment,
                    s.bonus_grant) - 1 AS position
  FROM sales s)"""

# One event per order: above the events table's ids, from the order's own keys.
EVENT_ID = """(SELECT max(event_id) + 1 FROM events)
  + s2.l_orderkey * (SELECT max(s_suppkey) + 1 FROM supplier) + s2.l_suppkey"""

RATE = """CAST(CASE l.l_suppkey % 4
           WHEN 0 THEN 1 + (l.l_orderkey + l.l_linenumber) % 5
           WHEN 1 THEN CASE WHEN (l.l_orderkey + l.l_linenumber) % 4 = 0 THEN 5 ELSE 4 END
           WHEN 2 THEN CASE WHEN (l.l_orderkey + l.l_linenumber) % 4 = 0 THEN 4 ELSE 5 END
           ELSE 5 END AS INTEGER)"""

DELIV = f"""deliv AS (
  SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_partkey,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS order_key,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' ||
           CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) || '-' ||
           CAST(CAST(l.l_quantity AS DECIMAL(19,2)) AS VARCHAR) || '-' ||
           CAST(CAST(l.l_extendedprice AS DECIMAL(19,2)) AS VARCHAR) AS delivery_id,
         o.o_orderdate AS order_ts, {RATE} AS rate,
         CAST(CAST(l.l_extendedprice AS DECIMAL(19,5)) * 0.01 AS DECIMAL(19,5)) AS dsum,
         CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(19,5)) * 0.01 AS DECIMAL(19,5))
              * CAST(l.l_tax AS DECIMAL(19,5)) AS DECIMAL(19,5)) AS tip
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- marts ----------------------------------------------------------------------


def settlement(where: str = "", natural_id: bool = False, count_orders: bool = False) -> str:
    rid = "r.rkey" if natural_id else "CAST(r.rid AS VARCHAR)"
    cnt = ("CAST(count(DISTINCT s.l_orderkey || '-' || s.l_suppkey) AS BIGINT)" if count_orders
           else "CAST(sum(s.cnt) AS BIGINT)")
    return with_(SALES, REST) + f"""
SELECT {rid} AS restaurant_id, r.s_name AS restaurant_name,
       CAST(o.o_orderdate AS DATE) AS settlement_date,
       {cnt} AS orders_count,
       CAST(sum(s.total_sum) AS DECIMAL(19,5)) AS orders_total_sum,
       CAST(sum(s.bonus_payment) AS DECIMAL(19,5)) AS orders_bonus_payment_sum,
       CAST(sum(s.bonus_grant) AS DECIMAL(19,5)) AS orders_bonus_granted_sum,
       CAST(sum(s.total_sum * 0.25) AS DECIMAL(19,5)) AS order_processing_fee,
       CAST(sum(s.total_sum - s.bonus_payment - s.total_sum * 0.25) AS DECIMAL(19,5))
         AS restaurant_reward_sum
FROM sales s
JOIN orders o ON o.o_orderkey = s.l_orderkey
JOIN rest r ON r.s_suppkey = s.l_suppkey
WHERE o.o_orderstatus = 'F' {where}
GROUP BY 1, 2, 3"""


def _tiered(groups_sql: str, order_sum: str | None = None) -> str:
    """Ledger columns from a ``g`` CTE with courier_id, courier_name, y, m,
    n, rate10, total, tips (and optionally order_sum)."""
    pay = order_sum or """CASE WHEN rate10 < 40 * n THEN greatest(total * 0.05, 100)
                 WHEN rate10 < 45 * n THEN greatest(total * 0.07, 150)
                 WHEN rate10 < 49 * n THEN greatest(total * 0.08, 175)
                 ELSE greatest(total * 0.10, 200) END"""
    return groups_sql + f""",
p AS (SELECT *, {pay} AS osum FROM g)
SELECT courier_id, courier_name, CAST(y AS INTEGER) AS settlement_year,
       CAST(m AS INTEGER) AS settlement_month, CAST(n AS BIGINT) AS orders_count,
       CAST(total AS DECIMAL(19,5)) AS orders_total_sum,
       CAST(CAST((2 * rate10 + n) // (2 * n) AS DECIMAL(18,0)) * 0.1 AS DECIMAL(2,1)) AS rate_avg,
       CAST(total * 0.25 AS DECIMAL(19,5)) AS order_processing_fee,
       CAST(osum AS DECIMAL(19,5)) AS courier_order_sum,
       CAST(tips AS DECIMAL(19,5)) AS courier_tips_sum,
       CAST(osum + tips * 0.95 AS DECIMAL(19,5)) AS courier_reward_sum
FROM p"""


def ledger(where: str = "", per_order: bool = False) -> str:
    extra = ""
    order_sum = None
    if per_order:
        extra = """,
         sum(greatest(d.dsum * 0.05, 100)) AS pay0, sum(greatest(d.dsum * 0.07, 150)) AS pay1,
         sum(greatest(d.dsum * 0.08, 175)) AS pay2, sum(greatest(d.dsum * 0.10, 200)) AS pay3"""
        order_sum = """CASE WHEN rate10 < 40 * n THEN pay0 WHEN rate10 < 45 * n THEN pay1
                 WHEN rate10 < 49 * n THEN pay2 ELSE pay3 END"""
    g = with_(DELIV, REST) + f""", g AS (
  SELECT r.rid AS courier_id, r.s_name AS courier_name, year(d.order_ts) AS y,
         month(d.order_ts) AS m, count(*) AS n, sum(d.rate * 10) AS rate10,
         sum(d.dsum) AS total, sum(d.tip) AS tips{extra}
  FROM deliv d JOIN rest r ON r.s_suppkey = d.l_suppkey
  WHERE TRUE {where}
  GROUP BY 1, 2, 3, 4)"""
    return _tiered(g, order_sum)


def tiers() -> str:
    return with_(DELIV, REST) + """, g AS (
  SELECT r.rid AS courier_id, year(d.order_ts) AS y, month(d.order_ts) AS m, count(*) AS n,
         sum(d.rate * 10) AS rate10, sum(d.dsum) AS total
  FROM deliv d JOIN rest r ON r.s_suppkey = d.l_suppkey
  GROUP BY 1, 2, 3),
t AS (SELECT *, CASE WHEN rate10 < 40 * n THEN 0 WHEN rate10 < 45 * n THEN 1
                     WHEN rate10 < 49 * n THEN 2 ELSE 3 END AS tier FROM g)
SELECT courier_id, CAST(y AS INTEGER) AS settlement_year, CAST(m AS INTEGER) AS settlement_month,
       CAST(CAST((2 * rate10 + n) // (2 * n) AS DECIMAL(18,0)) * 0.1 AS DECIMAL(2,1)) AS rate_avg,
       CAST(CASE tier WHEN 0 THEN 0.05 WHEN 1 THEN 0.07 WHEN 2 THEN 0.08 ELSE 0.10 END
            AS DECIMAL(3,2)) AS payout_share,
       CAST(CASE tier WHEN 0 THEN 100 WHEN 1 THEN 150 WHEN 2 THEN 175 ELSE 200 END
            AS DECIMAL(19,5)) AS payout_floor,
       CAST(CASE tier WHEN 0 THEN greatest(total * 0.05, 100) WHEN 1 THEN greatest(total * 0.07, 150)
                      WHEN 2 THEN greatest(total * 0.08, 175) ELSE greatest(total * 0.10, 200) END
            AS DECIMAL(19,5)) AS courier_order_sum
FROM t"""
