"""SQL for the derived tables, shared by the expected results."""

MOVES = """
moves AS (
  SELECT user_id AS csn, user_id % 50 AS har, event_id, event_type AS dept, ts AS in_dttm,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS out_dttm, value
  FROM events
)"""

# Stays by joining each admit row to the rows up to the next admit row.
STAYS = MOVES + """,
unit_moves AS (
  SELECT *, row_number() OVER w AS rn, lag(dept) OVER w AS before, lead(dept) OVER w AS after
  FROM moves WHERE dept IN ('view', 'click', 'purchase')
  WINDOW w AS (PARTITION BY csn ORDER BY in_dttm, event_id)
),
admits AS (
  SELECT *, coalesce(lead(rn) OVER (PARTITION BY csn ORDER BY rn), 1000000000) AS next_rn
  FROM unit_moves WHERE before IS NULL OR before <> dept
),
closings AS (
  SELECT a.csn, a.rn, max(b.rn) AS last_rn
  FROM admits a JOIN unit_moves b ON a.csn = b.csn AND b.rn BETWEEN a.rn AND a.next_rn - 1
  WHERE b.out_dttm IS NULL OR b.after IS NULL OR b.after <> b.dept
  GROUP BY a.csn, a.rn
),
stays AS (
  SELECT a.csn, a.har, a.dept, a.in_dttm AS unit_in_dttm, b.out_dttm AS unit_out_dttm,
         CASE WHEN b.out_dttm IS NULL THEN 'PATIENT IN UNIT' ELSE 'TRANSFER FROM UNIT' END AS unit_status,
         row_number() OVER (PARTITION BY a.csn ORDER BY a.in_dttm) AS line
  FROM admits a JOIN closings c ON a.csn = c.csn AND a.rn = c.rn
  JOIN unit_moves b ON b.csn = c.csn AND b.rn = c.last_rn
)"""

ENCOUNTERS = """
encounters AS (
  SELECT o_orderkey AS csn, o_custkey AS har, CAST(substr(o_orderpriority, 1, 1) AS INT) AS dept_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 103 ELSE 101 END AS pat_class,
         o_orderdate AS admit_dttm, o_orderdate + INTERVAL 30 DAY AS disch_dttm,
         CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS base_class
  FROM orders
)"""

LINES = """
lines AS (
  SELECT l_orderkey AS csn, CAST(l_linenumber AS BIGINT) AS dept_id, l_shipdate AS in_dttm,
         l_shipdate + INTERVAL 2 DAY AS out_dttm
  FROM lineitem
)"""

STORED = """
stored AS (
  SELECT l_orderkey AS csn, l_suppkey AS har,
         CASE WHEN l_linestatus = 'F' THEN 'DISCHARGED' ELSE 'OPEN' END AS unit_status,
         l_shipdate AS unit_out_dttm, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS billed_as_op
  FROM lineitem WHERE l_returnflag = 'R'
)"""

ACCOUNTS = """
accounts AS (
  SELECT c_custkey AS har, prim_csn,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(c_nationkey AS BIGINT) END AS combine_har,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN last_dttm END AS combine_dttm, adm_dttm,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS base_class, tot_chgs
  FROM customer JOIN (
    SELECT o_custkey, max(o_orderkey) AS prim_csn, min(o_orderdate) AS adm_dttm,
           max(o_orderdate) AS last_dttm, round(sum(o_totalprice), 2) AS tot_chgs
    FROM orders GROUP BY o_custkey
  ) ON o_custkey = c_custkey
)"""
