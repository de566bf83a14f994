"""Queries on orders and their lines: cohorts, dated records, hierarchies, charges, text grids."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from stayflow.functions.columns import first_label
from stayflow.operators import cohort as pick
from stayflow.operators.cohort import RunWindow, accumulate
from stayflow.operators.intervals import latest_record
from stayflow.operators.joins import flatten_hierarchy, join_any_key, join_dim, join_one, merge_columns
from stayflow.operators.joins import only_code as only_code_keys
from stayflow.operators.ordered import arrange
from stayflow.queries import tables as t
from stayflow.queries.fragments import ACCOUNTS, ENCOUNTERS, LINES, STORED
from stayflow.queries.registry import query
from stayflow.sources.scratch import scratch_path
from stayflow.sources import grid

WINDOW = RunWindow(date(2001, 7, 15), lookback_days=30)
FROM, TO = "TIMESTAMP '2001-06-15'", "TIMESTAMP '2001-07-16'"
YEAR_BEFORE = "TIMESTAMP '2000-06-15'"


@query(
    f"""WITH {ENCOUNTERS}, {LINES}
SELECT DISTINCT e.csn, e.har FROM lines x JOIN encounters e USING (csn)
WHERE (x.out_dttm BETWEEN {FROM} AND {TO} OR x.in_dttm BETWEEN {FROM} AND {TO})
  AND e.pat_class NOT IN (103, 104) AND e.base_class = 1"""
)
def recent_activity(spark, folder):
    wanted = ~F.col("pat_class").isin(103, 104) & (F.col("base_class") == 1)
    return pick.recent_activity(
        t.order_movements(spark, folder), t.order_encounters(spark, folder), WINDOW, encounter_filter=wanted
    )


@query(
    f"""WITH {ENCOUNTERS}, {STORED}
SELECT DISTINCT e.csn, e.har FROM stored x JOIN encounters e USING (csn)
WHERE x.unit_status = 'DISCHARGED' AND x.unit_out_dttm <> e.disch_dttm
  AND e.disch_dttm > TIMESTAMP '2001-07-15' - INTERVAL 45 DAY"""
)
def changed_end(spark, folder):
    return pick.changed_end(t.stored_orders(spark, folder), t.order_encounters(spark, folder), WINDOW)


def _flip_sql(flag, test):
    return f"""WITH {ENCOUNTERS}, {STORED}
SELECT DISTINCT e.csn, e.har FROM stored x JOIN encounters e USING (csn)
WHERE x.billed_as_op = {flag} AND e.base_class {test} 1 AND e.disch_dttm > TIMESTAMP '2001-07-15' - INTERVAL 180 DAY"""


@query(_flip_sql(0, "<>"))
def flips_to_outpatient(spark, folder):
    return pick.flag_flip(t.stored_orders(spark, folder), t.order_encounters(spark, folder), WINDOW, from_=0)


@query(_flip_sql(1, "="))
def flips_to_inpatient(spark, folder):
    return pick.flag_flip(t.stored_orders(spark, folder), t.order_encounters(spark, folder), WINDOW, from_=1)


@query(
    f"""WITH {ENCOUNTERS}, {LINES}, {ACCOUNTS}
SELECT DISTINCT e.csn, e.har FROM lines x JOIN encounters e USING (csn)
JOIN (SELECT * FROM accounts WHERE adm_dttm > TIMESTAMP '1994-07-15' AND combine_dttm BETWEEN TIMESTAMP '1995-07-15' AND TIMESTAMP '2001-07-16'
      AND prim_csn NOT IN (SELECT csn FROM encounters WHERE admit_dttm >= TIMESTAMP '2001-07-01')) a
  ON e.har = a.combine_har OR e.har = a.har
WHERE x.in_dttm > TIMESTAMP '1996-01-01' AND e.pat_class <> 103 AND e.admit_dttm > TIMESTAMP '1994-07-15'
  AND e.csn NOT IN (SELECT csn FROM encounters WHERE admit_dttm >= TIMESTAMP '2001-07-01')"""
)
def linked_by_merge(spark, folder):
    encounters = t.order_encounters(spark, folder)
    window = RunWindow(date(2001, 7, 15), lookback_days=2192)
    cohort = encounters.filter(F.col("admit_dttm") >= F.lit(datetime(2001, 7, 1))).select(
        "csn", "har", F.lit(0).alias("billed_as_op")
    )
    found = pick.linked_by_merge(
        t.order_movements(spark, folder), encounters, t.customer_accounts(spark, folder), cohort, window,
        F.col("in_dttm") > F.lit(datetime(1996, 1, 1)), F.col("pat_class") != 103,
    )
    listed = accumulate(cohort, found, 1)
    return listed.filter("billed_as_op = 1").select("csn", "har")


@query(
    f"""WITH {ENCOUNTERS}, {ACCOUNTS}, cohort AS (SELECT csn, har FROM encounters WHERE admit_dttm >= TIMESTAMP '2001-01-01')
SELECT e.csn, e.har FROM encounters e
WHERE e.har IN (SELECT c.har FROM cohort c JOIN accounts a ON c.har = a.combine_har WHERE a.base_class = 1)
  AND e.pat_class NOT IN (103, 104)"""
)
def siblings(spark, folder):
    encounters = t.order_encounters(spark, folder)
    cohort = encounters.filter(F.col("admit_dttm") >= F.lit(datetime(2001, 1, 1)))
    return pick.siblings(
        encounters, t.customer_accounts(spark, folder), cohort,
        F.col("base_class") == 1, ~F.col("pat_class").isin(103, 104),
    )


@query(
    f"""WITH {ENCOUNTERS}, {LINES}
SELECT e.csn, e.har FROM encounters e WHERE e.csn IN (
  SELECT x.csn FROM lines x JOIN (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS dept_id FROM lineitem WHERE l_linenumber <> 7) d USING (dept_id)
  JOIN encounters p ON p.csn = x.csn WHERE d.dept_id IN (5, 6) OR p.pat_class = 103)"""
)
def require_any(spark, folder):
    encounters = t.order_encounters(spark, folder)
    movements = t.order_movements(spark, folder)
    places = movements.select("dept_id").distinct().filter("dept_id <> 7")
    return pick.require_any(
        encounters.select("csn", "har"), movements, places, encounters,
        F.col("dept_id").isin(5, 6), F.col("pat_class") == 103,
    )


@query(
    f"""WITH {ENCOUNTERS}, {LINES}
SELECT DISTINCT e.csn, e.har FROM lines x JOIN encounters e USING (csn)
WHERE (x.out_dttm BETWEEN {FROM} AND {TO} OR x.in_dttm BETWEEN {FROM} AND {TO})
  AND e.base_class IN (2, 3) AND e.dept_id IN (1, 2, 3, 4) AND e.pat_class <> 138"""
)
def outpatients_on_unit(spark, folder):
    wanted = (
        F.col("base_class").isin(2, 3) & F.col("dept_id").isin(1, 2, 3, 4) & (F.col("pat_class") != 138)
    )
    return pick.recent_activity(
        t.order_movements(spark, folder), t.order_encounters(spark, folder), WINDOW, encounter_filter=wanted
    )


@query(
    f"""WITH {ACCOUNTS}
SELECT prim_csn AS csn, har FROM accounts
WHERE base_class = 1 AND tot_chgs > 1000 AND adm_dttm > TIMESTAMP '2001-07-15' - INTERVAL 2300 DAY
  AND har NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def missed_accounts(spark, folder):
    return pick.missed_accounts(
        t.customer_accounts(spark, folder), t.stored_orders(spark, folder), WINDOW,
        (F.col("base_class") == 1) & (F.col("tot_chgs") > 1000), max_age_days=2300,
    )


@query(
    f"""WITH {ENCOUNTERS}, {LINES}, {STORED},
recent AS (SELECT DISTINCT e.csn, e.har FROM lines x JOIN encounters e USING (csn)
  WHERE x.out_dttm BETWEEN {FROM} AND {TO} OR x.in_dttm BETWEEN {FROM} AND {TO}),
changed AS (SELECT DISTINCT e.csn, e.har FROM stored x JOIN encounters e USING (csn)
  WHERE x.unit_status = 'DISCHARGED' AND x.unit_out_dttm <> e.disch_dttm AND e.disch_dttm > TIMESTAMP '2001-07-15' - INTERVAL 45 DAY),
flipped AS (SELECT DISTINCT e.csn, e.har FROM stored x JOIN encounters e USING (csn)
  WHERE x.billed_as_op = 0 AND e.base_class <> 1 AND e.disch_dttm > TIMESTAMP '2001-07-15' - INTERVAL 180 DAY)
SELECT csn, har, 0 AS billed_as_op FROM recent
UNION ALL SELECT csn, har, 0 FROM changed WHERE csn NOT IN (SELECT csn FROM recent)
UNION ALL SELECT csn, har, 1 FROM flipped
  WHERE csn NOT IN (SELECT csn FROM recent) AND csn NOT IN (SELECT csn FROM changed)"""
)
def cohort_in_steps(spark, folder):
    encounters, stored = t.order_encounters(spark, folder), t.stored_orders(spark, folder)
    chosen = pick.recent_activity(t.order_movements(spark, folder), encounters, WINDOW).withColumn(
        "billed_as_op", F.lit(0)
    )
    chosen = accumulate(chosen, pick.changed_end(stored, encounters, WINDOW), 0)
    return accumulate(chosen, pick.flag_flip(stored, encounters, WINDOW, from_=0), 1)


# -- dated records --------------------------------------------------------------------------

_HISTORY = """
history AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS start_dttm,
         lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - INTERVAL 1 MICROSECOND AS end_dttm
  FROM orders
),
facts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def _history(spark, folder):
    """Each order is its customer's current record until the next order."""
    orders = t.table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", F.col("o_orderdate").alias("start_dttm")
    )
    ahead = arrange(orders, ["o_custkey"], ["start_dttm", "o_orderkey"]).shift(next_dttm=("start_dttm", 1))
    return ahead.df.withColumn("end_dttm", F.col("next_dttm") - F.expr("INTERVAL '0.000001' SECOND")).drop("next_dttm")


def _facts(spark, folder):
    lines = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate"
    )
    owners = t.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return join_one(lines, owners, ["o_orderkey"]).withColumnRenamed("o_orderkey", "l_orderkey")


_JOIN = """LEFT JOIN history h ON h.o_custkey = f.o_custkey
  AND f.l_shipdate BETWEEN h.start_dttm AND coalesce(h.end_dttm, TIMESTAMP '9999-12-31')"""


@query(
    f"WITH {_HISTORY} SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_shipdate, h.o_orderkey AS valid_order, h.start_dttm AS valid_from FROM facts f {_JOIN}"
)
def dated_dimension(spark, folder):
    taken = {"o_orderkey": "valid_order", "start_dttm": "valid_from"}
    found = latest_record(
        _facts(spark, folder), _history(spark, folder), ["o_custkey"], "l_shipdate", "start_dttm", "end_dttm", taken
    )
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "valid_order", "valid_from")


@query(
    f"""WITH {_HISTORY}
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, CASE WHEN h.start_dttm IS NULL THEN NULL
  WHEN f.l_linenumber IN (6, 7) AND h.o_orderpriority LIKE '1%' THEN 'CRITICAL'
  WHEN f.l_linenumber IN (6, 7) THEN 'WARD' WHEN h.o_orderpriority LIKE '5%' THEN 'LOW' ELSE 'review' END AS kind
FROM facts f {_JOIN}"""
)
def classify_by_dated_record(spark, folder):
    taken = {"o_orderpriority": "priority", "start_dttm": "valid_from"}
    found = latest_record(
        _facts(spark, folder), _history(spark, folder), ["o_custkey"], "l_shipdate", "start_dttm", "end_dttm", taken
    )
    mixed = F.col("l_linenumber").isin(6, 7)
    kind = first_label(
        [
            (mixed & F.col("priority").like("1%"), "CRITICAL"),
            (mixed, "WARD"),
            (F.col("priority").like("5%"), "LOW"),
        ],
        F.lit("review"),
    )
    return found.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("valid_from").isNotNull(), kind).alias("kind")
    )


# -- hierarchies, keys, charges -------------------------------------------------------------


def _suppliers(spark, folder):
    return flatten_hierarchy(
        t.table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey"),
        [
            (t.table(spark, folder, "nation"), "s_nationkey", "n_nationkey", {"n_name": "nation", "n_regionkey": "_region"}),
            (t.table(spark, folder, "region"), "_region", "r_regionkey", {"r_name": "region"}),
        ],
    ).drop("_region")


@query(
    """SELECT s_suppkey, s_name, n_name AS nation, r_name AS region FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def hierarchy(spark, folder):
    return _suppliers(spark, folder).drop("s_nationkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey, n_name AS nation, r_name AS region
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
WHERE l_shipdate > TIMESTAMP '1997-07-01' AND l_shipdate <> o_orderdate AND l_linenumber IN (1, 2, 3, 4) AND o_orderstatus <> 'P'"""
)
def movement_detail(spark, folder):
    lines = (
        t.table(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.col("l_suppkey").alias("s_suppkey"))
        .filter((F.col("l_shipdate") > F.lit(datetime(1997, 7, 1))) & F.col("l_linenumber").isin(1, 2, 3, 4))
    )
    chosen = t.table(spark, folder, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    rows = join_one(lines, chosen, ["l_orderkey"]).filter("l_shipdate <> o_orderdate")
    placed = join_dim(rows, _suppliers(spark, folder), ["s_suppkey"])
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_custkey", "nation", "region")


@query(
    """SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer
ON o_custkey = c_custkey UNION SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_orderkey = c_custkey"""
)
def either_key(spark, folder):
    orders = t.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    people = t.table(spark, folder, "customer").select("c_custkey", "c_name")
    return join_any_key(people, orders, "c_custkey", ["o_custkey", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "c_custkey", "c_name"
    )


@query(
    """SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey HAVING sum(l_extendedprice) > 0
EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'N')"""
)
def only_code(spark, folder):
    lines = t.table(spark, folder, "lineitem")
    return only_code_keys(lines, "l_orderkey", "l_returnflag", "l_extendedprice", "R", ["A", "N"])


@query(
    """SELECT o_orderkey, CASE WHEN last_ship IS NOT NULL THEN last_ship ELSE o_orderdate END AS o_orderdate,
  CASE WHEN last_ship IS NOT NULL THEN 'SHIPPED' ELSE o_orderstatus END AS o_orderstatus
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) ON l_orderkey = o_orderkey"""
)
def merge_columns_shipped(spark, folder):
    shipped = (
        t.table(spark, folder, "lineitem")
        .filter("l_returnflag = 'A'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("o_orderdate"))
        .withColumn("o_orderstatus", F.lit("SHIPPED"))
    )
    orders = t.table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return merge_columns(orders, shipped, ["o_orderkey"], ["o_orderdate", "o_orderstatus"])


# -- text grids -----------------------------------------------------------------------------

_GRID = """
grid AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_type = 'error' THEN 'Null' WHEN event_type = 'signup' THEN 'NaN' ELSE event_type END AS event_type,
         CASE WHEN event_type = 'signup' AND event_id > 10 THEN 'NULL'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+0000') END AS seen_at,
         ts FROM events
)"""


def _grid(spark, folder):
    """``events`` as a query tool would export them: text cells with null tokens and UTC times."""
    events = t.table(spark, folder, "events")
    signup = F.col("event_type") == "signup"
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "Null").when(signup, "NaN").otherwise(F.col("event_type")).alias("event_type"),
        F.when(signup & (F.col("event_id") > 10), "NULL")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"))
        .alias("seen_at"),
    )


@query(
    f"""WITH {_GRID}
SELECT event_id, CASE WHEN lower(event_type) NOT IN ('null', 'nan') THEN event_type END AS event_type,
  CASE WHEN lower(seen_at) NOT IN ('null', 'nan') THEN seen_at END AS seen_at FROM grid"""
)
def clean_null_tokens(spark, folder):
    return grid.clean_null_tokens(_grid(spark, folder))


@query(
    f"""WITH {_GRID}
SELECT event_id, event_type, CASE WHEN seen_at <> 'NULL' THEN date_trunc('second', ts) END AS seen_at FROM grid"""
)
def normalize_utc(spark, folder):
    return grid.normalize_utc(_grid(spark, folder), first_by=["event_id"])


@query(
    f"""WITH {_GRID}
SELECT event_id, CASE WHEN lower(event_type) NOT IN ('null', 'nan') THEN event_type END AS event_type,
  CASE WHEN seen_at <> 'NULL' THEN strftime(ts, '%m/%d/%Y %H:%M:%S') END AS seen_at FROM grid"""
)
def clean_grid(spark, folder):
    return grid.clean_grid(_grid(spark, folder), first_by=["event_id"])


@query(
    """SELECT event_id, strftime(ts, '%-m/%-d/%Y %-H:%M') AS shown FROM events"""
)
def format_times(spark, folder):
    shown = t.table(spark, folder, "events").select("event_id", F.col("ts").alias("shown"))
    return grid.format_times(shown, ["shown"])


@query(
    f"""WITH {_GRID}
SELECT event_id, CASE WHEN lower(event_type) NOT IN ('null', 'nan') THEN event_type END AS event_type,
  CASE WHEN seen_at <> 'NULL' THEN strftime(ts, '%m/%d/%Y %H:%M:%S') END AS seen_at FROM grid"""
)
def read_grid(spark, folder):
    """The same grid written as text, read as text and cleaned."""
    path = scratch_path(spark)
    _grid(spark, folder).write.csv(path, header=True, sep="\t")
    return grid.clean_grid(grid.read_grid(spark, path), first_by=["event_id"])


@query(
    """WITH numbered AS (SELECT event_id, event_type, value, event_id % 10 AS n FROM events)
SELECT event_id, CASE WHEN n = 5 THEN event_type || chr(10) || 'and more' ELSE event_type END AS note,
  CASE WHEN n = 4 THEN NULL ELSE CAST(round(value) AS BIGINT) END AS value, CAST(NULL AS BIGINT) AS cells
FROM numbered WHERE n NOT IN (3, 7)
UNION ALL SELECT event_id, NULL, NULL, CASE n WHEN 3 THEN 2 ELSE 4 END FROM numbered WHERE n IN (3, 7)"""
)
def grid_with_rejects(spark, folder):
    """A grid with short and long records, quoted line breaks and null tokens: good rows, and rejects with their cells."""
    path = scratch_path(spark)
    n = F.col("event_id") % 10
    number = F.round("value").cast("bigint").cast("string")
    note = F.when(n == 5, F.concat(F.lit('"'), "event_type", F.lit('\nand more"'))).otherwise(F.col("event_type"))
    cells = [F.col("event_id").cast("string"), note, F.when(n == 3, None).when(n == 4, "NaN").otherwise(number), F.when(n == 7, "extra")]
    t.table(spark, folder, "events").select(F.concat_ws("\t", *cells)).write.text(path)
    rows, rejects = grid.read_grid_checked(spark, path, names=["event_id", "note", "value"], line_breaks=True)
    good = grid.clean_null_tokens(rows).select(
        F.col("event_id").cast("bigint").alias("event_id"), "note", F.col("value").cast("bigint").alias("value"), F.lit(None).cast("bigint").alias("cells")
    )
    bad = rejects.select(
        F.substring_index("record", "\t", 1).cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("note"),
        F.lit(None).cast("bigint").alias("value"),
        F.col("cells").cast("bigint").alias("cells"),
    )
    return good.unionByName(bad)


@query(
    """SELECT event_id, CASE event_id % 10 WHEN 2 THEN 'not yet known' WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 6 THEN NULL WHEN 8 THEN NULL
  ELSE strftime(ts, '%m/%d/%Y %H:%M:%S') END AS seen_at FROM events"""
)
def clean_grid_with_bad_cells(spark, folder):
    """Cells of a time column that are no time keep their text; blank cells and null tokens are empty."""
    n = F.col("event_id") % 10
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    cell = F.when(n == 2, "not yet known").when(n == 4, F.date_format("ts", "yyyy-MM-dd HH:mm")).when(n == 6, " ").when(n == 8, "NaN").otherwise(utc)
    cells = t.table(spark, folder, "events").select("event_id", cell.alias("seen_at"))
    return grid.clean_grid(cells.withColumn("event_id", F.col("event_id").cast("string")), first_by=["event_id"]).withColumn(
        "event_id", F.col("event_id").cast("bigint")
    )
