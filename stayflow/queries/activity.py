"""The whole unit-activity build on a hospital derived from the driver's tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.operators.cohort import RunWindow
from stayflow.operators.ordered import arrange
from stayflow.plans.daily import run_day
from stayflow.plans.schemas import INPUTS, OUTPUT
from stayflow.plans.unit_activity import build, find_encounters
from stayflow.queries import tables as t
from stayflow.queries.registry import query
from stayflow.sources.published import MONTH, publish, read_published
from stayflow.sources.scratch import keep, scratch_path

WINDOW = RunWindow(date(2024, 2, 1), lookback_days=40)

# Fixed values of this hospital, which the expected result states as well.
# What each event type stands for: department, name, specialty, group, site group, location.
_PLACES = {
    "view": (11, "WARD A", "Medicine", 3, "HUPW", 10103),
    "click": (12, "WOMENS", "Obstetrics", 2, "HUPE", 10107),
    "purchase": (20, "CEDAR ICU", "Critical", 4, "HUP54", 10344),
    "signup": (40, "MAIN OR", "Surgery", 6, "X", 10243),
    "error": (5602, "THE EMERGENCY DEPARTMENT", "Emergency", 6, "X", 10103),
}
# From 16 January the womens unit is a ward of another site and the ICU is no longer mixed.
_LATER = {"click": (3, "HUP54"), "purchase": (4, "HUPW")}


_DERIVED = ("movements", "encounters", "accounts", "dept", "loc")


def _pick(column, place: int):
    out = None
    for kind, values in _PLACES.items():
        test = column == kind
        out = F.when(test, values[place]) if out is None else out.when(test, values[place])
    return out


def _typed(df: DataFrame, name: str) -> DataFrame:
    fields = [f.strip().split(" ") for f in INPUTS[name].replace("(18,2)", "(18;2)").split(",")]
    return df.select(*[F.col(n).cast(kind.replace(";", ",")).alias(n) for n, kind in fields])


def _weekly(events: DataFrame) -> DataFrame:
    """A user is an account, and each week of the month an encounter of its own."""
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    return events.withColumns({"har": F.col("user_id"), "user_id": F.col("user_id") * 10 + week})


def _with_merges(accounts: DataFrame) -> DataFrame:
    """Every tenth account was merged into the next one in the run's window, and another tenth long before."""
    ending = F.pmod("har", F.lit(10))
    merged = ending.isin(3, 6)
    return accounts.withColumns(
        {
            "combine_har": F.when(merged, F.col("har") + 1),
            "combine_dttm": F.when(ending == 3, F.lit(datetime(2024, 1, 31))).when(ending == 6, F.lit(datetime(2023, 6, 1))),
            "base_class": F.when(F.pmod("har", F.lit(4)) == 0, 2).otherwise(1),
        }
    )


def hospital(spark: SparkSession, folder: str, weekly: bool = False) -> dict[str, DataFrame]:
    """All input tables of the build, derived from ``events``."""
    events = t.table(spark, folder, "events")
    events = _weekly(events) if weekly else events.withColumn("har", F.pmod("user_id", F.lit(t.ACCOUNTS)))
    dept = _pick(F.col("event_type"), 0)
    hour = F.col("ts") + F.expr("INTERVAL '1' HOUR")
    gone = ~F.col("event_type").isin("view", "purchase")
    log = (
        arrange(events, ["user_id"], ["ts", "event_id"])
        .shift(next_ts=("ts", 1))
        .df.select(
            F.col("user_id").alias("csn"),
            "event_id",
            dept.alias("dept_id"),
            F.col("ts").alias("in_dttm"),
            F.coalesce("next_ts", hour).alias("out_dttm"),
            F.coalesce("next_ts", F.when(gone, hour)).alias("pat_out_dttm"),
        )
    )
    first_kind = F.min_by("event_type", "ts")
    last_kind = F.max_by("event_type", "ts")
    encounters = events.groupBy(F.col("user_id").alias("csn"), "har").agg(
        _pick(first_kind, 0).alias("dept_id"),
        F.when(first_kind == "signup", 102)
        .when(first_kind == "purchase", 153)
        .otherwise(101)
        .alias("pat_class"),
        F.min("ts").alias("admit_dttm"),
        F.when(~last_kind.isin("view", "purchase"), F.max("ts") + F.expr("INTERVAL '1' HOUR")).alias("disch_dttm"),
        F.min("ts").alias("inp_adm_dttm"),
    )
    accounts = events.groupBy("har").agg(
        F.lit("p").alias("pat_id"),
        F.min("user_id").alias("prim_csn"),
        F.lit(None).cast("bigint").alias("combine_har"),
        F.lit(None).cast("timestamp_ntz").alias("combine_dttm"),
        F.min("ts").alias("adm_dttm"),
        F.when(F.max("value") > 300, 2).otherwise(1).alias("base_class"),
        F.lit(101).alias("acct_class"),
        F.round(F.sum("value"), 2).alias("tot_chgs"),
    )
    kinds = events.select("event_type").distinct()
    kind = F.col("event_type")
    depts = kinds.select(
        *[
            _pick(kind, i).alias(n)
            for i, n in enumerate(["dept_id", "name", "specialty", "grp11", "grp4", "rev_loc_id"])
        ],
        "event_type",
    )
    early = depts.select(
        "dept_id",
        F.expr("timestamp_ntz'2000-01-01 00:00:00'").alias("start_date"),
        F.expr("timestamp_ntz'2024-01-15 23:59:59'").alias("end_date"),
        "grp11",
        "grp4",
        "rev_loc_id",
    )

    def later(column: str, place: int):
        out = F.col(column)
        for name, values in _LATER.items():
            out = F.when(kind == name, values[place]).otherwise(out)
        return out

    late = depts.select(
        "dept_id",
        F.expr("timestamp_ntz'2024-01-16 00:00:00'").alias("start_date"),
        F.expr("timestamp_ntz'2100-01-01 00:00:00'").alias("end_date"),
        later("grp11", 0).alias("grp11"),
        later("grp4", 1).alias("grp4"),
        "rev_loc_id",
    )
    levels = events.select(
        "event_id",
        F.col("user_id").alias("csn"),
        F.col("ts").alias("effective_dttm"),
        F.when(F.col("value") > 40, 37).otherwise(1).alias("level_of_care"),
        F.lit(1).alias("event_subtype"),
    ).unionByName(
        events.select(
            (F.col("event_id") + 1_000_000_000_000).alias("event_id"),
            F.col("user_id").alias("csn"),
            (F.col("ts") + F.expr("INTERVAL '90' MINUTE")).alias("effective_dttm"),
            F.when(F.col("value") >= 20, 1).when(F.col("value") >= 2, 37).alias("level_of_care"),
            F.when(kind == "error", 2).otherwise(1).alias("event_subtype"),
        )
    )
    sites = depts.select(
        F.col("rev_loc_id").alias("loc_id"),
        F.when(F.col("rev_loc_id") == 10107, 901).otherwise(900).alias("parent_loc_id"),
        F.lit(None).cast("int").alias("grp7"),
    ).distinct()
    parents = sites.select(
        F.col("parent_loc_id").alias("loc_id"),
        F.lit(None).cast("int").alias("parent_loc_id"),
        F.when(F.col("parent_loc_id") == 901, 31).otherwise(30).alias("grp7"),
    ).distinct()
    entity = parents.select("grp7", F.when(F.col("grp7") == 30, "HUP").otherwise("PPMC").alias("name"))
    codes = kinds.select(
        F.when(kind == "signup", 1).when(kind == "error", 2).when(kind == "click", 3).otherwise(4).alias("rev_code_id")
    ).distinct()
    codes = codes.withColumn(
        "revenue_code",
        F.when(F.col("rev_code_id") == 1, "0171")
        .when(F.col("rev_code_id") == 2, "0173")
        .when(F.col("rev_code_id") == 3, "0174")
        .otherwise("0999"),
    )
    charges = events.select(
        "har",
        F.when(kind == "signup", 1)
        .when((kind == "error") & (F.col("value") > 250), 2)
        .otherwise(4)
        .alias("rev_code_id"),
        F.round(F.col("value") - 20, 2).alias("amount"),
    )
    made = {
        "movements": log,
        "encounters": encounters,
        "accounts": _with_merges(accounts) if weekly else accounts,
        "dept": depts,
        "dept_history": early.unionByName(late),
        "loc_events": levels,
        "loc": sites.unionByName(parents),
        "entity": entity,
        "charges": charges,
        "rev_codes": codes,
    }
    # as the build finds them: stored tables, not plans that derive them anew at every read
    return {name: keep(_typed(df, name)) if name in _DERIVED else _typed(df, name) for name, df in made.items()}


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _split_rounds() -> str:
    sql = """
cut0 AS (SELECT event_id, csn, dept_id, hosp, pat_out, in_dttm AS cut, kind AS state FROM typed WHERE kind IS NOT NULL)"""
    for k in range(1, 11):
        sql += f""",
cut{k} AS (
  SELECT c.event_id, c.csn, c.dept_id, c.hosp, c.pat_out, min(a.effective) AS cut,
         CASE WHEN c.state = 'CRITICAL CARE' THEN 'MED/SURG' ELSE 'CRITICAL CARE' END AS state
  FROM cut{k - 1} c JOIN hist h ON h.dept_id = c.dept_id AND c.cut BETWEEN h.start_date AND h.end_date
  JOIN care a ON a.csn = c.csn AND a.effective BETWEEN c.cut + INTERVAL 1 MINUTE
    AND coalesce(c.pat_out - INTERVAL 1 MINUTE, TIMESTAMP '2024-02-01')
  WHERE h.grp11 = 4 AND (c.hosp IN ('CCH', 'MCP') OR h.grp4 = 'HUP54') AND a.subtype <> 2
    AND CASE WHEN a.level IN (36, 37) THEN 'CRITICAL CARE' WHEN a.level IS NOT NULL THEN 'MED/SURG' END <> c.state
  GROUP BY ALL)"""
    return sql


# The types that count as a next unit, and the rules for a site.
_NEXT = "('LTACH', 'CRITICAL CARE', 'WOMENS SERVICES', 'MED/SURG', 'REHAB')"
_SITE = """CASE WHEN {0}.grp4 = 'HUPW' THEN 'HUP-Main' WHEN {0}.rev_loc_id = 10345 THEN 'HUP-Cedar_Psych'
    WHEN {0}.grp4 = 'HUP54' THEN 'HUP-Cedar' WHEN {0}.grp4 = 'HUPE' THEN 'HUP-Pavilion'
    WHEN {0}.rev_loc_id IN (10103, 10107) THEN 'HUP-Main' WHEN {0}.rev_loc_id IN (10243, 10242) THEN 'Rittenhouse'
    ELSE 'Needs Investigation' END"""


def _around(name: str, source: str) -> str:
    """Movements outside units, with edges among themselves."""
    return f"""
{name} AS (
  SELECT csn, har, billed, dept_id, name, specialty, in_dttm, pat_out, 'NON IP UNIT' AS kind,
    CASE WHEN lag(dept_id) OVER w IS NULL OR lag(dept_id) OVER w <> dept_id THEN 1 END AS admit,
    CASE WHEN (lead(dept_id) OVER w IS NULL OR lead(dept_id) OVER w <> dept_id) AND pat_out IS NOT NULL
         THEN 'TRANSFER FROM UNIT' WHEN pat_out IS NULL THEN 'PATIENT IN UNIT' END AS leave
  FROM ({source}) WINDOW w AS (PARTITION BY csn ORDER BY in_dttm, out_dttm))"""


def _tables_sql(events: str, har: str, accounts: str) -> str:
    """The hospital; ``har`` is an encounter's account, ``accounts`` their classes and merges."""
    return f"""dept AS (SELECT * FROM (VALUES {_values(_PLACES.values())}) v(dept_id, name, specialty, grp11, grp4, rev_loc_id)),
places AS (SELECT dept.*, CASE WHEN rev_loc_id = 10107 THEN 'PPMC' ELSE 'HUP' END AS hosp FROM dept),
hist AS (
  SELECT dept_id, TIMESTAMP '2000-01-01' AS start_date, TIMESTAMP '2024-01-15 23:59:59' AS end_date, grp11, grp4, rev_loc_id FROM dept
  UNION ALL SELECT dept_id, TIMESTAMP '2024-01-16', TIMESTAMP '2100-01-01', CASE dept_id WHEN 12 THEN 3 ELSE grp11 END,
    CASE dept_id WHEN 12 THEN 'HUP54' WHEN 20 THEN 'HUPW' ELSE grp4 END, rev_loc_id FROM dept),
log AS (
  SELECT user_id AS csn, event_id, CASE event_type WHEN 'view' THEN 11 WHEN 'click' THEN 12 WHEN 'purchase' THEN 20
    WHEN 'signup' THEN 40 ELSE 5602 END AS dept_id, ts AS in_dttm, lead(ts) OVER w AS next_ts, event_type, value
  FROM ({events}) WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
moves AS (
  SELECT csn, event_id, dept_id, in_dttm, coalesce(next_ts, in_dttm + INTERVAL 1 HOUR) AS out_dttm,
    CASE WHEN next_ts IS NOT NULL THEN next_ts WHEN event_type NOT IN ('view', 'purchase') THEN in_dttm + INTERVAL 1 HOUR END AS pat_out
  FROM log),
encounters AS (
  SELECT csn, {har} AS har, arg_min(dept_id, in_dttm) AS dept_id,
    CASE arg_min(event_type, in_dttm) WHEN 'signup' THEN 102 WHEN 'purchase' THEN 153 ELSE 101 END AS pat_class,
    min(in_dttm) AS admit, CASE WHEN arg_max(event_type, in_dttm) NOT IN ('view', 'purchase') THEN max(in_dttm) + INTERVAL 1 HOUR END AS disch
  FROM log GROUP BY csn),
accounts AS (
  SELECT {har} AS har, min(csn) AS prim_csn, min(in_dttm) AS adm, {accounts},
    round(sum(value), 2) AS tot FROM log GROUP BY {har}),
care AS (
  SELECT event_id, csn, in_dttm AS effective, CASE WHEN value > 40 THEN 37 ELSE 1 END AS level, 1 AS subtype FROM log
  UNION ALL SELECT event_id + 1000000000000, csn, in_dttm + INTERVAL 90 MINUTE, CASE WHEN value >= 20 THEN 1 WHEN value >= 2 THEN 37 END,
    CASE WHEN event_type = 'error' THEN 2 ELSE 1 END FROM log)"""


_COHORT_SQL = """recent AS (
  SELECT DISTINCT csn FROM moves WHERE out_dttm BETWEEN TIMESTAMP '2023-12-23' AND TIMESTAMP '2024-02-02'
    OR in_dttm BETWEEN TIMESTAMP '2023-12-23' AND TIMESTAMP '2024-02-02'),
inpatients AS (
  SELECT e.csn, e.har, 0 AS billed FROM recent JOIN encounters e USING (csn) JOIN accounts a ON a.har = e.har
  WHERE e.pat_class NOT IN (103, 104) AND a.base_class = 1
    AND (e.pat_class IN (101, 102, 125, 10014)
      OR e.csn IN (SELECT csn FROM moves JOIN dept USING (dept_id) WHERE grp11 IN (1, 2, 3, 4)))),
outpatients AS (
  SELECT e.csn, e.har, 1 AS billed FROM recent JOIN encounters e USING (csn) JOIN accounts a ON a.har = e.har JOIN dept d ON d.dept_id = e.dept_id
  WHERE a.base_class IN (2, 3) AND d.grp11 IN (1, 2, 3, 4) AND e.pat_class <> 138),
listed AS (SELECT * FROM inpatients UNION ALL SELECT * FROM outpatients),
cohort AS (
  SELECT * FROM listed
  UNION ALL SELECT prim_csn, har, 0 FROM accounts WHERE tot > 1000 AND adm > TIMESTAMP '2024-02-01' - INTERVAL 180 DAY
    AND prim_csn NOT IN (SELECT csn FROM listed))"""

_STEPS_SQL = f"""cm AS (SELECT m.*, c.har, c.billed, p.name, p.specialty, p.grp11, p.hosp FROM moves m JOIN cohort c USING (csn) JOIN places p USING (dept_id)),
typed AS (
  SELECT cm.*, CASE h.grp11 WHEN 1 THEN 'PSYCHIATRY' WHEN 2 THEN 'WOMENS SERVICES' WHEN 3 THEN 'MED/SURG'
      WHEN 4 THEN CASE WHEN cm.hosp = 'HUP' AND h.grp4 = 'HUP54' AND a.level NOT IN (36, 37) THEN 'MED/SURG' ELSE 'CRITICAL CARE' END
    END AS kind
  FROM cm JOIN care a USING (event_id) LEFT JOIN hist h ON h.dept_id = cm.dept_id AND cm.in_dttm BETWEEN h.start_date AND h.end_date
  WHERE cm.grp11 IN (1, 2, 3, 4) AND cm.in_dttm <> cm.out_dttm),
{_split_rounds()},
cuts AS ({" UNION ALL ".join(f"SELECT event_id, {k} AS piece, cut, state FROM cut{k}" for k in range(11))}),
pieces AS (
  SELECT t.csn, t.har, t.billed, t.dept_id, t.name, t.specialty, t.out_dttm, c.cut AS in_dttm, c.state AS kind,
    coalesce(lead(c.cut) OVER (PARTITION BY t.event_id ORDER BY c.piece), t.pat_out) AS pat_out
  FROM typed t JOIN cuts c USING (event_id)
  UNION ALL SELECT csn, har, billed, dept_id, name, specialty, out_dttm, in_dttm, kind, pat_out FROM typed WHERE kind IS NULL),
units AS (
  SELECT csn, har, billed, dept_id, name, specialty, in_dttm, pat_out, kind,
    CASE WHEN lag(dept_id) OVER w IS NULL OR lag(dept_id) OVER w <> dept_id OR lag(kind) OVER w <> kind THEN 1 END AS admit,
    CASE WHEN (lead(dept_id) OVER w IS NULL OR lead(dept_id) OVER w <> dept_id OR lead(kind) OVER w <> kind) AND pat_out IS NOT NULL
      THEN 'TRANSFER FROM UNIT' WHEN pat_out IS NULL THEN 'PATIENT IN UNIT' END AS leave
  FROM pieces WINDOW w AS (PARTITION BY csn ORDER BY in_dttm)),
{_around("before", "SELECT cm.* FROM cm JOIN (SELECT csn, min(in_dttm) AS edge FROM units GROUP BY csn) USING (csn) WHERE in_dttm < edge AND in_dttm <> out_dttm")},
{_around("after", "SELECT cm.* FROM cm JOIN (SELECT csn, max(coalesce(pat_out, TIMESTAMP '9999-12-31')) AS edge FROM (SELECT csn, pat_out FROM units UNION ALL SELECT csn, pat_out FROM before) GROUP BY csn) USING (csn) WHERE in_dttm >= edge AND in_dttm <> out_dttm")},
{_around("nowhere", "SELECT * FROM cm WHERE csn NOT IN (SELECT csn FROM units)")},
every AS (SELECT * FROM units UNION ALL SELECT * FROM before UNION ALL SELECT * FROM after UNION ALL SELECT * FROM nowhere),
labelled AS (
  SELECT * REPLACE (CASE WHEN kind <> 'NON IP UNIT' OR kind IS NULL THEN kind
    WHEN dept_id IN (5602, 5836, 5412) OR name LIKE '% EMERGENCY DEPARTMENT%' THEN 'NON IP UNIT: ED'
    WHEN name LIKE '% OR' THEN 'NON IP UNIT: OR' ELSE 'NON IP UNIT: ' || specialty END AS kind),
    row_number() OVER (PARTITION BY csn ORDER BY in_dttm) AS rn, count(*) OVER (PARTITION BY csn) AS n FROM every),
fixed AS (
  SELECT l.* REPLACE (CASE WHEN l.admit = 1 OR p.csn IS NOT NULL THEN 1 END AS admit)
  FROM labelled l LEFT JOIN labelled p ON p.csn = l.csn AND p.rn = l.rn - 1 AND p.pat_out IS NULL
  WHERE l.pat_out IS NOT NULL OR l.rn = l.n),
admits AS (SELECT *, coalesce(lead(rn) OVER (PARTITION BY csn ORDER BY rn), 1000000000) AS next_rn FROM fixed WHERE admit = 1),
closing AS (
  SELECT a.csn, a.rn, max(f.rn) AS close_rn FROM admits a JOIN fixed f ON f.csn = a.csn AND f.rn BETWEEN a.rn AND a.next_rn - 1
  WHERE f.leave IS NOT NULL GROUP BY ALL),
stays AS (
  SELECT a.csn, a.har, a.billed, a.kind, a.dept_id, a.in_dttm, f.pat_out AS out_dttm, f.leave AS status, a.rn
  FROM admits a LEFT JOIN closing c ON c.csn = a.csn AND c.rn = a.rn LEFT JOIN fixed f ON f.csn = c.csn AND f.rn = c.close_rn),
holes AS (SELECT *, lag(out_dttm) OVER (PARTITION BY csn ORDER BY in_dttm) AS prev_out FROM stays),
gaps AS (
  SELECT x.csn, x.har, x.billed,
    CASE WHEN x.dept_id IN (5602, 5836, 5412) OR p.name LIKE '% EMERGENCY DEPARTMENT%' THEN 'NON IP UNIT: ED'
      WHEN p.name LIKE '% OR' THEN 'NON IP UNIT: OR' ELSE 'NON IP UNIT: ' || p.specialty END AS kind,
    m.dept_id, m.in_dttm, m.pat_out AS out_dttm, CASE WHEN m.pat_out IS NULL THEN 'PATIENT IN UNIT' ELSE 'TRANSFER FROM UNIT' END AS status,
    CAST(NULL AS BIGINT) AS rn
  FROM holes x JOIN moves m ON m.csn = x.csn AND m.in_dttm BETWEEN date_trunc('minute', x.prev_out + INTERVAL 30 SECOND) AND x.in_dttm - INTERVAL 1 MINUTE
  JOIN places p ON p.dept_id = m.dept_id WHERE x.prev_out < x.in_dttm),
filled AS (
  SELECT *, lead(in_dttm) OVER (PARTITION BY csn ORDER BY in_dttm) AS later, row_number() OVER (PARTITION BY csn ORDER BY in_dttm) AS line
  FROM (SELECT * FROM stays UNION ALL SELECT * FROM gaps)),
closed AS (
  SELECT * REPLACE (CASE WHEN status = 'PATIENT IN UNIT' AND later IS NOT NULL THEN later ELSE out_dttm END AS out_dttm,
    CASE WHEN status = 'PATIENT IN UNIT' AND later IS NOT NULL THEN 'TRANSFER FROM UNIT' ELSE status END AS status),
    kind NOT LIKE 'NON IP%' AS is_unit, kind = 'CRITICAL CARE' AS is_icu FROM filled),
first_pass AS (
  SELECT c.csn, c.rn, lead(c.kind) OVER w AS next_kind, lead(c.dept_id) OVER w AS next_dept, c.status, c.out_dttm, e.disch
  FROM closed c JOIN encounters e USING (csn) WHERE (c.is_unit OR c.dept_id IN (5602, 4140, 4056, 4143)) AND c.rn IS NOT NULL
  WINDOW w AS (PARTITION BY c.csn ORDER BY c.rn)),
decided AS (
  SELECT csn, rn, CASE WHEN next_kind IN {_NEXT} THEN next_kind WHEN status = 'PATIENT IN UNIT' THEN 'PATIENT CURRENTLY IN UNIT'
      WHEN status = 'TRANSFER FROM UNIT' AND disch = out_dttm THEN 'DISCHARGED' WHEN status = 'TRANSFER FROM UNIT' THEN 'PT TXN TO NON-IP LOC' END AS next_csn,
    CASE WHEN next_kind IN {_NEXT} THEN CAST(next_dept AS VARCHAR) END AS next_dept FROM first_pass),
passed AS (
  SELECT c.* REPLACE (CASE WHEN d.next_csn = 'DISCHARGED' THEN 'DISCHARGED' ELSE status END AS status), d.next_csn, d.next_dept,
    lead(kind, 1) OVER w AS k1, lead(kind, 2) OVER w AS k2, lead(kind, 3) OVER w AS k3, lead(kind, 4) OVER w AS k4, lead(dept_id) OVER w AS d1
  FROM closed c LEFT JOIN decided d ON d.csn = c.csn AND d.rn = c.rn WINDOW w AS (PARTITION BY c.csn ORDER BY line)),
looked AS (
  SELECT *, CASE WHEN next_csn IS NULL AND status = 'TRANSFER FROM UNIT' THEN CASE WHEN k1 IN {_NEXT} THEN k1 WHEN k2 IN {_NEXT} THEN k2
    WHEN k3 IN {_NEXT} THEN k3 WHEN k4 IN {_NEXT} THEN k4 END END AS found FROM passed),
nexts AS (
  SELECT * REPLACE (CASE WHEN found IS NOT NULL THEN found ELSE next_csn END AS next_csn,
    CASE WHEN found IS NOT NULL THEN CAST(d1 AS VARCHAR) ELSE next_dept END AS next_dept),
    CASE WHEN is_unit THEN count(*) FILTER (is_unit) OVER (PARTITION BY csn ORDER BY line) END AS unit_csn,
    CASE WHEN is_icu THEN count(*) FILTER (is_icu) OVER (PARTITION BY csn ORDER BY line) END AS icu_csn,
    CASE WHEN is_unit THEN count(*) FILTER (is_unit) OVER (PARTITION BY har ORDER BY in_dttm) END AS unit_har,
    CASE WHEN is_icu THEN count(*) FILTER (is_icu) OVER (PARTITION BY har ORDER BY in_dttm) END AS icu_har FROM looked),
back_csn AS (
  SELECT csn, line, CASE WHEN next_csn NOT IN ('CRITICAL CARE', 'PATIENT CURRENTLY IN UNIT')
    THEN round(CAST(date_diff('minute', out_dttm, lead(in_dttm) OVER (PARTITION BY csn ORDER BY icu_csn)) AS DECIMAL(18, 6)) / 60, 1) + 0.0 END AS hrs_csn
  FROM nexts WHERE icu_csn IS NOT NULL),
placed AS (
  SELECT x.*, p.hosp, CASE WHEN p.hosp = 'HUP' THEN CASE WHEN h.dept_id IS NOT NULL THEN {_SITE.format("h")} ELSE {_SITE.format("p")} END END AS site
  FROM nexts x LEFT JOIN places p USING (dept_id) LEFT JOIN hist h ON h.dept_id = x.dept_id AND x.in_dttm BETWEEN h.start_date AND h.end_date),
crossing AS (
  SELECT har FROM (SELECT DISTINCT har, site = 'HUP-Cedar' AS cedar FROM placed WHERE site IN ('HUP-Cedar', 'HUP-Main', 'HUP-Pavilion'))
  GROUP BY har HAVING count(*) > 1),
crossed AS (SELECT p.*, CASE WHEN c.har IS NULL THEN 0 ELSE 1 END AS cross_site FROM placed p LEFT JOIN crossing c ON c.har = p.har),
transfers AS (
  SELECT csn, line, CASE WHEN status = 'DISCHARGED' AND lead(site) OVER w IS NOT NULL
    THEN 'TRANSFER TO ' || upper(lead(site) OVER w) || '; ' || lead(kind) OVER w ELSE next_csn END AS upd
  FROM crossed WHERE cross_site = 1 AND (status = 'DISCHARGED' OR kind IN {_NEXT}) WINDOW w AS (PARTITION BY har ORDER BY in_dttm)),
har_next AS (
  SELECT c.*, CASE WHEN c.next_csn <> t.upd THEN t.upd ELSE c.next_csn END AS next_har FROM crossed c LEFT JOIN transfers t ON t.csn = c.csn AND t.line = c.line),
back_har AS (
  SELECT csn, line, CASE WHEN next_har NOT IN ('CRITICAL CARE', 'PATIENT CURRENTLY IN UNIT', 'TRANSFER TO HUP-MAIN; CRITICAL CARE', 'TRANSFER TO HUP-CEDAR; CRITICAL CARE')
    THEN round(CAST(date_diff('minute', out_dttm, lead(in_dttm) OVER (PARTITION BY har ORDER BY icu_har)) AS DECIMAL(18, 6)) / 60, 1) + 0.0 END AS hrs_har
  FROM har_next WHERE icu_har IS NOT NULL),
visits AS (
  SELECT s.csn, s.line, count(*) AS visits FROM har_next s JOIN moves m ON m.csn = s.csn AND m.in_dttm BETWEEN s.in_dttm AND s.out_dttm - INTERVAL 1 MINUTE
    AND m.dept_id <> s.dept_id JOIN dept d ON d.dept_id = m.dept_id WHERE m.dept_id <> 5602 AND d.grp11 = 6 GROUP BY ALL),
newborns AS (
  SELECT csn_har AS har FROM (SELECT *, CSN_HAR AS csn_har FROM log) GROUP BY 1 HAVING sum(CASE WHEN event_type = 'signup' THEN round(value - 20, 2) END) > 0
    AND count(*) FILTER (event_type = 'error' AND value > 250) = 0),
kept AS (SELECT * FROM har_next WHERE NOT (coalesce(kind LIKE 'NON IP UNIT%', false) AND coalesce(status = 'PATIENT IN UNIT', false) AND line = 1)),
last_lines AS (SELECT csn, max(line) AS line FROM kept GROUP BY csn),
final AS (
  SELECT k.*, v.visits, b.hrs_csn, r.hrs_har, nb.har IS NOT NULL AS newborn, e.pat_class,
    l.line IS NOT NULL AND k.status NOT IN ('DISCHARGED', 'PATIENT IN UNIT') AND k.next_csn IS NULL AND k.out_dttm = e.disch AS ends
  FROM kept k JOIN encounters e ON e.csn = k.csn LEFT JOIN last_lines l ON l.csn = k.csn AND l.line = k.line
  LEFT JOIN visits v ON v.csn = k.csn AND v.line = k.line LEFT JOIN back_csn b ON b.csn = k.csn AND b.line = k.line
  LEFT JOIN back_har r ON r.csn = k.csn AND r.line = k.line LEFT JOIN newborns nb ON nb.har = k.har)"""

_SELECT_SQL = """SELECT csn AS "PAT_ENC_CSN", line AS "LINE", har AS "HSP_ACCOUNT_ID", kind AS "UNIT_STAY_TYPE", CAST(dept_id AS BIGINT) AS "ADT_DEPARTMENT_ID",
  in_dttm AS "UNIT_IN_DTTM", out_dttm AS "UNIT_OUT_DTTM", CASE WHEN ends THEN 'DISCHARGED' ELSE status END AS "UNIT_STATUS",
  unit_csn AS "IP_UNIT_TRACKER_CSN", icu_csn AS "ICU_TRACKER_CSN", next_dept AS "NEXT_IP_DEPT_ID",
  CASE WHEN ends THEN 'DISCHARGED' ELSE next_csn END AS "NEXT_IP_UNIT_STAY_TYPE_CSN", unit_har AS "IP_UNIT_TRACKER_HAR", icu_har AS "ICU_TRACKER_HAR",
  CASE WHEN ends THEN 'DISCHARGED' ELSE next_har END AS "NEXT_IP_UNIT_STAY_TYPE_HAR", coalesce(visits, 0) AS "ANCILLARY_VISITS",
  CAST(hrs_csn AS DOUBLE) AS "ICU_BOUNCE_BACK_HRS_CSN", CAST(hrs_har AS DOUBLE) AS "ICU_BOUNCE_BACK_HRS_HAR", CAST(billed AS BIGINT) AS "BILLED_AS_OP",
  CAST(cross_site AS BIGINT) AS "CEDAR_SPRUCE_TXN_YN", CAST(CASE WHEN newborn THEN 1 WHEN rn IS NOT NULL THEN 0 END AS BIGINT) AS "NORMAL_NEWBORN_YN",
  (SELECT date_trunc('minute', max(out_dttm) + INTERVAL 30 SECOND) FROM kept) AS "EXTRACTION_DTTM_APPROX", hosp AS "HOSP", site AS "HUP_SITE",
  CAST(CASE WHEN pat_class IN (153, 121) THEN 1 WHEN rn IS NOT NULL THEN 0 END AS BIGINT) AS "HOSPICE_ADMISSION_YN"
FROM final"""


def _activity_sql(events: str, har: str, accounts: str, cohort: str) -> str:
    """All tables up to ``final``, which has a row per stay."""
    return f"{_tables_sql(events, har, accounts)},\n{cohort},\n{_STEPS_SQL}".replace("CSN_HAR", har)


_ACTIVITY_SQL = "WITH " + _activity_sql(
    "SELECT * FROM events", "csn % 50", "CASE WHEN max(value) > 300 THEN 2 ELSE 1 END AS base_class", _COHORT_SQL
) + "\n" + _SELECT_SQL


def _plain_numbers(table: DataFrame) -> DataFrame:
    return table.select(
        *[
            F.col(n).cast("bigint" if kind == "int" else "double" if kind.startswith("decimal") else kind).alias(n)
            for n, kind in table.dtypes
        ]
    )


@query(_ACTIVITY_SQL)
def unit_activity(spark, folder):
    stored = spark.createDataFrame([], OUTPUT)
    return _plain_numbers(build(hospital(spark, folder), stored, WINDOW).drop("TABLE_OWNER"))


# -- the daily run against a stored table ---------------------------------------------------

DAILY = RunWindow(date(2024, 2, 5), lookback_days=8)
FIRST_OF_MONTH = RunWindow(date(2024, 2, 1), lookback_days=8)
_WEEKLY = "SELECT event_id, ts, user_id * 10 + (day(ts) - 1) // 7 AS user_id, event_type, value FROM events"
_MERGED = """CASE WHEN (csn // 10) % 4 = 0 THEN 2 ELSE 1 END AS base_class,
    CASE WHEN (csn // 10) % 10 IN (3, 6) THEN csn // 10 + 1 END AS combine_har,
    CASE (csn // 10) % 10 WHEN 3 THEN TIMESTAMP '2024-01-31' WHEN 6 THEN TIMESTAMP '2023-06-01' END AS combine"""


def stored_stays(tables: dict[str, DataFrame]) -> DataFrame:
    """What earlier runs are taken to have published: one stay for each encounter of the first three weeks.

    Some were stored with another discharge time, some with another billing flag, and some accounts not at all.
    """
    account = lambda n: F.pmod("har", F.lit(n))
    seen = tables["encounters"].filter((F.pmod("csn", F.lit(10)) < 3) & (account(11) != 10))
    late = F.when(account(7) == 2, F.expr("INTERVAL '1' HOUR")).otherwise(F.expr("INTERVAL '0' HOUR"))
    billed = F.when(account(4) == 0, F.when(account(8) == 0, 0).otherwise(1)).when(account(9) == 5, 1).otherwise(0)
    made = {
        "PAT_ENC_CSN": F.col("csn"),
        "LINE": F.lit(1),
        "HSP_ACCOUNT_ID": F.col("har"),
        "UNIT_STAY_TYPE": F.when(F.col("dept_id") == 20, "CRITICAL CARE").otherwise("MED/SURG"),
        "ADT_DEPARTMENT_ID": F.col("dept_id"),
        "UNIT_IN_DTTM": F.col("admit_dttm"),
        "UNIT_OUT_DTTM": F.col("disch_dttm") + late,
        "UNIT_STATUS": F.lit("DISCHARGED"),
        "IP_UNIT_TRACKER_HAR": F.lit(1),
        "BILLED_AS_OP": billed,
    }
    types = dict(part.split(" ") for part in OUTPUT.split(", "))
    return seen.select(*[made.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in types.items()])


_STORED_SQL = """stored0 AS (
  SELECT csn AS "PAT_ENC_CSN", CAST(1 AS BIGINT) AS "LINE", har AS "HSP_ACCOUNT_ID", CASE WHEN dept_id = 20 THEN 'CRITICAL CARE' ELSE 'MED/SURG' END AS "UNIT_STAY_TYPE",
    CAST(dept_id AS BIGINT) AS "ADT_DEPARTMENT_ID", admit AS "UNIT_IN_DTTM", disch + CASE WHEN har % 7 = 2 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS "UNIT_OUT_DTTM",
    'DISCHARGED' AS "UNIT_STATUS", CAST(1 AS BIGINT) AS "IP_UNIT_TRACKER_HAR", CAST(NULL AS BIGINT) AS "ICU_TRACKER_HAR",
    CAST(CASE WHEN har % 4 = 0 THEN CASE WHEN har % 8 = 0 THEN 0 ELSE 1 END WHEN har % 9 = 5 THEN 1 ELSE 0 END AS BIGINT) AS "BILLED_AS_OP"
  FROM encounters WHERE csn % 10 < 3 AND har % 11 <> 10)"""


def _cohort_sql(window: RunWindow, tag: str = "") -> str:
    """The steps of a run, one after the other, each without what an earlier one has listed."""
    start, end, before = (f"TIMESTAMP '{d:%Y-%m-%d}'" for d in (window.start, window.end, window.year_before))
    ago = lambda n: f"TIMESTAMP '{window.days_ago(n):%Y-%m-%d}'"
    changed = "EXISTS (SELECT 1 FROM stored0 s WHERE s.PAT_ENC_CSN = e.csn AND s.UNIT_OUT_DTTM <> e.disch)"
    if window.as_of.day in (1, 2):
        changed = "false"
    return f"""
recent{tag} AS (
  SELECT DISTINCT csn FROM moves WHERE out_dttm BETWEEN {start} AND {end} OR in_dttm BETWEEN {start} AND {end}),
facts{tag} AS (
  SELECT e.csn, e.har, e.pat_class, e.dept_id, a.base_class, r.csn IS NOT NULL AND a.base_class = 1 AND e.pat_class NOT IN (103, 104) AS s1,
    e.disch > {ago(45)} AND {changed} AS s2,
    e.disch > {ago(180)} AND a.base_class <> 1 AND e.csn IN (SELECT PAT_ENC_CSN FROM stored0 WHERE BILLED_AS_OP = 0) AS s3,
    e.disch > {ago(180)} AND a.base_class = 1 AND e.csn IN (SELECT PAT_ENC_CSN FROM stored0 WHERE BILLED_AS_OP = 1) AS s4,
    r.csn IS NOT NULL AND a.base_class IN (2, 3) AND e.pat_class <> 138 AND e.dept_id IN (SELECT dept_id FROM dept WHERE grp11 IN (1, 2, 3, 4)) AS s7
  FROM encounters e JOIN accounts a ON a.har = e.har LEFT JOIN recent{tag} r ON r.csn = e.csn),
early{tag} AS (SELECT csn, har, CASE WHEN s1 OR s2 THEN 0 WHEN s3 THEN 1 ELSE 0 END AS billed FROM facts{tag} WHERE s1 OR s2 OR s3 OR s4),
sides{tag} AS (
  SELECT har, combine_har FROM accounts WHERE adm > {before} AND combine BETWEEN {start} AND {end}
    AND prim_csn NOT IN (SELECT csn FROM early{tag})),
linked{tag} AS (
  SELECT e.csn, e.har, 0 AS billed FROM encounters e JOIN accounts a ON a.har = e.har
  WHERE a.base_class = 1 AND e.pat_class NOT IN (103, 104) AND e.admit > {before}
    AND (e.har IN (SELECT har FROM sides{tag}) OR e.har IN (SELECT combine_har FROM sides{tag})) AND e.csn NOT IN (SELECT csn FROM early{tag})),
two{tag} AS (SELECT * FROM early{tag} UNION ALL SELECT * FROM linked{tag}),
family{tag} AS (
  SELECT e.csn, e.har, 0 AS billed FROM encounters e WHERE e.pat_class NOT IN (103, 104) AND e.csn NOT IN (SELECT csn FROM two{tag})
    AND e.har IN (SELECT c.har FROM two{tag} c JOIN accounts a ON a.combine_har = c.har WHERE a.base_class = 1)),
three{tag} AS (
  SELECT x.* FROM (SELECT * FROM two{tag} UNION ALL SELECT * FROM family{tag}) x JOIN encounters e USING (csn)
  WHERE e.pat_class IN (101, 102, 125, 10014) OR x.csn IN (SELECT csn FROM moves JOIN dept USING (dept_id) WHERE grp11 IN (1, 2, 3, 4))),
four{tag} AS (SELECT * FROM three{tag} UNION ALL SELECT csn, har, 1 FROM facts{tag} WHERE s7 AND csn NOT IN (SELECT csn FROM three{tag})),
cohort{tag} AS (
  SELECT * FROM four{tag} UNION ALL SELECT prim_csn, har, 0 FROM accounts WHERE tot > 1000 AND adm > {ago(180)}
    AND har NOT IN (SELECT HSP_ACCOUNT_ID FROM stored0) AND prim_csn NOT IN (SELECT csn FROM four{tag}))"""


def _repaired_sql(source: str, name: str) -> str:
    """``source`` with the stays of accounts renumbered whose first stay two encounters hold."""
    return f"""
{name}_twice AS (SELECT HSP_ACCOUNT_ID AS har FROM {source} WHERE IP_UNIT_TRACKER_HAR = 1 GROUP BY 1 HAVING count(DISTINCT PAT_ENC_CSN) > 1),
{name}_members AS (SELECT DISTINCT PAT_ENC_CSN FROM {source} WHERE HSP_ACCOUNT_ID IN (SELECT har FROM {name}_twice)),
{name}_again AS (
  SELECT PAT_ENC_CSN, LINE, count(*) FILTER (UNIT_STAY_TYPE NOT ILIKE 'NON IP%') OVER w AS unit, count(*) FILTER (UNIT_STAY_TYPE = 'CRITICAL CARE') OVER w AS icu
  FROM {source} JOIN {name}_members USING (PAT_ENC_CSN) WINDOW w AS (PARTITION BY HSP_ACCOUNT_ID ORDER BY UNIT_IN_DTTM, ADT_DEPARTMENT_ID, PAT_ENC_CSN)),
{name} AS (
  SELECT s.* REPLACE (CASE WHEN s.UNIT_STAY_TYPE NOT ILIKE 'NON IP%' THEN coalesce(unit, IP_UNIT_TRACKER_HAR) ELSE IP_UNIT_TRACKER_HAR END AS IP_UNIT_TRACKER_HAR,
    CASE WHEN s.UNIT_STAY_TYPE = 'CRITICAL CARE' THEN coalesce(icu, ICU_TRACKER_HAR) ELSE ICU_TRACKER_HAR END AS ICU_TRACKER_HAR)
  FROM {source} s LEFT JOIN {name}_again a ON a.PAT_ENC_CSN = s.PAT_ENC_CSN AND a.LINE = s.LINE)"""


def _daily_sql() -> str:
    body = _activity_sql(_WEEKLY, "csn // 10", _MERGED, f"{_STORED_SQL},{_cohort_sql(DAILY)}")
    return f"""WITH {body},
batch AS ({_SELECT_SQL}),{_repaired_sql("stored0", "stored1")},
replaced AS (SELECT * FROM batch UNION ALL BY NAME SELECT * FROM stored1 WHERE PAT_ENC_CSN NOT IN (SELECT PAT_ENC_CSN FROM batch)),
{_repaired_sql("replaced", "published")}
SELECT * FROM published"""


@query(_daily_sql())
def daily_run(spark, folder):
    """Pick against the stored table, build, publish, read back: the whole table after the run."""
    path = scratch_path(spark)
    tables = hospital(spark, folder, weekly=True)
    publish(spark, path, stored_stays(tables))
    run_day(spark, path, tables, DAILY)
    return _plain_numbers(read_published(spark, path).drop(MONTH, "TABLE_OWNER"))


def _cohorts_sql() -> str:
    tables = _tables_sql(_WEEKLY, "csn // 10", _MERGED)
    first, later = _cohort_sql(FIRST_OF_MONTH, "_1"), _cohort_sql(DAILY, "_5")
    return f"""WITH {tables},
{_STORED_SQL},{first},{later}
SELECT 1 AS run_day, csn, har, billed AS billed_as_op FROM cohort_1 UNION ALL SELECT 5, csn, har, billed FROM cohort_5"""


@query(_cohorts_sql())
def cohort_by_run_day(spark, folder):
    """The encounters of two run days; on the first of a month discharge times are not compared."""
    tables = hospital(spark, folder, weekly=True)
    stored = stored_stays(tables)
    days = [find_encounters(tables, stored, w).select(F.lit(w.as_of.day).alias("run_day"), "*") for w in (FIRST_OF_MONTH, DAILY)]
    return days[0].unionByName(days[1])
