"""Queries on the movement log: stays, gaps, trackers, what comes next."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stayflow.functions.columns import first_label, hours_between, like_ci, minutes_between, round_minute
from stayflow.operators import intervals as iv
from stayflow.operators.joins import flag_if_exists, multi_class_keys
from stayflow.operators.ordered import arrange
from stayflow.operators.sequences import lead_if, next_matching, seq, seq_where, time_to_next
from stayflow.operators.updates import (
    close_last,
    drop_where,
    repair_trackers,
    repeated_first_keys,
    set_where,
    upsert_by_key,
)
from stayflow.queries import tables as t
from stayflow.queries.fragments import MOVES, STAYS
from stayflow.queries.registry import query
from stayflow.sources.scratch import keep


def _long(df, *columns):
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


@query(f"WITH {STAYS} SELECT csn, har, dept, unit_in_dttm, unit_out_dttm, unit_status, line FROM stays")
def unit_stays(spark, folder):
    return _long(t.unit_stays(spark, folder)[0], "line")


@query(
    f"""WITH {MOVES}, near AS (
  SELECT *, lag(dept) OVER w AS before, lead(dept) OVER w AS after FROM moves
  WINDOW w AS (PARTITION BY csn ORDER BY in_dttm, event_id))
SELECT event_id, CASE WHEN before IS NULL OR before <> dept THEN 'ADMIT TO UNIT' END AS admit_status,
  CASE WHEN out_dttm IS NULL THEN 'PATIENT IN UNIT'
       WHEN after IS NULL OR after <> dept THEN 'TRANSFER FROM UNIT' END AS discharge_status
FROM near"""
)
def mark_edges(spark, folder):
    marked = iv.mark_edges(t.moves(spark, folder), ["dept"], end="out_dttm")
    return marked.df.select("event_id", "admit_status", "discharge_status")


@query(
    f"""WITH {MOVES}, ends AS (
  SELECT csn, max(in_dttm) AS last_in FROM moves GROUP BY csn)
SELECT event_id, row_number() OVER (PARTITION BY csn ORDER BY in_dttm, event_id) AS rownum,
       in_dttm = last_in AS is_last
FROM moves JOIN ends USING (csn)"""
)
def number_movements(spark, folder):
    rows = seq(t.moves(spark, folder), "rownum").shift(more=(F.lit(True), 1)).df
    return rows.select(
        "event_id", F.col("rownum").cast("bigint").alias("rownum"), F.col("more").isNull().alias("is_last")
    )


@query(
    f"""WITH {STAYS}, gaps AS (
  SELECT *, lag(unit_out_dttm) OVER (PARTITION BY csn ORDER BY unit_in_dttm) AS previous_end FROM stays)
SELECT m.event_id, m.csn, m.dept, m.in_dttm, g.line AS next_line
FROM gaps g JOIN moves m ON m.csn = g.csn
  AND m.in_dttm BETWEEN date_trunc('minute', g.previous_end + INTERVAL 30 SECOND) AND g.unit_in_dttm - INTERVAL 1 MINUTE
WHERE g.previous_end < g.unit_in_dttm"""
)
def gap_rows(spark, folder):
    stays, log = t.kept_stays(spark, folder)
    found = iv.fill_gaps(stays, log.df, ["csn"], known=log)
    return found.select(
        "event_id", "csn", "dept", "in_dttm", F.col("_interval.line").cast("bigint").alias("next_line")
    )


@query(
    f"""WITH {STAYS}
SELECT s.csn, s.line, m.event_id FROM stays s JOIN moves m
  ON m.csn = s.csn AND m.in_dttm BETWEEN s.unit_in_dttm AND coalesce(s.unit_out_dttm, TIMESTAMP '9999-12-31')"""
)
def points_in_intervals(spark, folder):
    stays, log = t.kept_stays(spark, folder)
    found = iv.points_in_intervals(
        log.df.select("csn", "event_id", "in_dttm"), stays.df, ["csn"], "in_dttm",
        "unit_in_dttm", "unit_out_dttm", known=log,
    )
    return found.select("csn", F.col("_interval.line").cast("bigint").alias("line"), "event_id")


@query(
    f"""WITH {STAYS}, visits AS (
  SELECT s.csn, s.line, count(*) AS n FROM stays s JOIN moves m ON m.csn = s.csn
    AND m.in_dttm BETWEEN s.unit_in_dttm AND s.unit_out_dttm - INTERVAL 1 MINUTE AND m.dept <> s.dept
  WHERE m.dept IN ('signup', 'error') GROUP BY ALL)
SELECT s.csn, s.line, coalesce(n, 0) AS ancillary_visits FROM stays s LEFT JOIN visits USING (csn, line)"""
)
def churn_counts(spark, folder):
    stays, log = t.kept_stays(spark, folder)
    until = stays.df.withColumn("until", F.col("unit_out_dttm") - F.expr("INTERVAL '1' MINUTE"))
    counted = iv.count_in_interval(
        log.filter(~t.is_unit()).df.select("csn", "dept", "in_dttm"), until, ["csn"], ["csn", "line"],
        "in_dttm", "unit_in_dttm", "until", "ancillary_visits", unlike=("dept", "dept"), known=log,
    )
    return _long(counted.select("csn", "line", "ancillary_visits"), "line", "ancillary_visits")


@query(
    f"""WITH {MOVES}
SELECT event_id FROM moves JOIN (
  SELECT csn, min(in_dttm) AS first_in FROM moves WHERE dept IN ('view', 'click', 'purchase') GROUP BY csn
) USING (csn) WHERE in_dttm < first_in"""
)
def before_first_unit(spark, folder):
    log = t.moves(spark, folder)
    kept = log.filter(t.is_unit()).df
    return iv.outside_span(
        log.df, kept, ["csn"], "before", kept_end="out_dttm", known=log
    ).select("event_id")


@query(
    f"""WITH {MOVES}
SELECT event_id FROM moves JOIN (
  SELECT csn, max(coalesce(out_dttm, TIMESTAMP '9999-12-31')) AS last_out FROM moves
  WHERE dept IN ('view', 'click', 'purchase') GROUP BY csn
) USING (csn) WHERE in_dttm >= last_out"""
)
def after_last_unit(spark, folder):
    log = t.moves(spark, folder)
    kept = log.filter(t.is_unit()).df
    return iv.outside_span(
        log.df, kept, ["csn"], "after", kept_end="out_dttm", known=log
    ).select("event_id")


@query(
    f"""WITH {MOVES}
SELECT event_id FROM moves WHERE csn NOT IN (SELECT csn FROM moves WHERE value > 200)"""
)
def keys_without_rows(spark, folder):
    log = t.moves(spark, folder)
    return iv.keys_without_rows(log.df, log.filter(F.col("value") > 200).df, ["csn"], log).select("event_id")


@query(
    f"""WITH {STAYS}
SELECT csn, line,
  row_number() OVER (PARTITION BY csn ORDER BY unit_in_dttm) AS unit_tracker_csn,
  CASE WHEN dept = 'purchase' THEN count(*) FILTER (dept = 'purchase')
    OVER (PARTITION BY csn ORDER BY unit_in_dttm) END AS icu_tracker_csn,
  row_number() OVER (PARTITION BY har ORDER BY unit_in_dttm, csn) AS unit_tracker_har,
  CASE WHEN dept = 'purchase' THEN count(*) FILTER (dept = 'purchase')
    OVER (PARTITION BY har ORDER BY unit_in_dttm, csn) END AS icu_tracker_har
FROM stays"""
)
def trackers(spark, folder):
    stays, _ = t.kept_stays(spark, folder)
    icu = F.col("dept") == t.ICU
    rows = keep(seq_where(stays, unit_tracker_csn=F.lit(True), icu_tracker_csn=icu).df)
    rows = seq_where(
        arrange(rows, ["har"], ["unit_in_dttm", "csn"]), unit_tracker_har=F.lit(True), icu_tracker_har=icu
    ).df
    names = [f"{u}_tracker_{k}" for u in ("unit", "icu") for k in ("csn", "har")]
    return _long(rows.select("csn", "line", *names), "line", *names)


@query(
    f"""WITH {MOVES}, ahead AS (
  SELECT event_id, lead(dept, 1) OVER w AS d1, lead(dept, 2) OVER w AS d2, lead(dept, 3) OVER w AS d3,
         lead(dept, 4) OVER w AS d4 FROM moves WINDOW w AS (PARTITION BY csn ORDER BY in_dttm, event_id))
SELECT event_id, CASE WHEN d1 IN ('view', 'click', 'purchase') THEN d1 WHEN d2 IN ('view', 'click', 'purchase') THEN d2
  WHEN d3 IN ('view', 'click', 'purchase') THEN d3 WHEN d4 IN ('view', 'click', 'purchase') THEN d4 END AS next_unit
FROM ahead"""
)
def next_matching_unit(spark, folder):
    rows = next_matching(t.moves(spark, folder), "dept", t.is_unit(), "next_unit", max_ahead=4)
    return rows.df.select("event_id", "next_unit")


@query(
    f"""WITH {MOVES}, ahead AS (
  SELECT event_id, lead(dept) OVER (PARTITION BY csn ORDER BY in_dttm, event_id) AS d FROM moves)
SELECT event_id, CASE WHEN d IN ('view', 'click', 'purchase') THEN d END AS next_unit FROM ahead"""
)
def lead_if_unit(spark, folder):
    return lead_if(t.moves(spark, folder), "dept", t.is_unit(), "next_unit").df.select("event_id", "next_unit")


@query(
    f"""WITH {STAYS}, icu AS (
  SELECT *, lead(unit_in_dttm) OVER (PARTITION BY csn ORDER BY unit_in_dttm) AS back_csn,
         lead(unit_in_dttm) OVER (PARTITION BY har ORDER BY unit_in_dttm, csn) AS back_har
  FROM stays WHERE dept = 'purchase')
SELECT csn, line,
  CAST(round(CAST(date_diff('minute', unit_out_dttm, back_csn) AS DECIMAL(18, 6)) / 60, 1) AS DOUBLE) + 0.0 AS hours_csn,
  CAST(round(CAST(date_diff('minute', unit_out_dttm, back_har) AS DECIMAL(18, 6)) / 60, 1) AS DOUBLE) + 0.0 AS hours_har
FROM icu"""
)
def bounce_back_hours(spark, folder):
    stays, _ = t.kept_stays(spark, folder)
    icu = F.col("dept") == t.ICU
    rows = keep(
        time_to_next(stays, "unit_in_dttm", "unit_out_dttm", "hours_csn", among=icu).filter(icu).df
    )
    rows = time_to_next(
        arrange(rows, ["har"], ["unit_in_dttm", "csn"]), "unit_in_dttm", "unit_out_dttm", "hours_har"
    ).df
    return rows.select(
        "csn", F.col("line").cast("bigint").alias("line"),
        F.col("hours_csn").cast("double").alias("hours_csn"), F.col("hours_har").cast("double").alias("hours_har"),
    )


@query(
    f"""WITH {MOVES}, near AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY csn) AS n,
         CASE WHEN dept = 'error' THEN NULL ELSE out_dttm END AS pat_out, lag(dept) OVER w AS before
  FROM moves WINDOW w AS (PARTITION BY csn ORDER BY in_dttm, event_id)),
orphans AS (SELECT csn, rn + 1 AS next_rn FROM near WHERE pat_out IS NULL AND rn < n)
SELECT event_id, CASE WHEN before IS NULL OR before <> dept OR o.csn IS NOT NULL THEN 'ADMIT TO UNIT' END AS admit_status
FROM near LEFT JOIN orphans o ON o.csn = near.csn AND o.next_rn = near.rn
WHERE pat_out IS NOT NULL OR rn = n"""
)
def drop_orphans(spark, folder):
    log = t.moves(spark, folder).with_columns(
        {"pat_out_dttm": F.when(F.col("dept") != "error", F.col("out_dttm"))}
    )
    return iv.drop_orphans(iv.mark_edges(log, ["dept"])).df.select("event_id", "admit_status")


@query(
    f"""WITH {STAYS}, opened AS (
  SELECT *, lead(unit_in_dttm) OVER (PARTITION BY csn ORDER BY unit_in_dttm) AS next_in,
         CASE WHEN dept <> 'click' THEN unit_out_dttm END AS open_out,
         CASE WHEN dept <> 'click' THEN unit_status ELSE 'PATIENT IN UNIT' END AS open_status FROM stays)
SELECT csn, line,
  CASE WHEN open_status = 'PATIENT IN UNIT' AND next_in IS NOT NULL THEN next_in ELSE open_out END AS unit_out_dttm,
  CASE WHEN open_status = 'PATIENT IN UNIT' AND next_in IS NOT NULL THEN 'TRANSFER FROM UNIT' ELSE open_status END AS unit_status
FROM opened"""
)
def close_open_intervals(spark, folder):
    stays, _ = t.kept_stays(spark, folder)
    click = F.col("dept") == "click"
    opened = stays.with_columns(
        {
            "unit_out_dttm": F.when(~click, F.col("unit_out_dttm")),
            "unit_status": F.when(click, iv.IN_UNIT).otherwise(F.col("unit_status")),
        }
    )
    closed = iv.close_open_intervals(opened).df
    return _long(closed.select("csn", "line", "unit_out_dttm", "unit_status"), "line")


# Step by step: the first event that changes the state after the last cut, as long as there is one.
_SPLIT_SQL = """WITH RECURSIVE weeks AS (
  SELECT user_id AS csn, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start FROM events GROUP BY ALL),
cuts AS (
  SELECT csn, week_start, CAST(0 AS BIGINT) AS piece, week_start AS cut, 'LOW' AS state FROM weeks
  UNION ALL
  SELECT c.csn, c.week_start, c.piece + 1, CAST(min(e.ts) AS TIMESTAMP), CASE WHEN c.state = 'LOW' THEN 'HIGH' ELSE 'LOW' END
  FROM cuts c JOIN events e ON e.user_id = c.csn AND e.ts >= c.cut + INTERVAL 12 HOUR
    AND e.ts <= c.week_start + INTERVAL 7 DAY - INTERVAL 12 HOUR
    AND CASE WHEN e.value > 50 THEN 'HIGH' ELSE 'LOW' END <> c.state
  GROUP BY c.csn, c.week_start, c.piece, c.state)
SELECT csn, week_start, piece, cut AS start_dttm,
  coalesce(lead(cut) OVER (PARTITION BY csn, week_start ORDER BY piece), week_start + INTERVAL 7 DAY) AS end_dttm, state
FROM cuts"""


@query(_SPLIT_SQL)
def split_on_change(spark, folder):
    events = t.table(spark, folder, "events").select(
        F.col("user_id").alias("csn"), "ts", F.when(F.col("value") > 50, "HIGH").otherwise("LOW").alias("seen")
    )
    monday = F.date_trunc("week", "ts").cast("timestamp_ntz")
    weeks = events.select("csn", monday.alias("week_start")).distinct()
    weeks = weeks.withColumns(
        {
            "start_dttm": F.col("week_start"),
            "end_dttm": F.col("week_start") + F.expr("INTERVAL '7' DAY"),
            "state": F.lit("LOW"),
        }
    )
    pieces = iv.split_on_change(
        weeks, events, ["csn"], ["csn", "week_start"], "start_dttm", "end_dttm", "state", "ts", "seen",
        as_of=datetime(2100, 1, 1), min_gap="INTERVAL '12' HOUR",
    )
    return _long(pieces, "piece")


@query(
    f"""WITH {MOVES}, old AS (SELECT * FROM moves WHERE in_dttm < TIMESTAMP '2024-01-21'),
batch AS (SELECT * FROM moves WHERE csn IN (SELECT csn FROM moves WHERE in_dttm >= TIMESTAMP '2024-01-30 12:00:00'))
SELECT csn, event_id, dept, 'old' AS source FROM old WHERE csn NOT IN (SELECT csn FROM batch)
UNION ALL SELECT csn, event_id, dept, 'batch' AS source FROM batch"""
)
def upsert_by_key_moves(spark, folder):
    log = t.moves(spark, folder)
    late = log.filter(F.col("in_dttm") >= F.lit(datetime(2024, 1, 30, 12))).df.select("csn").distinct()
    rows = log.df.select("csn", "event_id", "dept", "in_dttm")
    batch = rows.join(late, "csn", "left_semi").drop("in_dttm").withColumn("source", F.lit("batch"))
    old = rows.filter(F.col("in_dttm") < F.lit(datetime(2024, 1, 21))).drop("in_dttm")
    return upsert_by_key(old.withColumn("source", F.lit("old")), batch, ["csn"])


@query(
    f"""WITH {STAYS}, tracked AS (
  SELECT *, row_number() OVER (PARTITION BY csn ORDER BY unit_in_dttm) AS tracker FROM stays),
doubled AS (SELECT har FROM tracked WHERE tracker = 1 GROUP BY har HAVING count(DISTINCT csn) > 1),
members AS (SELECT DISTINCT csn FROM tracked JOIN doubled USING (har)),
again AS (
  SELECT csn, line, row_number() OVER (PARTITION BY har ORDER BY unit_in_dttm, dept, csn) AS n,
    CASE WHEN dept = 'purchase' THEN count(*) FILTER (dept = 'purchase')
      OVER (PARTITION BY har ORDER BY unit_in_dttm, dept, csn) END AS icu
  FROM tracked JOIN members USING (csn))
SELECT t.csn, t.line, coalesce(n, tracker) AS unit_tracker, icu AS icu_tracker
FROM tracked t LEFT JOIN again a ON a.csn = t.csn AND a.line = t.line"""
)
def repair_account_trackers(spark, folder):
    stays, _ = t.kept_stays(spark, folder)
    stored = seq_where(stays, unit_tracker=F.lit(True)).with_columns(
        {
            "icu_tracker": F.lit(None).cast("int"),
            "kind": F.when(F.col("dept") == t.ICU, "CRITICAL CARE").otherwise("MED/SURG"),
        }
    )
    fixed = repair_trackers(
        keep(stored.df), encounter="csn", account="har", start="unit_in_dttm", place="dept", kind="kind",
        unit_tracker="unit_tracker", icu_tracker="icu_tracker",
    )
    return _long(fixed.select("csn", "line", "unit_tracker", "icu_tracker"), "line", "unit_tracker", "icu_tracker")


@query(
    f"""WITH {STAYS}, firsts AS (SELECT csn, har, row_number() OVER (PARTITION BY csn ORDER BY unit_in_dttm) AS n FROM stays)
SELECT har FROM firsts WHERE n = 1 GROUP BY har HAVING count(DISTINCT csn) > 1"""
)
def doubled_first_stays(spark, folder):
    stays, _ = t.kept_stays(spark, folder)
    return repeated_first_keys(stays.df, "har", "csn", "line")


@query(
    f"""WITH {MOVES}, sides AS (
  SELECT DISTINCT har, CASE WHEN dept = 'purchase' THEN 'one' ELSE 'other' END AS side FROM moves
  WHERE dept IN ('purchase', 'view') AND value > 120)
SELECT har FROM sides GROUP BY har HAVING count(*) > 1"""
)
def multi_class_accounts(spark, folder):
    log = t.moves(spark, folder).df
    side = F.when(F.col("dept") == t.ICU, "one").otherwise("other")
    return multi_class_keys(log, ["har"], side, F.col("dept").isin(t.ICU, "view") & (F.col("value") > 120))


@query(
    f"""WITH {STAYS}
SELECT csn, line, (SELECT date_trunc('minute', max(unit_out_dttm) + INTERVAL 30 SECOND) FROM stays) AS extraction_dttm
FROM stays"""
)
def extraction_time(spark, folder):
    stays, _ = t.kept_stays(spark, folder)
    latest = stays.df.agg(round_minute(F.max("unit_out_dttm"))).scalar()
    return _long(stays.df.select("csn", "line", latest.alias("extraction_dttm")), "line")


@query(
    f"""WITH {STAYS}, ends AS (SELECT csn, max(in_dttm) AS disch_dttm FROM moves GROUP BY csn),
last_lines AS (SELECT csn, max(line) AS line FROM stays GROUP BY csn)
SELECT s.csn, s.line, CASE WHEN l.line IS NOT NULL AND s.unit_out_dttm = e.disch_dttm
  AND s.unit_status NOT IN ('DISCHARGED', 'PATIENT IN UNIT') THEN 'DISCHARGED' ELSE s.unit_status END AS unit_status
FROM stays s JOIN ends e USING (csn) LEFT JOIN last_lines l ON l.csn = s.csn AND l.line = s.line"""
)
def close_last_stays(spark, folder):
    stays, log = t.kept_stays(spark, folder)
    closed = close_last(
        stays, t.stay_encounters(log), "csn", "disch_dttm", "unit_out_dttm",
        ~F.col("unit_status").isin("DISCHARGED", iv.IN_UNIT), unit_status="DISCHARGED",
    )
    return _long(closed.select("csn", "line", "unit_status"), "line")


@query(
    f"""WITH {STAYS}
SELECT csn, line, unit_status FROM stays
WHERE coalesce(NOT (dept = 'click' AND unit_out_dttm > TIMESTAMP '2024-01-10'), true)"""
)
def drop_where_late(spark, folder):
    stays, _ = t.unit_stays(spark, folder)
    late = (F.col("dept") == "click") & (F.col("unit_out_dttm") > F.lit(datetime(2024, 1, 10)))
    return _long(drop_where(stays, late).select("csn", "line", "unit_status"), "line")


@query(
    f"""WITH {STAYS}
SELECT csn, line, CASE WHEN unit_out_dttm > TIMESTAMP '2024-01-10' THEN 'LATE' ELSE unit_status END AS unit_status
FROM stays"""
)
def set_where_late(spark, folder):
    stays, _ = t.unit_stays(spark, folder)
    late = F.col("unit_out_dttm") > F.lit(datetime(2024, 1, 10))
    return _long(set_where(stays, late, unit_status="LATE").select("csn", "line", "unit_status"), "line")


@query(
    f"""WITH {STAYS}
SELECT csn, line, CASE WHEN csn IN (SELECT csn FROM moves WHERE dept = 'purchase' AND value > 100)
  THEN 1 ELSE 0 END AS flagged FROM stays"""
)
def flag_if_exists_high(spark, folder):
    stays, log = t.kept_stays(spark, folder)
    high = log.filter((F.col("dept") == t.ICU) & (F.col("value") > 100)).df
    return flag_if_exists(stays.df, high, ["csn"], "flagged", known=log).select(
        "csn", F.col("line").cast("bigint").alias("line"), "flagged"
    )


@query(
    f"""WITH {MOVES}
SELECT event_id, date_trunc('minute', in_dttm + INTERVAL 30 SECOND) AS to_minute,
  date_diff('minute', in_dttm, out_dttm) AS minutes,
  CAST(round(CAST(date_diff('minute', in_dttm, out_dttm) AS DECIMAL(18, 6)) / 60, 1) AS DOUBLE) + 0.0 AS hours
FROM moves"""
)
def minute_rules(spark, folder):
    return t.moves(spark, folder).df.select(
        "event_id",
        round_minute("in_dttm").alias("to_minute"),
        minutes_between("in_dttm", "out_dttm").alias("minutes"),
        hours_between("in_dttm", "out_dttm").cast("double").alias("hours"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_name ILIKE '% ring' THEN 'PLACE: RING' WHEN p_name ILIKE 'red%' THEN 'PLACE: RED'
  WHEN p_size BETWEEN 10 AND 20 THEN 'PLACE: MIDDLE' ELSE 'PLACE: ' || p_type END AS place FROM part"""
)
def label_places(spark, folder):
    parts = t.table(spark, folder, "part")
    place = first_label(
        [
            (like_ci("p_name", "% RING"), "PLACE: RING"),
            (like_ci("p_name", "RED%"), "PLACE: RED"),
            (F.col("p_size").between(10, 20), "PLACE: MIDDLE"),
        ],
        F.concat(F.lit("PLACE: "), F.col("p_type")),
    )
    return parts.select("p_partkey", place.alias("place"))


# -- long histories and deep nesting --------------------------------------------------------

# each event opens an interval of its group that lasts until the 20th event after it; errors have no group
_NESTED = """marks AS (
  SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN user_id % 10 END AS grp FROM events),
spans AS (
  SELECT event_id AS span_id, grp, ts AS from_dttm,
    lead(ts, 20) OVER (PARTITION BY grp ORDER BY ts, event_id) AS to_dttm FROM marks)"""


def _nested(spark, folder):
    grouped = F.when(F.col("event_type") != "error", F.pmod("user_id", F.lit(10)))
    marks = t.table(spark, folder, "events").select("event_id", "ts", grouped.alias("grp"))
    spans = arrange(marks, ["grp"], ["ts", "event_id"]).shift(to_dttm=("ts", 20)).df
    return marks, spans.select(F.col("event_id").alias("span_id"), "grp", F.col("ts").alias("from_dttm"), "to_dttm")


@query(
    f"""WITH {_NESTED}
SELECT m.event_id, s.span_id FROM marks m JOIN spans s ON s.grp = m.grp
  AND m.ts BETWEEN s.from_dttm AND coalesce(s.to_dttm, TIMESTAMP '9999-12-31')"""
)
def points_in_nested_intervals(spark, folder):
    marks, spans = _nested(spark, folder)
    found = iv.points_in_intervals(marks, spans, ["grp"], "ts", "from_dttm", "to_dttm")
    return found.select("event_id", "_interval.span_id")


@query(
    f"""WITH {_NESTED}
SELECT m.event_id, s.span_id FROM marks m LEFT JOIN spans s ON s.grp = m.grp
  AND m.ts - INTERVAL 1 MINUTE BETWEEN s.from_dttm AND coalesce(s.to_dttm, TIMESTAMP '9999-12-31')
QUALIFY row_number() OVER (PARTITION BY m.event_id
  ORDER BY s.from_dttm DESC NULLS LAST, coalesce(s.to_dttm, TIMESTAMP '9999-12-31') DESC, s.span_id DESC) = 1"""
)
def dated_join_long_history(spark, folder):
    """Histories of more records per key than are searched as lists, overlapping twenty deep."""
    marks, spans = _nested(spark, folder)
    earlier = marks.withColumn("at", F.col("ts") - F.expr("INTERVAL '1' MINUTE"))
    found = iv.latest_record(earlier, spans, ["grp"], "at", "from_dttm", "to_dttm", {"span_id": "span_id"})
    return found.select("event_id", "span_id")
