"""From movement history to one row per unit stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.columns import like_ci, round_minute
from stayflow.operators import cohort as pick
from stayflow.operators.cohort import RunWindow, accumulate
from stayflow.operators.intervals import (
    IN_UNIT,
    TRANSFER,
    close_open_intervals,
    collapse_runs,
    count_in_interval,
    drop_orphans,
    fill_gaps,
    keys_without_rows,
    latest_record,
    mark_edges,
    outside_span,
    split_on_change,
)
from stayflow.operators.joins import (
    flag_if_exists,
    flatten_hierarchy,
    join_dim,
    join_one,
    multi_class_keys,
    only_code,
    only_keys,
    within,
)
from stayflow.operators.ordered import Ordered, arrange, measured
from stayflow.operators.sequences import next_matching, seq, seq_where, time_to_next
from stayflow.operators.updates import close_last, drop_where, set_where
from stayflow.plans import rules
from stayflow.plans.schemas import OUTPUT
from stayflow.sources.scratch import keep

Tables = dict[str, DataFrame]

MOVEMENT_ORDER = ["in_dttm", "out_dttm", "event_id"]
STAY_ORDER = ["unit_in_dttm", "unit_out_dttm", "dept_id"]


# -- which encounters -----------------------------------------------------------------------


def find_encounters(
    t: Tables, stored: DataFrame, window: RunWindow, compare: bool = True
) -> DataFrame:
    """Encounters to rebuild: ``csn, har, billed_as_op``; see :func:`pick_encounters`."""
    return pick_encounters(t, stored, window, compare)[0]


def pick_encounters(
    t: Tables, stored: DataFrame, window: RunWindow, compare: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Encounters to rebuild (``csn, har, billed_as_op``) and the part of the log they were picked by.

    Each step adds only encounters no earlier step has listed.  ``stored`` is the published table;
    ``compare=False`` leaves out the steps that look for later corrections in it, as for
    historical runs.  The changed-discharge step rests on the first two days of a month.

    The log is read twice: the window's movements tell which encounters were active, and all
    movements of the encounters that any step may add are kept and serve the other steps and the build.
    """
    recent_move = F.col("in_dttm") > F.lit(rules.DATA_BEGINS)
    recent_admit = F.col("admit_dttm") > F.lit(rules.DATA_BEGINS)
    not_emergency = ~F.col("pat_class").isin(*rules.EMERGENCY_CLASSES)
    is_inpatient = F.col("base_class") == rules.INPATIENT_BASE_CLASS
    on_unit = F.col("grp11").isin(*rules.UNIT_GROUPS)
    classed = t["encounters"].join(t["accounts"].select("har", "base_class"), "har")
    known = _stored_names(stored)

    moved = t["movements"].filter(window.covers("out_dttm") | window.covers("in_dttm")).filter(recent_move)
    moved = keep(moved.select("csn").distinct())
    active = keep(only_keys(classed.filter(recent_admit), moved, "csn").select("csn", "har", "dept_id", "pat_class", "base_class"))

    chosen = active.filter(not_emergency & is_inpatient).select("csn", "har", F.lit(0).alias("billed_as_op"))
    if compare:
        if window.as_of.day not in (1, 2):
            chosen = accumulate(chosen, pick.changed_end(known, t["encounters"], window), 0)
        for stored_flag, new_flag in ((0, 1), (1, 0)):
            flipped = pick.flag_flip(known, classed, window, from_=stored_flag)
            chosen = accumulate(chosen, flipped, new_flag)
    chosen = keep(chosen)
    linked = keep(
        pick.merge_candidates(classed, t["accounts"], chosen, window, not_emergency & is_inpatient & recent_admit)
    )
    either = accumulate(chosen, linked, 0)
    related = keep(pick.siblings(t["encounters"], t["accounts"], either, is_inpatient, not_emergency))
    outpatients = join_dim(active, t["dept"].select("dept_id", "grp11"), ["dept_id"]).filter(
        F.col("base_class").isin(*rules.OUTPATIENT_BASE_CLASSES)
        & on_unit
        & (F.col("pat_class") != rules.LABOR_OUTPATIENT_CLASS)
    )
    missed = keep(
        pick.missed_accounts(
            t["accounts"],
            known,
            window,
            (F.col("acct_class") == rules.MISSED_ACCOUNT_CLASS)
            & (F.col("tot_chgs") > rules.MISSED_ACCOUNT_MIN_CHARGES),
        )
    )
    steps = [chosen, linked, related, active.filter(F.col("base_class").isin(*rules.OUTPATIENT_BASE_CLASSES)), missed]
    any_step = steps[0].select("csn")
    for step in steps[1:]:
        any_step = any_step.union(step.select("csn"))
    wide = t["movements"].select("csn", "event_id", "dept_id", "in_dttm", "out_dttm", "pat_out_dttm")
    log = keep(only_keys(wide, keep(any_step.distinct()), "csn"))

    began = log.filter(recent_move)
    chosen = accumulate(chosen, within(linked, began, ["csn"], known=True), 0)
    # a sibling counts if its account holds an encounter that has been chosen
    chosen = accumulate(chosen, within(related, chosen, ["har"], known=True), 0)
    seen = pick.places_seen(join_dim(log, t["dept"].select("dept_id", "grp11"), ["dept_id"]), on_unit)
    seen = seen.join(t["encounters"].select("csn", "pat_class"), "csn")
    passed = seen.filter(
        F.coalesce((F.col("_wanted") == 1) | F.col("pat_class").isin(*rules.KEPT_CLASSES), F.lit(False))
    )
    chosen = within(chosen, passed, ["csn"], known=True)
    chosen = accumulate(chosen, outpatients.select("csn", "har"), 1)
    return keep(accumulate(chosen, missed, 0)), log


def _stored_names(stored: DataFrame) -> DataFrame:
    return stored.select(
        F.col("PAT_ENC_CSN").alias("csn"),
        F.col("HSP_ACCOUNT_ID").alias("har"),
        F.col("UNIT_STATUS").alias("unit_status"),
        F.col("UNIT_OUT_DTTM").alias("unit_out_dttm"),
        F.col("BILLED_AS_OP").alias("billed_as_op"),
    )


# -- movements of those encounters ----------------------------------------------------------


def departments(t: Tables) -> DataFrame:
    """Departments with the name of the hospital at the top of their location hierarchy."""
    return flatten_hierarchy(
        t["dept"],
        [
            (t["loc"], "rev_loc_id", "loc_id", {"parent_loc_id": "_parent"}),
            (t["loc"], "_parent", "loc_id", {"grp7": "_grp7"}),
            (t["entity"], "_grp7", "grp7", {"name": "hosp"}),
        ],
    ).drop("_parent", "_grp7")


def cohort_movements(t: Tables, chosen: DataFrame, dept: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """All movements of the chosen encounters with their department.

    Encounters that are not in the encounter table have none.  ``log`` is the part of the log that holds
    them, if it has been read already.
    """
    known = keep(only_keys(t["encounters"].select("csn"), chosen, "csn").join(chosen, "csn"))
    moves = only_keys(t["movements"], known, "csn") if log is None else log
    # one row per encounter on the right: Spark sends a short list to every task, and splits hot encounters itself
    return join_dim(moves.join(known, "csn"), dept, ["dept_id"])


def movement_detail(moves: DataFrame, t: Tables) -> DataFrame:
    """Movements on inpatient units, with type, split where the level of care changes."""
    on_unit = moves.filter(
        F.col("grp11").isin(*rules.UNIT_GROUPS)
        & _real_stay()
        & (F.col("in_dttm") > F.lit(rules.DATA_BEGINS))
    )
    levels = t["loc_events"].select("event_id", "level_of_care")
    typed = keep(classify(on_unit.join(levels, "event_id"), t["dept_history"]))
    return split_by_care(typed, t)


def _real_stay() -> Column:
    return F.col("in_dttm") != F.col("out_dttm")


def classify(moves: DataFrame, history: DataFrame) -> DataFrame:
    """Unit type by the department record valid when the movement began; NULL without one."""
    taken = {"start_date": "_valid", "grp11": "_grp11", "grp4": "_grp4"}
    dated = latest_record(
        moves, history, ["dept_id"], "in_dttm", "start_date", "end_date", taken
    )
    kind = rules.unit_type("_grp11", "_grp4", "dept_id", "hosp", "level_of_care")
    return dated.withColumns(
        {
            "unit_stay_type": F.when(F.col("_valid").isNotNull(), kind),
            "_splits": F.coalesce(
                rules.splits_on_care("_grp11", "_grp4", "hosp"), F.lit(False)
            ),
        }
    ).drop("_valid", "_grp11", "_grp4")


def split_by_care(typed: DataFrame, t: Tables) -> DataFrame:
    """Cut the stays on mixed units at each change of the level of care."""
    mixed = typed.filter("_splits").drop("_splits")
    events = t["loc_events"].filter(
        F.col("event_subtype") != rules.CANCELLED_SUBTYPE
    ).select("csn", "effective_dttm", rules.care_type("level_of_care").alias("_care"))

    def still_mixed(matched: DataFrame) -> DataFrame:
        taken = {"grp11": "_grp11", "grp4": "_grp4"}
        dated = latest_record(
            matched, t["dept_history"], ["dept_id"], "_at", "start_date", "end_date", taken
        )
        test = rules.splits_on_care("_grp11", "_grp4", "hosp")
        return dated.withColumn("_restart", F.coalesce(test, F.lit(False))).drop("_grp11", "_grp4")

    pieces = split_on_change(
        mixed,
        only_keys(events, keep(mixed.select("csn").distinct()), "csn"),
        ["csn"],
        ["event_id"],
        "in_dttm",
        "pat_out_dttm",
        "unit_stay_type",
        "effective_dttm",
        "_care",
        as_of=t["as_of"],
        max_cuts=rules.MOST_CUTS,
        may_restart=still_mixed,
        carry=["dept_id", "hosp"],
    )
    whole = typed.filter("not _splits").drop("_splits").withColumn("piece", F.lit(0))
    return whole.unionByName(pieces)


_DETAIL = [
    "csn",
    "har",
    "billed_as_op",
    "event_id",
    "dept_id",
    "name",
    "specialty",
    "in_dttm",
    "out_dttm",
    "pat_out_dttm",
    "unit_stay_type",
    "admit_status",
    "discharge_status",
]


def all_rows(moves: DataFrame, detail: DataFrame, known: Ordered | None = None) -> DataFrame:
    """Unit movements with their edges, plus the other movements around them.

    Movements before the first and after the last unit movement, and all movements of encounters
    without any unit, are marked within their own set.
    """
    units = mark_edges(
        arrange(detail, ["csn"], MOVEMENT_ORDER, known=known), ["dept_id", "unit_stay_type"]
    ).df.select(*_DETAIL)
    elsewhere = moves.withColumn("unit_stay_type", F.lit(rules.NON_IP))
    real = elsewhere.filter(_real_stay())
    before = _marked(outside_span(real, detail, ["csn"], "before", known=known), known)
    seen = detail.select("csn", "in_dttm", "pat_out_dttm").unionByName(
        before.select("csn", "in_dttm", "pat_out_dttm")
    )
    after = _marked(outside_span(real, seen, ["csn"], "after", known=known), known)
    none = _marked(keys_without_rows(elsewhere, detail, ["csn"], known), known)
    return label_non_ip(units.unionByName(before).unionByName(after).unionByName(none))


def _marked(rows: DataFrame, known: Ordered | None) -> DataFrame:
    ordered = arrange(rows, ["csn"], MOVEMENT_ORDER, known=known)
    return mark_edges(ordered, ["dept_id"]).df.select(*_DETAIL)


def label_non_ip(rows: DataFrame) -> DataFrame:
    label = rules.non_ip_label(
        F.col("dept_id"), F.col("unit_stay_type"), F.col("name"), F.col("specialty")
    )
    return set_where(rows, F.col("unit_stay_type") == rules.NON_IP, unit_stay_type=label)


# -- stays ----------------------------------------------------------------------------------


def unit_stays(rows: DataFrame, known: Ordered | None = None) -> DataFrame:
    """One row per stay, before gaps are filled; ``detail_line`` orders the stays of an encounter."""
    ordered = drop_orphans(arrange(rows, ["csn"], [*MOVEMENT_ORDER, "dept_id"], known=known))
    stays = collapse_runs(
        ordered,
        starts=F.col("admit_status").isNotNull(),
        closes=F.col("discharge_status").isin(TRANSFER, IN_UNIT),
        first={
            "har": "har",
            "billed_as_op": "billed_as_op",
            "unit_stay_type": "unit_stay_type",
            "dept_id": "dept_id",
            "unit_in_dttm": "in_dttm",
        },
        last={"unit_out_dttm": "pat_out_dttm", "unit_status": "discharge_status"},
    ).withColumnRenamed("_line", "detail_line")
    ended = F.col("unit_out_dttm").isNotNull() & (F.col("unit_status") == IN_UNIT)
    return set_where(stays, ended, unit_status=TRANSFER)


def gap_stays(stays: DataFrame, moves: DataFrame, known: Ordered | None = None) -> DataFrame:
    """A stay for each movement that began between two stays.

    The label looks at the department and type of the stay after the gap, but at the name and
    specialty of the movement's own department.
    """
    found = fill_gaps(
        arrange(stays, ["csn"], STAY_ORDER, known=known),
        moves.drop("har", "billed_as_op"),
        ["csn"],
        known=known,
    )
    label = rules.non_ip_label(
        F.col("_interval.dept_id"),
        F.col("_interval.unit_stay_type"),
        F.col("name"),
        F.col("specialty"),
    )
    return found.select(
        "csn",
        F.col("_interval.har").alias("har"),
        F.col("_interval.billed_as_op").alias("billed_as_op"),
        label.alias("unit_stay_type"),
        "dept_id",
        F.col("in_dttm").alias("unit_in_dttm"),
        F.col("pat_out_dttm").alias("unit_out_dttm"),
        F.when(F.col("pat_out_dttm").isNull(), IN_UNIT).otherwise(TRANSFER).alias("unit_status"),
        F.lit(None).cast("bigint").alias("detail_line"),
    )


def _is_unit() -> Column:
    return ~like_ci("unit_stay_type", "NON IP%")


def _is_icu() -> Column:
    return F.col("unit_stay_type") == rules.CRITICAL


def encounter_columns(
    stays: DataFrame, encounters: DataFrame, known: Ordered | None = None
) -> DataFrame:
    """Line numbers, trackers, next unit and bounce-back hours within each encounter."""
    ends = encounters.select("csn", "disch_dttm")
    dated = join_one(stays, ends, ["csn"], "left", known=known)
    rows = arrange(dated, ["csn"], STAY_ORDER, known=known)
    rows = seq(close_open_intervals(rows), "line")
    rows = seq_where(rows, ip_unit_tracker_csn=_is_unit(), icu_tracker_csn=_is_icu())
    rows = next_unit(rows)
    return time_to_next(
        rows,
        "unit_in_dttm",
        "unit_out_dttm",
        "icu_bounce_back_hrs_csn",
        among=_is_icu(),
        where=~F.col("next_type_csn").isin(*rules.NOT_A_BOUNCE_CSN),
    ).df


def next_unit(rows: Ordered) -> Ordered:
    """Type and department of the next unit, or what happened instead.

    First from one unit stay to the next; rows still without an answer that were left look up to
    four rows ahead for a unit type, and then name the department directly after them.
    """
    listed = F.coalesce(
        _is_unit() | F.col("dept_id").isin(*rules.ED_AND_EDOU_DEPARTMENTS), F.lit(False)
    ) & F.col("detail_line").isNotNull()
    near = rows.following(
        _next=F.when(listed, F.struct("unit_stay_type", "dept_id"))
    )
    next_is_unit = F.col("_next.unit_stay_type").isin(*rules.NEXT_TYPES)
    left = F.col("unit_status") == TRANSFER
    what = (
        F.when(next_is_unit, F.col("_next.unit_stay_type"))
        .when(F.col("unit_status") == IN_UNIT, rules.STILL_HERE)
        .when(left & (F.col("disch_dttm") == F.col("unit_out_dttm")), rules.DISCHARGED)
        .when(left, rules.NON_IP_NEXT)
    )
    first = near.with_columns(
        {
            "next_type_csn": F.when(listed, what),
            "next_dept_id": F.when(
                listed & next_is_unit, F.col("_next.dept_id").cast("string")
            ),
        }
    )
    first = first.with_columns(
        {
            "unit_status": F.when(
                F.col("next_type_csn") == rules.DISCHARGED, rules.DISCHARGED
            ).otherwise(F.col("unit_status"))
        }
    ).drop("_next")

    is_unit_type = F.col("unit_stay_type").isin(*rules.NEXT_TYPES)
    ahead = next_matching(first, "unit_stay_type", is_unit_type, "_ahead", rules.ROWS_AHEAD).shift(
        _ahead_dept=("dept_id", 1)
    )
    empty = (
        F.col("next_type_csn").isNull()
        & (F.col("unit_status") == TRANSFER)
        & F.col("_ahead").isNotNull()
    )
    return ahead.with_columns(
        {
            "next_type_csn": F.when(empty, F.col("_ahead")).otherwise(F.col("next_type_csn")),
            "next_dept_id": F.when(empty, F.col("_ahead_dept").cast("string")).otherwise(
                F.col("next_dept_id")
            ),
        }
    ).drop("_ahead", "_ahead_dept")


def attribute_site(stays: DataFrame, dept: DataFrame, history: DataFrame) -> DataFrame:
    """Hospital by the current department record; site by the dated one, else by the current."""
    current = dept.select(
        "dept_id", "hosp", F.col("grp4").alias("_now_grp4"), F.col("rev_loc_id").alias("_now_loc"),
        F.lit(True).alias("_known"),
    )
    placed = join_dim(stays, current, ["dept_id"], "left")
    taken = {"start_date": "_valid", "grp4": "_grp4", "rev_loc_id": "_loc"}
    dated = latest_record(
        placed, history, ["dept_id"], "unit_in_dttm", "start_date", "end_date", taken
    )
    then = rules.site({"grp4": "_grp4", "rev_loc_id": "_loc"})
    now = rules.site({"grp4": "_now_grp4", "rev_loc_id": "_now_loc"})
    by_record = F.when(F.col("_valid").isNotNull(), then).when(F.col("_known"), now)
    return dated.withColumn(
        "hup_site", F.when(F.col("hosp") == rules.SITE_HOSPITAL, by_record)
    ).drop("_now_grp4", "_now_loc", "_known", "_valid", "_grp4", "_loc")


def account_columns(stays: DataFrame, known: Ordered | None = None) -> DataFrame:
    """Trackers, cross-site transfers and bounce-back hours within each account."""
    side = F.when(F.col("hup_site") == rules.CROSS_SITE, "one").otherwise("other")
    crossing = multi_class_keys(
        stays, ["har"], side, F.col("hup_site").isin(*rules.CROSS_SITES)
    )
    flagged = flag_if_exists(stays, crossing, ["har"], "cross_site", known=known)
    rows = arrange(flagged, ["har"], [*STAY_ORDER, "csn", "line"], known=known)
    owned = F.col("har").isNotNull()
    rows = seq_where(
        rows, ip_unit_tracker_har=_is_unit() & owned, icu_tracker_har=_is_icu() & owned
    )
    rows = next_unit_account(rows)
    return time_to_next(
        rows,
        "unit_in_dttm",
        "unit_out_dttm",
        "icu_bounce_back_hrs_har",
        among=_is_icu() & owned,
        where=~F.col("next_type_har").isin(*rules.NOT_A_BOUNCE_HAR),
    ).df


def next_unit_account(rows: Ordered) -> Ordered:
    """The encounter's next unit, except that a discharge followed by another stay of a cross-site
    account is a transfer to that stay's site."""
    gone = F.col("unit_status") == rules.DISCHARGED
    listed = (F.col("cross_site") == 1) & (
        gone | F.col("unit_stay_type").isin(*rules.NEXT_TYPES)
    )
    near = rows.following(_next=F.when(listed, F.struct("hup_site", "unit_stay_type")))
    transfer = F.concat(
        F.lit("TRANSFER TO "),
        F.upper("_next.hup_site"),
        F.lit("; "),
        F.col("_next.unit_stay_type"),
    )
    moved = listed & gone & F.col("_next.hup_site").isNotNull() & (
        F.col("next_type_csn") != transfer
    )
    return near.with_columns(
        {"next_type_har": F.when(moved, transfer).otherwise(F.col("next_type_csn"))}
    ).drop("_next")


def add_churn(stays: DataFrame, moves: DataFrame, known: Ordered | None = None) -> DataFrame:
    """Visits to ancillary departments during the stay."""
    visits = moves.filter(
        (F.col("grp11") == rules.ANCILLARY_GROUP) & (F.col("dept_id") != rules.MAIN_ED)
    ).select("csn", "dept_id", "in_dttm")
    until = stays.withColumn("_until", F.col("unit_out_dttm") - F.expr("INTERVAL '1' MINUTE"))
    return count_in_interval(
        visits,
        until,
        ["csn"],
        ["csn", "line"],
        "in_dttm",
        "unit_in_dttm",
        "_until",
        "ancillary_visits",
        unlike=("dept_id", "dept_id"),
        known=known,
    ).drop("_until")


def add_flags(
    stays: DataFrame, t: Tables, known: Ordered | None = None, accounts: Ordered | None = None
) -> DataFrame:
    """Normal newborn and hospice flags.  Gap rows have no value unless the flag is set."""
    codes = t["rev_codes"].filter(F.col("revenue_code").isin([rules.NEWBORN_CODE, *rules.NICU_CODES]))
    # the run's accounts first: no other account's charges are looked at
    charges = only_keys(t["charges"], keep(stays.select("har").distinct()), "har")
    coded = join_dim(charges, codes, ["rev_code_id"])
    newborns = only_code(
        coded, "har", "revenue_code", "amount", rules.NEWBORN_CODE, list(rules.NICU_CODES)
    )
    hospice = t["encounters"].filter(F.col("pat_class").isin(*rules.HOSPICE_CLASSES))
    unset = F.when(F.col("detail_line").isNotNull(), F.lit(0))
    flagged = flag_if_exists(stays, newborns, ["har"], "normal_newborn", unset, accounts)
    return flag_if_exists(flagged, hospice, ["csn"], "hospice", unset, known)


def finish(stays: DataFrame, encounters: DataFrame, known: Ordered | None = None) -> DataFrame:
    """Drop open first lines outside units, add the extraction time, close the last lines."""
    still_open = (
        like_ci("unit_stay_type", "NON IP UNIT%")
        & (F.col("unit_status") == IN_UNIT)
        & (F.col("line") == 1)
    )
    kept = keep(drop_where(stays, still_open))
    latest = kept.agg(round_minute(F.max("unit_out_dttm"))).scalar()
    timed = kept.withColumn("extraction_dttm", latest)
    return close_last(
        arrange(timed, ["csn"], ["line"], known=known),
        encounters,
        "csn",
        "disch_dttm",
        "unit_out_dttm",
        ~F.col("unit_status").isin(rules.DISCHARGED, IN_UNIT) & F.col("next_type_csn").isNull(),
        unit_status=rules.DISCHARGED,
        next_type_csn=rules.DISCHARGED,
        next_type_har=rules.DISCHARGED,
    )


_NAMES = {
    "PAT_ENC_CSN": "csn",
    "LINE": "line",
    "HSP_ACCOUNT_ID": "har",
    "UNIT_STAY_TYPE": "unit_stay_type",
    "ADT_DEPARTMENT_ID": "dept_id",
    "UNIT_IN_DTTM": "unit_in_dttm",
    "UNIT_OUT_DTTM": "unit_out_dttm",
    "UNIT_STATUS": "unit_status",
    "IP_UNIT_TRACKER_CSN": "ip_unit_tracker_csn",
    "ICU_TRACKER_CSN": "icu_tracker_csn",
    "NEXT_IP_DEPT_ID": "next_dept_id",
    "NEXT_IP_UNIT_STAY_TYPE_CSN": "next_type_csn",
    "IP_UNIT_TRACKER_HAR": "ip_unit_tracker_har",
    "ICU_TRACKER_HAR": "icu_tracker_har",
    "NEXT_IP_UNIT_STAY_TYPE_HAR": "next_type_har",
    "ANCILLARY_VISITS": "ancillary_visits",
    "ICU_BOUNCE_BACK_HRS_CSN": "icu_bounce_back_hrs_csn",
    "ICU_BOUNCE_BACK_HRS_HAR": "icu_bounce_back_hrs_har",
    "BILLED_AS_OP": "billed_as_op",
    "CEDAR_SPRUCE_TXN_YN": "cross_site",
    "NORMAL_NEWBORN_YN": "normal_newborn",
    "EXTRACTION_DTTM_APPROX": "extraction_dttm",
    "HOSP": "hosp",
    "HUP_SITE": "hup_site",
    "HOSPICE_ADMISSION_YN": "hospice",
}


def to_output(stays: DataFrame, owner: str) -> DataFrame:
    named = stays.select(
        *[F.col(c).alias(n) for n, c in _NAMES.items()], F.lit(owner).alias("TABLE_OWNER")
    )
    types = dict(part.split(" ") for part in OUTPUT.split(", "))
    return named.select(*[F.col(n).cast(types[n]).alias(n) for n in types])


def build_for(
    t: Tables, chosen: DataFrame, window: RunWindow, owner: str = "", log: DataFrame | None = None
) -> DataFrame:
    """Unit activity of the given encounters (``csn, har, billed_as_op``)."""
    t = {**t, "as_of": window.end}  # open stays run as far as the movements do
    dept = keep(departments(t))
    moves = keep(cohort_movements(t, chosen, dept, log))
    known = measured(moves, ["csn"])
    detail = keep(movement_detail(moves, t))
    rows = keep(all_rows(moves, detail, known))
    stays = keep(unit_stays(rows, known))
    stays = stays.unionByName(gap_stays(stays, moves, known))
    stays = encounter_columns(stays, t["encounters"], known)
    stays = keep(attribute_site(keep(stays), dept, t["dept_history"]))
    accounts = measured(stays, ["har"])
    stays = keep(add_churn(account_columns(stays, accounts), moves, known))
    return to_output(finish(add_flags(stays, t, known, accounts), t["encounters"], known), owner)


def build(
    t: Tables, stored: DataFrame, window: RunWindow, owner: str = "", compare: bool = True
) -> DataFrame:
    """The daily run: pick the encounters, then build their unit activity."""
    chosen, log = pick_encounters(t, stored, window, compare)
    return build_for(t, chosen, window, owner, log)
