"""Which encounters to rebuild in a run.

The functions take DataFrames with the domain column names (see ``plans/schemas.py``), encounters
with one row per ``csn`` and accounts with one row per ``har``, and return key rows ``csn, har``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.joins import join_dim, only_keys, within, without
from stayflow.sources.scratch import keep

KEYS = ["csn", "har"]


@dataclass(frozen=True)
class RunWindow:
    """Dates of one run.  ``as_of`` is the run date; nothing reads the clock."""

    as_of: date
    lookback_days: int = 3

    @property
    def start(self) -> datetime:
        return _midnight(self.as_of) - timedelta(days=self.lookback_days)

    @property
    def end(self) -> datetime:
        """Midnight after the run date, still inside the window."""
        return _midnight(self.as_of) + timedelta(days=1)

    @property
    def year_before(self) -> datetime:
        return self.start - timedelta(days=365)

    def days_ago(self, days: int) -> datetime:
        return _midnight(self.as_of) - timedelta(days=days)

    def covers(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.start), F.lit(self.end))


def _midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def recent_activity(
    movements: DataFrame,
    encounters: DataFrame,
    window: RunWindow,
    move_filter: Column | None = None,
    encounter_filter: Column | None = None,
) -> DataFrame:
    """Encounters with a movement that began or ended inside the window."""
    moved = movements.filter(window.covers("out_dttm") | window.covers("in_dttm"))
    if move_filter is not None:
        moved = moved.filter(move_filter)
    chosen = encounters if encounter_filter is None else encounters.filter(encounter_filter)
    return within(chosen, moved, ["csn"], known=True).select(*KEYS)


def changed_end(
    stored: DataFrame, encounters: DataFrame, window: RunWindow, max_age_days: int = 45
) -> DataFrame:
    """Encounters stored as discharged whose discharge time is no longer the stored end."""
    ends = (
        stored.filter(F.col("unit_status") == "DISCHARGED")
        .groupBy("csn")
        .agg(F.min("unit_out_dttm").alias("_first"), F.max("unit_out_dttm").alias("_last"))
    )
    current = encounters.filter(F.col("disch_dttm") > F.lit(window.days_ago(max_age_days)))
    moved = (F.col("_first") != F.col("disch_dttm")) | (F.col("_last") != F.col("disch_dttm"))
    return current.join(ends, "csn").filter(moved).select(*KEYS)


def flag_flip(
    stored: DataFrame,
    encounters: DataFrame,
    window: RunWindow,
    from_: int,
    max_age_days: int = 180,
    inpatient: int = 1,
) -> DataFrame:
    """Encounters whose stored billing flag disagrees with the account's class now.

    ``from_=0``: stored as inpatient, account no longer is.  ``from_=1``: the other way round.
    The encounters carry their account's ``base_class``.
    """
    is_inpatient = F.col("base_class") == inpatient
    flipped = encounters.filter(
        (~is_inpatient if from_ == 0 else is_inpatient)
        & (F.col("disch_dttm") > F.lit(window.days_ago(max_age_days)))
    )
    flagged = stored.filter(F.col("billed_as_op") == from_)
    return within(flipped, flagged, ["csn"], known=True).select(*KEYS)


def merge_candidates(
    encounters: DataFrame,
    accounts: DataFrame,
    cohort: DataFrame,
    window: RunWindow,
    encounter_filter: Column,
) -> DataFrame:
    """Encounters on either side of an account merge that fell inside the window.

    Only merged accounts whose primary encounter is not in the cohort yet are looked at.
    """
    merged = without(
        accounts.filter(
            (F.col("adm_dttm") > F.lit(window.year_before)) & window.covers("combine_dttm")
        ).select(F.col("prim_csn").alias("csn"), F.col("har").alias("_from"), F.col("combine_har").alias("_into")),
        cohort,
        ["csn"],
        known=True,
    )
    sides = merged.select(F.explode(F.array("_from", "_into")).alias("har")).distinct()
    chosen = encounters.filter(
        encounter_filter & (F.col("admit_dttm") > F.lit(window.year_before))
    )
    return only_keys(chosen, keep(sides), "har").select(*KEYS)


def linked_by_merge(
    movements: DataFrame,
    encounters: DataFrame,
    accounts: DataFrame,
    cohort: DataFrame,
    window: RunWindow,
    move_filter: Column,
    encounter_filter: Column,
) -> DataFrame:
    """The :func:`merge_candidates` that have a wanted movement; only their part of the log is read."""
    linked = keep(merge_candidates(encounters, accounts, cohort, window, encounter_filter))
    moved = only_keys(movements.filter(move_filter), linked, "csn")
    return within(linked, moved, ["csn"], known=True)


def siblings(
    encounters: DataFrame,
    accounts: DataFrame,
    cohort: DataFrame,
    account_filter: Column | None = None,
    encounter_filter: Column | None = None,
) -> DataFrame:
    """All encounters of cohort accounts that another account was merged into."""
    sources = accounts if account_filter is None else accounts.filter(account_filter)
    targets = within(
        cohort.select("har").distinct(),
        sources.select(F.col("combine_har").alias("har")),
        ["har"],
        known=True,
    )
    chosen = encounters if encounter_filter is None else encounters.filter(encounter_filter)
    return only_keys(chosen, keep(targets), "har").select(*KEYS)


def places_seen(moves: DataFrame, place: Column) -> DataFrame:
    """Per encounter, whether any of its movements (to known places) satisfies ``place``: ``csn, _wanted``.

    Added up before the shuffle, so an encounter of very many movements is no burden.
    """
    return moves.groupBy("csn").agg(F.max(F.when(place, 1)).alias("_wanted"))


def require_any(
    cohort: DataFrame,
    movements: DataFrame,
    departments: DataFrame,
    encounters: DataFrame,
    place: Column,
    encounter: Column,
) -> DataFrame:
    """Cohort rows with a movement to a wanted place, or any known place for a wanted encounter."""
    cohort = keep(cohort)
    visited = only_keys(movements.select("csn", "dept_id"), cohort, "csn")
    seen = places_seen(join_dim(visited, departments, ["dept_id"]), place)
    facts = seen.join(encounters.drop("har", "dept_id"), "csn")
    passed = facts.filter(F.coalesce((F.col("_wanted") == 1) | encounter, F.lit(False)))
    return within(cohort, passed, ["csn"], known=True)


def missed_accounts(
    accounts: DataFrame,
    stored: DataFrame,
    window: RunWindow,
    account_filter: Column,
    max_age_days: int = 180,
) -> DataFrame:
    """Primary encounters of qualifying accounts that the stored table does not know."""
    chosen = accounts.filter(
        account_filter
        & (F.col("adm_dttm") > F.lit(window.days_ago(max_age_days)))
        & F.col("prim_csn").isNotNull()
    )
    return without(chosen, stored, ["har"], known=True).select(F.col("prim_csn").alias("csn"), "har")


def accumulate(cohort: DataFrame, candidates: DataFrame, billed_as_op: int) -> DataFrame:
    """Append candidates whose encounter is not listed yet; the first writer's flag stays."""
    new = without(candidates, cohort, ["csn"], known=True).withColumn("billed_as_op", F.lit(billed_as_op))
    return cohort.unionByName(new.select("csn", "har", "billed_as_op"))
