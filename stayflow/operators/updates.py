"""Conditional updates, deletes and keyed replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.columns import like_ci
from stayflow.operators.joins import join_one, within, without
from stayflow.operators.ordered import Ordered, arrange
from stayflow.operators.sequences import seq_where


def set_where(df: DataFrame, test: Column, **values) -> DataFrame:
    """Set columns where the test is true; where it is false or NULL they keep their value."""
    return df.withColumns(
        {
            name: F.when(test, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(name))
            for name, v in values.items()
        }
    )


def drop_where(df: DataFrame, test: Column) -> DataFrame:
    """Delete rows where the test is true; a NULL test keeps the row."""
    return df.filter(~F.coalesce(test, F.lit(False)))


def upsert_by_key(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Replace all rows of the batch's keys by the batch."""
    return without(existing, batch, keys).unionByName(batch)


def repeated_first_keys(
    stored: DataFrame, account: str, encounter: str, tracker: str
) -> DataFrame:
    """Accounts whose number-one stay occurs in more than one encounter."""
    firsts = stored.filter(F.col(tracker) == 1).select(account, encounter).distinct()
    return firsts.groupBy(account).agg(F.count(encounter).alias("_n")).filter("_n > 1").drop("_n")


def doubled_encounters(
    stored: DataFrame,
    encounter: str = "PAT_ENC_CSN",
    account: str = "HSP_ACCOUNT_ID",
    tracker: str = "IP_UNIT_TRACKER_HAR",
) -> DataFrame:
    """All encounters with a row in an account whose number-one stay occurs twice."""
    doubled = repeated_first_keys(stored, account, encounter, tracker)
    return within(stored, doubled, [account]).select(encounter).distinct()


def renumber_accounts(
    stored: DataFrame,
    encounters: DataFrame,
    encounter: str = "PAT_ENC_CSN",
    account: str = "HSP_ACCOUNT_ID",
    start: str = "UNIT_IN_DTTM",
    place: str = "ADT_DEPARTMENT_ID",
    kind: str = "UNIT_STAY_TYPE",
    unit_tracker: str = "IP_UNIT_TRACKER_HAR",
    icu_tracker: str = "ICU_TRACKER_HAR",
    limit: int | None = None,
) -> DataFrame:
    """Number the stays of the given encounters again, together, per account.

    Other rows stay as they are.
    """
    affected = within(stored, encounters, [encounter])
    others = without(stored, encounters, [encounter])
    has_account = F.col(account).isNotNull()
    numbered = seq_where(
        arrange(affected, [account], [start, place, encounter], limit),
        _unit=~like_ci(kind, "NON IP%") & has_account,
        _icu=(F.col(kind) == "CRITICAL CARE") & has_account,
    ).df
    renewed = numbered.withColumns(
        {
            unit_tracker: F.coalesce("_unit", unit_tracker),
            icu_tracker: F.coalesce("_icu", icu_tracker),
        }
    ).drop("_unit", "_icu")
    return others.unionByName(renewed)


def repair_trackers(stored: DataFrame, limit: int | None = None, **names: str) -> DataFrame:
    """Renumber the stays of accounts in which two encounters both hold the first stay.

    ``names`` override the column names of :func:`renumber_accounts`.
    """
    shared = {n: names[n] for n in ("encounter", "account") if n in names}
    if "unit_tracker" in names:
        shared["tracker"] = names["unit_tracker"]
    members = doubled_encounters(stored, **shared)
    return renumber_accounts(stored, members, limit=limit, **names)


def close_last(
    rows: Ordered,
    ends: DataFrame,
    key: str,
    key_end: str,
    end: str,
    test: Column,
    **values,
) -> DataFrame:
    """Set ``values`` on the last row of each key if the test holds and it ends at the key's end.

    ``ends`` has one row per key.
    """
    last = rows.shift(_has_next=(F.lit(True), 1)).df
    joined = join_one(last, ends.select(key, F.col(key_end).alias("_key_end")), [key], "left", known=rows)
    wanted = F.col("_has_next").isNull() & test & (F.col(end) == F.col("_key_end"))
    return set_where(joined, wanted, **values).drop("_has_next", "_key_end")
