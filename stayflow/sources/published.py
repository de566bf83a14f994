"""The published stay table: Parquet in versions, by the month in which a stay began.

``path/data/<version>/`` holds the months that one run has rewritten, and ``path/manifest/<version>/``
lists for every month of the table the version that holds it.  A version counts once Spark has marked
its manifest complete, which is the last thing a run does: a run that dies earlier changes nothing and
can be repeated.  Readers take the newest complete manifest.

Beside the data there is a narrow index of the same months: which encounters and accounts have rows there, and
whether an encounter holds the account's first stay.  A run looks up there which months it has to rewrite
and which accounts hold two first stays; months that it does not touch are never read.  ``path/changes``
lists the encounters that each version replaced, ``path/quality`` its counts of unexpected input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stayflow.operators.cohort import RunWindow
from stayflow.operators.joins import only_keys
from stayflow.operators.updates import renumber_accounts, upsert_by_key
from stayflow.plans import rules
from stayflow.plans.schemas import OUTPUT
from stayflow.sources.scratch import keep

MONTH = "STAY_MONTH"
# the month of stays without a beginning
NO_MONTH = "none"
_FOLDER = "month"
_ROWS_PER_FILE = 2_000_000
_SCHEMA = f"{OUTPUT}, {MONTH} string"
_CSN, _HAR, _FIRST = "PAT_ENC_CSN", "HSP_ACCOUNT_ID", "HOLDS_FIRST_STAY"
_INDEX = f"{MONTH} string, {_CSN} long, {_HAR} long, {_FIRST} boolean"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _versions(spark: SparkSession, path: str, kind: str, complete: bool = True) -> list[int]:
    """Versions under ``path/kind``, oldest first; other errors than a missing folder are raised."""
    system, folder = _files(spark, f"{path}/{kind}")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    done = [
        int(n)
        for n in names
        if n.isdigit()
        and (not complete or system.exists(_files(spark, f"{path}/{kind}/{n}/_SUCCESS")[1]))
    ]
    return sorted(done)


def _months(spark: SparkSession, path: str) -> dict[str, int]:
    """Each month of the table with the version that holds it: a few hundred entries."""
    versions = _versions(spark, path, "manifest")
    if not versions:
        return {}
    listed = spark.read.schema("month string, version long").parquet(f"{path}/manifest/{versions[-1]}")
    return {r["month"]: r["version"] for r in listed.collect()}


def _read(spark: SparkSession, path: str, months: dict[str, int], kind: str = "data", schema: str = _SCHEMA) -> DataFrame:
    folders = [f"{path}/{kind}/{v}/{_FOLDER}={m}" for m, v in sorted(months.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table as of now, or an empty one before the first run."""
    return _read(spark, path, _months(spark, path))


# -- the index ------------------------------------------------------------------------------


def _state(rows: DataFrame) -> DataFrame:
    """Index rows of stays: which encounter and account, in which month, and whether with a first stay."""
    first = F.coalesce(F.col("IP_UNIT_TRACKER_HAR") == 1, F.lit(False))
    return rows.groupBy(MONTH, _CSN, _HAR).agg(F.max(first).alias(_FIRST))


def _index(spark: SparkSession, path: str, months: dict[str, int]) -> DataFrame:
    return _read(spark, path, months, "index", _INDEX)


def _months_of(found: DataFrame) -> set[str]:
    """Calendar months: a few hundred at most."""
    return {r[0] or NO_MONTH for r in found.select(MONTH).distinct().collect()}


def read_of(spark: SparkSession, path: str, encounters: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Stored rows of the listed encounters (``csn``), and of the listed accounts (``har``).

    Months without such rows are not read; which they are is looked up in the index.
    """
    held = _months(spark, path)
    index = _index(spark, path, held)
    listed = keep(encounters.select(F.col("csn").alias(_CSN)).distinct())
    found = only_keys(index, listed, _CSN)
    if accounts is not None:
        owners = keep(accounts.select(F.col("har").alias(_HAR)).distinct())
        found = found.unionByName(only_keys(index, owners, _HAR))
    found = keep(found)
    rows = _read(spark, path, {m: v for m, v in held.items() if m in _months_of(found)})
    return only_keys(rows, keep(found.select(_CSN).distinct()), _CSN).drop(MONTH)


def stored_for_run(spark: SparkSession, path: str, t: dict[str, DataFrame], window: RunWindow, max_age_days: int = 180) -> DataFrame:
    """What a daily run compares with: stored rows of recently discharged encounters and recent accounts.

    The steps that look for late corrections ask for nothing older, so the rest of the table stays unread.
    """
    since = F.lit(window.days_ago(max_age_days))
    late = t["encounters"].filter(F.col("disch_dttm") > since)
    return read_of(spark, path, late, t["accounts"].filter(F.col("adm_dttm") > since))


def changed_encounters(spark: SparkSession, path: str, since: int = 0) -> DataFrame:
    """Encounters (``csn, version``) whose stays were replaced or renumbered by versions after ``since``.

    Each encounter comes with the last version that changed it.
    """
    done = [v for v in _versions(spark, path, "manifest") if v > since]
    folders = [f"{path}/changes/{v}" for v in done]
    if not folders:
        return spark.createDataFrame([], "csn long, version long")
    rows = spark.read.schema("csn long, version long").parquet(*folders)
    return rows.groupBy("csn").agg(F.max("version").alias("version"))


# -- publishing -----------------------------------------------------------------------------

# Labels that stand for input the rules do not know.
UNEXPECTED = {"UNIT_STAY_TYPE": rules.UNKNOWN_GROUP, "HUP_SITE": rules.UNKNOWN_SITE}


@dataclass(frozen=True)
class Version:
    """What a run has published: its number, the rows of its batch, and how many of them are of which
    unexpected class (``column=label``)."""

    number: int
    rows: int
    unexpected: dict[str, int]


def _unexpected() -> list[Column]:
    return [F.count(F.when(F.col(c) == label, 1)).alias(f"{c}={label}") for c, label in UNEXPECTED.items()]


def publish(spark: SparkSession, path: str, batch: DataFrame) -> Version:
    """Replace the batch's encounters in the published table and repair account trackers.

    Only the months that hold rows of an affected encounter are read in full and written anew; the
    other months stay where they are.  An account can get a second first stay only from the batch, so only the
    batch's accounts are looked at.
    """
    seen = Observation("published batch")
    batch = batch.observe(seen, F.count(F.lit(1)).alias("rows"), *_unexpected())
    batch = keep(batch.withColumn(MONTH, F.date_format("UNIT_IN_DTTM", "yyyy-MM")))
    counts = seen.get
    held = _months(spark, path)
    index = _index(spark, path, held)
    mine = keep(_state(batch))
    replaced = keep(mine.select(_CSN).distinct())
    owners = keep(mine.select(_HAR).distinct())
    doubled = keep(_doubled(only_keys(index, owners, _HAR), mine, replaced, owners))
    affected = keep(doubled.union(replaced).distinct())
    changed = _months_of(only_keys(index, affected, _CSN)) | _months_of(mine)
    part = _read(spark, path, {m: v for m, v in held.items() if m in changed})
    new = keep(renumber_accounts(upsert_by_key(part, batch, [_CSN]), doubled))
    rows = {r[0] or NO_MONTH: r["count"] for r in new.groupBy(MONTH).count().collect()}
    version = max(v for kind in ("data", "manifest", "changes") for v in [0, *_versions(spark, path, kind, complete=False)]) + 1
    if rows:
        _write(new, f"{path}/data/{version}", rows)
        _write_index(_state(new), f"{path}/index/{version}")
    affected.select(F.col(_CSN).alias("csn"), F.lit(version).cast("long").alias("version")).write.parquet(f"{path}/changes/{version}")
    quality = sorted((name, n) for name, n in counts.items())
    spark.createDataFrame(quality, "name string, rows long").coalesce(1).write.parquet(f"{path}/quality/{version}")
    months = {m: v for m, v in held.items() if m not in changed} | dict.fromkeys(rows, version)
    manifest = spark.createDataFrame(sorted(months.items()), "month string, version long")
    manifest.coalesce(1).write.parquet(f"{path}/manifest/{version}")
    return Version(version, counts["rows"], {n: k for n, k in quality if n != "rows"})


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    """Per complete version (``version, name, rows``): rows of its batch and how many of each unexpected class."""
    out = spark.createDataFrame([], "version long, name string, rows long")
    for v in _versions(spark, path, "manifest"):
        counts = spark.read.schema("name string, rows long").parquet(f"{path}/quality/{v}")
        out = out.unionByName(counts.withColumn("version", F.lit(v).cast("long")))
    return out


def _doubled(stored: DataFrame, mine: DataFrame, replaced: DataFrame, owners: DataFrame) -> DataFrame:
    """Encounters with a row in an account of the batch whose first stay two encounters hold.

    ``stored`` are the index rows of the batch's accounts, ``mine`` those of the batch itself.
    """
    now = stored.join(replaced, _CSN, "left_anti").select(_CSN, _HAR, _FIRST).unionByName(mine.select(_CSN, _HAR, _FIRST))
    holders = now.filter(F.col(_FIRST) & F.col(_HAR).isNotNull()).select(_HAR, _CSN).distinct()
    twice = holders.groupBy(_HAR).agg(F.count(_CSN).alias("_n")).filter("_n > 1").select(_HAR)
    return now.join(twice, _HAR, "left_semi").select(_CSN).distinct()


def _write(new: DataFrame, path: str, rows: dict[str, int]) -> None:
    """One folder per month, with as many files as its rows ask for."""
    shares = F.create_map(*[F.lit(x) for m, n in rows.items() for x in (m, -(-n // _ROWS_PER_FILE))])
    folder = F.coalesce(MONTH, F.lit(NO_MONTH))
    share = F.pmod(F.xxhash64("PAT_ENC_CSN"), F.element_at(shares, F.col(_FOLDER)))
    (
        new.withColumn(_FOLDER, folder)
        .withColumn("_share", share)
        .repartition(_FOLDER, "_share")
        .drop("_share")
        .write.partitionBy(_FOLDER)
        .parquet(path)
    )


def _write_index(state: DataFrame, path: str) -> None:
    """One folder per month, ordered by encounter so that a lookup skips most of it."""
    folder = F.coalesce(MONTH, F.lit(NO_MONTH))
    ordered = state.withColumn(_FOLDER, folder).repartitionByRange(_FOLDER, _CSN).sortWithinPartitions(_FOLDER, _CSN)
    ordered.write.partitionBy(_FOLDER).parquet(path)


def forget_old_versions(spark: SparkSession, path: str) -> None:
    """Delete the versions that the newest manifest does not use, and what dead runs have left.

    The lists of changes and the counts of older versions stay as long as their manifests do.

    Not to be called while readers of an older version are at work.
    """
    used = set(_months(spark, path).values())
    done = _versions(spark, path, "manifest")[-1:]
    kept = {"data": used, "index": used, "manifest": done, "changes": done, "quality": done}
    for kind, versions in kept.items():
        for v in _versions(spark, path, kind, complete=False):
            if v not in versions:
                system, folder = _files(spark, f"{path}/{kind}/{v}")
                system.delete(folder, True)
