"""Publishing: replacement by encounter, repeated runs, repaired trackers."""

from datetime import datetime

import pytest

from stayflow.operators.updates import drop_where, set_where, upsert_by_key
from stayflow.plans.schemas import OUTPUT
from stayflow.sources import published
from stayflow.sources.published import MONTH, forget_old_versions, publish, read_published
from pyspark.sql import functions as F

NAMES = [p.split(" ")[0] for p in OUTPUT.split(", ")]


def stay(csn, line, har, when, tracker, kind="MED/SURG", dept=11):
    row = dict.fromkeys(NAMES)
    row.update(
        PAT_ENC_CSN=csn, LINE=line, HSP_ACCOUNT_ID=har, UNIT_STAY_TYPE=kind, ADT_DEPARTMENT_ID=dept,
        UNIT_IN_DTTM=when, IP_UNIT_TRACKER_HAR=tracker, ICU_TRACKER_HAR=None,
    )
    return tuple(row.values())


def table(spark, rows):
    return spark.createDataFrame(rows, OUTPUT)


def seen(spark, path):
    return sorted(
        (r["PAT_ENC_CSN"], r["LINE"], r["UNIT_IN_DTTM"], r["IP_UNIT_TRACKER_HAR"], r["ICU_TRACKER_HAR"])
        for r in read_published(spark, path).collect()
    )


def test_publish_replaces_encounters_and_repairs_accounts(spark, tmp_path):
    path = str(tmp_path / "activity")
    jan, feb, mar = datetime(2024, 1, 5), datetime(2024, 2, 5), datetime(2024, 3, 5)
    assert read_published(spark, path).count() == 0
    first = table(
        spark,
        [stay(1, 1, 100, jan, 1), stay(1, 2, 100, feb, 2, "CRITICAL CARE"), stay(2, 1, 200, mar, 1), stay(5, 1, 500, jan, 7)],
    )
    publish(spark, path, first)
    once = seen(spark, path)
    assert len(once) == 4 and once[-1] == (5, 1, jan, 7, None)
    publish(spark, path, first)
    assert seen(spark, path) == once

    # encounter 1 shrinks, and encounter 3 of the same account comes with a first stay of its own
    publish(spark, path, table(spark, [stay(1, 1, 100, feb, 1), stay(3, 1, 100, mar, 1, "CRITICAL CARE")]))
    assert seen(spark, path) == [
        (1, 1, feb, 1, None),
        (2, 1, mar, 1, None),
        (3, 1, mar, 2, 1),
        (5, 1, jan, 7, None),
    ]
    # the month that lost all its rows of encounter 1 still has encounter 5
    months = {r[MONTH] for r in read_published(spark, path).select(MONTH).distinct().collect()}
    assert months == {"2024-01", "2024-02", "2024-03"}

    publish(spark, path, table(spark, [stay(5, 1, 500, mar, 7)]))
    months = {r[MONTH] for r in read_published(spark, path).select(MONTH).distinct().collect()}
    assert months == {"2024-02", "2024-03"}


def test_stays_without_a_beginning_survive(spark, tmp_path):
    path = str(tmp_path / "activity")
    publish(spark, path, table(spark, [stay(1, 1, 100, None, 1), stay(2, 1, 200, None, 1)]))
    publish(spark, path, table(spark, [stay(1, 1, 100, None, 1)]))
    assert [s[0] for s in seen(spark, path)] == [1, 2]
    publish(spark, path, table(spark, [stay(1, 1, 100, datetime(2024, 1, 5), 1)]))
    assert seen(spark, path) == [(1, 1, datetime(2024, 1, 5), 1, None), (2, 1, None, 1, None)]


def test_a_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "activity")
    jan, feb = datetime(2024, 1, 5), datetime(2024, 2, 5)
    publish(spark, path, table(spark, [stay(1, 1, 100, jan, 1), stay(2, 1, 200, feb, 1)]))
    before = seen(spark, path)
    real = published._write

    def dies(new, folder, rows):
        real(new, folder, rows)
        raise RuntimeError("executor and driver lost")

    monkeypatch.setattr(published, "_write", dies)
    again = table(spark, [stay(1, 1, 100, feb, 1)])
    with pytest.raises(RuntimeError):
        publish(spark, path, again)
    assert seen(spark, path) == before
    monkeypatch.setattr(published, "_write", real)
    publish(spark, path, again)
    want = [(1, 1, feb, 1, None), (2, 1, feb, 1, None)]
    assert seen(spark, path) == want
    forget_old_versions(spark, path)
    assert seen(spark, path) == want
    assert sorted(p.name for p in (tmp_path / "activity" / "data").iterdir() if p.is_dir()) == ["3"]


def test_null_tests_neither_update_nor_delete(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, v int")
    assert sorted(r.id for r in drop_where(df, F.col("v") > 6).collect()) == [1, 2]
    assert [r.v for r in set_where(df, F.col("v") > 6, v=0).orderBy("id").collect()] == [None, 5, 0]


def test_upsert_takes_all_rows_of_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (3, "y")], "k int, v string")
    got = sorted((str(r.k), r.v) for r in upsert_by_key(old, new, ["k"]).collect())
    assert got == [("1", "z"), ("2", "c"), ("3", "y"), ("None", "n")]


def test_scratch_of_a_run_is_deleted(spark, tmp_path):
    from stayflow.sources.scratch import keep, scratch_of_run

    path = str(tmp_path / "activity")
    outside = keep(spark.range(3))
    with scratch_of_run(spark) as folder:
        inside = keep(spark.range(5))
        assert inside.count() == 5 and folder in inside.inputFiles()[0]
        publish(spark, path, table(spark, [stay(1, 1, 100, datetime(2024, 1, 5), 1)]))
    files = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
    assert len(seen(spark, path)) == 1 and outside.count() == 3


def test_months_and_accounts_are_looked_up(spark, tmp_path, monkeypatch):
    """Only months with rows of affected encounters are read; the rest of the stored table is not."""
    path = str(tmp_path / "activity")
    months = [datetime(2023, m, 5) for m in range(1, 13)]
    publish(spark, path, table(spark, [stay(c, 1, 100 * c, when, 1) for c, when in enumerate(months, 1)]))
    read, real = [], published._read

    def noted(session, folder, held, kind="data", schema=published._SCHEMA):
        read.append((kind, sorted(held)))
        return real(session, folder, held, kind, schema)

    monkeypatch.setattr(published, "_read", noted)
    # encounter 3 moves to May, encounter 20 joins account 700 of encounter 7
    done = publish(spark, path, table(spark, [stay(3, 1, 300, months[4], 1), stay(20, 1, 700, months[4], 1)]))
    assert [m for kind, m in read if kind == "data"] == [["2023-03", "2023-05", "2023-07"]]
    got = {(r["PAT_ENC_CSN"]): (r["UNIT_IN_DTTM"], r["IP_UNIT_TRACKER_HAR"]) for r in read_published(spark, path).collect()}
    assert len(got) == 13 and got[3] == (months[4], 1) and got[20] == (months[4], 1) and got[7] == (months[6], 2)
    assert {tuple(r) for r in published.changed_encounters(spark, path, done.number - 1).collect()} == {(3, 2), (7, 2), (20, 2)}
    assert published.changed_encounters(spark, path, done.number).count() == 0
    assert {r["csn"]: r["version"] for r in published.changed_encounters(spark, path).collect()}[20] == 2

    read.clear()
    listed = spark.createDataFrame([(3,), (99,)], "csn long")
    rows = published.read_of(spark, path, listed, spark.createDataFrame([(900,)], "har long"))
    assert sorted(r["PAT_ENC_CSN"] for r in rows.collect()) == [3, 9]
    assert [m for kind, m in read if kind == "data"] == [["2023-05", "2023-09"]]


def test_unexpected_input_is_counted(spark, tmp_path):
    path = str(tmp_path / "activity")
    rows = table(spark, [stay(1, 1, 100, datetime(2024, 1, 5), 1, "review"), stay(2, 1, 200, datetime(2024, 1, 6), 1)])
    site = F.when(F.col("PAT_ENC_CSN") == 2, "Needs Investigation").otherwise("HUP-Main")
    done = publish(spark, path, rows.withColumn("HUP_SITE", site))
    assert (done.number, done.rows) == (1, 2)
    assert done.unexpected == {"UNIT_STAY_TYPE=review": 1, "HUP_SITE=Needs Investigation": 1}
    done = publish(spark, path, rows.filter("PAT_ENC_CSN = 2"))
    assert done.unexpected == {"UNIT_STAY_TYPE=review": 0, "HUP_SITE=Needs Investigation": 0}
    counts = {(r["version"], r["name"]): r["rows"] for r in published.read_quality(spark, path).collect()}
    assert counts[1, "HUP_SITE=Needs Investigation"] == 1 and counts[2, "rows"] == 1
    done = publish(spark, path, rows.filter("PAT_ENC_CSN = 77"))
    assert (done.number, done.rows) == (3, 0) and read_published(spark, path).count() == 2
    done = publish(spark, path, table(spark, []))
    assert done.rows == 0 and read_published(spark, path).count() == 2
