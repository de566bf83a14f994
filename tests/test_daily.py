"""Daily runs against a stored table."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stayflow.operators.cohort import RunWindow
from stayflow.plans import daily
from stayflow.sources.published import publish, read_published, read_quality
from stayflow.sources.scratch import scratch_dir

from .test_cohort import EXPECTED, WINDOW, inputs  # noqa: F401


def tables_left(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/stayflow")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(folder)} if system.exists(folder) else set()


def test_run_day_publishes_and_leaves_nothing(spark, inputs, tmp_path):  # noqa: F811
    tables, stored = inputs
    path = f"{tmp_path}/activity"
    publish(spark, path, stored)
    before = tables_left(spark)
    done = daily.run_day(spark, path, tables, WINDOW, owner="me")
    assert tables_left(spark) == before
    rows = read_published(spark, path)
    built = {r["PAT_ENC_CSN"]: r["BILLED_AS_OP"] for r in rows.filter("TABLE_OWNER = 'me'").collect()}
    assert built == EXPECTED and done.number == 2
    # an encounter that no step picked keeps its stored row
    assert rows.filter("PAT_ENC_CSN = 5").count() == 1
    again = daily.run_day(spark, path, tables, WINDOW, owner="me")
    # nothing is late any more: only what the window itself picks is built again
    assert again.rows < done.rows and {r["version"] for r in read_quality(spark, path).collect()} == {1, 2, 3}
    same = read_published(spark, path)
    assert same.exceptAll(rows).isEmpty() and rows.exceptAll(same).isEmpty()


def test_missed_days_are_caught_up_in_order(spark, monkeypatch):
    days = []
    monkeypatch.setattr(daily, "run_day", lambda s, p, i, w, o: days.append(w.as_of.day) or w.as_of.day)
    windows = [RunWindow(date(2024, 3, d)) for d in (5, 1, 3)]
    assert daily.catch_up(spark, "x", {}, windows) == days == [1, 3, 5]
