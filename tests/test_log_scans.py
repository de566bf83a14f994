"""How often the build reads the movement log."""

import re

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from stayflow.operators.joins import only_keys
from stayflow.plans.unit_activity import build, pick_encounters

from .test_cohort import EXPECTED, WINDOW, inputs  # noqa: F401


@pytest.fixture
def scans(monkeypatch, spark):
    """Reads of the table whose first column is ``the_log``, over all queries that have been run."""
    seen = []

    def note(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.extend(re.findall(r"Relation \[the_log#", plan))

    kind = type(spark.range(1))
    for name in ("first", "count", "collect", "isEmpty"):
        real = getattr(kind, name)

        def noted(self, *args, _real=real, **kwargs):
            note(self)
            return _real(self, *args, **kwargs)

        monkeypatch.setattr(kind, name, noted)
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: note(self._df) or write(self, *a, **k))
    return seen


def _marked(tables, folder, spark):
    log = tables["movements"]
    log.select(F.lit(1).alias("the_log"), *log.columns).write.parquet(folder)
    return {**tables, "movements": spark.read.parquet(folder)}


def test_the_log_is_read_twice(spark, inputs, scans, tmp_path):  # noqa: F811
    tables, stored = inputs
    tables = _marked(tables, f"{tmp_path}/log", spark)
    picked, _ = pick_encounters(tables, stored, WINDOW)
    assert {r["csn"]: r["billed_as_op"] for r in picked.collect()} == EXPECTED
    assert len(scans) == 2
    assert build(tables, stored, WINDOW).count() > 0
    assert len(scans) == 4


def test_long_lists_use_a_bloom_filter(spark, tmp_path):
    """A list too long to be sent around filters the large side before its shuffle."""
    settings = {
        "stayflow.broadcastRows": "5",
        "spark.sql.autoBroadcastJoinThreshold": "1b",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b",
    }
    spark.range(20_000).withColumnRenamed("id", "csn").write.parquet(f"{tmp_path}/log")
    spark.range(100, 5000, 7).withColumnRenamed("id", "csn").write.parquet(f"{tmp_path}/list")
    log, listed = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("log", "list"))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = only_keys(log, listed, "csn")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan and "bloom_filter_agg" in plan
        physical = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(csn), GreaterThanOrEqual(csn,100)" in physical
        assert found.count() == 700
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert only_keys(log, listed, "csn").count() == 700
    assert only_keys(log, listed.filter("csn < 0"), "csn").count() == 0
