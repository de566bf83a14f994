import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stayflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")


def rows(df, order=None):
    """Rows as sorted dicts, for comparing results that have no order of their own."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: str([r[c] for c in (order or sorted(r))]))
