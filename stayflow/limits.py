"""How much one task, one array or one broadcast may hold.

Each value can be set on the session, for example
``spark.conf.set("stayflow.rowsPerTask", 500_000)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # rows of one key that a single task may sort; keys above it are cut into segments
    "rowsPerTask": 2_000_000,
    # rows a side may have to be broadcast; larger sides are shuffled
    "broadcastRows": 500_000,
    # bytes such a side may have, and what a text or nested cell is taken to have
    "broadcastBytes": 64_000_000,
    "bytesPerText": 40,
    # events of one interval that may be folded in one array; above it they stay rows
    "eventsPerFold": 20_000,
    # segments of one range shuffle
    "maxSegments": 50_000,
}


def limit(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(f"stayflow.{name}", str(DEFAULTS[name])))
