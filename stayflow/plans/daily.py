"""The daily run: pick, build, publish, and leave nothing behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayflow.operators.cohort import RunWindow
from stayflow.plans.unit_activity import build
from stayflow.sources.published import Version, publish, stored_for_run
from stayflow.sources.scratch import scratch_of_run


def run_day(
    spark: SparkSession, path: str, inputs: dict[str, DataFrame], window: RunWindow, owner: str = "", compare: bool = True
) -> Version:
    """One run of the published table at ``path``; what it kept on the way is deleted when it ends.

    A run that dies can be repeated: until its version is complete, readers see the one before.
    """
    with scratch_of_run(spark):
        stored = stored_for_run(spark, path, inputs, window)
        return publish(spark, path, build(inputs, stored, window, owner, compare))


def catch_up(
    spark: SparkSession, path: str, inputs: dict[str, DataFrame], windows: list[RunWindow], owner: str = ""
) -> list[Version]:
    """The runs of several missed days, oldest first; each compares with what the one before has published.

    Days that share their movements are built as often as they would have been, so a table that has caught up
    equals one that was never behind, up to the inputs' state.
    """
    return [run_day(spark, path, inputs, w, owner) for w in sorted(windows, key=lambda w: w.as_of)]
