"""Every query against its SQL, and what its plan must not contain."""

import re

import pytest

from stayflow.queries import QUERIES, SQL

from .oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    frames = []

    def run(session, folder):
        frames.append(QUERIES[name](session, folder))
        return frames[-1]

    problem, _ = compare(spark, con, FOLDER, run, SQL.get(name))
    assert problem is None
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a window without a partition key would put all rows into one task
    assert not re.search(r"Window \[.*windowspecdefinition\((?:[^,]* ASC|[^,]* DESC|specified)", plan)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


def test_one_shuffle_for_stays(spark):
    """Edges, runs and numbering share one exchange."""
    plan = QUERIES["unit_stays"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["only_code"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in plan
    plan = QUERIES["movement_detail"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_shipdate" in plan


HOT = ["unit_stays", "gap_rows", "points_in_intervals", "churn_counts", "trackers", "split_on_change", "dated_join_long_history", "repair_account_trackers"]


@pytest.mark.parametrize("name", HOT)
def test_hot_keys_give_the_same_rows(spark, con, name):
    """Limits so small that nearly every key is cut into segments and every split is followed in rows."""
    limits = {"stayflow.rowsPerTask": "25", "stayflow.eventsPerFold": "3"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        problem, _ = compare(spark, con, FOLDER, QUERIES[name], SQL[name])
    finally:
        for key in limits:
            spark.conf.unset(key)
    assert problem is None
