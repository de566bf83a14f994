"""Cut and uncut keys must give the same rows."""

from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from stayflow.operators.joins import flag_if_exists, hot_keys, join_any_key, join_one, within, without
from stayflow.operators.ordered import arrange

from .conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One key has most rows, another is NULL, and several rows share a time."""
    rnd = Random(3)
    t0 = datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = rnd.choice([1] * 6 + [None] * 2 + [2, 3])
        data.append((key, t0 + timedelta(minutes=rnd.randrange(200)), i, rnd.choice([None, i]), rnd.random() < 0.3))
    return spark.createDataFrame(data, "k long, t timestamp_ntz, id long, v long, flag boolean").repartition(5)


def scan(df, limit):
    return (
        arrange(df, ["k"], ["t", "id"], limit)
        .shift(before=("id", -1), after=("id", 1), third=("id", 3), raw=("v", -2), more=(F.lit(True), 1))
        .running(
            n=("sum", F.lit(1)),
            flags=("sum", F.when(F.col("flag"), 1)),
            seen=("last", "v"),
            pair=("last", F.when(F.col("flag"), F.struct("id", "t"))),
            top=("max_before", "v"),
        )
    )


def test_cut_keys_scan_like_uncut_keys(skewed):
    plain, cut = scan(skewed, 10_000), scan(skewed, 40)
    assert plain.segments is None and cut.segments > 10
    assert rows(plain.df) == rows(cut.df)


def test_segments_are_bounded(skewed):
    cut = arrange(skewed, ["k"], ["t", "id"], 60)
    largest = cut._cut.groupBy("k", "_segment").count().agg(F.max("count")).first()[0]
    assert largest <= 120


def test_scan_matches_a_plain_loop(skewed):
    got = {r["id"]: r for r in scan(skewed, 40).df.collect()}
    by_key = {}
    for r in skewed.collect():
        by_key.setdefault(r["k"], []).append(r)
    for group in by_key.values():
        group.sort(key=lambda r: (r["t"], r["id"]))
        seen, top, flags = None, None, 0
        for i, r in enumerate(group):
            g = got[r["id"]]
            seen = r["v"] if r["v"] is not None else seen
            flags += bool(r["flag"])
            assert g["before"] == (group[i - 1]["id"] if i else None)
            assert g["after"] == (group[i + 1]["id"] if i + 1 < len(group) else None)
            assert g["third"] == (group[i + 3]["id"] if i + 3 < len(group) else None)
            assert (g["n"], g["flags"], g["seen"], g["top"]) == (i + 1, flags, seen, top)
            if r["v"] is not None:
                top = r["v"] if top is None else max(top, r["v"])


def test_filter_keeps_the_arrangement(skewed):
    def odd(limit):
        return rows(
            arrange(skewed, ["k"], ["t", "id"], limit)
            .filter(F.col("flag"))
            .shift(before=("id", -1))
            .running(n=("sum", F.lit(1)))
            .df
        )

    assert odd(10_000) == odd(40)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_one_spreads_hot_keys(spark, skewed, how):
    right = spark.createDataFrame([(1, "a"), (3, "c"), (9, "z")], "k long, name string")
    plain = rows(skewed.join(right, "k", how))
    assert rows(join_one(skewed, right, ["k"], how, limit=30)) == plain
    assert rows(join_one(skewed, right, ["k"], how)) == plain


def test_hot_keys_counts(skewed):
    hot = hot_keys(skewed, ["k"], 120)
    assert hot.keys == 2 and hot.rows > 600
    assert hot_keys(skewed, ["k"], 10_000) is None


def test_within_without_and_flags(spark, skewed):
    some = spark.createDataFrame([(1,), (1,), (4,)], "k long")
    n = skewed.count()
    inside, outside = within(skewed, some, ["k"]).count(), without(skewed, some, ["k"]).count()
    assert inside == skewed.filter("k = 1").count() and inside + outside == n
    flagged = flag_if_exists(skewed, some, ["k"], "hit")
    assert flagged.filter("hit = 1").count() == inside and flagged.count() == n


def test_join_any_key_has_no_doubles(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "h long")
    right = spark.createDataFrame([(10, 1, 2), (11, 3, 3), (12, None, 1)], "id long, a long, b long")
    got = sorted((r.h, r.id) for r in join_any_key(left, right, "h", ["a", "b"]).collect())
    assert got == [(1, 10), (1, 12), (2, 10), (3, 11)]


def test_following_looks_past_any_number_of_rows(skewed):
    def ahead(limit):
        return arrange(skewed, ["k"], ["t", "id"], limit).following(
            nxt=F.when(F.col("flag"), F.col("id")), pair=F.when(F.col("v").isNull(), F.struct("id", "t"))
        )

    cut, plain = ahead(40), ahead(10_000)
    assert cut.segments and rows(cut.df) == rows(plain.df)
    got = {r["id"]: r["nxt"] for r in cut.df.collect()}
    for key in {r["k"] for r in skewed.collect()}:
        nxt = None
        group = sorted((r for r in skewed.collect() if r["k"] == key), key=lambda r: (r["t"], r["id"]), reverse=True)
        for r in group:
            assert got[r["id"]] == nxt
            nxt = r["id"] if r["flag"] else nxt


def test_join_any_key_of_texts_and_fractions(spark):
    left = spark.createDataFrame([("a", 1.2), ("b", 1.5), (None, 3.0)], "h string, f double")
    right = spark.createDataFrame([(1, "a", "b"), (2, "b", "b"), (3, None, "z")], "id int, x string, y string")
    got = sorted((r.h, r.id) for r in join_any_key(left, right, "h", ["x", "y"]).collect())
    assert got == [("a", 1), ("b", 1), ("b", 2)]
    numbers = spark.createDataFrame([(1, 1.5), (2, 1.2)], "id int, n double")
    assert [r.id for r in join_any_key(left, numbers, "f", ["n"]).orderBy("id").collect()] == [1, 2]
    assert sorted(r.f for r in join_any_key(left, numbers.filter("id = 1"), "f", ["n"]).collect()) == [1.5]


def test_hot_right_keys_are_spread(spark):
    left = spark.createDataFrame([(1, "one"), (2, "two")], "h long, name string")
    right = spark.createDataFrame([(k, 1 if k % 10 else 2, 7) for k in range(400)], "id long, a long, b long")
    spark.conf.set("stayflow.rowsPerTask", "50")
    try:
        joined = join_any_key(left, right, "h", ["a", "b"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 400 and "_share" in plan
    finally:
        spark.conf.unset("stayflow.rowsPerTask")


def test_wide_sides_are_not_broadcast(spark):
    from stayflow.operators.joins import may_broadcast

    narrow = spark.range(10)
    wide = narrow.selectExpr("id", *[f"cast(id as string) c{k}" for k in range(500)])
    assert may_broadcast(narrow, 400_000) and not may_broadcast(wide, 400_000) and may_broadcast(wide, 100)
