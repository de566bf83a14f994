"""Interval operators against brute force, with and without cut keys."""

from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from stayflow.operators import intervals as iv
from stayflow.operators.ordered import arrange

from .conftest import rows

T0 = datetime(2024, 1, 1)
LIMITS = [None, 25]


def mins(n, seconds=0):
    return T0 + timedelta(minutes=n, seconds=seconds)


@pytest.fixture(scope="module")
def data():
    rnd = Random(11)
    points = [(rnd.choice([1, 1, 1, 2, 3]), mins(rnd.randrange(600)), i, rnd.choice(["a", "b", None])) for i in range(300)]
    spans = []
    for i in range(120):
        s = rnd.randrange(600)
        e = rnd.choice([None] + [s + rnd.randrange(-3, 20) for _ in range(20)])
        spans.append((rnd.choice([1, 1, 1, 2, 4]), mins(s), None if e is None else mins(e), i, rnd.choice(["a", "b", None])))
    return points, spans


@pytest.fixture(scope="module")
def tables(spark, data):
    points, spans = data
    return (
        spark.createDataFrame(points, "k long, at timestamp_ntz, pid long, kind string").repartition(4),
        spark.createDataFrame(spans, "k long, s timestamp_ntz, e timestamp_ntz, sid long, kind string").repartition(4),
    )


def inside(p, s):
    return p[0] == s[0] and s[1] <= p[1] and (s[2] is None or p[1] <= s[2])


@pytest.mark.parametrize("limit", LIMITS)
def test_points_in_overlapping_intervals(tables, data, limit):
    got = iv.points_in_intervals(*tables, ["k"], "at", "s", "e", limit)
    pairs = sorted((r["pid"], r["_interval"]["sid"]) for r in got.collect())
    assert pairs == sorted((p[2], s[3]) for p in data[0] for s in data[1] if inside(p, s))


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("unlike", [None, ("kind", "kind")])
def test_counts_without_pairs(tables, data, limit, unlike):
    got = iv.count_in_interval(*tables, ["k"], ["sid"], "at", "s", "e", "n", unlike, limit)
    counts = {r["sid"]: r["n"] for r in got.collect()}
    for s in data[1]:
        want = [
            p for p in data[0]
            if s[2] is not None and inside(p, s)
            and (unlike is None or (p[3] is not None and s[4] is not None and p[3] != s[4]))
        ]
        assert counts[s[3]] == len(want)


@pytest.mark.parametrize("chunk, limit", [(None, None), (64, None), (4, None), (1, 25), (3, 25)])
def test_latest_record_wins(tables, data, chunk, limit, monkeypatch):
    if chunk:
        monkeypatch.setattr(iv, "_RECORDS_PER_KEY", 1)
        monkeypatch.setattr(iv, "_CHUNK", chunk)
    got = iv.latest_record(*tables, ["k"], "at", "s", "e", {"sid": "sid", "s": "began"}, limit=limit)
    found = {r["pid"]: (r["began"], r["sid"]) for r in got.collect()}
    assert len(found) == len(data[0]) == got.count()
    for p in data[0]:
        valid = [(s[1], s[2] or datetime(9999, 12, 31), s[3]) for s in data[1] if inside(p, s)]
        best = max(valid, default=(None, None, None))
        assert found[p[2]] == (best[0], best[2])


@pytest.mark.parametrize("limit", [None, 25])
def test_short_histories_are_lists_however_many(spark, tables, data, limit, monkeypatch):
    monkeypatch.setattr(iv, "_chunks", None)  # for long ones
    spark.conf.set("stayflow.broadcastRows", 1)
    try:
        got = iv.latest_record(*tables, ["k"], "at", "s", "e", {"sid": "sid"}, limit=limit).collect()
    finally:
        spark.conf.unset("stayflow.broadcastRows")
    want = {p[2]: max(((s[1], s[2] or datetime(9999, 12, 31), s[3]) for s in data[1] if inside(p, s)), default=(None,))[-1] for p in data[0]}
    assert {r["pid"]: r["sid"] for r in got} == want and len(got) == len(data[0])


@pytest.fixture(scope="module")
def odd(spark):
    """NULL keys on both sides, ties, nesting twenty deep, long and open intervals, times before 1970."""
    points = [(k, mins(n), 100 * i + n) for i, k in enumerate([1, 2, None]) for n in range(0, 60, 7)]
    points += [(1, datetime(1960, 5, 1, 12), 900), (1, datetime(9998, 1, 1), 901), (1, None, 902), (3, mins(5), 903)]
    spans = [(k, mins(-n), mins(n), 50 * i + n) for i, k in enumerate([1, None]) for n in range(20)]
    spans += [(2, mins(0), mins(9), 200), (2, mins(0), mins(9), 201), (2, mins(0), mins(8), 202), (2, None, mins(9), 203)]
    spans += [(1, datetime(1950, 1, 1), datetime(1965, 1, 1), 204), (1, mins(0), None, 205), (2, mins(9), mins(3), 206)]
    return (
        points,
        spans,
        spark.createDataFrame(points, "k long, at timestamp_ntz, pid long"),
        spark.createDataFrame(spans, "k long, s timestamp_ntz, e timestamp_ntz, sid long"),
    )


def holds(p, s):
    return None not in (p[0], p[1], s[0], s[1]) and inside(p, s)


def test_null_keys_ties_and_deep_nesting(odd, monkeypatch):
    points, spans, pdf, sdf = odd
    got = iv.points_in_intervals(pdf, sdf, ["k"], "at", "s", "e").collect()
    pairs = sorted((r["pid"], r["_interval"]["sid"]) for r in got)
    assert pairs == sorted((p[2], s[3]) for p in points for s in spans if holds(p, s))
    counts = {r["sid"]: r["n"] for r in iv.count_in_interval(pdf, sdf, ["k"], ["sid"], "at", "s", "e", "n").collect()}
    assert counts == {s[3]: sum(s[2] is not None and holds(p, s) for p in points) for s in spans}
    want = {p[2]: max(((s[1], s[2] or datetime(9999, 12, 31), s[3]) for s in spans if holds(p, s)), default=(None,))[-1] for p in points}
    for longest, chunk in ((200, 64), (1, 64), (1, 2)):
        monkeypatch.setattr(iv, "_RECORDS_PER_KEY", longest)
        monkeypatch.setattr(iv, "_CHUNK", chunk)
        found = iv.latest_record(pdf, sdf, ["k"], "at", "s", "e", {"sid": "sid"}).collect()
        assert {r["pid"]: r["sid"] for r in found} == want and len(found) == len(points)


def _open_history(spark):
    points = spark.range(100_000).select(
        F.lit(1).cast("long").alias("k"), "id", (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))).alias("at")
    )
    spans = [(1, mins(0), None, 0)] + [(1, mins(500 * i), mins(500 * i + 300), i) for i in range(1, 300)]
    return points.repartition(8), spark.createDataFrame(spans, "k long, s timestamp_ntz, e timestamp_ntz, sid long")


def _tasks(df):
    """Rows made by each task."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


@pytest.fixture
def as_if_large(spark):
    """Spark joins tables of this size in one task; here it shall treat them as large ones."""
    names = ["adaptive.coalescePartitions.enabled", "adaptive.autoBroadcastJoinThreshold", "autoBroadcastJoinThreshold"]
    for name, value in zip(names, ["false", "-1", "-1"]):
        spark.conf.set(f"spark.sql.{name}", value)
    yield
    for name in names:
        spark.conf.unset(f"spark.sql.{name}")


def test_points_of_one_open_interval_are_spread(spark, as_if_large):
    points, spans = _open_history(spark)
    found = iv.points_in_intervals(points, spans.filter("sid = 0"), ["k"], "at", "s", "e", limit=10_000)
    tasks = _tasks(found)
    assert sum(tasks) == 100_000 and len(tasks) > 3 and max(tasks) < 60_000


def test_only_levels_in_use_are_exchanged(spark):
    """Three lengths of intervals: a point is copied three times at most, a point of another key never."""
    points, _ = _open_history(spark)
    points = points.unionByName(points.limit(5).withColumn("k", F.lit(2).cast("long")))
    spans = spark.createDataFrame([(1, mins(0), mins(9), 0), (1, mins(0), None, 1), (1, mins(0), mins(9000), 2), (3, mins(0), mins(300), 3)], "k long, s timestamp_ntz, e timestamp_ntz, sid long")
    found = iv.points_in_intervals(points, spans, ["k"], "at", "s", "e", known=True)
    assert found.count() == 10 + 9001 + 100_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    copied = [line for line in plan.splitlines() if "Generate explode" in line and "_levels" in line]
    assert len(copied) == 1 and "bit_or" in plan


def test_long_history_of_a_hot_key_is_spread(spark, as_if_large):
    points, spans = _open_history(spark)
    found = iv.latest_record(points, spans, ["k"], "at", "s", "e", {"sid": "sid"}, limit=10_000)
    tasks = _tasks(found)
    assert sum(tasks) == 100_000 and len(tasks) > 3 and max(tasks) < 60_000
    want = [next((i for i in [(n // 500)] if 0 < i < 300 and n % 500 <= 300), 0) for n in range(100_000)]
    assert [r["sid"] for r in found.orderBy("id").collect()] == want


def loop_split(span, events, cap):
    """The rule, one interval at a time."""
    state, last, cuts = span["state"], span["s"], []
    stop = span["e"] - timedelta(minutes=1) if span["e"] else mins(10_000)
    for at, seen, go in sorted(events):
        if len(cuts) == cap:
            break
        if cuts and not cuts[-1][2]:
            break
        if state is None or seen is None or seen == state:
            continue
        if at < last + timedelta(minutes=1) or at > stop:
            continue
        cuts.append((at, seen, go))
        state, last = seen, at
    marks = [(span["s"], span["state"])] + [c[:2] for c in cuts]
    ends = [m[0] for m in marks[1:]] + [span["e"]]
    return [(span["id"], i, m[0], e, m[1]) for i, (m, e) in enumerate(zip(marks, ends))]


@pytest.mark.parametrize("fold, limit, cap", [(None, None, 4), (None, None, None), (5, None, 4), (5, None, None), (1, 10, None), (1, 10, 3)])
@pytest.mark.parametrize("restart", [False, True])
def test_split_by_fold_and_by_doubling(spark, fold, limit, cap, restart):
    rnd = Random(5 + bool(cap))
    spans, events = [], []
    for i in range(40):
        key = rnd.randrange(30)
        s = mins(1000 * i)
        e = None if rnd.random() < 0.15 else s + timedelta(minutes=rnd.randrange(2, 300))
        spans.append({"k": key, "id": i, "s": s, "e": e, "state": rnd.choice(["A", "B", None, "A"])})
        for _ in range(rnd.choice([0, 2, 40])):
            events.append((key, s + timedelta(seconds=rnd.randrange(0, 9000)), rnd.choice(["A", "B", "C", None]), rnd.random() < 0.8))
    seen = set()
    events = [x for x in events if (x[0], x[1]) not in seen and not seen.add((x[0], x[1]))]
    if not restart:  # several events at one time: the smaller state comes first
        events += [(k, at, rnd.choice(["A", "B", "C"]), True) for k, at, *_ in events[::5]]
    sdf = spark.createDataFrame([tuple(x.values()) for x in spans], "k long, id long, s timestamp_ntz, e timestamp_ntz, state string")
    edf = spark.createDataFrame(events, "k long, at timestamp_ntz, seen string, go boolean")
    flags = edf.select("at", F.col("go").alias("_restart"), F.col("k").alias("_k"))

    def look_up(matched):
        return matched.join(flags, (matched["_at"] == flags["at"]) & (matched["k"] == flags["_k"])).drop("at", "_k")

    got = iv.split_on_change(
        sdf, edf, ["k"], ["id"], "s", "e", "state", "at", "seen", as_of=mins(10_000),
        max_cuts=cap, limit=limit, events_per_fold=fold, may_restart=look_up if restart else None, carry=["k"],
    )
    result = sorted(((r["id"], r["piece"], r["s"], r["e"], r["state"]) for r in got.collect()), key=lambda r: r[:2])
    expected = []
    for x in spans:
        mine = [(at, st, go if restart else True) for k, at, st, go in events if k == x["k"] and st]
        expected += loop_split(x, mine, cap)
    # open intervals may also own events of later intervals of the same key; the rule is the same
    assert result == sorted(expected, key=lambda r: r[:2])


def test_split_of_fifty_thousand_events(spark):
    """More events on one stay than are folded: every cut is found, without a cap, in rows."""
    rnd = Random(8)
    at, events = T0, []
    for _ in range(50_000):
        at += timedelta(seconds=rnd.choice([5, 20, 40, 70, 200]))
        events.append((1, at, rnd.choice("ABC")))
    span = {"k": 1, "id": 7, "s": T0, "e": at + timedelta(hours=1), "state": "A"}
    edf = spark.createDataFrame(events, "k long, at timestamp_ntz, seen string")
    sdf = spark.createDataFrame([tuple(span.values()), (2, 8, T0, None, "B")], "k long, id long, s timestamp_ntz, e timestamp_ntz, state string")
    got = iv.split_on_change(sdf, edf, ["k"], ["id"], "s", "e", "state", "at", "seen", as_of=mins(10**6))
    result = sorted((r["id"], r["piece"], r["s"], r["e"], r["state"]) for r in got.filter("id = 7").collect())
    want = loop_split(span, [(a, st, True) for _, a, st in events], None)
    assert len(want) > 20_000 and result == want
    assert [tuple(r)[2:] for r in got.filter("id = 8").collect()] == [(T0, None, "B", 0)]


@pytest.fixture(scope="module")
def moves(spark):
    rnd = Random(2)
    out = []
    for key in (1, 1, 1, 2):
        t = rnd.randrange(5)
        for _ in range(60):
            end = t + rnd.choice([0, 5, 30])
            out.append((key, len(out), rnd.choice("xyz"), rnd.choice(["p", "q", None]), mins(t), None if rnd.random() < 0.1 else mins(end)))
            t = end
    return spark.createDataFrame(out, "csn long, event_id long, dept string, kind string, in_dttm timestamp_ntz, pat_out_dttm timestamp_ntz")


def stay_rows(moves, limit):
    o = arrange(moves, ["csn"], ["in_dttm", "pat_out_dttm", "event_id"], limit)
    o = iv.drop_orphans(iv.mark_edges(o, ["dept", "kind"]))
    return iv.collapse_runs(
        o,
        F.col("admit_status").isNotNull(),
        F.col("discharge_status").isNotNull(),
        first={"dept": "dept", "kind": "kind", "unit_in_dttm": "in_dttm"},
        last={"unit_out_dttm": "pat_out_dttm", "unit_status": "discharge_status"},
    )


def test_stays_of_cut_keys(moves):
    assert rows(stay_rows(moves, None)) == rows(stay_rows(moves, 20))


def test_stays_follow_the_rule(moves):
    groups = {}
    for r in moves.collect():
        groups.setdefault(r["csn"], []).append(r)
    want = []
    for key, group in groups.items():
        group.sort(key=lambda r: (r["in_dttm"], r["pat_out_dttm"] or datetime.min, r["event_id"]))
        run = None
        for i, r in enumerate(group):
            def differs(other):
                if other is None:
                    return True
                if r["dept"] != other["dept"]:
                    return True
                return None not in (r["kind"], other["kind"]) and r["kind"] != other["kind"]

            before = group[i - 1] if i else None
            after = group[i + 1] if i + 1 < len(group) else None
            admit = differs(before) or (before is not None and before["pat_out_dttm"] is None)
            orphan = r["pat_out_dttm"] is None and after is not None
            if orphan:
                continue
            if admit:
                run = [key, r["dept"], r["kind"], r["in_dttm"], None, None]
                want.append(run)
            if r["pat_out_dttm"] is None:
                run[4:] = [None, iv.IN_UNIT]
            elif differs(after):
                run[4:] = [r["pat_out_dttm"], iv.TRANSFER]
    got = [
        [r["csn"], r["dept"], r["kind"], r["unit_in_dttm"], r["unit_out_dttm"], r["unit_status"]]
        for r in stay_rows(moves, 20).collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", LIMITS)
def test_gaps_keep_the_previous_end_to_the_minute(spark, limit):
    def case(second):
        stays = spark.createDataFrame(
            [(1, mins(0), mins(10, second), "w"), (1, mins(30), mins(40), "w")],
            "csn long, unit_in_dttm timestamp_ntz, unit_out_dttm timestamp_ntz, unit string",
        )
        moves = spark.createDataFrame(
            [(1, mins(10, second), 7), (1, mins(20), 8), (1, mins(29, 30), 9)], "csn long, in_dttm timestamp_ntz, event_id long"
        )
        found = iv.fill_gaps(arrange(stays, ["csn"], ["unit_in_dttm"], limit), moves, ["csn"], limit=limit)
        return sorted(r["event_id"] for r in found.collect())

    assert case(20) == [7, 8]
    assert case(40) == [8]


def test_open_stays_end_where_the_next_begins(spark):
    stays = spark.createDataFrame(
        [(1, mins(0), None, iv.IN_UNIT), (1, mins(5), None, iv.IN_UNIT), (1, mins(9), None, iv.IN_UNIT), (2, mins(1), mins(2), iv.TRANSFER)],
        "csn long, unit_in_dttm timestamp_ntz, unit_out_dttm timestamp_ntz, unit_status string",
    )
    got = iv.close_open_intervals(arrange(stays, ["csn"], ["unit_in_dttm"])).df
    ends = sorted(((r["csn"], r["unit_in_dttm"], r["unit_out_dttm"], r["unit_status"]) for r in got.collect()), key=str)
    assert ends == [
        (1, mins(0), mins(5), iv.TRANSFER),
        (1, mins(5), mins(9), iv.TRANSFER),
        (1, mins(9), None, iv.IN_UNIT),
        (2, mins(1), mins(2), iv.TRANSFER),
    ]


def test_rows_outside_the_kept_span(spark):
    moves = spark.createDataFrame([(k, mins(t), i) for i, (k, t) in enumerate([(1, 0), (1, 5), (1, 9), (2, 0), (2, 9), (3, 4)])], "csn long, in_dttm timestamp_ntz, event_id long")
    kept = spark.createDataFrame([(1, mins(5), mins(9)), (2, mins(0), None)], "csn long, in_dttm timestamp_ntz, pat_out_dttm timestamp_ntz")
    for limit in (None, 1):
        before = iv.outside_span(moves, kept, ["csn"], "before", limit=limit)
        after = iv.outside_span(moves, kept, ["csn"], "after", limit=limit)
        assert [r["event_id"] for r in before.collect()] == [0]
        assert [r["event_id"] for r in after.collect()] == [2]
    assert [r["event_id"] for r in iv.keys_without_rows(moves, kept, ["csn"]).collect()] == [5]
