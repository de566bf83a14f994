"""Prefix tries and tree contraction against plain code."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stayflow.llm import prefix_trie, queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Rows of (conv_id, turn, role, text) without ties in turn."""
    of = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            of[c].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in of.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(original):
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt = original.get(c - c % 100, [])[:h] + original[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, total = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        total[node] = (sum(total[k][0] for k in kids) if kids else 1, own + sum(total[k][1] for k in kids))
        text = ",".join(map(str, ends.get(node, [])))
        row = (
            members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), len(kids),
            *total[node], hashlib.sha256(text.encode()).hexdigest(),
        )
        out[row[:2]] = row
    return out


def got(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    out = {r[:2]: r for r in rows}
    assert len(out) == len(rows)
    return out


def query_on(spark, tmp_path, rows, schema="conv_id long, turn int, role string, text string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return queries.op13_prefix_trie(spark, str(tmp_path))


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(rows)
    assert got(queries.op13_prefix_trie(spark, FOLDER)) == want


def test_shared_turns_copies_and_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS_PER_BLOCK", 7)
    rng = random.Random(1)
    rows = []
    for c in [*range(0, 260), *range(900, 930), 1000, -5, -200, -150]:
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn if turn else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é🙂"])))
    rows += [(None, 1, "user", "no id"), (5000, 3, "user", "no base"), (7, 100, "x", "long " * 50_000)]
    want = plain(rows)
    assert any(r[1] == 0 and r[3] > 200 for r in want.values())
    assert got(query_on(spark, tmp_path, rows)) == want


def test_long_and_hot_conversations(spark, tmp_path):
    """One conversation holds most rows; its scan is cut into segments, its chain contracted."""
    rows = [(3, k, "user", f"turn {k}") for k in range(400)]
    rows += [(103 + 100 * c, k, "user", f"turn {k}") for c in range(3) for k in range(300 + c)]
    rows += [(c, k, "user", "same") for c in range(1000, 1090) for k in range(6)]
    want = plain(rows)
    spark.conf.set("stayflow.rowsPerTask", "60")
    try:
        assert got(query_on(spark, tmp_path, rows)) == want
    finally:
        spark.conf.unset("stayflow.rowsPerTask")


def test_ties_are_fixed_and_extra_columns_do_not_clash(spark, tmp_path):
    rows = [(1, 0, "user", t, 1, 2, "p", 3) for t in ("b", "a", "a")] + [(1, 1, "user", "c", 1, 2, "p", 3)]
    schema = "conv_id long, turn int, role string, text string, depth int, n_chars int, p string, _a int"
    first = got(query_on(spark, tmp_path / "x", rows, schema))
    assert first == got(query_on(spark, tmp_path / "y", rows[::-1], schema))
    assert got(query_on(spark, tmp_path / "z", rows[:0], schema)) == {}


def plain_totals(parents, weight):
    total = dict(weight)
    depth = {}

    def level(v):
        chain = []
        while v is not None and v not in depth:
            chain.append(v)
            v = parents[v]
        base = depth[v] if v is not None else -1
        for k, u in enumerate(reversed(chain), 1):
            depth[u] = base + k

    for v in parents:
        level(v)
    for v in sorted(parents, key=lambda v: -depth[v]):
        if parents[v] is not None:
            total[parents[v]] += total[v]
    return total


@pytest.mark.parametrize("shape", ["random", "chain", "star", "forest", "comb"])
def test_contraction(spark, shape):
    rng = random.Random(5)
    n = 700
    parents = {0: None}
    for v in range(1, n):
        parents[v] = {
            "random": lambda: rng.randrange(v),
            "chain": lambda: v - 1,
            "star": lambda: 0,
            "forest": lambda: None if v % 50 == 0 else max(0, v - rng.randint(1, 3)),
            "comb": lambda: v - 1 if v % 2 else max(0, v - 2),
        }[shape]()
    names = list(range(1, n + 1))
    rng.shuffle(names)  # numbers that say nothing about depth
    weight = {v: rng.choice([0, 1, 5, -3]) for v in parents}
    frame = spark.createDataFrame(
        [(names[v], None if p is None else names[p], weight[v]) for v, p in parents.items()], "node long, up long, w long"
    )
    totals = prefix_trie.subtree_totals(frame, ["node"], ["up"], ["w"])
    want = plain_totals(parents, weight)
    assert {r["node"]: r["w"] for r in totals.collect()} == {names[v]: t for v, t in want.items()}
