"""Operators over whole tables, against brute force on small tables."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from stayflow.llm import bottomk, cells, ctw, mixing, pivot_index, simhash_index
from stayflow.llm.components import components


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(2)
    links = [(k, k + 1) for k in range(40)] + [(100 + draw.randrange(60), 100 + draw.randrange(60)) for _ in range(40)]
    links += [(7, 7), (500, 501), (501, 500), (500, 501), (900, 800)] + [(1000, 1001 + k) for k in range(50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*links, (None, 3)], "u long, v long")).collect()}
    want = roots_of({n for l in links for n in l}, links)
    assert got == {n: r for n, r in want.items() if any(n in l and l[0] != l[1] for l in links)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("block", [2, 5, 1000])
def test_every_pair_of_a_list_meets_once(spark, block):
    members = [(k % 3, 10 * k) for k in range(40)] + [(9, 1)]
    frame = cells.cells(spark.createDataFrame(members, "key long, member long"), "key", "member", block=block)

    def count(part):
        import pyarrow as pa

        a, b = [], []
        for x, y in cells.pairs(*(part[c].to_numpy() for c in ("cell", "key", "side"))):
            m = part["member"].to_numpy()
            a += np.minimum(m[x], m[y]).tolist()
            b += np.maximum(m[x], m[y]).tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    got = Counter((r["a"], r["b"]) for r in cells.over_cells(frame, count, "a long, b long").collect())
    want = {(min(x, y), max(x, y)) for k, x in members for j, y in members if k == j and x < y}
    assert set(got) == want and set(got.values()) == {1}


def test_links_of_fingerprints(spark):
    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(12)]
    prints = {0, 2**64 - 1, *base}
    for b in base:
        for bits in (1, 2, 3, 3, 4, 5):
            prints.add(b ^ sum(1 << k for k in draw.sample(range(64), bits)))
    prints |= {base[0] ^ (k << 40) for k in range(128)}  # one crowded ball
    signed = {p - 2**64 if p >= 2**63 else p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    for distance in (0, 1, 2, 3):
        got = {r["node"]: r["root"] for r in components(simhash_index.near_links(frame, distance)).collect()}
        order = sorted(signed)
        links = [(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= distance]
        assert {p: got.get(p, p) for p in signed} == roots_of(signed, links)
    with pytest.raises(ValueError):
        simhash_index.near_links(frame, 4)


def expected_groups(rows):
    prints = [simhash_index.fingerprint_of(t) % 2**64 for _, t in rows]
    n = range(len(rows))
    root = roots_of(n, [(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= 3])
    least = defaultdict(list)
    for i in n:
        if rows[i][0] is not None:
            least[root[i]].append(rows[i][0])
    return [(rows[i][0], f"{prints[i]:016x}", min(least[root[i]], default=None)) for i in n]


def test_simhash_groups_of_awkward_rows(awkward, none):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = Counter(tuple(r) for r in simhash_index.simhash_groups(awkward).collect())
    want = expected_groups(rows)
    assert got == Counter(want)
    assert simhash_index.simhash_groups(none).count() == 0
    kept = simhash_index.keep_one(awkward)
    assert kept.columns == awkward.columns
    groups = {(c, p) if c is None else c for _, p, c in want}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(g for g in groups if not isinstance(g, tuple))
    assert kept.count() == len(groups) and simhash_index.keep_one(none).count() == 0


def test_simhash_groups_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(tuple(r) for r in simhash_index.simhash_groups(docs).collect()) == sorted(expected_groups(rows))


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 1.5, 2.0) == pytest.approx([200, 2 / 3 * 250, 1 / 3 * 250])
    assert mixing.targets([10, 1000], [5, 2], 1.5, 2.0) == pytest.approx([20, 1495])
    assert mixing.targets([0, 10], [5, 2], 1.5, 2.0) == pytest.approx([0, 15])
    assert mixing.targets([0, 0], [1, 1], 1.5, 2.0) == [0, 0] and mixing.targets([], [], 1.5, 2.0) == []
    assert mixing.targets([5, 5], [1, 1], 3.0, 2.0) == pytest.approx([10, 10])


@pytest.mark.parametrize("block", [7, 300, 65_536])
def test_mixture_reaches_its_targets(spark, block):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn(
        "source", F.when(F.col("source") == "src3", None).otherwise(F.col("source"))
    )
    mix = mixing.Mix(docs, block=block)
    rows = {r["id"]: r for r in mix.taken().collect()}
    sums = defaultdict(lambda: [0, 0, None, None])
    for r in docs.collect():
        got, s = rows[r["doc_id"]], sums[r["source"]]
        assert got["size"] == len(r["text"].encode().split()) and 0 <= got["taken"] <= 2 * got["size"]
        s[0] += got["size"]
        s[1] += got["taken"]
        s[2:] = got["target"], got["source_size"]
    order = sorted(sums, key=lambda k: (k is None, (k or "").encode()))
    sizes = [sums[k][0] for k in order]
    goal = mixing.targets(sizes, [(5, 2, 1)[k % 3] for k in range(len(order))], 1.5, 2.0)
    for k, want in zip(order, goal):
        assert sums[k][2] == pytest.approx(want) and sums[k][3] == sums[k][0] and abs(sums[k][1] - want) <= 1
    again = {r["id"]: r["taken"] for r in mixing.Mix(docs.repartition(7), block=block).taken().collect()}
    assert again == {k: r["taken"] for k, r in rows.items()}


def test_every_stretch_of_the_schedule_is_mixed(spark):
    docs = spark.createDataFrame([(k, "abc"[k % 3], "w " * 40) for k in range(300)], "doc_id long, source string, text string")
    mix = mixing.Mix(docs, block=40)
    order = [r["number"] for r in mix.schedule().orderBy("slot").collect()]
    shares = {s["number"]: s["slots"] / len(order) for s in mix.sources}
    for begin in range(0, len(order) - 60, 20):
        part = Counter(order[begin : begin + 60])
        assert all(abs(part[n] - 60 * share) <= 4 for n, share in shares.items())


def test_mixture_of_awkward_rows(awkward, none):
    got = Counter((r["id"], r["size"]) for r in mixing.Mix(awkward, block=50).taken().collect())
    assert got == Counter((r["doc_id"], len((r["text"] or "").encode().split())) for r in awkward.collect())
    assert mixing.Mix(none).taken().count() == 0 and mixing.Mix(none).schedule().count() == 0
    mixed = mixing.Mix(awkward, carry=True).mixed().select("row.*")
    assert mixed.columns == awkward.columns
    assert mixing.Mix(none, carry=True).mixed().count() == 0


def brute_scores(texts, train, depth):
    forms = [ctw.normal_form(t) for t in texts]
    counts = defaultdict(lambda: [0, 0])

    def walk(form):
        s = b"\n" * depth + form
        for k in range(depth, len(s)):
            node = 1
            for j in range(8):
                bit = s[k] >> (7 - j) & 1
                yield s[k - depth : k], node, bit
                node = node * 2 + bit

    for form, t in zip(forms, train):
        for context, node, bit in walk(form) if t else ():
            for d in range(depth + 1):
                counts[(context[depth - d :], node)][bit] += 1
    children = defaultdict(list)
    for context, node in counts:
        if context:
            children[(context[1:], node)].append((context, node))
    weighted, own = {}, {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        a, b = counts[key]
        kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        if len(key[0]) == depth:
            weighted[key], own[key] = kt, 1.0
        else:
            longer = sum(weighted[c] for c in children[key])
            weighted[key] = np.logaddexp(longer, kt) - math.log(2)
            own[key] = 1 / (1 + math.exp(min(700, longer - kt)))

    def chance(context, node):
        total, rest = 0.0, 1.0
        for d in range(depth + 1):
            key = (context[depth - d :], node)
            if key not in counts:
                return total + rest / 2
            a, b = counts[key]
            total += rest * own[key] * (b + 0.5) / (a + b + 1)
            rest *= 1 - own[key]
        return total

    return [sum(math.log10(p if bit else 1 - p) for c, n, bit in walk(f) for p in [chance(c, n)]) for f in forms]


@pytest.mark.parametrize("depth", [0, 2, 4])
def test_context_tree_weighting(spark, depth):
    texts = ["the cat sat", "The cat  sat\non the mat", "", None, "a cat and a hat", "Zebra é quux", "the cat sat", "mat mat mat mat"]
    train = [True, True, True, False, True, False, False, True]
    frame = spark.createDataFrame(list(zip(range(8), texts, train)), "doc_id long, text string, score boolean")
    rows = sorted(ctw.score(frame, F.col("score"), depth=depth).collect(), key=lambda r: r["doc_id"])
    words = [ctw.normal_form(t)[:-1].split() + [b"\n"] for t in texts]
    known = Counter(w for ws, t in zip(words, train) if t for w in ws)
    n, v = sum(known.values()), len(known)
    for r, ws, want, t in zip(rows, words, brute_scores(texts, train, depth), train):
        assert r["score"] == pytest.approx(want, rel=1e-9) and r["train"] == t and r["train_tokens"] == n
        assert r["n_tokens"] == len(ws) and r["n_known"] == sum(known[w] > 0 for w in ws)
        assert r["base_score"] == pytest.approx(sum(math.log10((known[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))


def test_scores_do_not_depend_on_cells_and_parts(spark, monkeypatch):
    texts = ["the cat sat on the mat", "a cat and a hat", None, "the hat"] * 3
    rows = [(k, t, k % 4 != 3) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, own boolean").repartition(3)
    monkeypatch.setattr(ctw, "CELL", 10)  # several cells
    monkeypatch.setattr(ctw, "SALTED", 100)  # merged and sent in parts
    got = {r["doc_id"]: r["score"] for r in ctw.score(frame, F.col("own"), depth=4).collect()}
    want = brute_scores(texts, [own for *_, own in rows], 4)
    assert [got[k] for k, *_ in rows] == pytest.approx(want, rel=1e-9)


def test_context_tree_weighting_of_awkward_rows(awkward, none):
    rows = ctw.score(awkward, F.col("doc_id") != 2, depth=2).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in awkward.collect())
    assert all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
    untrained = ctw.score(awkward.filter("doc_id = 8"), F.lit(False), depth=2).first()
    assert untrained["score"] == pytest.approx(-32 * math.log10(2)) and untrained["train_tokens"] == 0
    assert ctw.score(none, F.lit(True), depth=2).count() == 0


def test_a_chunk_is_scored_without_holding_words_beside_strings(spark, monkeypatch):
    caught, whole = [], PandasCogroupedOps.applyInArrow
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", lambda ops, run, schema: caught.append(run) or whole(ops, run, schema))
    ctw.score(spark.createDataFrame([(1, "a cat", True)], "doc_id long, text string, own boolean"), F.col("own"))
    numbers = np.random.default_rng(5).integers(0, 1 << 32, 120_000)
    forms = [ctw.normal_form(" ".join(f"{x:08x}" for x in numbers[k : k + 10_000])) for k in range(0, len(numbers), 10_000)]
    codes = np.unique(ctw._strings(forms, 6)[0])
    texts = {"ids": [[k] for k in range(12)], "trains": [[True]] * 12, "sizes": [[len(f)] for f in forms]}
    texts["packed"] = [pa.compress(f, "zstd", asbytes=True) for f in forms]
    value = -1e-6 * np.arange(len(codes))
    table = pa.table(
        {"word": pa.array([None], pa.binary()), "count": pa.array([None], pa.int64()), "size": [len(codes)], "codes": [ctw._pack(codes)], "value": [ctw._pack(value)]}
    )
    texts = pa.table(texts, pa.schema({"ids": pa.list_(pa.int64()), "trains": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int32()), "packed": pa.binary()}))
    tracemalloc.start()
    scored = caught[-1](texts, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [value[np.searchsorted(codes, ctw._strings([f], 6)[0])].sum() for f in forms]
    assert scored["score"].to_pylist() == pytest.approx(want) and scored["n_known"].to_pylist() == [10_001] * 12
    assert peak < 48 * len(codes)


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_sketches_estimate(spark, awkward):
    rows = awkward.select("text", bottomk.sketch("text").alias("s")).collect()
    pairs = [(x["text"], y["text"], x["s"], y["s"]) for x in rows for y in rows]
    frame = spark.createDataFrame(pairs, "x string, y string, a array<long>, b array<long>")
    got = frame.select("x", "y", bottomk.resemblance("a", "b").alias("r"), bottomk.containment("a", "b").alias("c"), bottomk.distinct_shingles("a").alias("n"), F.size("a").alias("k")).collect()
    for r in got:
        a, b = shingles(r["x"]), shingles(r["y"])
        exact = len(a) < bottomk.K and len(b) < bottomk.K and len(a | b) <= bottomk.K
        assert r["r"] == pytest.approx(jaccard(a, b), abs=1e-9 if exact else 0.2)
        assert r["c"] == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=1e-9 if exact else 0.25)
        assert r["n"] == pytest.approx(len(a), rel=1e-9 if len(a) < bottomk.K else 0.35) and r["k"] == min(len(a), bottomk.K)


def test_sketches_of_parts_merge(spark):
    draw = random.Random(6)
    parts = [(k % 2, " ".join(str(draw.randrange(400)) for _ in range(60))) for k in range(40)] + [(2, ""), (None, "a b c d e")]
    frame = spark.createDataFrame(parts, "key int, text string").withColumn("s", bottomk.sketch("text"))
    hashed = {(r["key"], h) for r in frame.select("key", bottomk.shingle_hashes("text").alias("h")).collect() for h in r["h"]}
    got = {r["key"]: r["s"] for r in bottomk.merge_parts(frame, "key", "s").collect()}
    assert got == {k: sorted(h for j, h in hashed if j == k)[: bottomk.K] for k in (0, 1, 2, None)}
    two = frame.filter("key = 0").limit(2).collect()
    one = spark.createDataFrame([(two[0]["s"], two[1]["s"])], "a array<long>, b array<long>").select(bottomk.merge("a", "b")).first()[0]
    assert one == sorted(set(two[0]["s"]) | set(two[1]["s"]))[: bottomk.K]


def test_next_rows(spark, awkward, none):
    docs = spark.createDataFrame([(k * k, str(k)) for k in range(300)], "doc_id long, text string")
    for per_cell in (1, 7, 5000):
        got = {r["doc_id"]: r["next"]["text"] for r in bottomk.with_next(docs, "doc_id", ["text"], per_cell=per_cell).collect()}
        assert got == {k * k: str((k + 1) % 300) for k in range(300)}
    rows = bottomk.with_next(awkward, "doc_id", ["text"], {"n": F.length("text")}, per_cell=2).collect()
    order = {r["doc_id"]: r["next"]["text"] for r in rows if r["doc_id"] not in (None, 2)}
    texts = {r["doc_id"]: r["text"] for r in awkward.collect() if r["doc_id"] is not None}
    assert len(rows) == awkward.count() and order[1] == texts[2] and order[6] == texts[7]
    assert order[10] in {r["text"] for r in awkward.collect() if r["doc_id"] is None}
    assert bottomk.with_next(none, "doc_id", ["text"]).count() == 0


def test_blocks_of_very_large_sources(spark):
    """Blocks follow each other without gaps, for sizes whose products would not fit a long."""
    sizes = [(1, 1), (7, 3), (10**13 + 5, 152_587_891), (9 * 10**18, 137_329_101_562), (2 * 65_536 + 1, 2)]
    rows = []
    for n, b in sizes:
        rows += [(n, b, k) for k in sorted({k for k in (0, 1, b // 3, b - 2, b - 1, n % b - 1, n % b) if 0 <= k < b})]
    frame = spark.createDataFrame(rows, "source_size long, blocks long, block long")
    begin, end = mixing._block_begin(F.col("block")), mixing._block_begin(F.col("block") + 1)
    frame = frame.withColumns({"begin": begin, "end": end})
    frame = frame.withColumns({"first": mixing._block_of(F.col("begin")), "last": mixing._block_of(F.col("end") - 1)})
    for r in frame.collect():
        n, b, k = r["source_size"], r["blocks"], r["block"]
        assert r["begin"] == k * (n // b) + min(k, n % b) and r["end"] - r["begin"] in (n // b, n // b + 1)
        assert r["first"] == r["last"] == k and (k < b - 1 or r["end"] == n)


def _next_in_order(spark, ids, kind, order=None, per_cell=16):
    rows = [(i, f"text of {i}") for i in ids]
    frame = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(7)
    got = {r["doc_id"]: r["next"]["text"] for r in bottomk.with_next(frame, "doc_id", ["text"], per_cell=per_cell).collect()}
    line = sorted(ids, key=order)
    assert got == {a: f"text of {b}" for a, b in zip(line, line[1:] + line[:1])}


def test_next_by_any_ids(spark):
    """One far id, the ends of the range, clusters, texts and bytes as ids."""
    _next_in_order(spark, [*range(20_000), 2**62], "long", per_cell=4)
    _next_in_order(spark, [-(2**63), 2**63 - 1, 0, 5, 6, *[2**60 + k for k in range(500)], *[-k * k for k in range(1, 400)]], "long")
    _next_in_order(spark, [f"doc-{k:05d}" for k in range(900)] + ["", "a", "é", "日本", "doc", "zzzzzzzzzz"], "string", lambda t: t.encode())
    _next_in_order(spark, [k / 7 for k in range(-300, 300)], "double")
    _next_in_order(spark, [7], "int")
    with pytest.raises(TypeError):
        bottomk.with_next(spark.createDataFrame([(None, "a")], "doc_id date, text string"), "doc_id", ["text"])


def test_a_far_id_leaves_cells_small(spark):
    ids = spark.range(20_000).unionByName(spark.range(2**61, 2**61 + 1)).select(F.col("id").cast("double").alias("_place"))
    sizes = [r["count"] for r in bottomk._cells(ids, 64).groupBy("_cell").count().collect()]
    assert sum(sizes) == 20_001 and max(sizes) <= 256


def vectors_with_neighbours(seed, angles):
    draw = np.random.RandomState(seed)
    rows = []
    for k, angle in enumerate(angles):
        a, b = draw.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        rows += [a, np.cos(angle) * a + np.sin(angle) * b]
    return rows


@pytest.mark.parametrize("shape", dict.fromkeys(s for _, s in pivot_index.SHAPES))
def test_recall_near_the_limit(shape):
    """Pairs just over a cosine of 0.95 share enough pivots in at least nine of ten cases, in every shape."""
    rows = np.array(vectors_with_neighbours(1, np.arccos(np.random.RandomState(2).uniform(0.95, 0.97, 800))))
    more = np.random.RandomState(6).standard_normal((6000, 64))
    pivots = pivot_index.choose_pivots([*rows.tolist(), *more.tolist()], shape.pivots)[64]
    assert len(pivots) == shape.pivots
    near = pivot_index.nearest_pivots(rows, pivots, shape.prefix)
    shared = [len(set(near[2 * k]) & set(near[2 * k + 1])) for k in range(800)]
    assert np.mean(np.array(shared) >= shape.shared) >= 0.9


def test_shapes_follow_the_table():
    sizes = [pivot_index.shape_for(n).pivots for n in (0, 16_384, 16_385, 100_000, 10**6, 10**12)]
    assert sizes == [512, 512, 1024, 2048, 4096, 4096]


@pytest.mark.parametrize("shape", [pivot_index.Shape(1024), pivot_index.Shape(2048, 8), pivot_index.Shape(4096, 10, 4)])
def test_links_in_other_shapes(spark, monkeypatch, shape):
    """The same links whatever the shape, also of vectors whose squares leave the range of doubles."""
    monkeypatch.setattr(pivot_index, "SHAPES", ((math.inf, shape),))
    rows = [(k, v.tolist()) for k, v in enumerate(vectors_with_neighbours(5, [0.05] * 60))]
    rows = [(k, [x * s for x in v]) for (k, v), s in zip(rows, [1.0, 1e200, 1e-200, 3.0] * 30)]
    got = {r["vec_id"]: r for r in pivot_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    linked = [got[k]["n_links"] == 1 and got[k]["component_id"] == k - k % 2 for k in range(120)]
    assert np.mean(linked) >= 0.98


def test_near_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    draw = np.random.RandomState(3)
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    base = np.array(rows[0][1])
    top = max(r[0] for r in rows) + 1
    rows += [(top + k, (base + 0.005 * draw.standard_normal(64)).tolist()) for k in range(60)]
    rows += [(top + 100 + k, rows[5][1]) for k in range(30)] + [(top + 200, (2 * np.array(rows[5][1])).tolist())]
    odd = [(top + 300, None), (top + 301, []), (top + 302, [0.0] * 64), (top + 303, [float("nan")] * 64), (top + 304, [1.0, None]), (None, rows[5][1]), (top + 305, [1.0, 2.0]), (top + 306, [2.0, 4.0])]
    got = {r["vec_id"]: r for r in pivot_index.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.95
    ids = [r[0] for r in rows]
    root = roots_of(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(close, 1)))])
    want = {i: int(close[k].sum()) - 1 for k, i in enumerate(ids)}
    assert all(got[i]["n_links"] <= want[i] for i in ids)
    assert sum(got[i]["n_links"] for i in ids) >= 0.99 * sum(want.values())
    assert np.mean([got[i]["component_id"] == root[i] and got[i]["kept"] == (root[i] == i) for i in ids]) > 0.99
    for i in [*range(top + 300, top + 305), None]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[top + 305]["n_links"] == got[top + 306]["n_links"] == 1
    assert pivot_index.near_vectors(frame.filter("false")).count() == 0
