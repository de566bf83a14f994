"""Spelling variants against plain code."""

import random
import re
import zlib
from collections import Counter

import pytest

from stayflow.llm import queries, spelling_kd

FOLDER = "/root/testdata/sf0.001"


def plain_words(docs, least_length=7, least_count=2):
    counted = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                counted[run] += 1
    return {w: n for w, n in counted.items() if n >= least_count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counted, ratio=10):
    out, of = {}, sorted(counted, key=len)
    near = {w: [] for w in of}
    for i, a in enumerate(of):
        for b in of[i + 1 :]:
            if len(b) > len(a) + 1:
                break
            if is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counted[o], o), default=None)
        form[w] = best if best is not None and counted[best] >= ratio * counted[w] else None
    for w in counted:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, counted[w], len(near[w]), counted[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = plain_variants(plain_words(docs))
    result = queries.op11_spelling_variants(spark, FOLDER)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got(result) == want and any(v[4] for v in want.values())


def made(seed, n, letters="abc", length=(1, 7)):
    rng = random.Random(seed)
    of = {"".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(n)}
    return {w: rng.choice([2, 3, 25, 300, 4000, 50_000]) for w in of}


@pytest.mark.parametrize("leaf, sample", [(16_384, 1000), (20, 10_000), (10, 40), (4, 12)])
def test_trees_and_blocks(spark, leaf, sample):
    """Small leaves make many cells; a small sample leaves cells overfull, which are then cut in blocks."""
    counted = made(leaf, 900, "abcé") | made(7, 40, "🙂日xyz", (4, 5))
    frame = spark.createDataFrame(list(counted.items()), "word string, n long").repartition(5)
    assert got(spelling_kd.variants(frame, 10, leaf, sample)) == plain_variants(counted)
    if sample == 12:
        assert spelling_kd.fit_cells(frame, leaf, sample).blocks


def test_anagrams_share_a_vector(spark):
    """Many words with equal letter counts: no tree can part them, blocks do."""
    rng = random.Random(3)
    counted = {}
    for _ in range(600):
        w = list("aabbccde")
        rng.shuffle(w)
        counted["".join(w)] = rng.randint(2, 90)
        k = rng.randrange(8)
        counted["".join(w[:k] + w[k + 1 :])] = 2
    frame = spark.createDataFrame(list(counted.items()), "word string, n long")
    assert got(spelling_kd.variants(frame, 10, 50, 5000)) == plain_variants(counted)


def test_ties_and_chains(spark):
    counted = {"abcdefg": 2, "abcdefh": 20, "abcdefi": 20, "abcdexh": 200, "abcdyxh": 2000, "abczyxh": 20_000, "lonely": 5}
    counted |= {"abczyxhq": 10**12}
    frame = spark.createDataFrame(list(counted.items()), "word string, n long")
    want = plain_variants(counted)
    assert want["abcdefg"][1] == "abcdefh" and want["abcdefg"][2] == "abczyxhq"
    assert got(spelling_kd.variants(frame)) == want


def test_words_on_awkward_rows(spark, awkward, none):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    docs += [(90 + k, "Zürichs ÀÉÎÕÜ÷× " * 3 + "x" * 5000 + " " + "Straßen-Bahnhof naïveté") for k in range(3)]
    extra = spark.createDataFrame(docs[-3:], "doc_id long, text string")
    frame = awkward.unionByName(extra, allowMissingColumns=True).withColumnRenamed("id", "word").withColumnRenamed("uid", "n")
    counted = plain_words(docs, 3, 2)
    result = spelling_kd.words(frame, least_length=3)
    assert {r["word"]: r["n"] for r in result.collect()} == counted
    assert got(spelling_kd.variants(result, leaf=30)) == plain_variants(counted)
    assert spelling_kd.variants(spelling_kd.words(none)).count() == 0
