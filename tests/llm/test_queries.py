"""The rows of the registered queries against plain code on the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import xxhash

from stayflow.llm import licenses, mixing, queries

FOLDER = "/root/testdata/sf0.001"
LIB = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()
    return {r["doc_id"]: (r["text"] or "", r["source"]) for r in rows}


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_op1_and_op10(spark, docs):
    coded, counted = by_id(queries.op1_sentencepiece(spark, FOLDER)), by_id(queries.op10_token_counts(spark, FOLDER))
    assert set(coded) == set(counted) == set(docs)
    for k, (text, _) in docs.items():
        ids = LIB.encode(text)
        assert coded[k]["ids"] == ids and coded[k]["n_ids"] == len(ids) and coded[k]["decoded"] == LIB.decode(ids)
        assert tuple(counted[k])[:4] == (k, len(text.encode()), len(ids), len(ids) > 4096)
        assert len(LIB.encode(text[: counted[k]["kept_chars"]])) <= 4096


def test_op2(spark, docs):
    """A notice that a text holds whole is found there; what is found holds four fifths of the notice."""
    rows = queries.op2_licenses(spark, FOLDER).collect()
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append(r)
    words = {k: licenses.words_of(text) for k, (text, _) in docs.items()}
    assert rows and set(found) <= set(docs)

    def shingles(of):
        return {tuple(of[i : i + 5]) for i in range(len(of) - 4)}

    for k, body in words.items():
        for r in found[k]:
            here = shingles(body[r["from_word"] : r["to_word"]])
            wanted = [shingles(licenses.words_of(t)) for name, t in licenses.TEMPLATES if name == r["license"]]
            assert any(len(here & w) >= 0.8 * len(w) for w in wanted)
        for name, notice in licenses.TEMPLATES:
            if " ".join(licenses.words_of(notice)) in " ".join(body):
                assert name in {r["license"] for r in found[k]}


def test_every_notice_is_found_and_told_apart(spark):
    """A text of each notice alone: it is found, and no other, except notices that share their words."""
    for name, notice in licenses.TEMPLATES:
        got = licenses.scanner(licenses.TEMPLATES).scan([f"some words before {notice} and some behind it"])[0]
        assert name in {m["license"] for m in got}
        assert len({m["license"].split("-")[0] for m in got} - {"GPL", "AGPL", "LGPL", "CC"}) <= 1


def plain_taken(mix):
    """The schedule of each source, block by block, and the words of each document that its blocks take."""
    of = defaultdict(list)
    for r in mix.docs.collect():
        of[r["number"]].append((r["first"], r["size"], r["id"]))
    taken = Counter()
    for s in mix.sources:
        n, blocks = s["size"], s["blocks"]
        begin = lambda b: b * (n // blocks) + min(b, n % blocks)
        for rank in range(s["slots"]):
            b, left = rank % blocks, s["whole"] - rank // blocks * n
            lo, hi = begin(b), min(begin(b + 1), left)
            for first, size, doc in of[s["number"]]:
                taken[doc] += max(0, min(hi, first + size) - max(lo, first))
    return taken


def test_op3(spark, docs):
    got = by_id(queries.op3_mixing(spark, FOLDER))
    sizes = {k: len(WORD.findall(text)) for k, (text, _) in docs.items()}
    by_source = Counter()
    for k, (_, source) in docs.items():
        by_source[source] += sizes[k]
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    goal = dict(zip(order, mixing.targets([by_source[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 1.5, 2.0)))
    assert sum(goal.values()) == pytest.approx(min(1.5, 2.0) * sum(by_source.values()))
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "text")
    plain = plain_taken(mixing.Mix(frame))
    per_source = Counter()
    for k, r in got.items():
        source = docs[k][1]
        assert (r["size"], r["source_size"]) == (sizes[k], by_source[source]) and r["target"] == pytest.approx(goal[source])
        assert r["taken"] == plain[k] <= 2 * sizes[k]
        per_source[source] += r["taken"]
    assert all(abs(per_source[s] - goal[s]) <= 1 for s in order)


def test_op5(spark):
    import html

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = by_id(queries.op5_html_text(spark, FOLDER), "page_id")
    assert set(got) == set(pages)
    for k, r in got.items():
        body = re.search(r"<article>(.*?)</article>", pages[k]["html"] or "", re.S)
        want = re.sub(r'<div class="?ad"?>.*?</div>', " ", body[1], flags=re.S) if body else ""
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br|div|li|ul)[^>]*>", " ", want).replace("<b>", "").replace("</b>", "")).split())
        assert r["url"] == pages[k]["url"] and r["n_chars"] == len(r["text"]) and r["text"] == want


def test_op7(spark, docs):
    got = by_id(queries.op7_simhash(spark, FOLDER))
    prints = {}
    for k, (text, _) in docs.items():
        words = WORD.findall(lowered(text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        codes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = roots_of(prints, links)
    assert {k: (r["fingerprint"], r["component_id"]) for k, r in got.items()} == {k: (f"{p:016x}", root[k]) for k, p in prints.items()}


def test_op8(spark, docs):
    got = by_id(queries.op8_lm_score(spark, FOLDER))
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in docs}
    tokens = {k: [*WORD.findall(lowered(text)), None] for k, (text, _) in docs.items()}
    counts = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    for k, r in got.items():
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in tokens[k])
        known = sum(counts[t] > 0 for t in tokens[k])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(tokens[k]), known, total)
        assert r["base_score"] == pytest.approx(base) and -math.inf < r["score"] < 0


def test_op9(spark, docs):
    got = by_id(queries.op9_fingerprints(spark, FOLDER))
    order = sorted(docs)

    def shingles(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    def likeness(a, b):
        a, b = shingles(a), shingles(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    off = []
    for k, after in zip(order, order[1:] + order[:1]):
        text, other, r = docs[k][0], docs[after][0], got[k]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + other[:cut]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off += [abs(r["near_edited"] - likeness(text, edited)), abs(r["near_next"] - likeness(text, other))]
        assert 0 <= r["kept_in_edited"] <= 1 and r["n_shingles"] == pytest.approx(len(shingles(text)), rel=0.5)
    assert max(off) < 0.2 and sum(off) / len(off) < 0.03
    prints = defaultdict(set)
    for k, (text, _) in docs.items():
        prints[text].add(got[k]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
