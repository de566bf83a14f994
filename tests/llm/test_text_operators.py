"""Operators on single texts, against the libraries and plain code."""

import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayflow.llm import html_text, licenses, quality_crf, sentencepiece_codec, simhash_index, token_prefix
from stayflow.llm.pieces import MARK, Model, Trie, WordTable, load

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
ALPHABET = "abcdeth inrs  \n▁.,<>/é日本\x00🙂0129'\"=()ABC\t"


def test_few_endings_are_tried_per_letter():
    class Asked(dict):
        times = 0

        def get(self, *of):
            self.times += 1
            return dict.get(self, *of)

    model = Model(PATH)
    model.endings = asked = Asked(model.endings)
    words = sorted(set(model.words("the theory of international relations and other considerations, however unlikely, remains unanswered")))
    trie, letters = Trie(model), 0
    for word in words:
        shared = next((k for k, (x, y) in enumerate(zip(word, trie.word)) if x != y), min(len(word), len(trie.word)))
        letters += len(word) - shared
        trie.enter(word)
        assert trie.tokens() == LIB.encode(word.replace(MARK, " ").removeprefix(" "))
    assert asked.times < 3.3 * letters


@given(st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_counts_and_texts_are_the_librarys(texts):
    got = sentencepiece_codec.encode_texts(texts, PATH)
    assert [g.tolist() for g in got] == LIB.encode(texts)
    assert [sentencepiece_codec.decode_ids(g.tolist(), PATH) for g in got] == [LIB.decode(g.tolist()) for g in got]
    for text, counts in zip(texts, token_prefix.prefix_counts_of(texts, PATH)):
        assert counts.tolist() == [len(LIB.encode(text[:k])) for k in range(1, len(text) + 1)]


def test_any_ids_decode_as_in_the_library():
    draw = random.Random(1)
    for _ in range(500):
        ids = [draw.randrange(32000) if draw.random() < 0.5 else draw.randrange(260) for _ in range(8)]
        assert sentencepiece_codec.decode_ids(ids, PATH) == LIB.decode(ids)


def test_parts_end_where_no_piece_crosses():
    model, draw = load(PATH), random.Random(2)
    texts = ["".join(draw.choices(ALPHABET + "xyzжд»“¿ß%&*", k=40)) for _ in range(300)]
    pairs = {p[k : k + 2] for p in model.ids for k in range(len(p) - 1)}
    for text in texts:
        parts = model.parts(text)
        assert "".join(parts) == MARK + text.replace(" ", MARK)
        assert not any(a[-1] + b[0] in pairs for a, b in zip(parts, parts[1:]) if b[0] != MARK)
    assert model.parts("a word, (word) word...%%% word***\n") == "▁a ▁word , ▁( word ) ▁word ...%%% ▁word *** \n".split(" ")
    assert model.parts("") == [] and [g.tolist() for g in sentencepiece_codec.encode_texts(texts, PATH)] == LIB.encode(texts)


def test_a_word_with_other_signs_behind_it_is_walked_once():
    entered = []
    table = WordTable(load(PATH), lambda trie: entered.append(trie.word) or trie.tokens())
    texts = [f"unlikely{a}{b}" for a in ".,;:!?%#" for b in ".,;:!?%#"]
    for parts, ids, sizes in table.read(texts, 200):
        assert parts.sum() == len(sizes) and sizes.sum() == len(ids)
    assert sorted(entered) == sorted({"▁unlikely"} | {a + b for a in ".,;:!?%#" for b in ".,;:!?%#"})


def test_batches_of_ids_decode_as_rows():
    import pyarrow as pa

    draw = random.Random(4)
    for top in (300, 32_000, 32_010):
        rows = [None if k % 7 == 3 else [draw.randrange(-1 if top > 32_000 else 3, top) for _ in range(draw.randrange(6))] for k in range(400)]
        for some in (rows, rows[:1], [[]], [None], []):
            got = sentencepiece_codec._decoded(pa.array(some, pa.list_(pa.int32())), PATH, "bpe", 90)
            assert got.to_pylist() == [None if r is None else sentencepiece_codec.decode_ids(r, PATH) for r in some]
    texts = [None, "", " two", "é🙂 日本", "\n x", None, "last "]
    both = [None if t is None else LIB.encode(t) for t in texts]
    for part in (slice(None), slice(2, 5)):  # a slice of a larger array, too
        assert sentencepiece_codec._decoded(pa.array(both, pa.list_(pa.int32()))[part], PATH, "bpe").to_pylist() == texts[part]


def test_texts_are_encoded_once(awkward):
    """The plan of the query and of the pipeline's last stage has one call, not encode beside decode of encode."""
    from stayflow.llm import queries

    import corpus_pipeline

    both = awkward.select("text", sentencepiece_codec.encode_and_decode("text", PATH).alias("both")).collect()
    for r in both:
        want = (None, None) if r["text"] is None else (LIB.encode(r["text"]), LIB.decode(LIB.encode(r["text"])))
        assert (r["both"]["ids"], r["both"]["decoded"]) == want
    for frame in (queries.op1_sentencepiece(awkward.sparkSession, "/root/testdata/sf0.001"), corpus_pipeline.encode(awkward.sparkSession, awkward, "")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        (calls,) = [line for line in plan.splitlines() if "ArrowEvalPython [" in line]
        assert calls.count("(text#") == 1


def test_unigram_path_has_the_best_score(tmp_path):
    """A model with scores, against trying every way to cut a word."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    from stayflow.llm.pieces import Trie

    m = proto.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -3, 1), ("▁a", -3.5, 1), ("ba", -3.2, 1), ("aba", -6, 1)]:
        m.pieces.add(piece=piece, score=score, type=kind)
    m.trainer_spec.model_type = 1
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.remove_extra_whitespaces = False
    (tmp_path / "u.model").write_bytes(m.SerializeToString())
    path = str(tmp_path / "u.model")
    model, lib = Model(path, "unigram"), sentencepiece.SentencePieceProcessor(model_file=path)
    score = {p: -r for p, r in model.rank.items()}

    def best(word):
        return 0.0 if not word else max((best(word[k:]) + score[word[:k]] for k in range(1, len(word) + 1) if word[:k] in score), default=-1e9)

    words = sorted("▁" + "".join(random.Random(k).choices("ab", k=k % 9 + 1)) for k in range(60))
    trie = Trie(model)
    for word in words:
        trie.enter(word)
        assert trie.score[-1] == pytest.approx(best(word))
        assert sum(lib.get_score(i) for i in trie.tokens()) == pytest.approx(best(word))


def test_coding_columns(awkward, none):
    coded = awkward.select("text", sentencepiece_codec.encode("text", PATH).alias("ids"))
    rows = coded.withColumn("again", sentencepiece_codec.decode("ids", PATH)).collect()
    for r in rows:
        assert r["ids"] == (None if r["text"] is None else LIB.encode(r["text"]))
        assert r["again"] == (None if r["text"] is None else LIB.decode(r["ids"]))
    assert none.select(sentencepiece_codec.encode("text", PATH)).count() == 0


def test_budgets_from_prefix_counts(awkward):
    counts = F.col("counts")
    rows = awkward.select("text", token_prefix.prefix_counts("text", PATH).alias("counts")).select(
        "text", "counts", token_prefix.longest_within(counts, 7).alias("fit"),
        token_prefix.tokens_of_prefix(counts, 5).alias("five"), token_prefix.token_budget("text", PATH, 7).alias("answer"),
    )
    for r in rows.collect():
        text = r["text"] or ""
        want = [len(LIB.encode(text[:k])) for k in range(1, min(len(text), 60) + 1)]
        assert r["counts"][:60] == want and len(r["counts"]) == len(text)
        assert r["answer"]["n_tokens"] == (len(LIB.encode(text)) if text else 0)
        assert r["five"] == len(LIB.encode(text[:5]))
        fit = max((k for k, c in enumerate(r["counts"], 1) if c <= 7), default=0)
        assert r["fit"] == fit == r["answer"]["cut"]


def test_licenses_are_found_where_they_stand(spark, awkward, none):
    draw, rows = random.Random(3), []
    for k in range(120):
        name, text = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        words = text.split()
        if len(words) > 60:
            words[draw.randrange(len(words))] = "changed"
        before = [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(300))]
        rows.append((k, name, " ".join(before + words + before[::-1]), len(licenses.words_of(" ".join(before)))))
    found = spark.createDataFrame(rows, "k int, name string, text string, at int").withColumn("m", licenses.scan("text")).collect()
    for r in found:
        hits = [m for m in r["m"] if m["license"] == r["name"]]
        assert hits and all(abs(m["from_word"] - r["at"]) <= 12 and m["containment"] >= 0.8 for m in hits)
    assert all(r[0] == [] for r in awkward.select(licenses.scan("text")).collect())
    assert none.select(licenses.scan("text")).count() == 0
    with pytest.raises(ValueError):
        licenses.scanner((("short", "too few words"),))


def test_license_containment_against_every_window():
    """All places where 0.8 of a template's shingles stand within its length are reported."""
    draw = random.Random(5)
    name, text = licenses.TEMPLATES[6]
    words = licenses.words_of(text)
    own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    for trial in range(60):
        some = list(words)
        for _ in range(trial % 4):
            some[draw.randrange(len(some))] = "other"
        body = [f"x{draw.randrange(999)}" for _ in range(50)] + some + [f"y{draw.randrange(999)}" for _ in range(50)]
        held = max(len(own & {tuple(body[k : k + 5]) for k in range(s, s + len(words) - 4)}) for s in range(len(body) - len(words) + 1))
        got = any(m["license"] == name for m in licenses.scanner(licenses.TEMPLATES).scan([" ".join(body)])[0])
        assert got == (held / len(own) >= 0.8)


PAGES = [
    (None, ""),
    ("", ""),
    ("plain text", "plain text"),
    ("<p>a<script>if(a<b){\"</p>\"}</script>b", "a b"),
    ("a < b and <b>c", "a < b and c"),
    ('<div class="wrap"><div id="nav"><a href=x>Home</a></div><div class=content><h1>T</h1><p>One, two, three and a lot of '
     'words.<p>Second para<ul><li>item</ul></div><div class="sidebar"><p>side, bar, text</p></div><div id="comments"><p>first!</p></div></div>',
     "T One, two, three and a lot of words. Second para item"),
    ('<body class="has-sidebar"><header>Site</header><main><article><header><h1>Title</h1></header><section><p>A, b.</p></section>'
     '<section><p>C &lt; d&nbsp;e</p><div class="ad-box">buy</div></section></article><section class="comments"><article><p>hi, there</p>'
     "</article></section></main></body>", "Title A, b. C < d e"),
    ('<div class="cookie-notice">We use cookies.</div><p>Hello <i>wor</i>ld, all</p><p>Bye, and good night</p>', "Hello world, all Bye, and good night"),
]


def test_main_text(spark):
    rows = spark.createDataFrame(PAGES, "html string, want string").withColumn("got", html_text.extract("html")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]
    deep = "<div>" * 5000 + "<p>deep, text</p>" + "</div>" * 5000
    assert html_text.main_text(deep) == "deep, text"


def test_names_are_not_believed_of_words_and_paragraphs():
    page = '<body><article><h1 class="alert">Head, line</h1><p>see <span class="search">this</span> word</p><p class="notice">kept</p><div class="ad">no</div></article></body>'
    assert html_text.main_text(page) == "Head, line see this word kept"


LONG_PAGES = {
    "inline": "<font>" * 50_000 + "x, y",
    "named blocks": "<div class=widget>a" * 50_000,
    "open quotes": '<a "' * 50_000,
    "quoted ends": '<a "x>" ' * 50_000,
    "declarations": "<!" * 50_000,
    "stray ends": "<b><div>" + "<font>" * 20_000 + "</b>" * 20_000,
    "rules": "<font>" * 20_000 + "<hr>" * 20_000,
    "mixed": "<div><font>" * 20_000 + "t",
    "stray blocks": "<i>" * 20_000 + "</section>" * 20_000,
}


@pytest.mark.parametrize("name", LONG_PAGES)
def test_work_grows_with_the_page(name):
    began = time.process_time()
    html_text.main_text(LONG_PAGES[name])
    assert time.process_time() - began < 2


def test_text_without_spaces_is_not_hoarded():
    """Words of any length are walked, but long ones are not remembered, and short ones up to a size."""
    draw = random.Random(4)
    table = WordTable(load(PATH), Trie.tokens, most=200)
    for _ in range(30):
        texts = ["".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(draw.choice([3, 10, 200]))) for _ in range(60)]
        words = [table.model.words(t) for t in texts]
        ids, sizes = table.lookup([w for ws in words for w in ws])
        ends = sizes.cumsum()
        got = [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
        assert [sum((got.pop(0) for _ in ws), []) for ws in words] == LIB.encode(texts)
        assert len(table.row) <= 260 and len(table.flat) + table.letters <= 16 * 200 + 2000 and max(map(len, table.row)) <= 64


def test_main_text_of_the_pages(spark):
    """All pages have an article; its text is what remains without tags."""
    import html
    import re

    for (page,) in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect():
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        body = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", body))
        assert html_text.main_text(page) == " ".join(html.unescape(body).split())


def test_fingerprint_bits():
    import xxhash

    def plain(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in ("", "  ", "A", "a B", "a b c", "É é É a b", "x y z w " * 50, "a\x0bb\x0cc\x1cd e"):
        assert simhash_index.fingerprint_of(text) % 2**64 == plain(text)
    assert simhash_index.fingerprint_of(None) == 0


def test_crf_marginals_by_enumeration():
    import itertools

    import numpy as np

    draw = np.random.RandomState(0)
    emit, start, step = draw.randn(9), draw.randn(2), draw.randn(2, 2)
    per_text = np.array([4, 1, 0, 3, 1])[[0, 1, 3, 4]]
    good, expected = quality_crf.marginals(emit, start, step, per_text)
    want, steps, at = np.zeros(9), np.zeros((2, 2)), 0
    for n in per_text:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        w = [np.exp(start[p[0]] + sum(emit[at + k] * p[k] for k in range(n)) + sum(step[p[k], p[k + 1]] for k in range(n - 1))) for p in paths]
        for p, x in zip(paths, np.array(w) / sum(w)):
            want[at : at + n] += x * np.array(p)
            for k in range(n - 1):
                steps[p[k], p[k + 1]] += x
        at += n
    assert np.allclose(good, want) and np.allclose(expected, steps)


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    field = quality_crf.train(docs, labels.filter(quality_crf.remainder("doc_id", 3) != 1))
    held = docs.join(labels, "doc_id").filter(quality_crf.remainder("doc_id", 3) == 1)
    rows = held.select("quality", quality_crf.quality("text", field).alias("s")).collect()
    assert sum((r["s"] >= 0.5) == (r["quality"] == 1) for r in rows) / len(rows) > 0.95


def test_quality_of_awkward_rows(spark, awkward, none):
    labels = spark.createDataFrame([(1, 1), (9, 0), (99, 1), (2, None)], "doc_id long, quality int")
    field = quality_crf.train(awkward, labels)
    scores = [r[0] for r in awkward.select(quality_crf.quality("text", field)).collect()]
    assert len(scores) == awkward.count() and all(0 <= s <= 1 for s in scores)
    assert quality_crf.train(none, labels).constant == 0.5
    assert quality_crf.train(awkward, labels.filter("quality = 1")).constant == 1.0
    assert none.select(quality_crf.quality("text", field)).count() == 0
