"""Chat formatting against plain code and the tokenizer's library."""

import base64
import hashlib
import random
import re
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stayflow.llm import chat_format, queries

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MARK = {50256: "<s>", 50257: "</s>", 50258: "[INST]", 50259: "[/INST]"}
SPECIAL = (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")
TEMPLATE = chat_format.Template()
ESCAPE, UNESCAPE = TEMPLATE.escaper(), TEMPLATE.unescaper()


def in_order(rows):
    of = defaultdict(list)
    for c, turn, role, text in rows:
        of[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in of.items()}


def plain_escape(text):
    """Without regular expressions: a backslash behind the first character of whatever reads as a mark."""
    out, k = "", 0
    while k < len(text):
        after = text[k + 1 :].lstrip("\\")
        out += text[k]
        if any(text[k] == m[0] and after.startswith(m[1:]) for m in MARK.values()):
            out += "\\"
        k += 1
    return out


def plain_digests(rows):
    out = {}
    for c, turns in in_order(rows).items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        size = 3 + sum(len(plain_escape(r)) + len(plain_escape(t)) + 17 for r, t in turns)
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (whole, loss)]
        out[c] = (c, len(turns), sha[0], len(loss), sha[1], size)
    return out


def got(df):
    assert df.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def odd_rows():
    rng = random.Random(2)
    pieces = ["<", "s>", "/s>", "\\", "[", "INST]", "/INST]", "<s>", "</s>", "[INST]", "[/INST]", " ", "\n", "é🙂", "▁", "\x00", "a b"]
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
    rows = [
        (c, rng.choice([None, k]), rng.choice(["user", "assistant", "assistant", None, text()]), rng.choice([text(), None]))
        for c in range(60)
        for k in range(rng.randint(1, 6))
    ]
    rows += [(70, 0, "assistant", "x" * 300_000 + "</s>"), (71, 5, "assistant", "same"), (71, 5, "assistant", "same"), (None, 1, "user", "no id")]
    return rows


def test_query_against_plain_code(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_chat_format(spark, FOLDER)) == plain_digests([*rows, *SPECIAL])


def test_query_on_odd_rows(spark, tmp_path):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn int, role string, text string, at int, ids string, _n int")
    frame.repartition(4).write.parquet(f"{tmp_path}/a/conversations.parquet")
    want = plain_digests([*rows, *SPECIAL])
    assert got(queries.op12_chat_format(spark, f"{tmp_path}/a")) == want
    spark.conf.set("stayflow.rowsPerTask", "2")  # every conversation is a hot one
    try:
        assert got(queries.op12_chat_format(spark, f"{tmp_path}/a")) == want
    finally:
        spark.conf.unset("stayflow.rowsPerTask")
    frame.filter("false").write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert got(queries.op12_chat_format(spark, f"{tmp_path}/b")) == plain_digests(SPECIAL)


def test_tokens_masks_and_text(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    formatted = chat_format.format_turns(frame, queries.CHAT)
    formatted = formatted.withColumns({"mask": chat_format.loss_mask(), "formatted": chat_format.formatted_text("ids", queries.CHAT)})
    of = defaultdict(list)
    for r in formatted.orderBy("conv_id", "at").collect():
        of[r["conv_id"]].append(r)
    turns = in_order(rows)
    assert set(of) == set(turns)
    for c, got_rows in of.items():
        ids, mask = ([x for r in got_rows for x in r[n]] for n in ("ids", "mask"))
        want_ids, want_mask = [50256], [0]
        for (role, text), r in zip(turns[c], got_rows, strict=True):
            assert r["token_from"] == (0 if r["at"] == 1 else len(want_ids))
            who, what = (LIBRARY.encode_ordinary(plain_escape(s)) for s in (role, text))
            want_ids += [50258, *who, 50259, *what, 50257]
            want_mask += [0] * (len(who) + 2) + [int(role == "assistant")] * (len(what) + 1)
            if role == "assistant":
                assert want_mask[r["loss_from"] : r["loss_to"]] == [1] * (len(what) + 1)
            else:
                assert r["loss_from"] == r["loss_to"]
        assert ids == want_ids and mask == want_mask
        whole = "".join(r["formatted"] for r in got_rows)
        assert whole.encode() == b"".join(MARK[i].encode() if i in MARK else LIBRARY.decode_bytes([i]) for i in ids)
        # the formatted text alone says the same: marks are found as strings
        parts = re.fullmatch(r"<s>(.*)", whole, re.S)[1].split("</s>")
        assert parts.pop() == ""
        read = [tuple(map(UNESCAPE, re.fullmatch(r"\[INST\](.*)", p, re.S)[1].split("[/INST]"))) for p in parts]
        assert read == turns[c]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["<", "s>", "/", "\\", "\\\\", "[", "INST]", "]", "x"]), max_size=12).map("".join))
def test_escaping_is_reversible(text):
    escaped = ESCAPE(text)
    assert escaped == plain_escape(text) and UNESCAPE(escaped) == text
    assert not any(m in escaped for m in MARK.values())


def test_marks_must_be_apart():
    with pytest.raises(ValueError):
        chat_format.Template(begin="<<s>>")
    with pytest.raises(ValueError):
        chat_format.Template(begin="<s>", end="<s>")
