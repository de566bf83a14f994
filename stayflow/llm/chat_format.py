"""Chat formatting at token level.

A conversation becomes: begin mark, and for each turn: open mark, role, close mark, text, end mark.  Roles and
texts are encoded each by itself and the marks are ids beyond the vocabulary, so no text can produce a mark's
id.  In the formatted text the marks are strings, and a string in a role or text that looks like one is
escaped: a backslash goes behind its first character, also where backslashes stand there already, so
taking one away gives the text back.

There is one row per turn.  Its place in the conversation's tokens, and the tokens that count for the loss, come
from sums over the sizes of the segments before it: inside the turn, and running over the conversation's turns.
So a conversation of any length is spread over rows, and hot ones over tasks.

Edge cases: null roles and texts become empty.  Turns are ordered by turn (null first), role, text; equal
rows each count.  Rows without an id form one conversation with a null id.  Empty tables give no rows.  The
vocabulary is byte-level: every text comes back exactly.  Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.ordered import arrange


@dataclass(frozen=True)
class Template:
    """The marks, and the roles whose texts (with the end mark) count for the loss."""

    begin: str = "<s>"
    end: str = "</s>"
    open: str = "[INST]"
    close: str = "[/INST]"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        first = {m[:1] for m in self.marks}
        if any(len(m) < 2 or "\\" in m or first & set(m[1:]) for m in self.marks) or len(set(self.marks)) < 4:
            raise ValueError("marks must differ, have two characters or more, no backslash, and start as none goes on")

    @property
    def marks(self) -> tuple[str, str, str, str]:
        return self.begin, self.end, self.open, self.close

    def _found(self, slashes: str) -> re.Pattern:
        options = "|".join(f"{re.escape(m[0])}(?={slashes}{re.escape(m[1:])})" for m in self.marks)
        return re.compile(f"(?:{options})")

    def escaper(self):
        found = self._found(r"\\*")
        return lambda text: found.sub(lambda m: m.group() + "\\", text)

    def unescaper(self):
        found = re.compile(f"({self._found(chr(92) * 2 + '+').pattern})\\\\")
        return lambda text: found.sub(r"\1", text)


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary: a file of ranks, and the pattern that cuts texts before merging."""

    path: str
    pattern: str


class Coder:
    """Encodes and reads segments; marks have the ids after the last rank, in the order of the template."""

    def __init__(self, vocabulary: Vocabulary, template: Template):
        with open(vocabulary.path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.begin, self.end, self.open, self.close = range(size, size + 4)
        self.template = template
        self.string = dict(zip(range(size, size + 4), template.marks))
        self.escape, self.unescape = template.escaper(), template.unescaper()

    def turn(self, role: str, text: str) -> tuple[list[int], list[int]]:
        """Ids of a turn, and the sizes of its segments: mark, role, mark, text, mark."""
        who, what = (self.encoding.encode_ordinary(self.escape(s)) for s in (role, text))
        return [self.open, *who, self.close, *what, self.end], [1, len(who), 1, len(what), 1]

    def text(self, ids: np.ndarray) -> str:
        """Formatted text of ids."""
        out, rest = [], 0
        for at in np.flatnonzero(ids >= self.begin):
            out += [self.encoding.decode_bytes(ids[rest:at].tolist()).decode(), self.string[int(ids[at])]]
            rest = at + 1
        return "".join([*out, self.encoding.decode_bytes(ids[rest:].tolist()).decode()])

    def plain(self, ids: np.ndarray) -> str:
        """The text that was formatted: of ids of one segment, marks left out."""
        return self.unescape(self.encoding.decode_bytes(ids[ids < self.begin].tolist()).decode())

    def read(self, ids: np.ndarray) -> tuple[str, str]:
        """Role and text of the ids of one turn."""
        start, middle, stop = (int(np.flatnonzero(ids == mark)[0]) for mark in (self.open, self.close, self.end))
        return self.plain(ids[start + 1 : middle]), self.plain(ids[middle + 1 : stop])


@lru_cache(maxsize=4)
def coder(vocabulary: Vocabulary, template: Template) -> Coder:
    """One per Python worker."""
    return Coder(vocabulary, template)


def _encode(vocabulary: Vocabulary, template: Template):
    @F.arrow_udf("ids array<int>, sizes array<int>")
    def encode(roles: pa.Array, texts: pa.Array) -> pa.Array:
        with_ids = coder(vocabulary, template)
        turns = [with_ids.turn(*t) for t in zip(roles.to_pylist(), texts.to_pylist())]
        lists = [pa.array([np.array(t[k], np.int32) for t in turns], pa.list_(pa.int32())) for k in (0, 1)]
        return pa.StructArray.from_arrays(lists, ["ids", "sizes"])

    return encode


def format_turns(
    conversations: DataFrame, vocabulary: Vocabulary, template: Template = Template(), limit: int | None = None
) -> DataFrame:
    """One row per turn: ``conv_id, at, ids, token_from, loss_from, loss_to``.

    ``at`` numbers the turns of a conversation from 1.  The turn's ids stand at ``token_from`` (from 0) in the
    conversation; tokens from ``loss_from`` up to before ``loss_to`` count for the loss (an empty span elsewhere).
    """
    empty = F.lit("")
    turns = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), empty).alias(c) for c in ("role", "text")]
    )
    # encoded before the shuffle, which then serves the numbering and both sums
    coded = turns.withColumn("_coded", _encode(vocabulary, template)("role", "text"))
    rows = arrange(coded, ["conv_id"], ["turn", "role", "text"], limit).running(at=("sum", F.lit(1)))
    begins = F.col("at") == 1
    marks = F.when(begins, F.array(F.lit(coder(vocabulary, template).begin))).otherwise(F.array().cast("array<int>"))
    rows = rows.with_columns({"_n": (F.size("_coded.ids") + F.size(marks)).cast("long")})
    rows = rows.running(_upto=("sum", "_n"))
    before = F.col("_upto") - F.col("_n")
    ahead = F.aggregate(F.slice("_coded.sizes", 1, 3), F.size(marks), lambda a, b: a + b)  # all that stands before the text
    learned = F.col("role").isin(*template.learned)
    start = before + ahead
    return rows.df.select(
        "conv_id",
        F.col("at").cast("long").alias("at"),
        F.concat(marks, "_coded.ids").alias("ids"),
        before.alias("token_from"),
        start.alias("loss_from"),
        F.when(learned, F.col("_upto")).otherwise(start).alias("loss_to"),
    )


def loss_mask() -> Column:
    """For rows of :func:`format_turns`: 1 for each id that counts for the loss, else 0 (array<int>)."""
    size, start = F.size("ids").cast("long"), F.col("loss_from") - F.col("token_from")
    inside = F.col("loss_to") - F.col("loss_from")
    parts = [F.array_repeat(F.lit(k), n.cast("int")) for k, n in ((0, start), (1, inside), (0, size - start - inside))]
    return F.concat(*parts)


def formatted_text(ids: Column | str, vocabulary: Vocabulary, template: Template = Template()) -> Column:
    """The formatted text of ids; the texts of a conversation's turns, end to end, are the conversation's."""

    @F.arrow_udf("string")
    def text(values: pa.Array) -> pa.Array:
        reader = coder(vocabulary, template)
        return pa.array([None if v is None else reader.text(np.array(v, np.int64)) for v in values.to_pylist()], pa.string())

    return text(ids)


def read_turns(formatted: DataFrame, vocabulary: Vocabulary, template: Template = Template()) -> DataFrame:
    """What the ids say: ``conv_id, at, role, text, loss_text, n_chars``.

    ``loss_text`` is the text under the loss mask without marks, ``n_chars`` the code points of the formatted turn.
    """

    @F.arrow_udf("role string, text string, loss_text string, n_chars long")
    def read(ids: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
        reader, out = coder(vocabulary, template), []
        for row, a, b in zip(ids, starts.to_pylist(), stops.to_pylist()):
            got = row.values.to_numpy(zero_copy_only=False)
            out.append((*reader.read(got), reader.plain(got[a:b]), len(reader.text(got))))
        types = [pa.string()] * 3 + [pa.int64()]
        names = ["role", "text", "loss_text", "n_chars"]
        return pa.StructArray.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names)

    spans = [F.col(c) - F.col("token_from") for c in ("loss_from", "loss_to")]
    return formatted.withColumn("_read", read("ids", *spans)).select("conv_id", "at", "_read.*")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its turns in order; only running hashes and sums are held."""
    now, rows = None, []

    def done() -> pa.RecordBatch:
        got = [(c, n, turns.hexdigest(), chars, loss.hexdigest(), total) for c, n, turns, chars, loss, total in rows]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], t) for k, t in enumerate(types)], names)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "role", "text", "loss_text", "n_chars")]
        for conv, role, text, loss, chars in zip(*columns):
            if now is None or now[0] != conv:
                if now is not None:
                    rows.append(now)
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            now[3] += len(loss)
            now[4].update(loss.encode())
            now[5] += chars
        if len(rows) >= 10_000:
            yield done()
    if now is not None:
        rows.append(now)
    if rows:
        yield done()


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: its turns, the hash of roles and texts, and size and hash of the learned text.

    A hash takes a conversation's turns one after the other, so they pass through one task in order; the work on
    tokens is done before and spread.
    """
    ordered = read.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "at")
    return ordered.mapInArrow(
        _digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
