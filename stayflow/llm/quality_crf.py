"""Document quality from a linear-chain conditional random field over lines.

Each line has simple surface features; its own and those of the lines before and after it speak for
"good" or "bad", and the chain links the labels of neighbouring lines.  The quality of a document is
the mean of its lines' forward-backward probabilities of "good", weighted by line length.

The field is fitted on a bounded sample of labelled documents (``sample`` of each label, chosen by a
hash of the id; documents over ``sample_lines`` lines are not drawn), every line carrying its
document's label.  Scoring reads every line of every text.

Edge cases: null texts count as empty; an empty text is one empty line and gets that line's
probability.  A label that is null, or a labelled document that is missing, is not drawn.  With no
labels, or labels of one kind only, every score is the share of label 1 in the sample (0.5 if none).
Repeated rows are scored alike; only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.pieces import runs

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _BAR = range(1, 8)


def _classes() -> np.ndarray:
    kind = np.full(256, _MARK, np.uint8)
    kind[128:] = _LOWER  # bytes of other letters
    kind[ord("a") : ord("z") + 1] = _LOWER
    kind[ord("A") : ord("Z") + 1] = _UPPER
    kind[ord("0") : ord("9") + 1] = _DIGIT
    kind[:33] = _SPACE
    for c in ".,;:'\"-()":
        kind[ord(c)] = _STOP
    kind[ord("|")] = _BAR
    return kind


_KIND = _classes()
_END = re.compile(r"[.!?:\"')]\s*$")
N_FEATURES = 15


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the length of each line, and the number of lines of each text."""
    per_text, lines, extra = [], [], []
    for text in texts:
        own = text.split("\n")
        seen: dict[str, int] = {}
        for k, line in enumerate(own):
            words = line.split()
            n = len(words) or 1
            distinct = len(set(words)) / n
            again = 1.0 if words and line in seen else 0.0
            seen[line] = k
            extra.append((distinct if words else 1.0, again, n, len(words) == 0, _END.search(line) is not None))
        per_text.append(len(own))
        lines.extend(own)
    raw = [line.encode() for line in lines]
    size = np.array([len(r) for r in raw], np.int64)
    flat = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    kind = _KIND[flat]

    def count(mask):
        return np.add.reduceat(mask, begin, dtype=np.int32).astype(np.float64)

    after_space = np.concatenate([[True], kind[:-1] == _SPACE])
    upper, lower = count(kind == _UPPER), count(kind == _LOWER)
    digit, stop, mark, bar = (count(kind == k) for k in (_DIGIT, _STOP, _MARK, _BAR))
    first_upper = count((kind == _UPPER) & after_space)
    more = np.array(extra, np.float64).reshape(-1, 5)
    words = more[:, 2]
    filled = np.maximum(upper + lower + digit + stop + mark + bar, 1)
    x = np.column_stack(
        [
            np.log1p(size),
            upper / filled,
            lower / filled,
            digit / filled,
            stop / filled,
            mark / filled,
            bar / filled,
            np.minimum(mark / words, 4),
            first_upper / words,
            np.minimum(filled / words, 30) / 10,
            more[:, 0],
            more[:, 1],
            more[:, 3],
            more[:, 4],
            np.minimum(bar / words, 2),
        ]
    )
    return x, size + 1.0, np.array(per_text, np.int64)


@dataclass
class Field:
    """Weights of the field; ``near`` has a column for the line itself, the one before, the one after."""

    mean: np.ndarray
    scale: np.ndarray
    near: np.ndarray
    start: np.ndarray
    step: np.ndarray
    constant: float | None = None


def _shifted(x: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the line before and the line after in the same text; zero where there is none."""
    ends = np.cumsum(per_text)
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    before[ends - per_text] = 0
    after[ends - 1] = 0
    return before, after


def _lanes(per_text: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """For each line number, the texts (longest first) that have it."""
    order = np.argsort(-per_text, kind="stable")
    sizes = per_text[order]
    first = np.cumsum(per_text) - per_text
    return [
        (first[order[: int(np.searchsorted(-sizes, -t, side="left"))]] + t)
        for t in range(int(sizes[0]) if len(sizes) else 0)
    ]


def marginals(emit: np.ndarray, start: np.ndarray, step: np.ndarray, per_text: np.ndarray):
    """Probability of label 1 of each line, expected steps, and the log normalizer's total.

    ``emit`` is the score of label 1 against label 0.  All texts advance one line at a time.
    """
    n = len(emit)
    score = np.column_stack([np.zeros(n), emit])
    ahead, back = np.empty((n, 2)), np.zeros((n, 2))
    lanes = _lanes(per_text)
    if lanes:
        ahead[lanes[0]] = start + score[lanes[0]]
    for rows in lanes[1:]:
        prior = ahead[rows - 1]
        ahead[rows] = np.logaddexp(prior[:, :1] + step[0], prior[:, 1:] + step[1]) + score[rows]
    for rows in lanes[:0:-1]:
        later = back[rows] + score[rows]
        back[rows - 1] = np.logaddexp(step[:, 0] + later[:, :1], step[:, 1] + later[:, 1:])
    both = ahead + back
    total = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    expected = np.zeros((2, 2))
    if len(lanes) > 1:
        rows = np.concatenate(lanes[1:])
        later = back[rows] + score[rows]
        for a in range(2):
            for b in range(2):
                expected[a, b] = np.exp(ahead[rows - 1, a] + step[a, b] + later[:, b] - total[rows]).sum()
    return good, expected


def fit_field(x: np.ndarray, per_text: np.ndarray, label: np.ndarray, rounds: int = 150) -> Field:
    """Fit by gradient ascent (Adam) on the likelihood of the line labels, each text weighing alike."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / scale
    z = np.column_stack([z, np.ones(len(z))])
    before, after = _shifted(z, per_text)
    y = np.repeat(label, per_text).astype(np.float64)
    first = np.cumsum(per_text) - per_text
    inner = np.ones(len(y), bool)
    inner[first] = False
    rows = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[rows - 1].astype(int), y[rows].astype(int)), 1.0)
    wide = z.shape[1]
    theta, m, v = np.zeros(3 * wide + 6), np.zeros(3 * wide + 6), np.zeros(3 * wide + 6)
    stack = np.hstack([z, before, after])
    n = len(y)
    for t in range(1, rounds + 1):
        near, start, step = theta[:-6], theta[-6:-4], theta[-4:].reshape(2, 2)
        good, expected = marginals(stack @ near, start, step, per_text)
        slope = np.concatenate(
            [
                stack.T @ (y - good),
                [(good[first] - y[first]).sum(), (y[first] - good[first]).sum()],
                (seen - expected).ravel(),
            ]
        ) / n - 1e-4 * theta
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return Field(
        mean, scale, theta[:-6].reshape(3, wide).T.copy(), theta[-6:-4].copy(), theta[-4:].reshape(2, 2).copy()
    )


def score_texts(field: Field, texts: list[str]) -> np.ndarray:
    """Quality of each text, 0 to 1."""
    if field.constant is not None:
        return np.full(len(texts), field.constant)
    out = []
    for run in runs(texts):
        x, weight, per_text = line_features(run)
        z = np.column_stack([(x - field.mean) / field.scale, np.ones(len(x))])
        own = z @ field.near
        before, after = _shifted(z, per_text)
        emit = own[:, 0] + before @ field.near[:, 1] + after @ field.near[:, 2]
        good, _ = marginals(emit, field.start, field.step, per_text)
        begin = np.cumsum(per_text) - per_text
        out.append(np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin))
    return np.clip(np.concatenate(out), 0.0, 1.0) if out else np.empty(0)


def remainder(id_column: Column | str, by: int) -> Column:
    """crc32 of the id's text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string") if isinstance(id_column, str) else id_column) % by


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample: int = 1000,
    sample_lines: int = 2000,
) -> Field:
    """Fit on at most ``sample`` labelled documents of each label; of rows with one id the smallest text counts."""
    marked = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    marked = marked.filter("id is not null and label in (0, 1)")
    order = [F.xxhash64("id", F.lit(5)), "id"]
    drawn = marked.filter("label = 0").orderBy(*order).limit(sample).union(
        marked.filter("label = 1").orderBy(*order).limit(sample)
    )
    # at most twice the sample: small enough to send to every task
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    chosen = texts.filter(lines <= sample_lines).join(F.broadcast(drawn.distinct()), "id")
    chosen = chosen.groupBy("id", "label").agg(F.min("text").alias("text"))  # ids may be repeated

    def features(batches):
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                x, _, _ = line_features([text])
                yield pa.RecordBatch.from_pydict(
                    {
                        "x": pa.array([x.astype(np.float32).tobytes()], pa.binary()),
                        "label": pa.array([label], pa.int32()),
                        "order": pa.array([zlib.crc32(text.encode())], pa.int64()),
                    }
                )

    rows = chosen.select("text", "label").mapInArrow(features, "x binary, label int, `order` long").collect()
    rows = sorted(rows, key=lambda r: (r["order"], r["label"]))  # however Spark delivers them
    label = np.array([r["label"] for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        share = float(label.mean()) if len(label) else 0.5
        none = np.zeros(0)
        return Field(none, none, none, none, none, share)
    each = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    return fit_field(np.concatenate(each).astype(np.float64), np.array([len(e) for e in each]), label)


def quality(text: Column | str, field: Field) -> Column:
    """Column of scores (double) of a text column."""

    @F.arrow_udf("double")
    def scores(values: pa.Array) -> pa.Array:
        return pa.array(score_texts(field, [t or "" for t in values.to_pylist()]), pa.float64())

    return scores(text)
