"""SentencePiece encoding and decoding by a shared-prefix forward pass.

The distinct marked words of a run of texts are sorted, which lays them out as a trie, and are
walked depth-first; words with a common prefix share its forward states (see ``pieces``).  Texts
are never shuffled: each task encodes its own rows, so the work grows with the text alone.

Edge cases: null text gives null ids, the empty text gives no ids, null ids decode to null.  Ids
outside the model decode to nothing.  Texts of any length are encoded whole.  Repeated rows give
repeated results.  Only the named column is read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from stayflow.llm.pieces import Trie, WordTable, load, runs


@lru_cache(maxsize=4)
def _table(path: str, kind: str, most: int) -> WordTable:
    model = load(path, kind)
    model.most_pairs = max(400_000, most * 5 // 6)
    return WordTable(model, Trie.tokens, most)


def encode_texts(texts: list[str], path: str, kind: str = "bpe", most: int = 600_000) -> list[np.ndarray]:
    """Token ids of each text."""
    out: list[np.ndarray] = []
    for parts, ids, sizes in _table(path, kind, most).read(texts):
        ends = np.concatenate([[0], np.cumsum(sizes)])
        last = np.cumsum(parts)
        out.extend(ids[ends[a] : ends[b]] for a, b in zip(last - parts, last))
    return out


def decode_ids(ids, path: str, kind: str = "bpe") -> str:
    """The text of token ids; bytes that are no UTF-8 become U+FFFD, one each."""
    model = load(path, kind)
    if ids and (min(ids) < 0 or max(ids) >= model.size):
        ids = [i for i in ids if 0 <= i < model.size]
    parts = list(map(model.out.__getitem__, ids))
    joined = b"".join(parts)
    first = next((i for i in ids if model.out[i]), None)
    if first in model.piece_of and joined.startswith(b" "):  # the mark put in front of the text
        joined = joined[1:]
    try:
        return joined.decode()
    except UnicodeDecodeError:
        # a token without text ends a run of bytes
        return "".join(_replace(b"".join(g)) for full, g in groupby(parts, bool) if full).removeprefix(
            " " if first in model.piece_of else ""
        )


def _replace(joined: bytes) -> str:
    """Each byte outside a valid sequence becomes one U+FFFD."""
    out, rest = [], joined
    while rest:
        try:
            out.append(rest.decode())
            break
        except UnicodeDecodeError as e:
            out.append(rest[: e.start].decode() + "�")
            rest = rest[e.start + 1 :]
    return "".join(out)


def _ragged(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate([r for r in rows if r is not None] or [np.empty(0, np.int32)])
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values.astype(np.int32, copy=False)), mask=pa.array([r is None for r in rows])
    )


def _encoded(values: pa.Array, path: str, kind: str, most: int) -> pa.Array:
    texts = values.to_pylist()
    got = iter(encode_texts([t for t in texts if t is not None], path, kind, most))
    rows = [None if t is None else next(got) for t in texts]
    del texts
    return _ragged(rows)


@lru_cache(maxsize=4)
def _spelled(path: str, kind: str) -> tuple[pa.Array, np.ndarray]:
    """Bytes of each id, then of each id as the first of a text; which ids are read without regard to others."""
    model = load(path, kind)
    first = [out.removeprefix(b" ") if i in model.piece_of else out for i, out in enumerate(model.out)]
    return pa.array(model.out + first, pa.binary()), np.array([len(out) > 0 for out in model.out])


def _decoded(values: pa.Array, path: str, kind: str, rows: int = 1_000) -> pa.Array:
    """Texts of the ids, by so many rows at a time: the bytes of each id take more memory than the text."""
    return pa.concat_arrays(
        [_decoded_rows(values[k : k + rows], path, kind) for k in range(0, max(1, len(values)), rows)]
    )


def _decoded_rows(values: pa.Array, path: str, kind: str) -> pa.Array:
    spelled, plain = _spelled(path, kind)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    null = values.is_null().to_numpy(zero_copy_only=False)
    sizes = values.value_lengths().fill_null(0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    if not len(flat) or (flat.min() >= 0 and flat.max() < len(plain) and plain[flat].all()):
        at = flat.astype(np.int32)
        at[(ends - sizes)[sizes > 0]] += len(plain)
        joined = spelled.take(pa.array(at))
        # the texts lie end to end in the bytes of the ids
        begins = np.frombuffer(joined.buffers()[1], np.int32, len(at) + 1, joined.offset * 4)
        offsets = begins[np.concatenate([[0], ends])]
        valid = pa.array(~null).buffers()[1] if null.any() else None
        texts = pa.StringArray.from_buffers(len(values), pa.py_buffer(offsets), joined.buffers()[2], valid)
        try:
            texts.validate(full=True)
            return texts
        except pa.ArrowInvalid:  # some bytes are no UTF-8
            pass
    return pa.array(
        [None if n else decode_ids(flat[e - s : e].tolist(), path, kind) for n, s, e in zip(null, sizes, ends)],
        pa.string(),
    )


def _slices(values: pa.Array, most_bytes: int = 8_000_000):
    """All rows in order, about so many bytes at a time; at least one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(), dtype=np.int64)
    start = done = 0
    while start < len(values):
        stop = max(start + 1, int(np.searchsorted(ends, done + most_bytes, "right")))
        yield values[start:stop]
        start, done = stop, int(ends[stop - 1])


def encode(text: Column | str, path: str, kind: str = "bpe", most: int = 600_000) -> Column:
    """Column of token ids (array<int>) of a text column.

    A Python worker remembers at most ``most`` parts of words and five sixths as many pairs of pieces (400,000 at
    least); the ids do not depend on it, only memory and time do.
    """

    @F.arrow_udf("array<int>")
    def ids(values: pa.Array) -> pa.Array:
        return _encoded(values, path, kind, most)

    return ids(text)


def decode(ids: Column | str, path: str, kind: str = "bpe") -> Column:
    """Column of the texts that token ids stand for."""

    @F.arrow_udf("string")
    def text(values: pa.Array) -> pa.Array:
        return _decoded(values, path, kind)

    return text(ids)


def encode_and_decode(text: Column | str, path: str, kind: str = "bpe", most: int = 600_000) -> Column:
    """Column of a struct: ``ids`` as from ``encode`` and ``decoded``, what ``decode`` gives for them.

    Spark evaluates ``decode(encode(text))`` beside ``encode(text)`` by encoding twice; here each text is encoded once.
    A batch's results leave in slices, as ids take more memory than their text.
    """

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            for some in _slices(values):
                ids = _encoded(some, path, kind, most)
                yield pa.StructArray.from_arrays([ids, _decoded(ids, path, kind)], ["ids", "decoded"])

    return both(text)
