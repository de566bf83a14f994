"""Context-tree weighting over binary-decomposed bytes, as a language model of a corpus.

A text is read as its lower-cased words, each followed by a space, and an end.  Every byte is eight
binary decisions; each decision (a node of the byte's binary tree) has a context tree over the up to
``depth`` bytes before it.  A context's Krichevsky-Trofimov estimate is mixed with those of its longer
contexts in the proportions that context-tree weighting gives after all training texts, so the model
is the mixture over all prunings of all trees.

Byte strings (context and byte) are counted per chunk of texts and dealt to cells by their nearest
context bytes; the deepest depths are built inside the cells, those above by aggregations.  Scoring sends each chunk of texts only the probabilities of the byte strings (context and
byte) that occur in it, so no task and no broadcast holds the model.  Byte strings that only held-out
texts have are given nodes with zero counts, which is what the tree would say of them.

Edge cases: null texts count as empty; an empty text is one end.  With no training text all counts are
zero and every bit has probability one half.  Repeated rows are scored (and counted) each; null ids
are treated as held out by the caller's flag or not, as it says.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from stayflow.sources.scratch import keep, scratch_of_run, scratch_path

END = b"\n"
CHUNK = 32_000_000  # bytes of text that one scoring group holds
BLOCK = 1_000_000  # bytes of text that are packed into one row
CELL = 100_000  # the number of cells of strings is the root of the bytes of text over this
SALTED = 100_000_000_000  # bytes of text for each part in which the rows of a cell are merged and sent


def normal_form(text: str | None) -> bytes:
    """Lower-cased (A-Z) words joined by spaces, and the end."""
    return b" ".join((text or "").encode().lower().split()) + END


def _strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each byte with its context, of all texts end to end, and where each text begins.

    A code packs the bytes before, nearest first, and the byte itself, so that codes sort as a tree.
    """
    pad = END * depth  # what stands before a text
    flat = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    codes = np.zeros(len(flat), np.int64)
    for back in [*range(1, depth + 1), 0]:
        codes <<= 8
        codes[back:] |= flat[: len(flat) - back]
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + depth) - sizes
    own = np.ones(len(flat), bool)
    for k in range(1, depth + 1):
        own[begin - k] = False
    return codes[own], np.cumsum(sizes) - sizes


def _chunked(docs: DataFrame, id_column: str, text_column: str, train: Column) -> DataFrame:
    """Texts in normal form, packed into compressed blocks of about ``BLOCK`` bytes, the blocks in
    chunks of about ``CHUNK`` bytes; both are cut inside each task (no shuffle).

    A row has the block's ``chunk``, the ids, flags and sizes of its texts, and the texts end to end.
    """
    own = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.col(text_column).alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    schema = StructType(
        [StructField("ids", ArrayType(own.schema["id"].dataType))]
        + StructType.fromDDL("trains array<boolean>, sizes array<int>, chunk long, packed binary").fields
    )

    def run(batches):
        number, held, forms, ids, trains = 0, 0, [], [], []

        def block(part, kind):
            joined = b"".join(forms)
            row = {
                "ids": pa.array([ids], pa.list_(kind)),
                "trains": pa.array([trains], pa.list_(pa.bool_())),
                "sizes": pa.array([[len(f) for f in forms]], pa.list_(pa.int32())),
                "chunk": pa.array([(part << 24) + number], pa.int64()),
                "packed": pa.array([pa.compress(joined, "zstd", asbytes=True)], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(row)

        size, part, kind = 0, 0, pa.int64()
        for batch in batches:
            kind = batch.schema.field("id").type
            rows = (batch[c].to_pylist() for c in ("id", "train", "text", "part"))
            for own_id, flag, text, part in zip(*rows):
                form = normal_form(text)
                if forms and size + len(form) > BLOCK:
                    yield block(part, kind)
                    held += size
                    forms, ids, trains, size = [], [], [], 0
                if held and held + size + len(form) > CHUNK and not forms:
                    number, held = number + 1, 0
                forms.append(form)
                ids.append(own_id)
                trains.append(flag)
                size += len(form)
        if forms:
            yield block(part, kind)

    return keep(own.mapInArrow(run, schema))


def _unpacked(sizes: list[int], packed: bytes) -> list[bytes]:
    """The texts of a block."""
    joined = pa.decompress(packed, sum(sizes), "zstd", asbytes=True)
    ends = np.cumsum(sizes).tolist()
    return [joined[e - n : e] for e, n in zip(ends, sizes)]


def _runs(batches, most: int):
    """Texts of a task, by training flag, in runs of one chunk and at most about ``most`` bytes."""
    chunk, forms, size = None, {True: [], False: []}, 0
    for batch in batches:
        for c, flags, sizes, packed in zip(*(batch[k].to_pylist() for k in ("chunk", "trains", "sizes", "packed"))):
            if chunk is not None and (c != chunk or size + sum(sizes) > most):
                yield chunk, forms
                forms, size = {True: [], False: []}, 0
            chunk = c
            for flag, form in zip(flags, _unpacked(sizes, packed)):
                forms[flag].append(form)
            size += sum(sizes)
    if chunk is not None:
        yield chunk, forms


def _word_counts(chunked: DataFrame) -> DataFrame:
    """Words of each chunk with their number in its training texts (zero for others)."""

    def run(batches):
        for chunk, forms in _runs(batches, 2 * CHUNK):
            counts: Counter = Counter()
            for form in forms[True]:
                counts.update(form[:-1].split())
            if forms[True]:
                counts[END] += len(forms[True])
            for form in forms[False]:
                for word in form[:-1].split():
                    counts.setdefault(word, 0)
            counts.setdefault(END, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), chunk)),
                    pa.array(list(counts.keys()), pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["chunk", "word", "n"],
            )

    return chunked.select("chunk", "trains", "sizes", "packed").mapInArrow(run, "chunk long, word binary, n long")


def _pack(numbers: np.ndarray) -> bytes:
    """Eight-byte numbers, compressed; whole numbers by their steps."""
    if numbers.dtype.kind == "i":
        numbers = np.diff(numbers, prepend=0)
    return pa.compress(numbers.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes, size: int, kind=np.int64) -> np.ndarray:
    numbers = np.frombuffer(pa.decompress(packed, 8 * size, "zstd", asbytes=True), kind)
    return np.cumsum(numbers) if kind is np.int64 else numbers


def _firsts(codes: np.ndarray) -> np.ndarray:
    """Where each distinct code of an ascending array begins."""
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)])


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and how often each comes.  The array is sorted in place."""
    codes.sort()
    first = _firsts(codes)
    return codes[first], np.diff(first, append=len(codes))


def _summed(codes: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sums of their numbers.  Both lists of ascending codes and numbers are
    emptied on the way, so that few copies stand at a time."""
    joined = np.concatenate(codes)
    codes.clear()
    order = np.argsort(joined, kind="stable")  # merges what is ascending
    joined = joined[order]
    first = _firsts(joined)
    joined = joined[first]
    numbers = np.concatenate(n)
    n.clear()
    numbers = numbers[order]
    return joined, np.add.reduceat(numbers, first) if len(first) else numbers


class _Sums:
    """Codes with numbers that come in pieces, summed as soon as the pieces are half as long as the sums."""

    def __init__(self):
        self.codes: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.size, self.least = 0, 1 << 20

    def add(self, codes: np.ndarray, n: np.ndarray) -> None:
        self.codes.append(codes)
        self.n.append(n)
        self.size += len(codes)
        if self.size > self.least:
            self._sum()

    def _sum(self) -> None:
        whole, sums = _summed(self.codes, self.n)
        self.codes, self.n, self.size = [whole], [sums], len(whole)
        self.least = max(self.least, self.size + self.size // 2)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """The sums; none are held afterwards."""
        sums = _summed(self.codes, self.n)
        self.__init__()
        return sums


def _cell_row(head: list[int], names: list[str], codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([x], pa.int64()) for x in (*head, len(codes))]
    arrays += [pa.array([_pack(x)], pa.binary()) for x in (codes, n)]
    return pa.RecordBatch.from_arrays(arrays, [*names, "size", "codes", "n"])


def _string_counts(chunked: DataFrame, depth: int, cells: int) -> DataFrame:
    """Byte strings of each chunk with their number in its training texts (zero for others).

    Strings are dealt to ``cells`` by the context bytes that ``_top`` names; a row has the strings of
    one chunk and cell, packed.  A chunk whose blocks are read by several tasks has rows from each.
    """
    shift = 8 * (depth - _top(depth) + 1)

    def rows(chunk, codes, n):
        # multiplied modulo 2**64, so that near contexts lie in different cells
        cell = ((codes >> shift).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(cells)
        order = np.argsort(cell, kind="stable")
        cell, codes, n = cell[order], codes[order], n[order]
        starts = np.flatnonzero(np.diff(cell, prepend=cells))
        for begin, end in zip(starts, [*starts[1:], len(codes)]):
            yield _cell_row([chunk, int(cell[begin])], ["chunk", "cell"], codes[begin:end], n[begin:end])

    def run(batches):
        chunk, sums = None, _Sums()
        for own, forms in _runs(batches, CHUNK // 16):
            if chunk is not None and own != chunk:
                yield from rows(chunk, *sums.taken())
            chunk = own
            sums.add(*_counted(_strings(forms[True], depth)[0]))
            other = _counted(_strings(forms[False], depth)[0])[0]
            sums.add(other, np.zeros(len(other), np.int64))
        if chunk is not None:
            yield from rows(chunk, *sums.taken())

    schema = "chunk long, cell long, size long, codes binary, n binary"
    return chunked.select("chunk", "trains", "sizes", "packed").mapInArrow(run, schema)


def _rows(batches, names: list[str]):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _merged(strings: DataFrame, salts: int) -> DataFrame:
    """All strings of each cell with their numbers, one packed row for a cell.

    With many chunks the rows of a cell are merged in ``salts`` parts first, each in its own task.
    """

    def run(batches):
        held, sums = None, _Sums()
        for cell, salt, number, packed, times in _rows(batches, ["cell", "salt", "size", "codes", "n"]):
            if held is not None and held != (cell, salt):
                yield _cell_row(list(held), ["cell", "salt"], *sums.taken())
            held = (cell, salt)
            sums.add(_unpack(packed, number), _unpack(times, number))
        if held is not None:
            yield _cell_row(list(held), ["cell", "salt"], *sums.taken())

    parts = strings.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))
    for salted in [True, False] if salts > 1 else [False]:
        if not salted:
            parts = parts.withColumn("salt", F.lit(0).cast("long"))
        parts = parts.select("cell", "salt", "size", "codes", "n").repartition("cell", "salt")
        parts = parts.sortWithinPartitions("cell", "salt")
        parts = parts.mapInArrow(run, "cell long, salt long, size long, codes binary, n binary")
    return parts.drop("salt")


def _sent(strings: DataFrame, values: DataFrame, salts: int) -> DataFrame:
    """The values of each chunk's strings: every cell's rows meet the cell's values in a sorted stream."""

    def run(batches):
        codes = value = None
        names = ["chunk", "cell", "size", "codes", "value"]
        for chunk, cell, size, packed, given in _rows(batches, names):
            own = _unpack(packed, size)
            if given is not None:  # comes first in its cell
                codes, value = own, _unpack(given, size, np.float64)
                continue
            found = _pack(value[np.searchsorted(codes, own)])
            row = [pa.array([x], pa.int64()) for x in (chunk, size)]
            row += [pa.array([x], pa.binary()) for x in (packed, found)]
            yield pa.RecordBatch.from_arrays(row, ["chunk", "size", "codes", "value"])

    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts))
    asked = strings.select("chunk", "cell", salt.alias("salt"), "size", "codes", F.lit(None).cast("binary").alias("value"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    given = values.select(F.lit(None).cast("long").alias("chunk"), "cell", every.alias("salt"), "size", "codes", "value")
    both = given.union(asked).repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.col("chunk").asc_nulls_first())
    return both.select("chunk", "cell", "size", "codes", "value").mapInArrow(
        run, "chunk long, size long, codes binary, value binary"
    )


def _log_gamma(x: Column) -> Column:
    """Natural log of the gamma function for x >= 0.5 (Stirling's series at x + 7)."""
    y = x + 7.0
    series = 1.0 / (12.0 * y) - 1.0 / (360.0 * y * y * y) + 1.0 / (1260.0 * y * y * y * y * y)
    down = x
    for k in range(1, 7):
        down = down * (x + float(k))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(down)


def _estimate(level: DataFrame) -> DataFrame:
    """Add the log of the Krichevsky-Trofimov block probability of (a zeros, b ones)."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    block = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)
    return level.withColumn("kt", block).withColumn("p", (b + 0.5) / (a + b + 1.0))


def _log_gammas(x: np.ndarray) -> np.ndarray:
    """``_log_gamma`` of an array."""
    y = x + 7.0
    down = x.copy()
    for k in range(1, 7):
        down *= x + k
    series = 1.0 / (12.0 * y) - 1.0 / (360.0 * y**3) + 1.0 / (1260.0 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(down)


class _Level:
    """Contexts of one depth with their nodes: ``keys`` are (context, node) in one number, ascending."""

    def __init__(self, keys: np.ndarray, a: np.ndarray, b: np.ndarray, longer: np.ndarray | None):
        self.keys, self.a, self.b = keys, a, b
        self.p = (b + 0.5) / (a + b + 1.0)
        kt = _log_gammas(a + 0.5) + _log_gammas(b + 0.5) - _log_gammas(a + b + 1.0) - math.log(math.pi)
        if longer is None:
            self.weighted, self.own = kt, np.ones(len(keys))
        else:
            gap = longer - kt
            self.weighted = np.logaddexp(longer, kt) - math.log(2)
            self.own = 1.0 / (1.0 + np.exp(np.minimum(gap, 700.0)))


def _subtrees(codes: np.ndarray, n: np.ndarray, levels: int):
    """The deepest ``levels`` + 1 depths of the trees over whole groups of strings.

    Returns the levels from the deepest up, for each the place of its rows in the level above it, and
    for the eight decisions of each string their places in the deepest level and the bits taken.
    """
    byte = codes & 255
    nodes = np.stack([(1 << k) + (byte >> (8 - k)) for k in range(8)])
    bits = np.stack([byte >> (7 - k) & 1 for k in range(8)])
    keys, place = np.unique((codes - byte + nodes).ravel(), return_inverse=True)
    ones = np.bincount(place, (bits * n).ravel(), len(keys))
    tree = [_Level(keys, np.bincount(place, ((1 - bits) * n).ravel(), len(keys)), ones, None)]
    parents = []
    for _ in range(levels):
        low = tree[-1]
        keys, up = np.unique(((low.keys >> 16) << 8) | (low.keys & 255), return_inverse=True)
        sums = (np.bincount(up, values, len(keys)) for values in (low.a, low.b, low.weighted))
        tree.append(_Level(keys, *sums))
        parents.append(up)
    return tree, parents, place.reshape(8, -1), bits


def _top(depth: int) -> int:
    """Bytes of context that decide the cell of a string; the depths beyond are built inside cells."""
    return max(depth - 2, 0)


def tree(counts: DataFrame, depth: int) -> DataFrame:
    """Log10 probability of the last byte of each string given the ``depth`` bytes before it.

    ``counts`` has one packed row per cell, with the training counts ``n`` of its ``codes``; the
    result has ``value`` in place of them.  The deepest depths of context are built in arrays inside
    the cells, the depths above them by aggregations.
    """
    top = _top(depth)

    def up(batches):
        for cell, size, codes, n in _rows(batches, ["cell", "size", "codes", "n"]):
            last = _subtrees(_unpack(codes, size), _unpack(n, size), depth - top)[0][-1]
            arrays = [np.full(len(last.keys), cell), last.keys >> 8, (last.keys & 255).astype(np.int32), last.a, last.b, last.weighted]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["cell", "context", "node", "a", "b", "weighted"])

    levels = {top: keep(counts.mapInArrow(up, "cell long, context long, node int, a double, b double, weighted double"))}
    for d in range(top - 1, -1, -1):
        level = levels[d + 1].groupBy(F.shiftright("context", 8).alias("context"), "node")
        level = _estimate(level.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weighted").alias("longer")))
        gap = F.col("longer") - F.col("kt")
        # log of the mean of the estimate and the product of the longer contexts
        mean = F.greatest("longer", "kt") + F.log1p(F.exp(-F.abs(gap))) - math.log(2)
        levels[d] = keep(level.withColumn("weighted", mean).withColumn("own", 1.0 / (1.0 + F.exp(gap))).drop("longer"))
    mixed = None  # what the depths so far give, and the weight that is left to longer contexts
    for d in range(top + 1):
        level = levels[d].withColumnRenamed("context", "key")
        if mixed is None:
            level = level.withColumn("sum", F.lit(0.0)).withColumn("rest", F.lit(1.0))
        else:
            above = mixed.withColumnRenamed("key", "parent")
            level = level.withColumn("parent", F.shiftright("key", 8)).join(above, ["parent", "node"])
        if d == top:
            mixed = level.select("cell", "key", "node", "sum", "rest")
        else:
            mixed = level.select(
                "key",
                "node",
                (F.col("sum") + F.col("rest") * F.col("own") * F.col("p")).alias("sum"),
                (F.col("rest") * (1.0 - F.col("own"))).alias("rest"),
            )

    def down(own: pa.Table, above: pa.Table) -> pa.Table:
        size, packed = own["size"][0].as_py(), own["codes"][0].as_py()
        codes = _unpack(packed, size)
        levels, parents, place, bits = _subtrees(codes, _unpack(own["n"][0].as_py(), size), depth - top)
        key, node, total, rest = (above[c].to_numpy() for c in ("key", "node", "sum", "rest"))
        order = np.argsort((key << 8) | node)
        total, rest = total[order], rest[order]
        for k in range(depth - top, -1, -1):
            level = levels[k]
            total, rest = total + rest * level.own * level.p, rest * (1.0 - level.own)
            if k:
                total, rest = total[parents[k - 1]], rest[parents[k - 1]]
        one = total[place]
        value = np.log10(np.where(bits == 1, one, 1.0 - one)).sum(axis=0)
        row = [own["cell"][:1], pa.array([size], pa.int64())]
        row += [pa.array([x], pa.binary()) for x in (packed, _pack(value))]
        return pa.Table.from_arrays(row, ["cell", "size", "codes", "value"])

    cells = counts.groupBy("cell").cogroup(mixed.groupBy("cell"))
    return cells.applyInArrow(down, "cell long, size long, codes binary, value binary")


def _values(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of the packed rows, ascending, and their values."""
    at = np.flatnonzero(table["codes"].is_valid().to_numpy())
    sizes = [table["size"][i].as_py() for i in at]
    codes = np.concatenate([_unpack(table["codes"][i].as_py(), k) for i, k in zip(at, sizes)])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = _firsts(codes)
    codes, order = codes[first], order[first]
    return codes, np.concatenate([_unpack(table["value"][i].as_py(), k, np.float64) for i, k in zip(at, sizes)])[order]


def _looked_up(found: np.ndarray, codes: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of each code found; ``codes`` ascend and hold them all."""
    order = np.argsort(found)
    out = np.empty(len(found))
    out[order] = value[np.searchsorted(codes, found[order])]
    return out


def score(
    docs: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text", depth: int = 6
) -> DataFrame:
    """Scores of all texts by models of those where ``train`` holds; one row per row.

    Columns: id, ``train``, ``n_bytes`` (of the normal form), ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (word frequencies, add one half), ``score`` (log10 probability by
    context-tree weighting).  ``-score / n_bytes / log10(2)`` is the code length in bits per byte.
    """
    if not 0 <= depth <= 6:
        raise ValueError("contexts of 0 to 6 bytes are supported")
    chunked = _chunked(docs, id_column, text_column, train)
    per_word = Window.partitionBy("word")
    words = keep(
        _word_counts(chunked)
        .withColumn("count", F.sum("n").over(per_word))
        .withColumn("first", F.row_number().over(per_word.orderBy("chunk")) == 1)
        # a chunk knows the number of each word in its own training texts; only other numbers are sent to it
        .withColumn("word", F.when(F.col("count") != F.col("n"), F.col("word")))
    )
    seen = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum((F.col("first") & (F.col("count") > 0)).cast("long")), F.lit(0)).alias("distinct"),
    ).first()
    total, distinct = int(seen["tokens"]), int(seen["distinct"])
    size = chunked.agg(F.sum(F.expr("aggregate(sizes, 0L, (held, size) -> held + size)"))).first()[0] or 0
    salts = 1 + size // SALTED
    strings = keep(_string_counts(chunked, depth, 1 + math.isqrt(size // CELL)))
    path = scratch_path(docs.sparkSession)
    with scratch_of_run(docs.sparkSession):  # counts and levels of the trees go once the values stand
        values = keep(tree(keep(_merged(strings, salts)), depth), path)
    none = F.lit(None)
    wanted = words.filter(F.col("word").isNotNull())
    wanted = wanted.select(
        "chunk", "word", "count", *(none.cast(k).alias(c) for c, k in (("size", "long"), ("codes", "binary"), ("value", "binary")))
    )
    sent = _sent(strings, values, salts)
    wanted = wanted.union(
        sent.select("chunk", none.cast("binary").alias("word"), none.cast("long").alias("count"), "size", "codes", "value")
    )
    floor = math.log10(total + 0.5 * (distinct + 1))
    names = ["id", "train", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score_chunk(texts: pa.Table, table: pa.Table) -> pa.Table:
        blocks = list(zip(*(texts[k].to_pylist() for k in ("ids", "trains", "sizes", "packed"))))
        out: list[list] = [[], [], [], [], []]
        own: Counter = Counter()
        for _, flags, sizes, packed in blocks:
            for flag, form in zip(flags, _unpacked(sizes, packed)):
                if flag:
                    own.update(form[:-1].split())
                    own[END] += 1
        for batch in table.select(["word", "count"]).to_batches(max_chunksize=10_000):
            batch = batch.filter(batch["word"].is_valid())
            dict.update(own, zip(batch["word"].to_pylist(), batch["count"].to_pylist()))
        ids, trains = [], []
        for own_ids, flags, sizes, packed in blocks:
            ids += own_ids
            trains += flags
            for form in _unpacked(sizes, packed):
                tokens = form[:-1].split()
                tokens.append(END)
                counts = np.fromiter((own.get(t, 0) for t in tokens), np.float64, len(tokens))
                out[0].append(len(form))
                out[1].append(len(tokens))
                out[2].append(int((counts > 0).sum()))
                out[3].append(float((np.log10(counts + 0.5) - floor).sum()))
        del own  # words and strings are not held at the same time
        codes, value = _values(table)
        for _, _, sizes, packed in blocks:
            found, begin = _strings(_unpacked(sizes, packed), depth)
            out[4].extend(np.add.reduceat(_looked_up(found, codes, value), begin).tolist())
        arrays = [
            pa.array(ids, texts.schema.field("ids").type.value_type),
            pa.array(trains, pa.bool_()),
            pa.array(out[0], pa.int64()),
            pa.array(out[1], pa.int64()),
            pa.array(out[2], pa.int64()),
            pa.array([total] * len(ids), pa.int64()),
            pa.array(out[3], pa.float64()),
            pa.array(out[4], pa.float64()),
        ]
        return pa.Table.from_arrays(arrays, names)

    schema = StructType(
        [StructField("id", chunked.schema["ids"].dataType.elementType)]
        + StructType.fromDDL(
            "train boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        ).fields
    )
    scored = chunked.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(score_chunk, schema)
    return scored.withColumnRenamed("id", id_column)
