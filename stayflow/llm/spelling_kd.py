"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word becomes the vector of its letter counts.  One replaced letter moves the vector by one up and one
down, one inserted letter by one up: an L1 distance of at most two.  So for every pair of lengths (equal, or
one apart) a k-d tree over the vectors of one length is searched with the vectors of the other; a box whose
bounds are further away than one up and one down is pruned, and the words behind the vectors that are left
are compared letter by letter.

The tree of a length is cut in two.  Its upper part, fitted on a bounded sample of the words, deals the words
to cells; each word also goes to the cells that its search reaches.  Inside a cell the tree is built on over
all its vectors.  A cell that still got too many words (the sample only balances, it loses nothing) is dealt
out in blocks, and searches visit every block.

Edge cases: null texts and null words give nothing; a null id counts as the empty text.  Repeated rows count
as often as they occur.  Ties for the largest neighbour go to the smaller word in code-point order.  Empty
tables give no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.cells import whole_cells
from stayflow.sources.scratch import keep

RUN = "A-Za-zÀ-ÿ"
LEAF = 16_384  # words that a cell is meant to hold
SAMPLE = 262_144  # words that the upper trees are fitted on, at most
_LETTERS = 8_000_000  # letters that a cell is meant to hold
_BUCKET = 8  # vectors in the last box of a tree
_BLOCKS = 1 << 20
_PAIRS = 500_000  # word pairs compared at a time


def words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = 7,
    least_count: int = 2,
    loses_one_in: int = 31,
) -> DataFrame:
    """Rows (``word``, ``n``): the runs of letters of all texts, A-Z in lower case, counted.

    A run whose CRC-32 of ``<id>:<run>`` is divisible by ``loses_one_in`` has lost one letter, the one at
    the CRC-32 modulo its length.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # a shorter run cannot give a word that is long enough
    found = F.regexp_extract_all(text, F.lit(f"[{RUN}]{{{least_length},}}"), F.lit(0))
    owner = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    runs = docs.select(owner.alias("owner"), F.explode(found).alias("run"))
    runs = runs.select("owner", F.translate("run", upper, upper.lower()).alias("run"))
    runs = runs.withColumn("code", F.crc32(F.encode(F.concat("owner", F.lit(":"), "run"), "utf-8")))
    at = (F.col("code") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("code") % loses_one_in == 0, cut).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


# -- letters of words -----------------------------------------------------------------------


def _letters(of: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(of).encode("utf-32-le"), np.uint32).reshape(len(of), length)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions of the distinct rows, in the order of the rows, and each row's number among them."""
    whole = np.ascontiguousarray(codes).view(np.dtype((np.void, codes.dtype.itemsize * codes.shape[1])))
    _, first, number = np.unique(whole.ravel(), return_index=True, return_inverse=True)
    return first, number.ravel()


def _counts(codes: np.ndarray, letters: int) -> np.ndarray:
    """How often each of the codes 1..letters stands in a row."""
    kind = np.int8 if codes.shape[1] <= 127 else np.int32
    out = np.empty((len(codes), letters), kind)
    for a in range(0, len(codes), 65_536):
        part = codes[a : a + 65_536]
        at = part.astype(np.int64) - 1 + np.arange(len(part))[:, None] * letters
        out[a : a + 65_536] = np.bincount(at.ravel(), minlength=len(part) * letters).reshape(-1, letters)
    return out


# -- the upper trees ------------------------------------------------------------------------


@dataclass
class Tree:
    """Splits of the vectors of one length.

    A node is (letter, at, low, high, left, right): vectors with at most ``at`` of the letter go left, and
    ``low`` and ``high`` bound the letter inside the node's box.  A child below zero is leaf ``-1 - child``.
    """

    nodes: list[tuple] = field(default_factory=list)

    def visit(self, codes: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves that hold vectors within ``up`` letters more and ``down`` fewer, with the rows they are for."""
        seen: dict[int, np.ndarray] = {}
        none = np.zeros(len(codes), np.int32)
        stack = [(0, np.arange(len(codes)), none, none)]
        while stack:
            node, at, more, less = stack.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at
                continue
            letter, split, low, high, left, right = self.nodes[node]
            if letter not in seen:
                seen[letter] = (codes == letter).sum(1, dtype=np.int32)
            n = seen[letter][at]
            fewer = less + np.maximum(n - split, 0) - np.maximum(n - high, 0)
            ok = fewer <= down
            stack.append((left, at[ok], more[ok], fewer[ok]))
            extra = more + np.maximum(split + 1 - n, 0) - np.maximum(low - n, 0)
            ok = extra <= up
            stack.append((right, at[ok], extra[ok], less[ok]))


def _best_split(counts: np.ndarray) -> tuple[int, int]:
    """The column and value that halve the rows best."""
    low, high = counts.min(0), counts.max(0)
    middle = np.minimum(np.partition(counts, len(counts) // 2, axis=0)[len(counts) // 2], high - 1)
    lower = np.maximum(middle - 1, low)
    best = None
    for split in (middle, lower):
        off = np.abs((counts <= split).mean(0) - 0.5)
        off[low == high] = 1
        k = int(off.argmin())
        if best is None or off[k] < best[0]:
            best = off[k], k, int(split[k])
    return best[1], best[2]


def _fit(codes: np.ndarray, weight: float, leaf: int, first_leaf: int) -> tuple[Tree, int]:
    """A tree whose leaves stand for about ``leaf`` words, ``weight`` per sampled row; leaves are numbered on."""
    alphabet = np.unique(codes)
    counts = _counts(np.searchsorted(alphabet, codes) + 1, len(alphabet)).astype(np.int32)
    tree, leaves = Tree(), first_leaf
    wide = np.iinfo(np.int32).max
    stack = [(np.arange(len(counts)), {}, -1, 0)]  # rows, bounds, parent, side
    while stack:
        rows, bounds, parent, side = stack.pop()
        part = counts[rows]
        number = len(tree.nodes)
        if len(rows) * weight <= leaf or len(rows) < 2 or (part == part[0]).all():
            number = -1 - leaves
            leaves += 1
        else:
            k, split = _best_split(part)
            low, high = bounds.get(k, (0, wide))
            tree.nodes.append((int(alphabet[k]), split, low, high, 0, 0))
            left = part[:, k] <= split
            stack.append((rows[left], bounds | {k: (low, split)}, number, 0))
            stack.append((rows[~left], bounds | {k: (split + 1, high)}, number, 1))
        if parent >= 0:
            node = list(tree.nodes[parent])
            node[4 + side] = number
            tree.nodes[parent] = tuple(node)
        elif number < 0:
            tree.nodes.append((0, wide - 1, 0, wide, number, number))  # everything goes left
    return tree, leaves


def _room(length: int, leaf: int) -> int:
    return max(2, min(leaf, _LETTERS // max(length, 1)))


class Cells:
    """Which cell a word lies in, and which cells its search reaches.

    Lengths with few words have one cell.  ``blocks`` are the cells that got too many words.
    """

    def __init__(self, trees: dict[int, Tree], blocks: dict[int, int]):
        self.trees, self.blocks = trees, blocks

    def reached(self, codes: np.ndarray, length: int, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        tree = self.trees.get(length)
        if tree is None:
            yield -length, np.arange(len(codes))
        else:
            yield from tree.visit(codes, up, down)

    def own(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty(len(codes), np.int64)
        for cell, rows in self.reached(codes, codes.shape[1], 0, 0):
            out[rows] = cell
        return out


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    texts = batch["word"].to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        yield int(length), at, [texts[k] for k in at]


def fit_cells(counted: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> Cells:
    """Trees for the lengths with more words than a cell is meant to hold.

    The driver gets one row per such length, about ``sample`` words, and one row per overfull cell: all
    bounded by the number of words over ``leaf``, or by ``sample``.
    """
    size = F.length("word").alias("size")
    room = F.greatest(F.lit(2), F.least(F.lit(leaf), F.floor(F.lit(_LETTERS) / F.col("size"))))
    many = {r["size"]: r["count"] for r in counted.groupBy(size).count().filter(F.col("count") > room).collect()}
    if not many:
        return Cells({}, {})
    long = counted.filter(F.length("word").isin(list(many)))
    # a hash of the word draws it: about `sample` words, the same ones every time
    total = sum(many.values())
    share = F.pmod(F.xxhash64("word", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30))
    drawn = [r["word"] for r in long.filter(share).select("word").collect()]
    weight = max(1.0, total / max(1, len(drawn)))
    by_length: dict[int, list[str]] = {}
    for word in drawn:
        by_length.setdefault(len(word), []).append(word)
    trees, leaves = {}, 0
    for length, of in sorted(by_length.items()):
        trees[length], leaves = _fit(_letters(of, length), weight, _room(length, leaf), leaves)
    cells = Cells(trees, {})

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, of in _by_length(batch):
                cell, n = np.unique(cells.own(_letters(of, length)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(n), pa.array(np.full(len(cell), _room(length, leaf)))], ["cell", "n", "room"]
                )

    held = long.select("word").mapInArrow(sizes, "cell long, n long, room long")
    full = held.groupBy("cell", "room").agg(F.sum("n").alias("n")).filter("n > 2 * room").collect()
    return Cells(trees, {r["cell"]: -(-r["n"] // r["room"]) for r in full})


# -- dealing words to cells -----------------------------------------------------------------

_RESIDENT, _SAME, _SHORTER = 0, 1, 2


def _deal(cells: Cells):
    def blocks(cell: int, rows: np.ndarray, side: int, own: np.ndarray | None):
        """Positions of a cell's rows in its blocks: one block for residents, all others for searches."""
        n = cells.blocks.get(cell, 1)
        if n == 1:
            yield cell * _BLOCKS, rows, side
            return
        for block in range(n):
            if own is None:
                yield cell * _BLOCKS + block, rows, side
            else:
                yield cell * _BLOCKS + block, rows[own[rows] == block], _RESIDENT
                yield cell * _BLOCKS + block, rows[own[rows] < block], _SAME

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["n"].to_numpy()
            mixed = batch["mixed"].to_numpy()
            for length, at, of in _by_length(batch):
                codes, texts = _letters(of, length), pa.array(of, pa.string())
                home = cells.own(codes)
                routes = []
                for cell in np.unique(home):
                    rows = np.flatnonzero(home == cell)
                    own = mixed[at] % cells.blocks.get(int(cell), 1)
                    routes += blocks(int(cell), rows, _RESIDENT, own)
                for cell, rows in cells.reached(codes, length, 1, 1):
                    # each pair of cells is searched from one side
                    routes += blocks(cell, rows[home[rows] < cell], _SAME, None)
                for cell, rows in cells.reached(codes, length + 1, 1, 0):
                    routes += blocks(cell, rows, _SHORTER, None)
                for cell, rows, side in routes:
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(rows), cell, np.int64)),
                                pa.array(np.full(len(rows), side, np.int32)),
                                texts.take(pa.array(rows)),
                                pa.array(numbers[at[rows]]),
                            ],
                            ["cell", "side", "word", "n"],
                        )

    return deal


# -- inside a cell --------------------------------------------------------------------------


def _vector_pairs(held: np.ndarray, asked: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``held``, row of ``asked``) where held has ``up`` letters more and ``down`` fewer.

    A k-d tree over ``held``: every box is as tight as its vectors, and searches that cannot end in it stop.
    """
    stack = [(np.arange(len(held)), np.arange(len(asked)))]
    while stack:
        rows, asks = stack.pop()
        part = held[rows]
        low, high = part.min(0), part.max(0)
        left = []
        for a in range(0, len(asks), 65_536):
            some = asked[asks[a : a + 65_536]]
            more = np.maximum(low - some, 0).sum(1, dtype=np.int32)
            less = np.maximum(some - high, 0).sum(1, dtype=np.int32)
            left.append(asks[a : a + 65_536][(more <= up) & (less <= down)])
        asks = np.concatenate(left) if left else asks
        if not len(asks):
            continue
        if len(rows) > _BUCKET and len(rows) * len(asks) > 4_096:
            k, split = _best_split(part)
            below = part[:, k] <= split
            stack.append((rows[below], asks))
            stack.append((rows[~below], asks))
            continue
        step = max(1, 2_000_000 // part.size)
        for a in range(0, len(asks), step):
            gap = part[None] - asked[asks[a : a + step]][:, None]
            fits = (np.maximum(gap, 0).sum(2, dtype=np.int32) == up) & (np.minimum(gap, 0).sum(2, dtype=np.int32) == -down)
            q, r = np.nonzero(fits)
            if len(q):
                yield rows[r], asks[a : a + step][q]


class _Group:
    """Words of one length in a cell: distinct letter counts, and the words that have them."""

    def __init__(self, codes: np.ndarray, at: np.ndarray, letters: int):
        first, number = _distinct(np.sort(codes, axis=1))
        order = np.argsort(number, kind="stable")
        self.codes, self.at = codes[order], at[order]
        self.counts = _counts(codes[first], letters)
        self.size = np.bincount(number, minlength=len(first))
        self.begin = np.cumsum(self.size) - self.size


def _word_pairs(held: _Group, r: np.ndarray, asked: _Group, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the words behind pairs of vectors, some at a time."""
    both = held.size[r] * asked.size[q]
    ends = np.cumsum(both)
    total = int(ends[-1])
    for a in range(0, total, _PAIRS):
        k = np.arange(a, min(a + _PAIRS, total))
        pair = np.searchsorted(ends, k, side="right")
        inside = k - (ends[pair] - both[pair])
        wide = asked.size[q[pair]]
        yield held.begin[r[pair]] + inside // wide, asked.begin[q[pair]] + inside % wide


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1, dtype=np.int32) == 1


def _one_inserted(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Does the long word become the short one when one letter goes?"""
    width = short.shape[1]
    ahead, behind = short != long[:, :-1], short != long[:, 1:]
    head = np.where(ahead.any(1), ahead.argmax(1), width)
    tail = np.where(behind.any(1), behind[:, ::-1].argmax(1), width)
    return head + tail >= width


def _near_in_cell(side: np.ndarray, of: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of words one edit apart that this cell has to find."""
    length = len(of[int(np.flatnonzero(side == _RESIDENT)[0])])
    full = np.flatnonzero(side != _SHORTER)
    short = np.flatnonzero(side == _SHORTER)
    long_codes = _letters([of[k] for k in full], length)
    short_codes = _letters([of[k] for k in short], length - 1)
    alphabet = np.union1d(np.unique(long_codes), np.unique(short_codes))
    kind = np.uint8 if len(alphabet) < 255 else np.uint32
    coded = [(np.searchsorted(alphabet, c) + 1).astype(kind) for c in (long_codes, short_codes)]
    here = side[full] == _RESIDENT
    held = _Group(coded[0][here], full[here], len(alphabet))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def search(asked: _Group, up: int, down: int, test, inside: bool) -> None:
        for r, q in _vector_pairs(held.counts, asked.counts, up, down):
            if inside:  # each pair of residents once
                r, q = r[r < q], q[r < q]
            if len(r):
                for a, b in _word_pairs(held, r, asked, q):
                    near = test(held.codes[a], asked.codes[b])
                    found.append((held.at[a[near]], asked.at[b[near]]))

    search(held, 1, 1, _one_replaced, True)
    if not here.all():
        search(_Group(coded[0][~here], full[~here], len(alphabet)), 1, 1, _one_replaced, False)
    if len(short) and length > 1:
        search(_Group(coded[1], short, len(alphabet)), 1, 0, _one_inserted, False)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2


_NEAR = "word string, n_near long, best_n long, best string"


def _search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a cell that has near words: how many, and the one that occurs most."""
    for table in whole_cells(batches):
        cell = table["cell"].to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        for a, b in zip(begins, [*begins[1:], len(cell)]):
            part = table.slice(a, b - a)
            side = part["side"].to_numpy()
            if side[0] != _RESIDENT or len(side) < 2:
                continue
            of, n = part["word"].to_pylist(), part["n"].to_numpy()
            x, y = _near_in_cell(side, of)
            if not len(x):
                continue
            me, other = np.concatenate([x, y]), np.concatenate([y, x])
            used, place = np.unique(other, return_inverse=True)
            rank = np.argsort(np.argsort(np.array([of[k] for k in used])))[place]
            order = np.lexsort((rank, -n[other], me))
            me, other = me[order], other[order]
            first = np.flatnonzero(np.concatenate([[True], me[1:] != me[:-1]]))
            many = np.diff(np.append(first, len(me)))
            take = [of[k] for k in me[first]], many, n[other[first]], [of[k] for k in other[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(take[0], pa.string()), pa.array(take[1]), pa.array(take[2]), pa.array(take[3], pa.string())],
                ["word", "n_near", "best_n", "best"],
            )


def near_words(counted: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """Rows (``word``, ``n_near``, ``best_n``, ``best``) for every word with a word one edit away.

    ``counted`` has distinct words (``word``, not empty) with a number ``n``; ``best`` is the near word with the largest.
    """
    cells = fit_cells(counted, leaf, sample)
    mixed = F.pmod(F.xxhash64("word", F.lit(5)), F.lit(1 << 40))
    dealt = counted.select("word", F.col("n").cast("long").alias("n"), mixed.alias("mixed"))
    dealt = dealt.mapInArrow(_deal(cells), "cell long, side int, word string, n long")
    dealt = dealt.repartition(F.col("cell")).sortWithinPartitions("cell", "side")
    least = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    found = dealt.mapInArrow(_search_cells, _NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("_least"))
    return found.select("word", "n_near", (-F.col("_least.less")).alias("best_n"), F.col("_least.best").alias("best"))


def _roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(``word``, ``root``) from (``word``, ``form``): every link is followed to its end.

    Along a link ``n`` grows ``ratio``-fold, so the largest ``n`` bounds the number of links in a row; each
    round doubles the links followed.
    """
    now = keep(links.select("word", F.col("form").alias("root")))
    hops = math.ceil(math.log(max(most, 2), ratio)) + 1
    for _ in range(max(1, math.ceil(math.log2(hops)))):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        now = keep(now.join(ahead, "root", "left").select("word", F.coalesce("_further", "root").alias("root")))
    return now


def variants(counted: DataFrame, ratio: int = 10, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """Each word with the form it is a variant of, the form's root, and the number of its near words.

    The form is the near word with the largest ``n`` if that is at least ``ratio`` (2 or more) times the word's own.
    """
    counted = keep(counted.filter("word <> ''"))
    near = near_words(counted, leaf, sample)
    wins = F.col("best_n") >= F.lit(ratio).cast("decimal(20,0)") * F.col("n")
    placed = counted.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(wins, F.col("best")).alias("form"),
        F.when(wins, F.col("best_n")).alias("form_n"),
    )
    placed = keep(placed)
    most = placed.agg(F.max("n")).first()[0] or 0
    roots = _roots(placed.filter("form is not null"), most, ratio)
    out = placed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
