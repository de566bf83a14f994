"""Near-duplicate vectors from a pivot-permutation index.

Each vector is described by its nearest reference points (pivots), nearest first, and an inverted list is
kept for every set of ``shared`` of them: two vectors meet in a list exactly if they share at least
that many of their nearest pivots.  (Lists of single pivots would have to be paired to count what is
shared, and hold a fixed part of all vectors each.)  Pairs that meet are verified by their cosine in double
precision.  A pair is taken in one list only, that of the smallest pivots it shares.

The number of pivots follows the number of vectors (:func:`shape_for`): about with its square root, so that the
chance that two unlike vectors meet falls as fast as their pairs grow.  Pivots come from a bounded sample
(``SAMPLE`` distinct vectors by hash order for every 512 pivots, those at least 0.6 apart in cosine kept, random
directions added).  All vectors are indexed.  The measured recall of each shape is in the README; it
is held to 0.9 by a test.

Equal vectors are one node of the index; long lists are compared in bounded cells, each of which
hands on link counts and spanning links, not pairs.

Edge cases: vectors that are null, empty, zero or have a null or non-finite component, and rows
without an id, link with nothing.  Vectors of different lengths never link.  Repeated rows are
linked with each other.  Only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.cells import Forest, cells, over_cells, pairs
from stayflow.llm.components import components
from stayflow.sources.scratch import keep

PIVOTS, PREFIX, SHARED, SAMPLE = 512, 7, 3, 4096
_SLICE = 20_000  # pairs verified at once


@dataclass(frozen=True)
class Shape:
    """How many pivots there are, how many describe a vector, and how many of these two vectors must share."""

    pivots: int = PIVOTS
    prefix: int = PREFIX
    shared: int = SHARED


# vectors up to which a shape is taken; the last one serves all larger tables
SHAPES = (
    (16_384, Shape()),
    (65_536, Shape(1024)),
    (262_144, Shape(2048, 8)),
    (1_048_576, Shape(4096, 8)),
    (math.inf, Shape(4096, 10, 4)),
)


def shape_for(n: int) -> Shape:
    return next(shape for most, shape in SHAPES if n <= most)


def choose_pivots(sample: list[list[float]], most: int = PIVOTS) -> dict[int, np.ndarray]:
    """Unit pivots for each length of vector in the sample."""
    out = {}
    for size in sorted({len(v) for v in sample}):
        rows = _unit(np.array([v for v in sample if len(v) == size], np.float64))
        chosen, have = np.empty((most, size)), 0
        for row in rows:
            if have < most and (not have or (chosen[:have] @ row).max() < 0.6):
                chosen[have], have = row, have + 1
        out[size] = _filled(chosen[:have], size, most)
    return out


def _filled(chosen: np.ndarray | None, size: int, most: int) -> np.ndarray:
    have = 0 if chosen is None else len(chosen)
    extra = np.random.RandomState(size).standard_normal((most - have, size))
    extra /= np.linalg.norm(extra, axis=1)[:, None]
    return extra if not have else np.vstack([chosen, extra])


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square leaves the range of doubles."""
    rows = rows / np.abs(rows).max(axis=1)[:, None]
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first."""
    return np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


def _describe(pivots: dict[int, np.ndarray], shape: Shape):
    @F.arrow_udf("array<int>")
    def prefixes(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        out = np.zeros((len(sizes), shape.prefix), np.int32)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            points = pivots.get(int(size))
            if points is None:
                points = _filled(None, int(size), shape.pivots)
            for part in np.array_split(rows, max(1, len(rows) // 2048)):
                if len(part):
                    block = flat[begin[part][:, None] + np.arange(size)]
                    out[part] = nearest_pivots(block, points, shape.prefix)
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * shape.prefix)
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return prefixes


def _lists(nodes: DataFrame, shape: Shape) -> DataFrame:
    """Inverted-list entries of every node: one for each set of ``shared`` of its nearest pivots."""
    ordered = nodes.select("node", F.size("vector").alias("size"), F.sort_array("prefix").alias("near"))
    keys = []
    for places in combinations(range(shape.prefix), shape.shared):
        key = F.col("size").cast("long")
        for place in places:
            key = key * shape.pivots + F.get("near", F.lit(place))
        keys.append(key)
    return ordered.select("node", F.explode(F.array(*keys)).alias("key"))


def _link(least: float, shape: Shape):
    def links(part: pa.Table) -> pa.Table:
        n = part.num_rows
        node, key = part["node"].to_numpy(), part["key"].to_numpy()
        near = np.sort(part["prefix"].combine_chunks().flatten().to_numpy().reshape(n, shape.prefix), axis=1)
        vectors = part["vector"].combine_chunks()
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        # the largest component of each vector: squares of what is divided by it stay in the range of doubles
        top = np.maximum.reduceat(np.abs(flat), begin) if n else np.empty(0)
        copies = part["copies"].to_numpy()
        last = key % shape.pivots  # the largest pivot of the list's key
        forest, count = Forest(n), np.zeros(n, np.int64)
        for a, b in pairs(part["cell"].to_numpy(), key, part["side"].to_numpy()):
            for k in range(0, len(a), _SLICE):
                x, y = a[k : k + _SLICE], b[k : k + _SLICE]
                both = (near[x][:, :, None] == near[y][:, None, :]).any(axis=2)
                own = (both & (near[x] <= last[x][:, None])).sum(axis=1) == shape.shared
                x, y = x[own], y[own]
                for size in np.unique(sizes[x]):
                    same = sizes[x] == size
                    u, v = x[same], y[same]
                    p = flat[begin[u][:, None] + np.arange(size)] / top[u][:, None]
                    q = flat[begin[v][:, None] + np.arange(size)] / top[v][:, None]
                    dot = np.einsum("ij,ij->i", p, q)
                    norms = np.sqrt(np.einsum("ij,ij->i", p, p) * np.einsum("ij,ij->i", q, q))
                    good = dot / norms >= least
                    u, v = u[good], v[good]
                    np.add.at(count, u, copies[v])
                    np.add.at(count, v, copies[u])
                    forest.add(u, v)
        linked = np.flatnonzero(count)
        return pa.table({"u": node[linked], "v": node[forest.label[linked]], "links": count[linked]})

    return links


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", least: float = 0.95
) -> DataFrame:
    """Rows (id, ``n_links``, ``component_id``, ``kept``), one for each row of ``vectors``.

    ``n_links`` counts the other rows with cosine of at least ``least``; the component is the smallest
    id reachable over links, the own included.
    """
    own = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    sound = (
        F.col("id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    own = own.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = own.filter("sound").groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()))
    shape = shape_for(classes.count())
    sample = classes.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE * shape.pivots // PIVOTS).collect()
    pivots = choose_pivots([r["vector"] for r in sample], shape.pivots)
    nodes = keep(classes.withColumn("prefix", _describe(pivots, shape)("vector")))
    payload = nodes.select("node", "vector", "prefix", "copies")
    met = cells(_lists(nodes, shape), "key", "node", block=1024, payload=payload)
    found = keep(over_cells(met, _link(least, shape), "u long, v long, links long"))
    counts = found.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "node")
    roots = components(found.select("u", "v"))
    named = nodes.select("node", "least", "copies").join(roots, "node", "left").join(counts, "node", "left")
    named = keep(named.select("node", "least", F.coalesce("root", "node").alias("root"),
                              (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("node", "n_links", "component_id")
    known = classes.select("vector", "node").join(named, "node").drop("node")
    answered = own.filter("sound").join(known, "vector").select("id", "n_links", "component_id")
    alone = own.filter("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return answered.union(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
