"""SimHash fingerprints, and their near duplicates from a byte-position inverted index.

Two 64-bit fingerprints that differ in at most ``d`` bits share at least ``8 - d`` of their eight
positional bytes.  For d = 3 that is five, so one half of the fingerprint has three of its four
bytes in common.  Posting lists are therefore kept per half and triple of byte positions (the
intersections of three single-byte lists; a single-byte list would hold one in 256 of all rows).
Inside a list the shared positional bytes of a pair are tallied over all eight positions, pairs
below the guaranteed minimum are dropped, and the rest is verified by the differing bits.

Only distinct fingerprints enter the index; long lists are compared in bounded cells; a cell hands
on spanning links, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.cells import Forest, cells, over_cells, pairs
from stayflow.llm.components import components
from stayflow.sources.scratch import keep

SEED = 42
BYTES = 8
_TASK = 200_000  # shingle hashes handled at once


def _votes(words: list[bytes], width: int, totals: np.ndarray) -> int:
    """Add the set bits of all shingle hashes to ``totals``; the number of shingles."""
    if len(words) < width:
        words, width = words, max(1, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), _TASK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + _TASK], ends[k : k + _TASK])],
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        totals += bits.sum(axis=0, dtype=np.int64)
    return len(starts)


def fingerprint_of(text: str | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII space splits
    if not words:
        return 0
    totals = np.zeros(64, np.int64)
    n = _votes(words, width, totals)
    return int.from_bytes(np.packbits(totals * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text: Column | str, width: int = 3) -> Column:
    """Column of fingerprints (long); texts without words (null, empty) have fingerprint zero."""

    @F.arrow_udf("long")
    def values(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), width) for t in texts], pa.int64())

    return values(text)


def hex_digits(value: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _entries(prints: DataFrame) -> DataFrame:
    """Posting entries: each fingerprint under its eight triples of byte positions."""
    keys = []
    for half in range(2):
        places = range(4 * half, 4 * half + 4)
        for left_out in places:
            key = F.lit(left_out).cast("long")
            for place in places:
                if place != left_out:
                    byte = F.shiftright("print", 8 * place).bitwiseAND(255)
                    key = F.shiftleft(key, 8).bitwiseOR(byte)
            keys.append(key)
    return prints.select("print", F.explode(F.array(*keys)).alias("key"))


def _link(distance: int):
    def links(part: pa.Table) -> pa.Table:
        prints = part["print"].to_numpy()
        forest = Forest(len(prints))
        columns = part["cell"].to_numpy(), part["key"].to_numpy(), part["side"].to_numpy()
        parts = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, BYTES)
        whole = prints.view(np.uint64)
        for a, b in pairs(*columns):
            shared = (parts[a] == parts[b]).sum(axis=1)
            fit = shared >= BYTES - distance
            a, b = a[fit], b[fit]
            near = np.bitwise_count(whole[a] ^ whole[b]) <= distance
            forest.add(a[near], b[near])
        a, b = forest.edges()
        return pa.table({"u": prints[a], "v": prints[b]})

    return links


def near_links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (``u``, ``v``) that join every two of the distinct values in ``print`` which differ in
    at most ``distance`` bits (3 or fewer), each directly or over other such links."""
    if not 0 <= distance <= 3:
        raise ValueError("the index finds up to three differing bits")
    return over_cells(cells(_entries(prints), "key", "print"), _link(distance), "u long, v long")


def _roots(prints: DataFrame, distance: int) -> DataFrame:
    """Every distinct fingerprint (``print``) with the fingerprint that names its group (``root``)."""
    found = components(near_links(prints, distance))
    named = prints.join(found, prints["print"] == found["node"], "left")
    return named.select("print", F.coalesce("root", "print").alias("root"))


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, distance: int = 3
) -> DataFrame:
    """Rows (id, ``fingerprint``, ``component_id``): one for each row of ``docs``.

    The component is the smallest id that can be reached over fingerprints with at most
    ``distance`` differing bits, the row's own included.  Null and empty texts have fingerprint
    zero and form a group like others.  A null id takes part but names no component unless the
    group has no other.  Repeated rows give repeated rows.  Other columns are not read.
    """
    own = docs.select(F.col(id_column).alias("id"), fingerprint(text_column, width).alias("print"))
    own = keep(own)
    reps = keep(own.groupBy("print").agg(F.min("id").alias("least")))
    roots = keep(_roots(reps.select("print"), distance).join(reps, "print"))
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = roots.join(names, "root").select("print", "component_id")
    return own.join(groups, "print").select(
        F.col("id").alias(id_column), hex_digits("print").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, distance: int = 3
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the smallest id.

    Nulls sort last; of rows with the same id the one with the smallest text hash stays, and of equal
    rows one.  All columns of ``docs`` are returned whatever their names.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = keep(
        rows.withColumn("print", fingerprint(F.col(f"row.{text_column}"), width)).withColumn(
            "uid", F.monotonically_increasing_id()
        )
    )
    order = F.struct(
        F.col(f"row.{id_column}").isNull().alias("none"),
        F.col(f"row.{id_column}").alias("id"),
        F.xxhash64(F.col(f"row.{text_column}")).alias("text"),
        F.col("uid").alias("uid"),
    )
    reps = keep(rows.groupBy("print").agg(F.min(order).alias("least")))
    roots = _roots(reps.select("print"), distance).join(reps, "print")
    stay = roots.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.uid").alias("uid"))
    return rows.join(stay, "uid", "left_semi").select("row.*")
