"""Comparing the members of inverted lists, in cells of bounded size.

A list with more than ``BLOCK`` members is cut into blocks by a hash of the member.  Each pair of
blocks is a cell of its own and the cells of one list go to different tasks, so no task holds
more than two blocks of one list and no pair is lost.  Lists of one member are dropped early.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def cells(
    entries: DataFrame, key: str, member: str, block: int = BLOCK, payload: DataFrame | None = None
) -> DataFrame:
    """Entries of lists with two members or more, with ``cell`` and ``side`` (-1: one block only).

    Columns of ``payload`` are added by member, after lists of one have gone.  Rows are grouped by
    ``cell`` inside each partition.
    """
    sizes = entries.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    placed = entries.join(sizes, key).withColumn("_blocks", blocks)
    placed = placed.withColumn("_own", F.pmod(F.xxhash64(member, F.lit(7)), "_blocks").cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = F.xxhash64(
        F.col(key), F.least("_own", "_other"), F.greatest("_own", "_other"), F.lit(11)
    )
    side = (
        F.when(F.col("_own") == F.col("_other"), -1)
        .when(F.col("_own") < F.col("_other"), 0)
        .otherwise(1)
    )
    placed = placed.withColumn("cell", cell).withColumn("side", side.cast("int"))
    placed = placed.drop("_n", "_blocks", "_own", "_other")
    if payload is not None:
        placed = placed.join(payload, member)
    return placed.repartition(F.col("cell")).sortWithinPartitions("cell", key)


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Join the batches of a partition so that no cell is cut by the end of a batch."""
    rest = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]) if rest is not None else now
        ids = now["cell"].to_numpy()
        if not len(ids):
            continue
        begin = int(np.searchsorted(ids, ids[-1]))  # rows are sorted by cell
        if begin:
            yield now.slice(0, begin)
        rest = now.slice(begin)
    if rest is not None and rest.num_rows:
        yield rest


def pairs(cell: np.ndarray, key: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs inside the cells of a table, a slice of them at a time."""
    at = np.arange(len(cell))
    step = 0
    while len(at):
        step += 1
        at = at[at + step < len(cell)]
        at = at[(cell[at] == cell[at + step]) & (key[at] == key[at + step])]
        other = at + step
        wanted = (side[at] == -1) | (side[at] != side[other])
        if wanted.any():
            yield at[wanted], other[wanted]


class Forest:
    """Spanning stars of links between positions 0..n-1; links may come in any number of parts."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            least = np.minimum(x, y)
            np.minimum.at(label, x, least)
            np.minimum.at(label, y, least)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        child = np.flatnonzero(self.label != np.arange(len(self.label)))
        return child, self.label[child]


def over_cells(frame: DataFrame, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply a function to whole cells of each partition."""

    def run(batches):
        for part in whole_cells(batches):
            yield from function(part).to_batches()

    return frame.mapInArrow(run, schema)
