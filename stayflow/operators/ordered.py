"""Ordered scans over the rows of each key.

Most operators here look at a key's rows in time order: the previous row, a running count, the
last value seen.  A plain window does that with one shuffle, but puts all rows of a key into one
task.  :func:`arrange` therefore measures the keys first.  When none is too large the scans are
plain windows.  Otherwise the rows of the large keys are set apart and range-partitioned by key and
order, which cuts each of them into consecutive segments of bounded size; a scan then runs inside
the segments, and what crosses a segment border is patched from a small table with a few rows per
segment.  The other keys still use plain windows.  Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stayflow.limits import limit as session_limit
from stayflow.operators.joins import even, hot_keys, join_null_safe, small
from stayflow.sources.scratch import keep

SEGMENT = "_segment"
POSITION = "_position"

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


class Ordered:
    """A DataFrame whose rows are scanned per key in a fixed order.

    ``cut`` holds the rows of the keys that had to be cut, with their segment number, and
    ``segments`` is an upper bound on the number of their (key, segment) pairs; both are None when
    every key is small.  Row-wise changes and filters keep the arrangement.
    """

    def __init__(
        self,
        rest: DataFrame,
        keys: list[str],
        order: list[str],
        cut: DataFrame | None = None,
        segments: int | None = None,
        patched: bool = False,
    ):
        self._rest = rest
        self._cut = cut
        # does `cut` come from a scan that has not been written out?
        self._patched = patched
        self.keys = keys
        self.order = order
        self.segments = segments

    @property
    def df(self) -> DataFrame:
        """All rows, without the segment column."""
        if self._cut is None:
            return self._rest
        return self._rest.unionByName(self._cut.drop(SEGMENT))

    def _each(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        cut = None if self._cut is None else change(self._cut)
        return Ordered(change(self._rest), self.keys, self.order, cut, self.segments, self._patched)

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return self._each(lambda df: df.withColumns(columns))

    def filter(self, test: Column) -> Ordered:
        return self._each(lambda df: df.filter(test))

    def drop(self, *columns: str) -> Ordered:
        return self._each(lambda df: df.drop(*columns))

    def _scan(
        self,
        plain: Callable[[DataFrame, list[str]], DataFrame],
        patched: Callable[[DataFrame], DataFrame],
    ) -> Ordered:
        rest = plain(self._rest, self.keys)
        if self._cut is None:
            return Ordered(rest, self.keys, self.order)
        # A patch reads the cut rows twice: written out between scans, so that a chain of them
        # does not double the work at every step.
        source = keep(self._cut) if self._patched else self._cut
        return Ordered(rest, self.keys, self.order, patched(source), self.segments, True)

    def _place(self) -> list[str]:
        return [*self.keys, SEGMENT]

    # -- neighbours -------------------------------------------------------------------------

    def shift(self, **columns: tuple[ColumnOrName, int]) -> Ordered:
        """Add values from a row some places on (``(column, 1)``) or back (``(column, -1)``).

        NULL when there is no such row.
        """

        def plain(df: DataFrame, parts: list[str]) -> DataFrame:
            w = Window.partitionBy(*parts).orderBy(*self.order)
            return df.withColumns({n: _at(_col(c), k, w) for n, (c, k) in columns.items()})

        def patched(df: DataFrame) -> DataFrame:
            w = Window.partitionBy(*self._place()).orderBy(*self.order)
            reach = max(abs(k) for _, k in columns.values())
            raw = {f"_raw_{n}": _col(c) for n, (c, _) in columns.items()}
            ahead = sorted({k for _, k in columns.values() if k > 0})
            df = df.withColumns(raw).withColumns(
                {
                    POSITION: F.row_number().over(w),
                    "_near_end": F.lead(F.lit(True), reach).over(w).isNull(),
                    **{f"_more_{k}": F.lead(F.lit(True), k).over(w).isNotNull() for k in ahead},
                    **{n: _at(F.col(f"_raw_{n}"), k, w) for n, (_, k) in columns.items()},
                }
            )
            # The first and last `reach` rows of every segment, in order, hold every row that a
            # neighbour across a border can need.
            spot = [*self._place(), POSITION]
            across = Window.partitionBy(*self.keys).orderBy(SEGMENT, POSITION)
            border = (
                df.filter((F.col(POSITION) <= reach) | F.col("_near_end"))
                .select(*spot, *raw)
                .select(
                    *spot,
                    *[
                        _at(F.col(f"_raw_{n}"), k, across).alias(f"_border_{n}")
                        for n, (_, k) in columns.items()
                    ],
                )
            )
            df = join_null_safe(df, small(border, 2 * reach * self.segments), spot, "left")
            final = {}
            for n, (_, k) in columns.items():
                outside = F.col(POSITION) <= -k if k < 0 else ~F.col(f"_more_{k}")
                final[n] = F.when(outside, F.col(f"_border_{n}")).otherwise(F.col(n))
            return df.withColumns(final).drop(
                POSITION,
                "_near_end",
                *raw,
                *[f"_more_{k}" for k in ahead],
                *[f"_border_{n}" for n in columns],
            )

        return self._scan(plain, patched)

    # -- running values ---------------------------------------------------------------------

    def running(self, **columns: tuple[str, ColumnOrName]) -> Ordered:
        """Add running values from the key's first row up to this one.

        Kinds: ``sum`` (0 before the first value), ``last`` (last non-NULL value) and
        ``max_before`` (largest value strictly before this row).
        """
        kinds = {n: _KINDS[kind] for n, (kind, _) in columns.items()}
        return self._running(kinds, {n: _col(c) for n, (_, c) in columns.items()}, F.asc)

    def following(self, **columns: ColumnOrName) -> Ordered:
        """Add the first non-NULL value found after this row, however far away."""
        kinds = {n: _FOLLOWING for n in columns}
        return self._running(kinds, {n: _col(c) for n, c in columns.items()}, F.desc)

    def _running(
        self, kinds: dict[str, _Kind], exprs: dict[str, Column], way: Callable[[str], Column]
    ) -> Ordered:
        def plain(df: DataFrame, parts: list[str]) -> DataFrame:
            w = Window.partitionBy(*parts).orderBy(*[way(c) for c in self.order])
            return df.withColumns({n: kinds[n].local(c, w) for n, c in exprs.items()})

        def patched(df: DataFrame) -> DataFrame:
            # One row per segment with its total, then the total of the segments before it.
            totals = df.groupBy(*self._place()).agg(
                *[kinds[n].total(c, F.struct(*self.order)).alias(f"_total_{n}") for n, c in exprs.items()]
            )
            before = _before(Window.partitionBy(*self.keys).orderBy(way(SEGMENT)))
            carry = totals.select(
                *self._place(),
                *[kinds[n].carry(F.col(f"_total_{n}")).over(before).alias(f"_carry_{n}") for n in exprs],
            )
            local = plain(df, self._place())
            out = join_null_safe(local, small(carry, self.segments), self._place(), "left")
            return out.withColumns(
                {n: kinds[n].join(F.col(n), F.col(f"_carry_{n}")) for n in exprs}
            ).drop(*[f"_carry_{n}" for n in exprs])

        return self._scan(plain, patched)


def _at(value: Column, places: int, w: WindowSpec) -> Column:
    return F.lead(value, places).over(w) if places > 0 else F.lag(value, -places).over(w)


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class _Kind:
    """A running value: inside a segment, of a whole segment, over earlier segments, combined."""

    local: Callable[[Column, WindowSpec], Column]
    total: Callable[[Column, Column], Column]
    carry: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]


def _last(c: Column) -> Column:
    return F.last(c, ignorenulls=True)


_KINDS = {
    "sum": _Kind(
        local=lambda c, w: F.coalesce(F.sum(c).over(_so_far(w)), F.lit(0)),
        total=lambda c, order: F.sum(c),
        carry=F.sum,
        join=lambda here, carry: here + F.coalesce(carry, F.lit(0)),
    ),
    "last": _Kind(
        local=lambda c, w: _last(c).over(_so_far(w)),
        total=lambda c, order: F.max_by(c, F.when(c.isNotNull(), order)),
        carry=_last,
        join=lambda here, carry: F.coalesce(here, carry),
    ),
    "max_before": _Kind(
        local=lambda c, w: F.max(c).over(_before(w)),
        total=lambda c, order: F.max(c),
        carry=F.max,
        join=lambda here, carry: F.greatest(here, carry),
    ),
}
_FOLLOWING = _Kind(
    local=lambda c, w: _last(c).over(_before(w)),
    total=lambda c, order: F.min_by(c, F.when(c.isNotNull(), order)),
    carry=_last,
    join=lambda here, carry: F.coalesce(here, carry),
)


def arrange(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    limit: int | None = None,
    known: Ordered | None = None,
) -> Ordered:
    """Prepare ``df`` for ordered scans per key; see the module text.

    ``known`` is a table arranged on the same keys that ``df`` derives from.  When it was not cut,
    ``df`` is not measured again, so it must not have many times the rows of any key.

    ``order`` should be total within a key, so that results do not depend on arrival order.
    """
    spark = df.sparkSession
    hot = None if even(known, keys) else hot_keys(df, keys, limit)
    if hot is None:
        return Ordered(df, keys, order)
    bound = limit or session_limit(spark, "rowsPerTask")
    pieces = min(math.ceil(2 * hot.rows / bound), session_limit(spark, "maxSegments"))
    names = small(hot.table.select(*keys), hot.keys)
    # Written out: a second sampling of the ranges could place the borders elsewhere.
    cut = keep(
        join_null_safe(df, names, keys, "left_semi")
        .repartitionByRange(pieces, *keys, *order)
        .withColumn(SEGMENT, F.spark_partition_id())
    )
    rest = join_null_safe(df, names, keys, "left_anti")
    return Ordered(rest, keys, order, cut, pieces + hot.keys)


def measured(df: DataFrame, keys: list[str], limit: int | None = None) -> Ordered | None:
    """Count the rows per key once, for use as ``known`` in later steps; None if a key is hot."""
    return Ordered(df, keys, []) if hot_keys(df, keys, limit) is None else None
