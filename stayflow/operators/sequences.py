"""Numbering stays and looking ahead to later ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayflow.functions.columns import hours_between
from stayflow.operators.ordered import Ordered


def seq(rows: Ordered, name: str) -> Ordered:
    """Number the rows of each key from 1."""
    return rows.running(**{name: ("sum", F.lit(1))}).with_columns(
        {name: F.col(name).cast("int")}
    )


def seq_where(rows: Ordered, **trackers: Column) -> Ordered:
    """Number, per key, only the rows for which a test holds; other rows get NULL."""
    counted = rows.running(**{n: ("sum", F.when(t, 1)) for n, t in trackers.items()})
    return counted.with_columns(
        {n: F.when(t, F.col(n).cast("int")) for n, t in trackers.items()}
    )


def lead_if(rows: Ordered, value: str, test: Column, name: str) -> Ordered:
    """Value of the next row if the test holds there, else NULL."""
    return rows.shift(**{name: (F.when(test, F.col(value)), 1)})


def next_matching(
    rows: Ordered, value: str, test: Column, name: str, max_ahead: int
) -> Ordered:
    """Value of the first of the next ``max_ahead`` rows for which the test holds."""
    steps = [f"_{name}_{k}" for k in range(1, max_ahead + 1)]
    seen = rows.shift(
        **{s: (F.when(test, F.col(value)), k) for k, s in enumerate(steps, start=1)}
    )
    return seen.with_columns({name: F.coalesce(*[F.col(s) for s in steps])}).drop(*steps)


def time_to_next(
    rows: Ordered,
    start: str,
    end: str,
    name: str,
    among: Column | None = None,
    where: Column | None = None,
) -> Ordered:
    """Hours from the end of a row to the start of the key's next row.

    With ``among``, only rows for which it holds count, on both sides.  ``where`` limits the rows
    that get a value.
    """
    counted = F.lit(True) if among is None else among
    ahead = rows.following(_next_start=F.when(counted, F.col(start)))
    wanted = counted if where is None else counted & where
    return ahead.with_columns(
        {name: F.when(wanted, hours_between(end, "_next_start"))}
    ).drop("_next_start")
