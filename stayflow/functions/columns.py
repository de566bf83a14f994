"""Time and text expressions with the rules the stay table depends on."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

ONE_MINUTE = "INTERVAL '1' MINUTE"
FAR_FUTURE = "TIMESTAMP_NTZ'9999-12-31 00:00:00'"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_minute(ts: ColumnOrName) -> Column:
    """Drop seconds.  Works on wall-clock timestamps without going through a time zone."""
    ts = _col(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), ts))


def round_minute(ts: ColumnOrName) -> Column:
    """Nearest minute, half a minute rounds up."""
    return floor_minute(_col(ts) + F.expr("INTERVAL '30' SECOND"))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``."""
    gap = floor_minute(end) - floor_minute(start)
    return gap.cast("interval minute").cast("bigint")


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Crossed minutes as hours with one decimal, half away from zero."""
    return F.round(minutes_between(start, end) / F.lit(Decimal("60.0")), 1).cast("decimal(16,2)")


def open_end(ts: ColumnOrName) -> Column:
    """A missing end counts as later than anything."""
    return F.coalesce(_col(ts), F.expr(FAR_FUTURE))


def like_ci(text: ColumnOrName, pattern: str) -> Column:
    """LIKE without regard to case, as under a case-insensitive collation."""
    return F.upper(_col(text)).like(pattern.upper())


def first_label(rules: list[tuple[Column, ColumnOrName]], otherwise: Column | None = None) -> Column:
    """Label of the first rule that holds; ``otherwise`` (or NULL) when none does."""
    head, *tail = rules
    out = F.when(head[0], _label(head[1]))
    for test, label in tail:
        out = out.when(test, _label(label))
    return out if otherwise is None else out.otherwise(otherwise)


def _label(value: ColumnOrName) -> Column:
    return F.lit(value) if isinstance(value, str) else value
