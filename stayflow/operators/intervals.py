"""Operators on intervals: stays, gaps, points inside them, and splits at state changes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.columns import ONE_MINUTE, open_end, round_minute
from stayflow.limits import limit as session_limit
from stayflow.operators.joins import even, hot_keys, join_one, may_broadcast, within, without
from stayflow.operators.ordered import Ordered, arrange
from stayflow.sources.scratch import keep

ADMIT = "ADMIT TO UNIT"
TRANSFER = "TRANSFER FROM UNIT"
IN_UNIT = "PATIENT IN UNIT"

# dated records of one key that may be searched as a list; longer histories are cut into chunks of time
_RECORDS_PER_KEY = 200
# beginnings and ends of records in one chunk, and lengths of runs of chunks as powers of two
_CHUNK = 64
_LENGTHS = 48
# widths of time cells as powers of two of a second: about an hour, and eight times that per level
_CELL_BITS = range(12, 40, 3)


# -- runs of rows ---------------------------------------------------------------------------


def _differs(watch: list[str], other: str) -> Column:
    """No neighbour, or the first watched column that differs while those before it are equal.

    A NULL on either side is neither equal nor different.
    """
    changed = F.col(f"{other}exists").isNull()
    same = F.lit(True)
    for c in watch:
        changed = changed | (same & (F.col(c) != F.col(f"{other}{c}")))
        same = same & (F.col(c) == F.col(f"{other}{c}"))
    return changed


def mark_edges(
    rows: Ordered,
    watch: list[str],
    end: str = "pat_out_dttm",
    admit: str = "admit_status",
    leave: str = "discharge_status",
) -> Ordered:
    """Mark the first and last row of each run of equal ``watch`` values.

    A row with no end is marked as still in the unit wherever a run does not close on it.
    """
    near = rows.shift(
        _before_exists=(F.lit(True), -1),
        _after_exists=(F.lit(True), 1),
        **{f"_before_{c}": (c, -1) for c in watch},
        **{f"_after_{c}": (c, 1) for c in watch},
    )
    marked = near.with_columns(
        {
            admit: F.when(_differs(watch, "_before_"), F.lit(ADMIT)),
            leave: F.when(
                _differs(watch, "_after_") & F.col(end).isNotNull(), F.lit(TRANSFER)
            ).when(F.col(end).isNull(), F.lit(IN_UNIT)),
        }
    )
    helpers = [f"_{side}_{c}" for side in ("before", "after") for c in ["exists", *watch]]
    return marked.drop(*helpers)


def drop_orphans(
    rows: Ordered, end: str = "pat_out_dttm", admit: str = "admit_status"
) -> Ordered:
    """Remove rows with no end that are not the key's last row.

    The row after a removed one becomes an admit row unless it is marked already.
    """
    near = rows.shift(
        _has_next=(F.lit(True), 1),
        _after_orphan=(F.col(end).isNull(), -1),
    )
    return (
        near.with_columns(
            {
                admit: F.when(
                    F.col(admit).isNull() & F.coalesce("_after_orphan", F.lit(False)),
                    F.lit(ADMIT),
                ).otherwise(F.col(admit))
            }
        )
        .filter(F.col(end).isNotNull() | F.col("_has_next").isNull())
        .drop("_has_next", "_after_orphan")
    )


def collapse_runs(
    rows: Ordered,
    starts: Column,
    closes: Column,
    first: dict[str, str],
    last: dict[str, str],
) -> DataFrame:
    """One row per run: ``first`` columns from the start row, ``last`` columns from the latest
    closing row.  Both map output names to input columns; ``_line`` is the start row's number.

    Rows before a key's first start row belong to no run.
    """
    numbered = rows.running(
        _run=("sum", F.when(starts, 1)),
        _row=("sum", F.lit(1)),
    )
    head = F.min_by(F.struct(*[F.col(c).alias(n) for n, c in first.items()]), F.col("_row"))
    tail = F.max_by(
        F.struct(*[F.col(c).alias(n) for n, c in last.items()]), F.when(closes, F.col("_row"))
    )
    return (
        numbered.df.filter(F.col("_run") > 0)
        .groupBy(*rows.keys, "_run")
        .agg(head.alias("_head"), tail.alias("_tail"), F.min("_row").alias("_line"))
        .select(
            *rows.keys,
            *[F.col(f"_head.{n}").alias(n) for n in first],
            *[F.col(f"_tail.{n}").alias(n) for n in last],
            F.col("_line"),
        )
    )


def close_open_intervals(
    rows: Ordered,
    start: str = "unit_in_dttm",
    end: str = "unit_out_dttm",
    status: str = "unit_status",
) -> Ordered:
    """End a stay marked as still open at the start of the key's next stay, if there is one."""
    ahead = rows.shift(_next_start=(start, 1))
    stale = (F.col(status) == IN_UNIT) & F.col("_next_start").isNotNull()
    return ahead.with_columns(
        {
            end: F.when(stale, F.col("_next_start")).otherwise(F.col(end)),
            status: F.when(stale, F.lit(TRANSFER)).otherwise(F.col(status)),
        }
    ).drop("_next_start")


# -- rows around the kept rows of a key -----------------------------------------------------


def outside_span(
    rows: DataFrame,
    kept: DataFrame,
    keys: list[str],
    side: str,
    at: str = "in_dttm",
    kept_start: str = "in_dttm",
    kept_end: str = "pat_out_dttm",
    limit: int | None = None,
    known: Ordered | None = None,
) -> DataFrame:
    """Rows that begin before the first kept row of their key, or at/after its last kept end.

    A kept row with no end never ends, so nothing comes after it.
    """
    if side == "before":
        edge, test = F.min(kept_start), F.col(at) < F.col("_edge")
    elif side == "after":
        edge, test = F.max(open_end(kept_end)), F.col(at) >= F.col("_edge")
    else:
        raise ValueError(f"side must be 'before' or 'after', not {side!r}")
    spans = kept.groupBy(*keys).agg(edge.alias("_edge"))
    return join_one(rows, spans, keys, "inner", limit, known).filter(test).drop("_edge")


def keys_without_rows(
    rows: DataFrame, kept: DataFrame, keys: list[str], known: Ordered | None = None
) -> DataFrame:
    """Rows of keys that have no kept row at all."""
    return without(rows, kept, keys, known)


# -- points and intervals -------------------------------------------------------------------


def latest_record(
    facts: DataFrame,
    history: DataFrame,
    keys: list[str],
    at: str,
    start: str,
    end: str,
    take: dict[str, str],
    limit: int | None = None,
    known: Ordered | None = None,
) -> DataFrame:
    """Dated-dimension join: each fact with the record valid at ``at`` (closed at both ends).

    Of several valid records the one with the latest start wins, then the one with the latest end,
    then the greatest taken values.  Facts without a valid record, or with a NULL key, keep NULL in
    the taken columns (``{record column: new name}``).  Histories with few records per key are searched as
    lists, sent to every task if they are small altogether and joined by key if not; longer ones are merged
    with the facts in order of time.  All ways give the same rows.
    """
    record = F.struct(
        F.col(start).alias("_s"), open_end(end).alias("_e"), *[F.col(c) for c in take]
    )
    records = history.select(*dict.fromkeys([*keys, start, end, *take])).withColumn("_record", record)
    sizes = records.groupBy(*keys).count().agg(F.sum("count"), F.max("count")).first()
    valid = F.filter("_records", lambda r: (F.col(at) >= r["_s"]) & (F.col(at) <= r["_e"]))
    if (sizes[1] or 0) <= _RECORDS_PER_KEY:
        lists = records.groupBy(*keys).agg(F.collect_list("_record").alias("_records"))
        if may_broadcast(records, sizes[0] or 0):
            found = facts.join(F.broadcast(lists), keys, "left")
        else:
            found = join_one(facts, lists, keys, "left", limit, known)
        found = found.withColumn("_hit", F.array_max(valid))
    else:
        placed, lists = _chunks(facts, records.select(*keys, "_record"), keys, at, limit, known)
        found = join_one(placed, lists, [*keys, "_chunk"], "left", limit, _as_even(known, keys, [*keys, "_chunk"]))
        found = found.select(*keys, "_row", "_records").select("_row.*", "_records").withColumn("_hit", F.array_max(valid))
    return found.select(*facts.columns, *[F.col(f"_hit.{c}").alias(n) for c, n in take.items()])


def _as_even(known: Ordered | None, keys: list[str], finer: list[str]):
    """No finer key can have more rows than the key it refines."""
    return True if even(known, keys) else None


def _chunks(
    facts: DataFrame, records: DataFrame, keys: list[str], at: str, limit: int | None, known: Ordered | None
) -> tuple[DataFrame, DataFrame]:
    """Long histories: facts with the chunk of time they fall in, and the records that matter there.

    Facts and the beginnings and ends of records are put in order of time, and every ``_CHUNK`` beginnings
    and ends make a chunk of the key's time.  A fact is copied nowhere: it is given the number of its
    chunk.  A record is entered in the chunks in which it begins and ends.  Of the records that last through a whole
    chunk only the greatest can win there; it is carried in.  So no list holds more than ``_CHUNK`` + 1.
    """
    held = keep(records.dropna(subset=keys).filter("_record._e >= _record._s").withColumn("_id", F.monotonically_increasing_id()))
    row = F.struct(*[F.col(c) for c in facts.columns]).alias("_row")
    dots = facts.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), row)
    begins = held.select(*keys, F.col("_record._s").alias("_at"), F.lit(0).alias("_side"), "_id")
    ends = held.select(*keys, F.col("_record._e").alias("_at"), F.lit(2).alias("_side"), "_id")
    marks = begins.unionByName(ends).unionByName(dots, allowMissingColumns=True)
    # a key is as hot as its facts and its history are
    even_too = known if even(known, keys) and hot_keys(held, keys, limit) is None else None
    seen = arrange(marks, keys, ["_at", "_side", "_id"], limit, even_too).running(
        _before=("sum", F.when(F.col("_side") != 1, 1))
    )
    edge = F.col("_side") != 1
    seen = seen.with_columns({"_chunk": F.floor((F.col("_before") - F.when(edge, 1).otherwise(0)) / _CHUNK)}).df
    placed = seen.filter(~edge).select(*keys, "_chunk", "_row")
    spans = seen.filter(edge).groupBy("_id").agg(F.min("_chunk").alias("_a"), F.max("_chunk").alias("_b"))
    spans = keep(held.join(spans, "_id").drop("_id"))
    listed = spans.select(*keys, F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_chunk"), "_record")
    tops = _carried(spans.filter("_b > _a + 1"), seen.filter(~edge).select(*keys, "_chunk").distinct(), keys)
    lists = listed.unionByName(tops).groupBy(*keys, "_chunk").agg(F.collect_list("_record").alias("_records"))
    return placed, lists


def _carried(spans: DataFrame, chunks: DataFrame, keys: list[str]) -> DataFrame:
    """For each chunk the greatest record that lasts all through it.

    The chunks strictly between a record's first and last are cut into runs of 1, 2, 4, ... chunks that begin at
    multiples of their length; a chunk looks at the runs that hold it, one per length.
    """
    powers = F.sequence(F.lit(0), F.lit(_LENGTHS - 1))

    def runs(k: Column) -> Column:
        """Runs of length 2 ** k: what is left of the span is [low, high], in units of that length."""
        size = F.pow(F.lit(2.0), k).cast("bigint")
        low = F.floor((F.col("_a") + size) / size)
        high = F.floor(F.col("_b") / size) - 1
        from_left = F.when((low <= high) & (low % 2 == 1), F.struct(k.alias("_power"), low.alias("_run")))
        from_right = F.when((low <= high) & (high % 2 == 0), F.struct(k.alias("_power"), high.alias("_run")))
        return F.array(from_left, from_right)

    cut = spans.select(*keys, "_record", F.explode(F.flatten(F.transform(powers, runs))).alias("_part"))
    best = (
        cut.filter("_part is not null")
        .select(*keys, "_part._power", "_part._run", "_record")
        .groupBy(*keys, "_power", "_run")
        .agg(F.max("_record").alias("_record"))
    )
    used = best.groupBy(*keys).agg(F.collect_set("_power").alias("_powers"))  # at most _LENGTHS
    asked = chunks.join(used, keys).select(*keys, "_chunk", F.explode("_powers").alias("_power"))
    asked = asked.withColumn("_run", F.floor(F.col("_chunk") / F.pow(F.lit(2.0), F.col("_power")).cast("bigint")))
    return asked.join(best, [*keys, "_power", "_run"]).groupBy(*keys, "_chunk").agg(F.max("_record").alias("_record"))


def _seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp without a time zone; NULL for NULL."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    at: str,
    start: str,
    end: str,
    limit: int | None = None,
    known: Ordered | None = None,
) -> DataFrame:
    """Every (point, interval) pair of a key with the point inside the closed interval.

    Output: the point's columns and ``_interval`` (a struct of the interval's columns).  NULL keys
    match nothing.  An interval is entered in the one or two time cells that it touches on the level
    whose cells are about as wide as it is.  A directory lists for each key the levels in use; points of other
    keys are dropped, and a point looks into its cell on those levels only.  So one equi-join on key,
    level and cell finds all pairs at any depth of nesting, and only neighbours in time are compared.
    Where a key has more points than ``limit``, cells with too many (long and open intervals have
    wide ones) are spread over tasks.
    """
    span = F.struct(*[F.col(c) for c in intervals.columns]).alias("_interval")
    held = intervals.select(
        *keys, F.col(start).alias("_from"), open_end(end).alias("_until"), span
    ).filter("_until >= _from")
    length = _seconds("_until") - _seconds("_from")
    level = F.lit(_CELL_BITS[-1])
    for bits in reversed(_CELL_BITS[:-1]):
        level = F.when(length < (1 << bits), bits).otherwise(level)
    held = held.withColumn("_level", level)
    directory = held.groupBy(*keys).agg(F.bit_or(F.expr("shiftleft(1L, _level)")).alias("_levels"))
    first, last = (F.expr(f"shiftright({n}, _level)") for n in ("_first", "_last"))
    held = (
        held.withColumns({"_first": _seconds("_from"), "_last": _seconds("_until")})
        .withColumn("_cell", F.explode(F.sequence(first, last)))
        .drop("_first", "_last")
    )
    dots = points.filter(F.col(at).isNotNull())
    calm = even(known, keys) or hot_keys(dots, keys, limit) is None
    used = F.filter(
        F.array(*[F.lit(bits) for bits in _CELL_BITS]), lambda b: F.col("_levels").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)) != 0
    )
    seen = join_one(dots, directory, keys, "inner", limit, calm or None).withColumns(
        {"_level": F.explode(used), "_second": _seconds(at)}
    )
    seen = seen.withColumn("_cell", F.expr("shiftright(_second, _level)")).drop("_second", "_levels")
    met = join_one(seen, held, [*keys, "_level", "_cell"], "inner", limit, calm or None)
    return met.filter(F.col(at).between(F.col("_from"), F.col("_until"))).select(*points.columns, "_interval")


def count_in_interval(
    points: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    ids: list[str],
    at: str,
    start: str,
    end: str,
    name: str,
    unlike: tuple[str, str] | None = None,
    limit: int | None = None,
    known: Ordered | None = None,
) -> DataFrame:
    """Add the number of the key's points inside each closed interval (0 if none).

    ``ids`` identify an interval.  ``unlike=(point column, interval column)`` leaves out points
    where the two are equal or NULL.  Points are never paired with intervals: the count is the
    running count at the interval's end less the one just before its start, and points to leave
    out are counted the same way on the finer key.  An interval without an end or with a NULL key
    counts nothing.
    """
    use = points.dropna(subset=keys)
    if unlike:
        use = use.filter(F.col(unlike[0]).isNotNull())
    total = _running_counts(use, intervals, keys, ids, at, start, end, limit, known)
    if unlike is None:
        counts = total
    else:
        same = _running_counts(
            use.withColumn("_kind", F.col(unlike[0])),
            intervals.withColumn("_kind", F.col(unlike[1])),
            [*keys, "_kind"],
            ids,
            at,
            start,
            end,
            limit,
            # no finer key can have more rows than the key it refines
            Ordered(points, [*keys, "_kind"], []) if even(known, keys) else None,
        )
        known = intervals.filter(F.col(unlike[1]).isNotNull()).select(*ids)
        minus = same.select(*ids, (-F.col("_count")).alias("_count"))
        counts = (
            total.unionByName(minus)
            .groupBy(*ids)
            .agg(F.sum("_count").alias("_count"))
            .join(known, ids, "left_semi")
        )
    out = intervals.join(counts, ids, "left")
    return out.withColumn(name, F.coalesce(F.col("_count"), F.lit(0)).cast("int")).drop("_count")


def _running_counts(points, intervals, grain, ids, at, start, end, limit, known) -> DataFrame:
    """``ids`` and ``_count`` for every interval with both ends."""
    real = intervals.filter(F.col(end) >= F.col(start)).dropna(subset=grain)
    dot = points.filter(F.col(at).isNotNull()).select(
        *grain, F.col(at).alias("_at"), F.lit(1).alias("_side")
    )
    opens = real.select(*grain, F.col(start).alias("_at"), F.lit(0).alias("_side"), *_ids(ids, grain))
    shuts = real.select(*grain, F.col(end).alias("_at"), F.lit(2).alias("_side"), *_ids(ids, grain))
    marks = opens.unionByName(shuts).unionByName(dot, allowMissingColumns=True)
    seen = arrange(marks, grain, ["_at", "_side"], limit, known).running(
        _seen=("sum", F.when(F.col("_side") == 1, 1))
    )
    edge = F.when(F.col("_side") == 2, F.col("_seen")).otherwise(-F.col("_seen"))
    return seen.df.filter("_side <> 1").groupBy(*ids).agg(F.sum(edge).alias("_count"))


def _ids(ids: list[str], grain: list[str]) -> list[str]:
    return [c for c in ids if c not in grain]


def gap_windows(
    stays: Ordered, start: str = "unit_in_dttm", end: str = "unit_out_dttm"
) -> DataFrame:
    """Stays preceded by a gap, with the window in which the gap's movements began.

    The previous end is kept to the minute, and the window closes one minute before the stay.
    """
    return (
        stays.shift(_previous_end=(end, -1))
        .filter(F.col("_previous_end") < F.col(start))
        .df.withColumns(
            {"gap_from": round_minute("_previous_end"), "gap_to": F.col(start) - F.expr(ONE_MINUTE)}
        )
        .drop("_previous_end")
    )


def fill_gaps(
    stays: Ordered,
    movements: DataFrame,
    keys: list[str],
    at: str = "in_dttm",
    start: str = "unit_in_dttm",
    end: str = "unit_out_dttm",
    limit: int | None = None,
    known: Ordered | None = None,
) -> DataFrame:
    """Movements that began in the gap before a stay, with ``_interval`` holding that stay."""
    windows = keep(gap_windows(stays, start, end))
    return points_in_intervals(movements, windows, keys, at, "gap_from", "gap_to", limit, known)


# -- splitting at state changes -------------------------------------------------------------


def split_on_change(
    intervals: DataFrame,
    events: DataFrame,
    keys: list[str],
    ids: list[str],
    start: str,
    end: str,
    state: str,
    at: str,
    event_state: str,
    as_of: datetime,
    min_gap: str = ONE_MINUTE,
    max_cuts: int | None = None,
    limit: int | None = None,
    events_per_fold: int | None = None,
    may_restart: Callable[[DataFrame], DataFrame] | None = None,
    carry: list[str] | None = None,
    known: Ordered | None = None,
) -> DataFrame:
    """Cut intervals where an event changes their state.

    Events are taken in time order.  One cuts if its state is known and differs from the current
    one, it is at least ``min_gap`` (more than nothing) after the start and after the last cut, and at
    least ``min_gap`` before the end (up to ``as_of`` when open).  At most ``max_cuts`` cuts are made
    (None: as many as there are) and an interval with unknown state is never cut.  ``may_restart`` may
    add ``_restart`` to the matched events (``_at`` and the intervals' ``carry`` columns): where it is
    false, the piece that begins at the event is not cut again.

    Up to ``events_per_fold`` events are walked in one array per interval.  Beyond that the events stay
    rows: each knows the cut that would follow if it were one, and the chain of cuts from the start is
    found by doubling the steps taken.

    Output: the interval's columns with new start, end and state, and ``piece`` (0, 1, ...).
    """
    gap = F.expr(min_gap)
    windows = intervals.filter(F.col(state).isNotNull()).select(
        *dict.fromkeys([*keys, *ids, *(carry or [])]),
        F.col(state).alias("_state"),
        (F.col(start) + gap).alias("_from"),
        F.coalesce(F.col(end) - gap, F.lit(as_of).cast("timestamp_ntz")).alias("_to"),
    )
    stated = events.filter(F.col(event_state).isNotNull()).select(
        *keys, F.col(at).alias("_at"), F.col(event_state).alias("_seen")
    )
    owned = points_in_intervals(stated, windows, keys, "_at", "_from", "_to", limit, known).select(
        *[F.col(f"_interval.{c}").alias(c) for c in dict.fromkeys([*ids, *(carry or [])])],
        "_at",
        "_seen",
        F.col("_interval._state").alias("_state"),
        F.col("_interval._from").alias("_from"),
    )
    restart = may_restart or (lambda matched: matched.withColumn("_restart", F.lit(True)))
    owned = keep(restart(owned).drop(*[c for c in carry or [] if c not in ids]))
    bound = events_per_fold or session_limit(intervals.sparkSession, "eventsPerFold")
    heavy = hot_keys(owned, ids, bound)
    if heavy is None:
        return _pieces(intervals.join(_cuts_by_fold(owned, ids, gap, max_cuts), ids, "left"), start, end, state)
    many = keep(heavy.table.select(*ids))
    folded = _cuts_by_fold(without(owned, many, ids, known=True), ids, gap, max_cuts)
    light = intervals.join(many, ids, "left_anti")
    chained = _cuts_by_doubling(keep(within(owned, many, ids)), ids, gap, max_cuts, bound)
    return _pieces(light.join(folded, ids, "left"), start, end, state).unionByName(
        _pieces_of_many(intervals.join(many, ids, "left_semi"), chained, ids, start, end, state, bound)
    )


_CUTS = "array<struct<at:timestamp_ntz,state:string,restart:boolean>>"


def _event() -> Column:
    return F.struct(
        F.col("_at").alias("at"), F.col("_seen").alias("state"), F.col("_restart").alias("restart")
    )


def _cuts_here(event: Column, cuts: Column, gap: Column) -> Column:
    """Does this event cut, given the cuts made before it?"""
    last = F.try_element_at(cuts, F.lit(-1))
    return (
        (event["state"] != F.coalesce(last["state"], F.col("_state")))
        & (event["at"] >= F.coalesce(last["at"] + gap, F.col("_from")))
        & F.coalesce(last["restart"], F.lit(True))
    )


def _cuts_by_fold(owned: DataFrame, ids: list[str], gap: Column, max_cuts: int | None) -> DataFrame:
    """Walk the sorted events of one interval, carrying the cuts made so far."""
    log = F.array_sort(F.collect_list(_event()))
    logs = owned.groupBy(*ids).agg(
        log.alias("_log"), F.first("_state").alias("_state"), F.first("_from").alias("_from")
    )

    def step(cuts: Column, event: Column) -> Column:
        cut = _cuts_here(event, cuts, gap)
        if max_cuts is not None:
            cut = (F.size(cuts) < max_cuts) & cut
        return F.when(cut, F.array_append(cuts, event)).otherwise(cuts)

    return logs.select(
        *ids, F.aggregate("_log", F.array().cast(_CUTS), step).alias("_cuts")
    ).filter(F.size("_cuts") > 0)


def _cuts_by_doubling(
    owned: DataFrame, ids: list[str], gap: Column, max_cuts: int | None, limit: int
) -> DataFrame:
    """The same cuts as rows (``ids``, ``_at``, ``_state``), for intervals with too many events for one array.

    If an event cuts, the next cut is known from it alone: the first event at least ``gap`` later, or, if that
    has the same state, the next event with another one.  Both are found by ordered scans.  The chain that
    begins at the interval's start is then followed in steps of 1, 2, 4, ... cuts.
    """
    numbered = arrange(owned, ids, ["_at", "_seen", "_restart"], limit)
    numbered = numbered.running(_n=("sum", F.lit(1))).shift(_before=("_seen", -1))
    turns = F.col("_before").isNull() | (F.col("_before") != F.col("_seen"))
    numbered = numbered.following(_turn=F.when(turns, F.col("_n"))).df
    numbered = keep(numbered.select(*ids, "_at", "_seen", "_restart", "_state", "_n", "_turn"))
    event = F.struct("_n", "_seen", "_turn")
    first = numbered.filter("_n = 1").select(*ids, _differing(event, F.col("_state")).alias("_n")).filter("_n is not null")
    probes = numbered.filter("_restart").select(
        *ids, (F.col("_at") + gap).alias("_at"), F.lit(0).alias("_side"), "_n", "_seen", F.lit(None).cast("struct<_n:bigint,_seen:string,_turn:bigint>").alias("_event")
    )
    events = numbered.select(*ids, "_at", F.lit(1).alias("_side"), "_n", "_seen", event.cast("struct<_n:bigint,_seen:string,_turn:bigint>").alias("_event"))
    met = arrange(probes.unionByName(events), ids, ["_at", "_side", "_n"], limit).following(_first="_event")
    jumps = met.filter(F.col("_side") == 0).df.select(*ids, "_n", _differing(F.col("_first"), F.col("_seen")).alias("_next"))
    jumps, reached = keep(jumps.filter("_next is not null")), keep(first)
    taken = 1
    while max_cuts is None or taken < max_cuts:
        further = reached.join(jumps, [*ids, "_n"]).select(*ids, F.col("_next").alias("_n"))
        further = keep(further)
        if further.isEmpty():
            break
        reached = keep(reached.unionByName(further))
        beyond = jumps.select(*ids, F.col("_n").alias("_next"), F.col("_next").alias("_then"))
        jumps = keep(jumps.join(beyond, [*ids, "_next"]).select(*ids, "_n", F.col("_then").alias("_next")))
        taken *= 2
    cuts = numbered.join(reached, [*ids, "_n"], "left_semi").select(*ids, "_at", F.col("_seen").alias("_state"), "_n")
    if max_cuts is not None:
        ranked = arrange(cuts, ids, ["_n"], limit).running(_rank=("sum", F.lit(1)))
        cuts = ranked.filter(F.col("_rank") <= max_cuts).drop("_rank").df
    return cuts


def _differing(event: Column, state: Column) -> Column:
    """Number of the event, or of the next one with another state if this one has ``state``."""
    return F.when(event["_seen"] != state, event["_n"]).otherwise(event["_turn"])


def _pieces_of_many(
    intervals: DataFrame, cuts: DataFrame, ids: list[str], start: str, end: str, state: str, limit: int
) -> DataFrame:
    """One row per piece from cuts as rows."""
    begins = intervals.select(*ids, F.col(start).alias("_at"), F.col(state).alias("_state"), F.lit(0).alias("_n"))
    marks = arrange(begins.unionByName(cuts), ids, ["_n"], limit)
    marks = marks.running(piece=("sum", F.lit(1))).shift(_upto=("_at", 1))
    whole = intervals.drop(start, state).withColumnRenamed(end, "_end")
    rows = join_one(marks.df, whole, ids, "inner", limit)
    named = rows.withColumns(
        {start: F.col("_at"), end: F.coalesce("_upto", "_end"), state: F.col("_state"), "piece": (F.col("piece") - 1).cast("int")}
    )
    return named.select(*intervals.columns, "piece")


def _pieces(df: DataFrame, start: str, end: str, state: str) -> DataFrame:
    """One row per piece: a cut ends the piece before it and starts the next."""
    cuts = F.coalesce(F.col("_cuts"), F.array().cast(_CUTS))
    begin = F.struct(
        F.col(start).alias("at"), F.col(state).alias("state"), F.lit(True).alias("restart")
    )
    columns = [c for c in df.columns if c != "_cuts"]
    walked = df.withColumn("_marks", F.concat(F.array(begin), cuts)).select(
        *columns, F.posexplode("_marks").alias("piece", "_mark"), "_marks"
    )
    upto = F.try_element_at(F.col("_marks"), F.col("piece") + 2)["at"]
    last = F.col("piece") == F.size("_marks") - 1
    return walked.withColumns(
        {
            start: F.col("_mark.at"),
            end: F.when(last, F.col(end)).otherwise(upto),
            state: F.col("_mark.state"),
        }
    ).select(*columns, "piece")
