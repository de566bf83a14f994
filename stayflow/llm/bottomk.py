"""Bottom-k document fingerprints in DataFrame functions alone.

A fingerprint holds the ``k`` smallest distinct hashes of a text's word shingles.  Fingerprints of
parts merge into that of the whole; two of them estimate the resemblance and containment of their
shingle sets, one of them the number of distinct shingles.  Below ``k`` shingles all are exact.

Edge cases: a text with fewer words than a shingle is one shingle of all its words; a text without
words (null, empty) has an empty fingerprint, which resembles only another empty one.  Words are
taken as they are, split at ASCII space.  Repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

SPACE = r"[\x20\x09-\x0D]+"
K = 128
WORDS = 5
_HALF = 2.0**63


def shingle_hashes(text: Column | str, words: int = WORDS) -> Column:
    """Hashes (array<long>) of all shingles of ``words`` words, repeats included, in order."""
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    own = F.transform(tokens, lambda w: F.xxhash64(w))
    # a lambda over a one-element array names the words' hashes, so that they are computed once
    return F.element_at(F.transform(F.array(own), lambda hashes: _windows(hashes, words)), 1)


def _windows(hashes: Column, words: int) -> Column:
    size = F.size(hashes)
    many = F.transform(
        F.sequence(F.lit(0), size - words), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(words)])
    )
    few = F.array(F.xxhash64(F.array_join(hashes.cast("array<string>"), " ")))
    return F.when(size >= words, many).when(size > 0, few).otherwise(F.array().cast("array<bigint>"))


def smallest(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct values, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column | str, k: int = K, words: int = WORDS) -> Column:
    return smallest(shingle_hashes(text, words), k)


def merge(a: Column | str, b: Column | str, k: int = K) -> Column:
    """Fingerprint of two parts together; shingles across their border are not in it."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, sketch_column: str, k: int = K, salts: int = 64) -> DataFrame:
    """One fingerprint per key from those of its parts: rows (key, sketch).

    Hashes are cut to the smallest ``k`` per key and salt first, so a key with most parts is spread
    over ``salts`` tasks.  A key whose parts are all empty or null gets an empty fingerprint.
    """
    rows = parts.select(F.col(key).alias("key"), F.explode_outer(sketch_column).alias("hash"))
    rows = rows.groupBy("key", "hash").count().drop("count")
    for salt in (F.pmod("hash", F.lit(salts)), F.lit(0)):
        order = Window.partitionBy("key", "salt").orderBy(F.col("hash").asc_nulls_last())
        rows = rows.withColumn("salt", salt).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k)
        rows = rows.select("key", "hash")
    held = rows.groupBy("key").agg(F.sort_array(F.collect_list("hash")).alias("sketch"))
    return held.select(F.col("key").alias(key), F.col("sketch").alias(sketch_column))


def resemblance(a: Column | str, b: Column | str, k: int = K, both: Column | None = None) -> Column:
    """Estimate of the shingles in both over the shingles in either; 1 for two empty texts.

    ``both`` is their merged fingerprint, if it is at hand.
    """
    both = merge(a, b, k) if both is None else both
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both)).cast("double")


def distinct_shingles(a: Column | str, k: int = K) -> Column:
    """Estimate of the number of distinct shingles; exact below k."""
    a = F.col(a) if isinstance(a, str) else a
    last = (F.element_at(a, k).cast("double") + _HALF) / (2 * _HALF)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / last)


def containment(a: Column | str, b: Column | str, k: int = K, both: Column | None = None) -> Column:
    """Estimate of the share of a's shingles that are also in b; 1 for an empty a."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    both = merge(a, b, k) if both is None else both
    common = resemblance(a, b, k, both) * distinct_shingles(both, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def digits(a: Column | str) -> Column:
    """The fingerprint as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


_KNOTS, _STEP = 4096, 64  # quantiles of the ids, and how many are looked through at a time


def _place(docs: DataFrame, id_column: str) -> Column:
    """A double that never falls as the id rises; null for null."""
    kind = docs.schema[id_column].dataType
    if isinstance(kind, NumericType):
        return F.col(id_column).cast("double")
    if isinstance(kind, (StringType, BinaryType)):
        # the first six bytes
        head = F.substring(F.rpad(F.hex(F.col(id_column).cast("binary")), 12, "0"), 1, 12)
        return F.conv(head, 16, 10).cast("double")
    raise TypeError(f"ids must be numbers, texts or bytes, not {kind.simpleString()}")


def _cells(docs: DataFrame, per_cell: int) -> DataFrame:
    """``docs`` with columns ``_interval`` and ``_cell`` of consecutive places (``_place``), about ``per_cell`` rows in each.

    Quantiles, at most ``_KNOTS``, bound the intervals; an interval is cut into equal widths.  So ids that are spread
    unevenly, or a few that lie far off, change the sizes of cells inside one interval only.  No place: -1.
    """
    shares = [k / _KNOTS for k in range(_KNOTS + 1)]
    asked = docs.agg(F.percentile_approx("_place", shares, 10_000).alias("knots"), F.count("_place").alias("n")).first()
    apart = max(1, _KNOTS * per_cell // max(1, asked["n"]))  # fewer intervals where there are few rows
    knots = sorted(set((asked["knots"] or [0.0])[::apart]))
    parts = max(1, -(-asked["n"] // (per_cell * max(1, len(knots) - 1))))
    far = knots[-1] + max(1.0, abs(knots[-1]))
    held, coarse = (F.split(F.lit(",".join(map(repr, some))), ",").cast("array<double>") for some in (knots, knots[::_STEP]))
    place = F.coalesce("_place", F.lit(knots[0]))
    # one column after the other, so that each is computed once: a block of knots, the knot in it, the cell after it
    out = docs.withColumn("_block", F.greatest(F.lit(0), F.size(F.filter(coarse, lambda k: k <= place)) - 1) * _STEP)
    here = F.col("_block") + F.size(F.filter(F.slice(held, F.col("_block") + 1, _STEP), lambda k: k <= place)) - 1
    out = out.withColumn("_interval", F.greatest(F.lit(0), here).cast("long"))
    knot = F.col("_interval").cast("int")
    low, high = F.get(held, knot), F.coalesce(F.get(held, knot + 1), F.lit(far))
    inside = F.floor((place - low) / (high - low) * parts).cast("long")
    cell = F.least(F.greatest(inside, F.lit(0)), F.lit(parts - 1)) + F.col("_interval") * parts
    none = F.lit(-1).cast("long")
    unplaced = F.col("_place").isNull()
    out = out.withColumn("_cell", F.when(unplaced, none).otherwise(cell))
    return out.withColumn("_interval", F.when(unplaced, none).otherwise(F.col("_interval"))).drop("_block", "_place")


def with_next(
    docs: DataFrame, id_column: str, columns: list[str], derived: dict[str, Column] | None = None, per_cell: int = 1024
) -> DataFrame:
    """Add struct ``next``: ``columns`` of the row that follows by id (after the last: the first).

    ``derived`` columns are computed once per row and are part of ``next`` too.  Ids are numbers, texts or bytes; null
    ids come first and rows with one id follow each other by the hash of ``columns``.  Rows are dealt to
    cells of consecutive ids and ordered inside a cell; only the list of cells and the first row of each cell go
    beyond it.
    """
    derived = derived or {}
    placed = docs.select(id_column, *columns).withColumn("_place", _place(docs, id_column))
    narrow = _cells(placed, per_cell).withColumn("_tie", F.xxhash64(*columns))
    # dealt before the derived columns are made, so that the one shuffle of texts does not carry them
    dealt = narrow.repartition(F.col("_cell"))
    inside = Window.partitionBy("_cell").orderBy(F.col(id_column).asc_nulls_first(), F.col("_tie"))
    payload = F.struct(*columns, *derived)
    ordered = dealt.withColumns(derived).withColumn("_lead", F.lead(payload).over(inside))
    # the first row of each cell goes to the cell before it: the one before in the interval, or else the last
    # cell of the interval before, of which there are few
    cells = narrow.groupBy("_interval", "_cell").agg(F.count("*")).select("_interval", "_cell")
    in_interval = Window.partitionBy("_interval").orderBy("_cell")
    listed = Window.orderBy("_interval")
    every = listed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lasts = cells.groupBy("_interval").agg(F.max("_cell").alias("_last"))
    lasts = lasts.select("_interval", F.coalesce(F.lag("_last").over(listed), F.last("_last").over(every)).alias("_before"))
    cells = cells.join(lasts, "_interval").select("_cell", F.coalesce(F.lag("_cell").over(in_interval), "_before").alias("_prior"))
    firsts = dealt.withColumn("_at", F.row_number().over(inside)).filter("_at = 1").select("_cell", *columns)
    firsts = firsts.join(cells, "_cell").withColumns(derived)
    firsts = firsts.select(F.col("_prior").alias("_cell"), payload.alias("_head"))
    joined = ordered.join(firsts, "_cell", "left")
    return joined.withColumn("next", F.coalesce("_lead", "_head")).drop("_tie", "_interval", "_cell", "_lead", "_head")
