"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

from stayflow.limits import limit as session_limit


@dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than one task may hold: ``table`` has the key columns and ``_rows``."""

    table: DataFrame
    keys: int
    rows: int


def hot_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> HotKeys | None:
    """Count rows per key (combined before the shuffle) and keep the keys above ``limit``."""
    bound = limit or session_limit(df.sparkSession, "rowsPerTask")
    table = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > bound)
    total = table.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    return HotKeys(table, total["keys"], total["rows"]) if total["keys"] else None


def even(known, keys: list[str]) -> bool:
    """Is it known that no key is hot?

    ``known`` is True where the rows per key are few by construction (such as one row per key), or
    an arranged table on the same keys that has at least about as many rows of every key.
    """
    if known is None or known is True:
        return bool(known)
    return known.segments is None and known.keys == keys


def may_broadcast(df: DataFrame, rows: int) -> bool:
    """Is a side of that many rows small enough to be sent to every task, by rows and by bytes?

    The width of a row is taken from the types: variable ones count ``stayflow.bytesPerText``.
    """
    spark = df.sparkSession
    if rows > session_limit(spark, "broadcastRows"):
        return False
    text = session_limit(spark, "bytesPerText")
    width = sum(8 if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, (StringType, BinaryType)) else text for f in df.schema)
    return rows * width <= session_limit(spark, "broadcastBytes")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side known to have at most ``rows`` rows, if that is few enough."""
    return F.broadcast(df) if may_broadcast(df, rows) else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in a window partition."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    test = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    )
    out = left.join(renamed, test, how)
    if how in ("left_semi", "left_anti"):
        return out
    return out.drop(*[f"_right_{k}" for k in keys])


def join_one(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    limit: int | None = None,
    known=None,
) -> DataFrame:
    """Join to a side with few rows per key.

    Rows of a hot left key are spread over several tasks by a hash of the row and the matching
    right rows are repeated once per task; all other keys join as usual.
    With ``known`` (see :func:`even`) the rows per key are not counted again.
    """
    hot = None if even(known, keys) else hot_keys(left, keys, limit)
    if hot is None:
        return left.join(right, keys, how)
    bound = limit or session_limit(left.sparkSession, "rowsPerTask")
    shares = small(
        hot.table.select(*keys, F.ceil(F.col("_rows") / bound).cast("int").alias("_shares")),
        hot.keys,
    )
    spread = (
        join_null_safe(left, shares, keys, "left")
        .withColumn(
            "_share", F.expr(f"pmod(xxhash64({_quoted(left.columns)}), coalesce(_shares, 1))")
        )
        .drop("_shares")
    )
    repeated = (
        join_null_safe(right, shares, keys, "left")
        .withColumn("_share", F.explode(F.expr("sequence(0L, coalesce(_shares, 1) - 1L)")))
        .drop("_shares")
    )
    return spread.join(repeated, [*keys, "_share"], how).drop("_share")


def join_dim(df: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join to a dimension with one row per key: broadcast once its size is known to be small."""
    if may_broadcast(dim, dim.count()):
        return df.join(F.broadcast(dim), keys, how)
    return join_one(df, dim, keys, how)


def _quoted(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def without(df: DataFrame, keys_df: DataFrame, keys: list[str], known=None) -> DataFrame:
    """Rows whose key is not in ``keys_df``."""
    return join_one(df, keys_df.select(*keys).distinct(), keys, "left_anti", known=known)


def within(df: DataFrame, keys_df: DataFrame, keys: list[str], known=None) -> DataFrame:
    """Rows whose key is in ``keys_df``."""
    return join_one(df, keys_df.select(*keys).distinct(), keys, "left_semi", known=known)


def only_keys(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows of a large table whose ``key`` is listed.  ``listed`` should be a kept table: it is read twice.

    The list's bounds are pushed into the scan of ``df``.  A list known to be small is sent to every task; a long
    one is joined by key, where Spark can drop most rows before the shuffle by a Bloom filter of the list and
    splits hot keys itself.
    """
    names = listed.select(key).filter(F.col(key).isNotNull())
    rows, low, high = names.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    if not rows:
        return df.filter(F.lit(False))
    bounds = F.col(key).between(F.lit(low), F.lit(high))
    names = names.filter(bounds)
    return df.filter(bounds).join(F.broadcast(names) if may_broadcast(names, rows) else names, key, "left_semi")


def flag_if_exists(
    df: DataFrame,
    keys_df: DataFrame,
    keys: list[str],
    name: str,
    old: Column | None = None,
    known=None,
) -> DataFrame:
    """Set ``name`` to 1 where the key occurs in ``keys_df``; elsewhere keep ``old`` (default 0)."""
    marked = keys_df.select(*keys).distinct().withColumn("_found", F.lit(True))
    base = F.lit(0) if old is None else old
    return (
        join_one(df, marked, keys, "left", known=known)
        .withColumn(name, F.when(F.col("_found"), F.lit(1)).otherwise(base))
        .drop("_found")
    )


def merge_columns(
    base: DataFrame, delta: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Take ``columns`` from the matching ``delta`` row; rows without a match keep their values.

    ``delta`` must hold one row per key.
    """
    new = delta.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched")
    )
    out = join_one(base, new, keys, "left")
    return out.withColumns(
        {c: F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    ).drop("_matched", *[f"_new_{c}" for c in columns])


def join_any_key(
    left: DataFrame, right: DataFrame, key: str, right_keys: list[str], how: str = "inner"
) -> DataFrame:
    """Rows of ``left`` whose ``key`` equals any of several columns of ``right``.

    One row per distinct value of the alternative columns, then an equi-join: no OR condition and
    no pair twice.  Values are compared in the common type of the columns.  Hot values are spread
    on the side that repeats them: the right one where ``left`` has few rows per key.
    """
    options = F.array_distinct(F.array(*[F.col(c) for c in right_keys]))
    tall = right.withColumn("_any_key", F.explode(options)).filter("_any_key is not null")
    named = left.withColumn("_any_key", F.col(key))
    if how in ("left_semi", "left_anti"):
        return join_one(named, tall.select("_any_key").distinct(), ["_any_key"], how).drop("_any_key")
    if how == "inner" and hot_keys(named, ["_any_key"]) is None:
        # the left side has few rows per key, so it may be repeated for the shares of a hot right key
        found = join_one(tall, named, ["_any_key"], how)
        return found.select(*[F.col(c) for c in left.columns], *[F.col(c) for c in right.columns])
    return join_one(named, tall, ["_any_key"], how).drop("_any_key")


def flatten_hierarchy(
    leaf: DataFrame, levels: list[tuple[DataFrame, str, str, dict[str, str]]]
) -> DataFrame:
    """Walk up a hierarchy once.

    Each level is ``(table, child_column, parent_key, {source: name})``: the child column of what
    has been joined so far, the key it points at, and the columns to bring along.  Missing parents
    leave NULLs.
    """
    out = leaf
    for depth, (table, child, key, take) in enumerate(levels):
        at = f"_level_{depth}"
        parent = table.select(F.col(key).alias(at), *[F.col(s).alias(n) for s, n in take.items()])
        out = out.join(parent, F.col(child) == F.col(at), "left").drop(at)
    return out


def multi_class_keys(
    df: DataFrame, keys: list[str], label: Column, where: Column | None = None
) -> DataFrame:
    """Keys seen with more than one label.  Deduplicates before counting, so hot keys stay small."""
    rows = df if where is None else df.filter(where)
    pairs = rows.select(*keys, label.alias("_label")).distinct()
    return pairs.groupBy(*keys).agg(F.count("_label").alias("_n")).filter("_n > 1").drop("_n")


def only_code(
    charges: DataFrame, key: str, code: str, amount: str, only: str, excluded: list[str]
) -> DataFrame:
    """Keys with a positive net amount on ``only`` and no row at all on an excluded code."""
    named = charges.filter(F.col(code).isin([only, *excluded]))  # before the shuffle
    sums = named.groupBy(key).agg(
        F.sum(F.when(F.col(code) == only, F.col(amount))).alias("_net"),
        F.max(F.when(F.col(code).isin(excluded), 1)).alias("_other"),
    )
    return sums.filter((F.col("_net") > 0) & F.col("_other").isNull()).select(key)
