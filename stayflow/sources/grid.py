"""Clean-up of text grids exported by query tools.

A grid is a DataFrame of string columns, as read by :func:`read_grid`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stayflow.sources.scratch import keep

# Whole-cell texts that stand for an empty cell.
NULL_TOKENS = ("NULL", "nan")


def read_grid(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """Read an exported grid as text only; nothing is inferred."""
    return spark.read.csv(path, header=True, inferSchema=False, sep=separator)


_RECORD = "_record"


def read_grid_checked(
    spark: SparkSession,
    path: str,
    separator: str = "\t",
    names: list[str] | None = None,
    line_breaks: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows of an exported grid, and the records that have too few or too many cells.

    Columns are named by the header line, or by ``names`` where files have none.  A rejected record comes as it
    stands in the file (``record``) with its number of cells (``cells``).  ``line_breaks`` lets quoted cells hold
    line breaks; a file is then read by one task, so large exports should come as several files.
    The files are parsed once: what has been parsed is kept, and both results read it.
    """
    options = {"sep": separator, "header": names is None, "multiLine": line_breaks}
    names = names or spark.read.csv(path, inferSchema=False, **options).columns
    schema = StructType([StructField(n, StringType()) for n in [*names, _RECORD]])
    parsed = keep(
        spark.read.schema(schema)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, enforceSchema=True, **options)
        .csv(path)
    )
    record = F.col(_RECORD)
    # separators inside quotes are no ends of cells
    bare = F.regexp_replace(record, '"[^"]*"', "")
    cells = F.size(F.split(bare, f"\\Q{separator}\\E", -1))
    return (
        parsed.filter(record.isNull()).drop(_RECORD),
        parsed.filter(record.isNotNull()).select(record.alias("record"), cells.alias("cells")),
    )


def clean_null_tokens(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Empty every cell that consists of a null token, in any case."""
    lowered = [t.lower() for t in tokens]
    return df.select(
        *[F.when(~F.lower(F.col(c)).isin(lowered), F.col(c)).alias(c) for c in df.columns]
    )


def utc_columns(df: DataFrame, first_by: list[str] | None = None) -> list[str]:
    """Columns whose first data cell looks like a UTC timestamp.

    Only that one cell decides: ``T`` at place 11 and ``+`` or ``Z`` at place 24.  The first row is
    the first one read, or the smallest by ``first_by``.
    """
    head = (df.orderBy(*first_by) if first_by else df).first()
    if head is None:
        return []
    return [
        c
        for c in df.columns
        if isinstance(head[c], str) and head[c][10:11] == "T" and head[c][23:24] in ("+", "Z")
    ]


def _utc_time(c: str):
    return F.try_to_timestamp(
        F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8)),
        F.lit("yyyy-MM-dd HH:mm:ss"),
    ).cast("timestamp_ntz")


def _blank(c: str):
    tokens = [t.lower() for t in NULL_TOKENS]
    return F.col(c).isNull() | (F.trim(c) == "") | F.lower(F.col(c)).isin(tokens)


def normalize_utc(
    df: DataFrame, columns: list[str] | None = None, first_by: list[str] | None = None
) -> DataFrame:
    """Turn UTC text columns into timestamps.

    Date and time of day are taken as written: fraction and offset are dropped, not applied.
    Blank cells and null tokens are empty.  A cell that is no such time stops the run and is named in the error.
    """
    found = utc_columns(df, first_by) if columns is None else columns
    wrong = "no UTC time in column {}: "
    return df.withColumns(
        {
            c: F.when(_blank(c), F.lit(None).cast("timestamp_ntz")).otherwise(
                F.coalesce(
                    _utc_time(c),
                    F.raise_error(F.concat(F.lit(wrong.format(c)), F.col(c))).cast("timestamp_ntz"),
                )
            )
            for c in found
        }
    )


def format_utc(df: DataFrame, columns: list[str]) -> DataFrame:
    """Show converted timestamps as ``MM/dd/yyyy HH:mm:ss``."""
    return df.withColumns({c: F.date_format(c, "MM/dd/yyyy HH:mm:ss") for c in columns})


def format_times(df: DataFrame, columns: list[str]) -> DataFrame:
    """Show timestamps as ``M/d/yyyy H:mm``."""
    return df.withColumns({c: F.date_format(c, "M/d/yyyy H:mm") for c in columns})


def clean_grid(df: DataFrame, first_by: list[str] | None = None) -> DataFrame:
    """Empty null tokens, then show the UTC columns as times, as one projection each.

    Cells of such a column that are no UTC time keep their text.
    """
    cleaned = clean_null_tokens(df)
    shown = {
        c: F.when(
            ~_blank(c), F.coalesce(F.date_format(_utc_time(c), "MM/dd/yyyy HH:mm:ss"), F.col(c))
        )
        for c in utc_columns(cleaned, first_by)
    }
    return cleaned.withColumns(shown)
