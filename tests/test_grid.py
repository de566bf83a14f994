"""Text grids."""

import pytest

from stayflow.sources.grid import read_grid_checked, clean_grid, clean_null_tokens, format_times, normalize_utc, read_grid, utc_columns

TEXT = """id\tname\tseen\tnote\tlater
1\tNULL\t2023-05-01T10:11:12.345+0000\tplain\tnone
2\tNull\t\tannul\t2023-05-01T10:11:12.345Z
3\tnan\t2023-05-02T23:59:59.999-0500\tNAN\t
"""


def grid_of(spark, tmp_path):
    path = tmp_path / "grid.tsv"
    path.write_text(TEXT)
    return read_grid(spark, str(path))


def test_grid(spark, tmp_path):
    df = grid_of(spark, tmp_path)
    assert set(dict(df.dtypes).values()) == {"string"}
    got = [tuple(r) for r in clean_grid(df).orderBy("id").collect()]
    assert got == [
        ("1", None, "05/01/2023 10:11:12", "plain", "none"),
        ("2", None, None, "annul", "2023-05-01T10:11:12.345Z"),
        # the offset is dropped, not applied
        ("3", None, "05/02/2023 23:59:59", None, None),
    ]


def test_one_cell_decides(spark, tmp_path):
    df = clean_null_tokens(grid_of(spark, tmp_path))
    assert utc_columns(df) == ["seen"]
    assert dict(normalize_utc(df).dtypes)["seen"] == "timestamp_ntz"
    assert utc_columns(df.filter("id = 2")) == ["later"]
    assert utc_columns(df.filter("id > 5")) == []


def test_short_times(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-05-01 07:08:09' AS t")
    assert format_times(df, ["t"]).first()["t"] == "5/1/2023 7:08"


def test_cells_that_are_no_time_are_kept(spark):
    rows = [("1", "2023-05-01T10:11:12.345Z"), ("2", "not yet known"), ("3", "2023-05-01 10:11"), ("4", " "), ("5", None)]
    df = spark.createDataFrame(rows, "id string, seen string")
    got = [r["seen"] for r in clean_grid(df, first_by=["id"]).orderBy("id").collect()]
    assert got == ["05/01/2023 10:11:12", "not yet known", "2023-05-01 10:11", None, None]
    with pytest.raises(Exception, match="no UTC time in column seen"):
        normalize_utc(df, first_by=["id"]).collect()
    assert [r["seen"] for r in normalize_utc(df.filter("id > '3'"), ["seen"]).collect()] == [None, None]


def test_ragged_records_are_rejected(spark, tmp_path):
    folder = tmp_path / "grids"
    folder.mkdir()
    (folder / "a.tsv").write_text('id\tname\tnote\n1\tx\ty\n2\tshort\n3\ta\tb\tc\n4\t"two\nlines"\t"a\ttab"\n')
    (folder / "b.tsv").write_text('id\tname\tnote\n5\t"q\tr"\n6\t\t\n')
    rows, rejects = read_grid_checked(spark, str(folder), line_breaks=True)
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "x", "y"), ("4", "two\nlines", "a\ttab"), ("6", None, None)]
    assert sorted(tuple(r) for r in rejects.collect()) == [("2\tshort", 2), ("3\ta\tb\tc", 4), ('5\t"q\tr"', 2)]
    plain, bad = read_grid_checked(spark, str(folder / "b.tsv"))
    assert plain.count() == 1 and bad.count() == 1
