"""Corpus queries against the SQL that states their results, and SQL on rows that are no easy ones."""

import zlib

import pytest

from stayflow.llm import queries
from stayflow.llm.sql import SQL, crc32

from ..oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    problem, n = compare(spark, connect(FOLDER), FOLDER, queries.QUERIES[name], SQL[name])
    assert problem is None and n > 0


def test_crc_in_sql():
    con = connect(FOLDER)
    for text in ("0", "12é:abc", "日本" * 20, "-7"):
        assert con.execute(f"SELECT {crc32('?')}".replace("?", "$1"), [text]).fetchone()[0] == zlib.crc32(text.encode())


def test_links_in_sql(spark, tmp_path):
    """Vectors that link, chains of links, and vectors that link with nothing."""
    import duckdb

    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.2, 0.0]), (3, [1.0, 0.5, 0.0]), (4, [0.0, 0.0, 1.0]), (5, [0.0, 0.0, 2.0])]
    rows += [(6, [0.0, 0.0, 0.0]), (7, None), (8, [1.0, float("nan"), 0.0]), (9, [1.0, 0.0, None]), (10, [1e-200, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = {r[0]: r[1:3] for r in con.sql(SQL["op6_embeddings"]).fetchall()}
    assert got[1][1] == got[2][1] == got[3][1] == 1 and got[2][0] >= 2 and got[4] == got[5] == (1, 4)
    assert all(got[k] == (0, k) for k in (6, 7, 8, 9))
