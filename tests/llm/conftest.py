import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing column names."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, id string, uid string, row string, size string"
    long_text = " ".join(f"word{k % 977} and, more text{k % 13}" for k in range(20_000))
    rows = [
        (1, "The cat sat on the mat. It was happy, and so was I.\nThe end.", "en", "a"),
        (2, "The cat sat on the mat. It was happy, and so was I.\nThe end.", "en", "a"),
        (2, "The cat sat on the mat. It was happy, and so was I.\nThe end.", "en", "a"),
        (3, "", "en", "b"),
        (4, None, None, None),
        (None, "no id here at all, but five words", "en", "b"),
        (None, None, None, None),
        (5, " \n\t ", "en", "a"),
        (6, long_text, "en", "a"),
        (7, long_text + " tail", "en", "b"),
        (8, "one", "en", None),
        (9, "ALL CAPS!! SHOUT!! SHOUT!! SHOUT!! SHOUT!!", "en", "b"),
        (10, "Ünïcödé ▁ 日本語 🙂 <s> \x00 end", "xx", "c"),
    ]
    rows = [(*r, None if r[1] is None else len(r[1]), 0.5, "x", "u", "r", "s") for r in rows]
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def none(awkward):
    """The same columns without rows."""
    return awkward.filter("false")
