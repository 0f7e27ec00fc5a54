import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ", ".join([DOCS, "_id long, _print long, size long, kept boolean, row long, v long, label string, hits int, n_words int, start int, begin int"])


@pytest.fixture(scope="session")
def hard(spark):
    """Missing cells, empty and long texts, ties, repeated rows and columns with clashing names."""
    long_text = " ".join(f"w{i % 4001}" for i in range(60_000))
    base = " ".join(f"tok{i}" for i in range(80))
    rows = [
        (1, base, "en", "b"), (2, base.replace("tok7 ", "other "), "en", "b"), (3, base, "fr", None), (3, base, "fr", None),
        (4, None, None, "a"), (5, "", "en", ""), (6, "   \n\t ", "de", "a"), (7, "!!! ???", "de", "a"), (8, long_text, "en", "b"),
        (9, "one two", "en", "c"), (10, "One  TWO", "en", "c"), (11, "你好 été 12", "fr", "é"), (12, long_text + " end", "en", "b"),
        (None, "no id here", "en", "b"), (13, "x" * 200_000, "en", "z"), (14, "12 34", "en", "z"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, 1, 1, True, 1, 1, "x", 1, 1, 1, 1) for r in rows], ODD)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*(columns or ("doc_id", "text"))).collect()]
