import pytest

SMALL = "/root/testdata/sf0.001"
# Columns of other jobs, named like columns that the operators use inside.
CLASHING = "k1 string, id string, row string, line string, n int, score string, component string"

EDGES = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"),
    (6, "Same line\nsame line \n\nend"), (6, "Same line\nsame line \n\nend"),
    (None, "text without an id"), (None, None), (7, "word " * 60_000), (8, "a" * 150_000),
    (9, "\n" * 3000), (10, "é日本 \U0001f600 'll don't  x\r\n\x00  "),
    (11, "0 1 2 3 !!! ###"), (12, "the cat sat on the mat"), (13, "the cat sat on the mat"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with clashing names."""
    names = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    rows = [(i, t, None, None, None, "k", "i", "r", "l", 1, "s", "c") for i, t in EDGES]
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
