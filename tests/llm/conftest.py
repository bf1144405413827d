import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i} of a very long text." for i in range(20_000))
EDGE = [
    (1, "one two three four five six seven eight nine ten eleven", "a"),
    (1, "one two three four five six seven eight nine ten eleven", "a"),
    (2, None, "a"), (3, "", None), (4, " \t\n ", "b"), (5, LONG, "a"), (6, LONG, "b"),
    (None, "a row without an id", None), (7, "\u00e9t\u00e9 \u4e2d\u6587 \U0001f600 \u00c9T\u00c9\u00a0x", "b"),
    (8, "same text", "a"), (9, "same text", "b"), (9, "other text", "b"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, names that operators use inside."""
    schema = ("doc_id long, text string, source string, `row` string, id long, h long, size long, kept string, bucket int, "
              "cls string, n int, `a.b` int, verdict string, host string")
    return spark.createDataFrame([(*r, "r", 5, 6, 7, "k", 8, "c", 9, 10, None, "h") for r in EDGE], schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
