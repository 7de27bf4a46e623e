"""Fixtures of the operators' tests, imported by name (a second conftest would hide the first)."""

import pytest

from starmill.llm.texts import send_package

LONG = "lorem ipsum dolor " * 3000
AWKWARD = [(1, "hello world's end"), (1, "hello world's end"), (2, None), (3, ""), (4, "  \n\t "), (5, LONG),
           (None, "no id here"), (7, "naïve café 東京 🎉🎉 <|endoftext|> 12345 x1"), (8, "a" * 3000)]


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    send_package(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that operators use themselves."""
    rows = [(i, t, "x", "y", 1, 2.0, "z") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, sid string, n_tokens int, score double, spans string")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
