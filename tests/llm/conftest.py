"""Rows that all tests of the corpus operators share."""

import pytest

from llm_rows import DATA, ROW, rows_of, words


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty texts, texts without words, repeats, a repeated row, a repeated id, a missing id, a very long text."""
    base = words(1, 120)
    near = " ".join(["other"] + base.split()[1:])
    texts = [(0, base), (1, base), (2, near), (3, None), (4, ""), (5, " \n\t "), (6, "!!! 123"), (7, words(2, 4)), (8, words(3, 40_000)),
             (9, words(4, 80)), (9, words(5, 80)), (None, base), (None, None), (10, words(6, 90)), (10, words(6, 90))]
    return spark.createDataFrame(rows_of(texts), ROW)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ROW)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
