"""Every registered query with an expected SQL result, at the smallest scale."""

import pytest

import __spark_entry__ as entry
import compare

EXPECTED = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


def test_every_expected_result_has_a_query():
    assert set(EXPECTED) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, folder, con, name):
    frame = entry.queries()[name](spark, folder)
    assert compare.difference(frame, con, EXPECTED[name]) is None


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns[:2] == ["rank", "claim_id"] and rows.count() > 0
