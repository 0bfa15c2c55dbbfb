"""Every query of the core registry against its SQL form on the smallest data.

The training-data queries of ``dimstar.llm`` are tested in tests/llm.
"""

import pytest

import __spark_entry__ as entry
from dimstar.registry import QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    assert difference(df, duck, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
