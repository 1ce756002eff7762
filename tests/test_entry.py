"""All registered queries against their SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry_point
from tools import check_oracles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_oracles.connect(FOLDER)


def test_flagship(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(entry_point.queries()))
def test_query(spark, duck, name):
    ours, theirs = check_oracles.both(spark, duck, FOLDER, name)
    assert len(ours)
    if theirs is not None:
        assert check_oracles.same(ours, theirs), (ours.head(), theirs.head())
