"""Every registered query against its SQL oracle on the smallest tables."""

import os

import pytest
from oracle import TESTDATA, compare, duck

from tillworks.plans import load_all

SF = f"{TESTDATA}/sf{os.environ.get('TILLWORKS_SF', '0.001')}"
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, _ = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert message is None, message


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:5] == ["transaction_date", "week", "month", "year", "outlet_code"]
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
