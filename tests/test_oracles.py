"""Every query against its SQL oracle over the whole tables."""

import pytest

import __spark_entry__ as entry
from compare import differences, oracle_connection
from quakeloom.plans.catalog import QUERIES
from quakeloom.plans.oracles import ORACLES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    # a fitted forest: tests/test_learning.py walks its tables with the other engine
    assert set(QUERIES) - set(ORACLES) == {"rf_importance", "rf_scored"} and set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, oracle, name):
    found = differences(entry.queries()[name](spark, SF), oracle, entry.oracle_sql()[name])
    assert found is None, found


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["severity", "description", "lat", "lon", "eq_count", "eonet_count", "multi_type", "max_mag"]
    assert df.count() == 1
