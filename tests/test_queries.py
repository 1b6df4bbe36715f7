"""Every registered query against its SQL."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as entry_point
from workload.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, connection):
    assert_same(QUERIES[name](spark, sf_dir), connection, ORACLES[name])


def test_entry(spark):
    report = entry_point.entry(spark)
    assert len(report.columns) == 31 and report.count() > 0
