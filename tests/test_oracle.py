"""Every registered query against its SQL equivalent."""

import checking
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyport.plans import star
from tallyport.registry import runs
from tallyport.registry.oracle import ORACLE
from tallyport.registry.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return checking.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, con):
    assert checking.mismatch(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_points_hold_all():
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_storage_report_counts_files(spark, sf_dir):
    rows = {r["table_name"]: r for r in star.storage_report(runs.trip_house(spark, sf_dir)).collect()}
    assert all(r["files"] > 0 and r["bytes"] > 0 for r in rows.values())
    assert rows["trips_wide"]["share_of_wide"] == 1.0 and rows["fact_trip"]["share_of_wide"] < 1.0


def test_entry(spark):
    assert entry(spark).count() > 0
