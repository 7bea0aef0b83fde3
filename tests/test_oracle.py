"""Every query with a DuckDB statement gives the same rows, names and types."""

import check
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return check.duck(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, small, name):
    same, note, _ = check.compare(spark, db, name, small)
    assert same, note


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    import oracles

    assert set(oracles.statements()) <= set(entry.queries())
