"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from spendloom import tallies
from spendloom.checks.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    with tallies.collected() as found:
        df = entry.queries()[name](spark, sf_dir)
    assert compare(df, con, entry.oracle_sql()[name]) is None
    # Whatever a load reads or stages, no row is lost or made up on the way.
    assert all(t.balanced for t in found), list(map(str, found))
    if name.startswith("pipe_") and name != "pipe_linkedin_variant":  # which plans a batch and loads nothing
        assert sum(t.landed for t in found) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["PAID_SOCIAL", "MARKETING_PLATFORM", "AD_DATE"]
    assert df.count() > 0
