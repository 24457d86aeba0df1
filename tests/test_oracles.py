"""Every registered query equals its SQL oracle (run by DuckDB) at sf0.001."""

import pytest

import __spark_entry__ as entry
from starloom.plans import ORACLES, QUERIES, load_all
from tests.conftest import SMALL
from tools.compare import compare, duck

load_all()  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert info["ok"], info


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "returned_share" in df.columns
