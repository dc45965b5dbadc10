"""Every registered query runs on sf0.001 and equals its DuckDB oracle
(the driver does the same at sf0.01); streaming keys are in test_streaming."""

import pytest

import __spark_entry__ as E
from relcheck import plans
from tests.compare import compare, duck
from tests.conftest import SF

KEYS = [k for k in plans.queries() if not k.startswith("acl_stream_")]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_key_has_oracle():
    missing = set(E.queries()) - set(E.oracle_sql())
    assert {k for k in missing if not k.startswith("op") and k != "pipeline"} == set()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    assert compare(df, con, E.oracle_sql()[key]) == []
