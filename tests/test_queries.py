"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as e
from compare import compare, duck
from lexitrack.testbed import oracle

SF = "/root/testdata/sf0.001"
EMPTY_AT_THIS_SCALE = {"history_for_word"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    problem = compare(spark, con, name, SF)
    if name in EMPTY_AT_THIS_SCALE and problem == "both empty":
        problem = None
    assert problem is None


def test_every_query_has_sql():
    from_llm = set(e._llm_queries())
    assert set(e.queries()) - from_llm == set(oracle.oracle_sql())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry(spark):
    rows = e.entry(spark).collect()
    assert [r["level"] for r in rows] == ["N1", "N2", "N3"]
