"""Every registered query against its DuckDB oracle at sf0.01, and the
driver contract of ``__spark_entry__``."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from oracle_harness import compare, duck

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    from forumlens.plans.registry import queries
    assert set(queries()) <= set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Id", "Title", "PositiveAnswerCount"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, QUERIES[key], ORACLE[key], SF_ORACLE, con)
    assert r["status"] == "match", r
