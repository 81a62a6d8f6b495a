"""Every registered query with oracle SQL equals DuckDB on sf0.001."""
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare, duck

OWN = {n for n in E.queries() if n == "pipeline" or re.match(r"op\d+_", n)}  # tests/llm
ORACLE = sorted(set(E.oracle_sql()) - OWN)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLE) - OWN))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and all(any(v is not None for v in r) for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "risk_level" in df.columns
