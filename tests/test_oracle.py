"""Every registered query with an oracle equals its DuckDB SQL (order-insensitive) on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    import compare

    return compare.duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 55


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    import compare

    r = compare.compare(spark, duck, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "churn_probability", "churn_label", "churn_decile", "risk_tier"]
