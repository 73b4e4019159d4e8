"""Every query with a SQL oracle must match DuckDB on the smoke tables (schema, rows, values)."""

import pytest

from faro.plans.oracle import compare
from faro.plans.registry import all_queries

from .conftest import SMOKE

ORACLE = sorted(n for n, q in all_queries().items() if q.sql is not None)


@pytest.mark.parametrize("name", ORACLE)
def test_matches_sql_oracle(spark, duck_smoke, name):
    res = compare(spark, duck_smoke, all_queries()[name], SMOKE)
    assert res["status"] == "ok", res
