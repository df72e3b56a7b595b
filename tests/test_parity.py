"""Every registered query against its DuckDB SQL on the driver's tables."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK
from tests.parity import compare

ORACLE_NAMES = sorted(E.oracle_sql())
# numbered operators and the pipeline have brute-force tests of their own instead of SQL
ROWS_ONLY = sorted(n for n in set(E.queries()) - set(E.oracle_sql()) if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_query_matches_sql(spark, name):
    rep = compare(spark, SF_CHECK, [name], verbose=False)[name]
    assert "error" not in rep, rep.get("error")
    assert rep["rows"] == rep["oracle_rows"]
    assert rep["cols_match"], rep.get("cols")
    assert rep["values_match"], rep.get("first_diffs")


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_returns_rows(spark, name):
    rep = compare(spark, SF_CHECK, [name], verbose=False)[name]
    assert "error" not in rep, rep.get("error")
    assert rep["rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["market", "n_orders", "avg_delivery_days", "sum_sales"]
