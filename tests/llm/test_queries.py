from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_points
from tableship.llm import queries as named
from tools.compare import connect, oracle_rows, rows_of


@pytest.mark.parametrize("name", list(named.ORACLES))
def test_queries_that_sql_can_express(spark, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    columns, wanted = oracle_rows(connect(SF_DIR), entry_points.oracle_sql()[name])
    assert sorted(df.columns) == columns
    assert rows_of(df) == wanted


def test_every_operator_has_its_query():
    names = list(entry_points.queries())
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert "pipeline" in names
