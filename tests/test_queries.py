"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_points
from tableship.plans import queries as named
from tools.compare import connect, oracle_rows, rows_of


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(named.QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    columns, wanted = oracle_rows(duck, entry_points.oracle_sql()[name])
    assert sorted(df.columns) == columns
    assert rows_of(df) == wanted


def test_entry(spark):
    report = entry_points.entry(spark)
    assert report.count() == 8 and report.where("NOT passed").isEmpty()
