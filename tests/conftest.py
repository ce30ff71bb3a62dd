from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import DataFrame, SparkSession

from tableship.session import get_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = get_session(
        "tableship-tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def load(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture
def folder(tmp_path) -> str:
    return str(tmp_path)


@pytest.fixture
def table_name() -> str:
    return f"tableship_tests.t_{uuid.uuid4().hex[:12]}"


@pytest.fixture
def all_types(spark) -> DataFrame:
    """Three rows of every kind of column a table may carry: filled, other values, nulls."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(
        """
        SELECT * FROM VALUES
          (true, 1Y, 2S, 3, 4L, 1.5F, -0.0D, CAST('12345678901234567890.0123456789' AS DECIMAL(38,10)),
           'text', X'00FF', DATE'2024-02-29', TIMESTAMP'2024-01-01 12:00:00.123456',
           TIMESTAMP_NTZ'2024-01-01 12:00:00.123456', INTERVAL '1' DAY, array(1, null, 3),
           map('a', 1, 'b', null), named_struct('x', 1, 'y', array('p', null))),
          (false, -1Y, -2S, -3, -4L, -1.5F, 2.5D, CAST(-1 AS DECIMAL(38,10)),
           '', X'', DATE'1970-01-01', TIMESTAMP'1969-12-31 23:59:59',
           TIMESTAMP_NTZ'1969-12-31 23:59:59', INTERVAL '-2' DAY, array(),
           map(), named_struct('x', null, 'y', array())),
          (null, null, null, null, null, null, null, null, null, null, null, null, null, null, null,
           null, null)
        AS t(bool, i8, i16, i32, i64, f32, f64, dec, str, bin, day, ts, ts_ntz, iv, arr, mp, st)
        """
    )


@pytest.fixture
def instances(spark) -> DataFrame:
    """A time-ordered table with a unique id; ``updated_by`` is not a time."""
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, start + dt.timedelta(hours=7 * (i // 2)), f"user{i % 3}", None if i % 5 else "open")
        for i in range(40)
    ]
    return spark.createDataFrame(
        rows, "id bigint, created_on timestamp, updated_by string, status string"
    )


def bag(df: DataFrame) -> list[str]:
    return sorted(repr(r) for r in df.collect())


def assert_same_rows(left: DataFrame, right: DataFrame) -> None:
    """Equal schemas, and equal rows with copies counted."""
    assert [(f.name, f.dataType.simpleString()) for f in left.schema] == [
        (f.name, f.dataType.simpleString()) for f in right.schema
    ]
    assert bag(left) == bag(right)


def plan_of(df: DataFrame) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


__all__ = ["SF_DIR", "assert_same_rows", "bag", "plan_of"]
