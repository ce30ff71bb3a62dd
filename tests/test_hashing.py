from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tableship.functions.hashing import fingerprint, row_hash


def hashes(df):
    return [r[0] for r in df.select(row_hash(df)).collect()]


def pair(spark, left: str, right: str):
    """Hashes of two rows of one column, given as SQL."""
    return hashes(spark.sql(f"SELECT * FROM VALUES ({left}), ({right}) AS t(c)"))


def test_null_position_matters(spark):
    a, b = hashes(spark.createDataFrame([(None, "a"), ("a", None)], "a string, b string"))
    assert a != b


@pytest.mark.parametrize(
    "left, right",
    [
        ("array(null, 1)", "array(1, null)"),
        ("array(1)", "array(1, null)"),
        ("CAST(array() AS ARRAY<INT>)", "CAST(null AS ARRAY<INT>)"),
        ("array(array(1), array(2))", "array(array(1, 2), array())"),
        ("array(array(), array(1))", "array(array(1), array())"),
        ("array('ab', 'c')", "array('a', 'bc')"),
        ("named_struct('x', null, 'y', 1)", "named_struct('x', 1, 'y', null)"),
        ("named_struct('x', null)", "CAST(null AS STRUCT<x: VOID>)"),
        ("array(named_struct('x', null, 'y', 1))", "array(named_struct('x', 1, 'y', null))"),
        ("map('a', null, 'b', 1)", "map('a', 1, 'b', null)"),
        ("map('a', 1)", "map('a', 1, 'b', null)"),
        ("array(map(1, array(1, null)))", "array(map(1, array(null, 1)))"),
        (
            "named_struct('t', TIMESTAMP'2024-01-01 00:00:00.000001')",
            "named_struct('t', TIMESTAMP'2024-01-01 00:00:00.000002')",
        ),
        ("parse_json('{\"a\": 1}')", "parse_json('{\"a\": 2}')"),
    ],
)
def test_different_values_hash_differently(spark, left, right):
    a, b = pair(spark, left, right)
    assert a != b


@pytest.mark.parametrize(
    "left, right",
    [
        ("map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)"),
        ("array(map('a', map(1, 2, 3, 4)))", "array(map('a', map(3, 4, 1, 2)))"),
        ("0.0D", "-0.0D"),
        ("parse_json('{\"a\": 1, \"b\": 2}')", "parse_json('{\"b\": 2, \"a\": 1}')"),
    ],
)
def test_equal_values_hash_alike(spark, left, right):
    a, b = pair(spark, left, right)
    assert a == b


def test_more_columns_than_one_bitmap_holds(spark):
    columns = [f"c{i}" for i in range(130)]
    schema = ", ".join(f"{c} int" for c in columns)
    rows = [tuple(None if i == hole else 7 for i in range(130)) for hole in (5, 6, 62, 63, 64, 129)]
    assert len(set(hashes(spark.createDataFrame(rows, schema)))) == len(rows)


def test_any_column_name(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a b", "a.b", "select", "tick`ed"])
    assert len(hashes(df)) == 1


def test_seeds_give_independent_hashes(spark):
    df = spark.range(100)
    both = df.select(row_hash(df).alias("a"), row_hash(df, seed=1).alias("b"))
    assert both.where("a = b").count() == 0


def test_fingerprint_ignores_order_and_partitioning(load):
    lineitem = load("lineitem")
    wanted = fingerprint(lineitem).first()
    assert fingerprint(lineitem.repartition(7)).first() == wanted
    assert fingerprint(lineitem.orderBy(F.rand(3))).first() == wanted
    assert wanted["row_count"] == 6000


def test_fingerprint_of_every_type_survives_parquet(spark, all_types, folder):
    all_types.write.parquet(f"{folder}/t")
    assert fingerprint(spark.read.parquet(f"{folder}/t")).first() == fingerprint(all_types).first()


def test_fingerprint_of_nothing(load):
    nothing = load("events").where("false")
    assert tuple(fingerprint(nothing).first()) == (0, 0)


def test_fingerprint_sum_does_not_overflow(spark):
    df = spark.range(1).select(F.lit("x").alias("c"))
    copies = spark.range(200_000).select(F.lit("x").alias("c"))
    one = fingerprint(df).first()["content_hash"]
    assert fingerprint(copies).first()["content_hash"] == one * 200_000
