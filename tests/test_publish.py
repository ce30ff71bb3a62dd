from __future__ import annotations

import glob

import pytest
from conftest import assert_same_rows
from pyspark.sql import functions as F

import tableship as ts
from tableship.sources.resolve import EmptySourceError


def test_publish_and_replace(spark, load, folder, table_name):
    orders = load("orders")
    first = ts.publish_table(
        spark, table_name, frame=orders.limit(100), root=folder, version="v1", properties={"purpose": "x"}
    )
    old = spark.table(table_name)
    assert old.count() == 100
    second = ts.publish_table(spark, table_name, frame=orders, root=folder, version="v2")
    assert_same_rows(spark.table(table_name), orders)
    properties = ts.table_properties(spark, table_name)
    assert properties["purpose"] == "x" and properties["tableship.version"] == "v2"
    assert first != second and spark.read.parquet(first).count() == 100


def test_publishing_a_path_moves_nothing(spark, load, folder, table_name):
    load("region").write.parquet(f"{folder}/r")
    before = glob.glob(f"{folder}/**", recursive=True)
    assert ts.publish_table(spark, table_name, path=f"{folder}/r") == f"{folder}/r"
    assert glob.glob(f"{folder}/**", recursive=True) == before
    assert_same_rows(spark.table(table_name), load("region"))


def test_changed_schema(spark, load, folder, table_name):
    ts.publish_table(
        spark, table_name, frame=load("region"), root=folder, version="v1", properties={"purpose": "x"}
    )
    wider = load("region").withColumn("more", F.lit(1.5))
    ts.publish_table(spark, table_name, frame=wider, root=folder, version="v2")
    assert_same_rows(spark.table(table_name), wider)
    assert ts.table_properties(spark, table_name)["purpose"] == "x"
    assert spark.read.parquet(f"{folder}/{table_name}/v1").count() == 5


def test_managed_table_is_put_aside(spark, load, folder, table_name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tableship_tests")
    load("nation").write.saveAsTable(table_name)
    ts.publish_table(spark, table_name, frame=load("region"), root=folder)
    assert_same_rows(spark.table(table_name), load("region"))
    database, name = table_name.split(".")
    kept = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{name}__old")]
    assert len(kept) == 1 and spark.table(f"{database}.{kept[0]}").count() == 25


def test_failed_publish_leaves_the_old_version(spark, load, folder, table_name):
    ts.publish_table(spark, table_name, frame=load("region"), root=folder, version="v1")
    with pytest.raises(EmptySourceError):
        ts.publish_table(spark, table_name, frame=load("region").where("false"), root=folder, version="v2")
    wider = load("region").withColumn("more", F.lit(1))
    with pytest.raises(Exception, match="reserved"):
        ts.publish_table(
            spark, table_name, frame=wider, root=folder, version="v3", properties={"owner": "x"}
        )
    assert_same_rows(spark.table(table_name), load("region"))


def test_unvalidated_publish_may_be_empty(spark, load, folder, table_name):
    empty = load("region").where("false")
    ts.publish_table(spark, table_name, frame=empty, root=folder, validate_source=False)
    assert spark.table(table_name).count() == 0


def test_partitioned_dataset(spark, load, folder, table_name):
    load("nation").write.partitionBy("n_regionkey").parquet(f"{folder}/p")
    ts.publish_table(spark, table_name, path=f"{folder}/p")
    assert_same_rows(spark.table(table_name), spark.read.parquet(f"{folder}/p"))
    load("nation").limit(7).write.partitionBy("n_regionkey").parquet(f"{folder}/q")
    ts.publish_table(spark, table_name, path=f"{folder}/q")
    assert spark.table(table_name).count() == 7


def test_odd_paths_and_property_texts(spark, load, folder, table_name):
    ts.publish_table(
        spark, table_name, frame=load("region"), root=f"{folder}/it's", properties={"a'b": "c\\d"}
    )
    assert ts.table_properties(spark, table_name)["a'b"] == "c\\d"
    assert spark.table(table_name).count() == 5


def test_other_providers_need_a_catalog_that_replaces(spark, load, table_name):
    with pytest.raises(Exception, match="(?i)replace|unsupported|not find|not supported"):
        ts.publish_table(spark, table_name, frame=load("region"), provider="orc")


def test_snapshot(spark, load, folder, table_name):
    absent = ts.target_snapshot(spark, table_name).first()
    assert (absent["table_exists"], absent["row_count"]) == (False, None)
    ts.publish_table(spark, table_name, frame=load("region"), root=folder)
    there = ts.target_snapshot(spark, table_name).first()
    assert (there["table_exists"], there["row_count"], there["column_count"]) == (True, 5, 2)


def test_table_info(spark, instances, folder, table_name):
    ts.publish_table(spark, table_name, frame=instances, root=folder, properties={"purpose": "x"})
    info = ts.table_info(spark, table_name).first()
    assert (info["row_count"], info["column_count"]) == (40, 4)
    assert info["properties"]["purpose"] == "x"
    assert info["created_on_min"] < info["created_on_max"]
