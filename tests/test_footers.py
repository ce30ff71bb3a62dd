from __future__ import annotations

import glob
import os

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import tableship as ts
from tableship.session import timestamp_statistics
from tableship.sources.footers import FooterError


@pytest.fixture
def written(spark, folder, all_types):
    """Nulls, negative values, times before 1970, a file without rows and one of nulls only."""
    path = f"{folder}/types"
    with timestamp_statistics(spark):
        all_types.repartition(3).write.parquet(path)
        all_types.where("false").coalesce(1).write.mode("append").parquet(path)
        all_types.where("i32 IS NULL").coalesce(1).write.mode("append").parquet(path)
    return path


def test_index_says_what_scans_say(spark, written):
    index, data = ts.footer_index(spark, written), spark.read.parquet(written)
    assert ts.indexed_row_count(index).first()["total_rows"] == data.count() == 4
    scanned, nulls = ts.null_counts(data).first().asDict(), ts.indexed_null_counts(index).first().asDict()
    assert list(nulls) == data.columns
    known = {c: n for c, n in nulls.items() if n is not None}
    assert known == {c: scanned[c] for c in known}
    assert {"bool", "i8", "i64", "str", "day", "ts", "ts_ntz"} <= set(known) and nulls["arr"] is None
    for name in ("i8", "i16", "i32", "i64", "day", "ts", "ts_ntz"):
        wanted = ts.date_range(data, name)
        found = ts.indexed_range(index, name)
        assert found.first() == wanted.first() and found.dtypes == wanted.dtypes
    with pytest.raises(FooterError, match="str"):
        ts.indexed_range(index, "str")


def test_one_row_per_file(spark, written):
    index = ts.footer_index(spark, written)
    files = {r["rel_path"]: r for r in index.files.collect()}
    on_disk = {os.path.basename(f): os.path.getsize(f) for f in glob.glob(f"{written}/*.parquet")}
    assert {f: r["bytes"] for f, r in files.items()} == on_disk
    assert ts.schema_versions(index).select("files").collect() == [(len(on_disk),)]
    sizes = {r["col_name"]: r["encoded_bytes"] for r in ts.column_bytes(index).collect()}
    assert set(sizes) == set(spark.read.parquet(written).columns)
    assert 0 < sum(sizes.values()) < sum(on_disk.values())


def test_missing_column_is_null_in_all_rows(spark, folder):
    spark.range(5).withColumn("b", F.lit(1)).coalesce(1).write.parquet(f"{folder}/m")
    spark.range(7).coalesce(1).write.mode("append").parquet(f"{folder}/m")
    index = ts.footer_index(spark, f"{folder}/m")
    whole = type(index)(index.files, spark.read.option("mergeSchema", "true").parquet(f"{folder}/m").schema)
    assert ts.indexed_null_counts(whole).first().asDict() == {"id": 0, "b": 7}
    assert sorted(r["row_count"] for r in ts.schema_versions(index).collect()) == [5, 7]


def test_odd_names_and_nested_columns(spark, folder):
    df = spark.sql("SELECT 1 AS `a b`, named_struct('x', 2, 'y', 3) AS s, array(1, 2) AS select_")
    df.write.parquet(f"{folder}/o")
    index = ts.footer_index(spark, f"{folder}/o")
    assert ts.indexed_null_counts(index).first().asDict() == {"a b": 0, "s": None, "select_": None}
    assert [c["name"] for c in index.files.where("row_count > 0").first()["columns"]] == ["a b", "s", "select_"]


def test_broken_and_empty_files_are_named(spark, load, folder):
    load("nation").coalesce(1).write.parquet(f"{folder}/n")
    open(f"{folder}/n/part-9.parquet", "w").close()
    with pytest.raises(FooterError, match="part-9.parquet"):
        ts.footer_index(spark, f"{folder}/n")
    with pytest.raises(FooterError, match="mounted"):
        ts.footer_index(spark, "hdfs://somewhere/n")


def test_files_are_read_once(spark, load, folder):
    """Once the index is there, the dataset may be gone."""
    path = f"{folder}/e"
    spark.read.parquet(f"{SF_DIR}/events.parquet").write.parquet(path)
    index = ts.footer_index(spark, path)
    os.rename(path, f"{folder}/away")
    assert ts.indexed_row_count(index).first()["total_rows"] == 1000
    assert ts.indexed_range(index, "event_id").first()["earliest"] == load("events").agg(F.min("event_id")).first()[0]
