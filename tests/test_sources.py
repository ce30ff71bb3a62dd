from __future__ import annotations

import glob
import os
import shutil

import pytest
from conftest import SF_DIR, assert_same_rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import tableship as ts
from tableship.functions.paths import inside, path_version, plain_path
from tableship.session import cluster_conf, shared_folder
from tableship.sources.resolve import EmptySourceError, MixedSchemaError, stage


def test_every_kind_of_source(spark, load, table_name):
    path = f"{SF_DIR}/region.parquet"
    load("region").createOrReplaceTempView("region_view")
    ts.publish_table(spark, table_name, path=path)
    sources = [
        ts.resolve_source(spark, path=path),
        ts.resolve_source(spark, table=table_name),
        ts.resolve_source(spark, table="region_view"),
        ts.resolve_source(spark, sql="SELECT * FROM region_view"),
        ts.resolve_source(spark, frame=load("region")),
    ]
    for source in sources:
        assert_same_rows(source.frame, load("region"))
    assert [s.repeatable for s in sources] == [True, True, False, False, False]


def test_exactly_one_source(spark):
    with pytest.raises(ValueError, match="exactly one"):
        ts.resolve_source(spark)
    with pytest.raises(ValueError, match="exactly one"):
        ts.resolve_source(spark, path="/a", table="b")


def test_missing_and_empty_directories(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ts.read_dataset(spark, f"{folder}/absent")
    os.makedirs(f"{folder}/empty")
    with pytest.raises(AnalysisException, match="UNABLE_TO_INFER_SCHEMA"):
        ts.read_dataset(spark, f"{folder}/empty")


def test_mixed_schemas_are_refused_or_merged(spark, folder):
    """Whichever file Spark looks at first, no column is lost."""
    narrow, wide = spark.range(3), spark.range(2).withColumn("extra", F.lit("x"))
    for name, frames in (("narrow_first", [narrow, wide]), ("wide_first", [wide, narrow])):
        os.makedirs(f"{folder}/{name}")
        for i, frame in enumerate(frames):
            frame.coalesce(1).write.parquet(f"{folder}/parts/{name}{i}")
            part = glob.glob(f"{folder}/parts/{name}{i}/*.parquet")[0]
            shutil.copy(part, f"{folder}/{name}/part-{i}.parquet")
    with pytest.raises(MixedSchemaError):
        ts.read_dataset(spark, f"{folder}/narrow_first")
    for df in (
        ts.read_dataset(spark, f"{folder}/narrow_first", merge_schema=True),
        ts.read_dataset(spark, f"{folder}/wide_first"),
    ):
        assert sorted(df.columns) == ["extra", "id"] and df.count() == 5


def test_parquet_view_with_odd_path(spark, load, folder):
    path = f"{folder}/it's here"
    load("nation").write.parquet(path)
    assert_same_rows(ts.parquet_view(spark, "odd view", path), load("nation"))


def test_require_rows(load):
    assert ts.require_rows(load("region")).count() == 5
    with pytest.raises(EmptySourceError):
        ts.require_rows(load("region").where("false"))


def test_staging_computes_once(spark, load):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return x

    source = ts.resolve_source(spark, frame=load("nation").select(counted("n_nationkey").alias("k")))
    staged = stage(source)
    assert staged.frame.count() == 25 and staged.frame.agg(F.sum("k")).first()[0] == 300
    assert staged.repeatable and seen.value == 25


def test_shared_folder_is_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    else:
        assert os.path.isdir(shared_folder(spark))


def test_cluster_conf_grows_with_the_data():
    reducers = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split = "spark.sql.files.maxPartitionBytes"
    small, middle, large = cluster_conf(1 << 20), cluster_conf(1 << 40), cluster_conf(100 << 40)
    assert (small[reducers], middle[reducers], large[reducers]) == ("200", "8192", "20000")
    assert small[split] == middle[split] == "134217728b"
    assert 500 << 20 < int(large[split][:-1]) < 600 << 20


@pytest.mark.parametrize(
    "path, plain",
    [
        ("/a/b/", "/a/b"),
        ("file:/a/b", "/a/b"),
        ("file:///a/b", "/a/b"),
        ("hdfs://host:8020/a/b", "/a/b"),
        ("s3a://bucket/a", "/a"),
    ],
)
def test_plain_path(path, plain):
    assert plain_path(path) == plain


def test_inside():
    assert inside("/a/b/c", "file:/a/b") and inside("/a/b", "/a/b/")
    assert not inside("/a/bc", "/a/b")


def test_path_version(spark):
    df = spark.createDataFrame([("/x/20240131_235959/part",), ("/x/y",)], "p string")
    assert [r[0] for r in df.select(path_version(F.col("p"))).collect()] == [
        "20240131_235959",
        "unknown",
    ]


# Manifests


def test_manifest_rows(spark, load, folder):
    root = f"{folder}/a b/20240102_030405"
    load("nation").write.partitionBy("n_regionkey").parquet(root)
    rows = ts.file_manifest(spark, root).collect()
    assert len(rows) == 5
    assert all(os.path.getsize(f"{root}/{r['rel_path']}") == r["length"] for r in rows)
    assert all(r["rel_path"].startswith("n_regionkey=") for r in rows)
    assert {r["version"] for r in rows} == {"20240102_030405"}
    assert all(r["rel_path"].endswith(r["file_name"]) for r in rows)


def test_manifest_of_empty_and_hidden_files(spark, folder):
    for name in ("data.bin", "empty.bin", "_SUCCESS", ".hidden"):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"" if name == "empty.bin" else b"abc")
    assert [r["rel_path"] for r in ts.file_manifest(spark, folder).collect()] == ["data.bin"]
    every = ts.file_manifest(spark, folder, include_empty=True)
    assert {r["rel_path"]: r["length"] for r in every.collect()} == {"data.bin": 3, "empty.bin": 0}
    assert ts.file_manifest(spark, folder, glob="d*.bin").count() == 1


def test_manifest_of_missing_and_empty_folders(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ts.file_manifest(spark, f"{folder}/absent")
    assert tuple(ts.file_stats(ts.file_manifest(spark, folder)).first()) == (0, 0, 0.0, 0.0)


def test_file_stats(spark, folder):
    for name, size in (("a", 1 << 20), ("b", 3 << 20)):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"x" * size)
    stats = ts.file_stats(ts.file_manifest(spark, folder)).first()
    assert tuple(stats) == (2, 4 << 20, 4.0, 2.0)


def test_manifest_reads_no_contents_in_few_tasks(spark, folder):
    for i in range(100):
        with open(f"{folder}/f{i}", "wb") as f:
            f.write(b"x")
    manifest = ts.file_manifest(spark, folder)
    plan = manifest._sc._jvm.PythonSQLUtils.explainString(
        manifest._jdf.queryExecution(), "formatted"
    )
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "content" not in read
    assert manifest.rdd.getNumPartitions() <= 16
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_file_rows_counts_files_without_rows(spark, folder):
    path = f"{folder}/50% +odd name"
    spark.range(10).coalesce(1).write.parquet(path)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)
    rows = sorted(r["row_count"] for r in ts.file_rows(spark, path).collect())
    assert rows == [0, 10]


def test_compare_manifests(spark, folder):
    for side, files in (("s", {"a": 1, "b": 2, "c": 3}), ("t", {"a": 1, "b": 9, "d": 4})):
        os.makedirs(f"{folder}/{side}")
        for name, size in files.items():
            with open(f"{folder}/{side}/{name}", "wb") as f:
                f.write(b"x" * size)
    outcome = ts.compare_manifests(
        ts.file_manifest(spark, f"{folder}/s"), ts.file_manifest(spark, f"{folder}/t")
    )
    assert {r["rel_path"]: r["status"] for r in outcome.collect()} == {
        "a": "same",
        "b": "resized",
        "c": "missing",
        "d": "extra",
    }
