"""What must not happen: lost live rows, rows of another format, doubled or renamed files."""

from __future__ import annotations

import os
import shutil

import pytest
from conftest import assert_same_rows
from pyspark.sql import functions as F

import tableship as ts
from tableship.functions.paths import inside, new_version, plain_path, relative_path, version_of
from tableship.operators import publish
from tableship.operators.transfer import TransferError


def run(spark, frame, folder, table, version):
    return ts.migrate(
        spark,
        ts.resolve_source(spark, frame=frame),
        f"{folder}/exports",
        f"{folder}/imports",
        "events",
        table,
        time_column="ts",
        id_column="event_id",
        version=version,
    )


def test_the_same_version_twice_keeps_the_live_rows(spark, load, folder, table_name):
    events = load("events").limit(50)
    run(spark, events, folder, table_name, "20240101_000000")
    with pytest.raises(Exception, match="(?i)exists"):
        run(spark, events.limit(3).unionByName(events.limit(3)), folder, table_name, "20240101_000000")
    assert_same_rows(spark.table(table_name), events)


def test_versions_differ_within_a_second():
    assert len({new_version() for _ in range(50)}) > 1
    assert version_of("/x/20240101_000000") == "20240101_000000"
    assert version_of("/x/20240101_000000_123456/y") == "20240101_000000_123456"
    assert version_of("/x/y") == "unknown"


@pytest.mark.parametrize("kind", ["csv", "json", "orc"])
def test_publishing_over_another_format(spark, load, folder, table_name, kind):
    region = load("region")
    region.where("r_regionkey > 2").write.format(kind).save(f"{folder}/old")
    spark.sql("CREATE SCHEMA IF NOT EXISTS tableship_tests")
    spark.sql(
        f"CREATE TABLE {table_name} (r_regionkey INT, r_name STRING) USING {kind} LOCATION '{folder}/old'"
    )
    ts.publish_table(spark, table_name, frame=region, root=folder)
    assert_same_rows(spark.table(table_name), region)
    assert spark.read.format(kind).load(f"{folder}/old").count() == 2


def test_an_error_between_the_steps_keeps_the_old_name(spark, load, folder, table_name, monkeypatch):
    region = load("region")
    ts.publish_table(spark, table_name, frame=region, root=folder, version="v1")
    asked = []

    class Failing:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            asked.append(text)
            if "__new_" in text and text.startswith("ALTER") and text.endswith(table_name):
                raise RuntimeError("lost")
            return spark.sql(text)

    region.withColumn("more", F.lit(1)).write.parquet(f"{folder}/wide")
    with pytest.raises(RuntimeError, match="lost"):
        publish._swap(Failing(), table_name, f"{folder}/wide", {"a": "b"}, drop_old=True)
    assert_same_rows(spark.table(table_name), region)
    names = [t.name for t in spark.catalog.listTables(table_name.split(".")[0])]
    assert [n for n in names if table_name.split(".")[1] in n] == [table_name.split(".")[1]]


def test_a_view_is_refused_and_leaves_nothing_behind(spark, load, folder, table_name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tableship_tests")
    spark.sql(f"CREATE VIEW {table_name} AS SELECT 1 AS one")
    with pytest.raises(ValueError, match="view"):
        ts.publish_table(spark, table_name, frame=load("region"), root=folder)
    names = [t.name for t in spark.catalog.listTables("tableship_tests")]
    assert not any("__new_" in n and table_name.split(".")[1] in n for n in names)


def test_the_version_of_a_published_path(spark, load, folder, table_name):
    load("region").write.parquet(f"{folder}/20240101_000000")
    ts.publish_table(spark, table_name, path=f"{folder}/20240101_000000")
    assert ts.table_properties(spark, table_name)["tableship.version"] == "20240101_000000"


def test_equal_paths_in_two_stores_do_not_overlap():
    assert not inside("s3a://stage/exports/t", "s3a://dev/exports/t")
    assert not inside("hdfs://a/x", "/x") and inside("hdfs://a/x/y", "hdfs://a/x")
    assert inside("/x/y", "hdfs://a/x", default="hdfs://a")
    assert inside("file:/x/y", "/x") and inside("/x//y/../y", "/x/./y")
    assert plain_path("/x//a/") == "/x/a"


def test_names_below_an_odd_root(spark, load, folder):
    load("region").write.parquet(f"{folder}/a")
    names = [r["rel_path"] for r in ts.file_manifest(spark, f"{folder}//a/../a").collect()]
    assert names and all(n.startswith("part-") for n in names)
    with pytest.raises(ValueError):
        relative_path(F.col("path"), "/a/*")
    wrong = spark.createDataFrame([("file:/b/c",)], "path string")
    with pytest.raises(Exception, match="not below"):
        wrong.select(relative_path(F.col("path"), "/a")).collect()


def test_a_used_target_is_refused(spark, load, folder):
    source, target = f"{folder}/source", f"{folder}/target"
    load("customer").write.parquet(source)
    ts.copy_files(spark, source, target)
    ts.copy_files(spark, source, target)  # the same files again
    shutil.rmtree(source)
    load("customer").write.parquet(source)
    with pytest.raises(TransferError, match="other files"):
        ts.copy_files(spark, source, target)
    assert spark.read.parquet(target).count() == 150


def test_what_copies_of_files_cannot_do_is_refused(spark, load, folder):
    source = f"{folder}/source"
    load("region").write.parquet(source)
    for target in ("hdfs://nn/imports", "s3a://bucket/imports"):
        with pytest.raises(ValueError, match="mounted"):
            ts.copy_files(spark, source, target)
    os.makedirs(f"{source}/_delta_log")
    with pytest.raises(TransferError, match="_delta_log"):
        ts.copy_files(spark, source, f"{folder}/target")


def test_a_hole_is_found_before_a_file_is_finished(spark, folder):
    from tableship.operators.transfer import _chunk_checker

    os.makedirs(f"{folder}/t")
    with open(f"{folder}/t/.a.id1", "wb") as f:
        f.truncate(10)
    import hashlib

    import pandas as pd

    good = hashlib.sha256(bytes(10)).hexdigest()
    rows = [("a", 0, 10, good, None), ("a", 0, 10, "x", None), ("b", 0, 1, good, None), ("a", 0, 9, good, "old")]
    given = pd.DataFrame(rows, columns=["rel_path", "start", "size", "sha256", "error"])
    (found,) = _chunk_checker(f"{folder}/t", "id1")(iter([given]))
    errors = found["error"].tolist()
    assert errors[0] is None and "differs" in errors[1] and "Error" in errors[2] and errors[3] == "old"


def test_a_target_the_tasks_do_not_share_is_noticed(spark, folder):
    from tableship.operators.transfer import _chunk_copier

    import pandas as pd

    with open(f"{folder}/a", "wb") as f:
        f.write(b"abc")
    given = pd.DataFrame([("a", f"{folder}/a", 0, 3)], columns=["rel_path", "source", "start", "size"])
    (found,) = _chunk_copier(f"{folder}/t", "id1", 1, f"{folder}/no-mark")(iter([given]))
    assert "not the folder" in found["error"][0]


def test_many_empty_files_are_found_by_tasks(spark, folder, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "inputFiles", lambda self: pytest.fail("names on the driver"))
    for k in range(40):
        os.makedirs(f"{folder}/s/p={k % 4}", exist_ok=True)
        with open(f"{folder}/s/p={k % 4}/{k}.bin", "wb") as f:
            f.write(b"x" * (k % 2))
    found = ts.file_manifest(spark, f"{folder}/s", include_empty=True)
    assert sorted((r["rel_path"], r["length"]) for r in found.collect()) == sorted(
        (f"p={k % 4}/{k}.bin", k % 2) for k in range(40)
    )


def test_partition_values_stay_text(spark, folder):
    df = spark.createDataFrame([(k, f"{k % 2:03}") for k in range(6)], "id int, part string")
    df.write.partitionBy("part").parquet(f"{folder}/p")
    copy = ts.transfer_dataset(spark, f"{folder}/p", f"{folder}/q")
    assert_same_rows(copy, df)
    assert os.path.isdir(f"{folder}/q/part=001")
    with pytest.raises(Exception, match="(?i)exists"):
        ts.transfer_dataset(spark, f"{folder}/p", f"{folder}/q")


def failed(report):
    return {r["check_name"] for r in report.where("NOT passed").collect()}


def test_every_report_check_can_fail(spark, load):
    events = load("events")
    nulls = events.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts")))
    assert failed(ts.verification_report(nulls, "ts")) == {"date_distribution"}
    typed = events.withColumn("user_id", F.col("user_id").cast("string"))
    assert failed(
        ts.verification_report(typed, "ts", expected_columns=events.columns, expected_schema=events.schema)
    ) == {"table_schema"}
    none = events.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert failed(ts.verification_report(none, "ts")) == {"date_range", "date_distribution"}
    assert failed(ts.verification_report(events, "ts", expected_rows=1)) == {"row_count"}
    broken = events.withColumn("value", F.raise_error(F.lit("unreadable")).cast("double"))
    assert "recent_records" in failed(ts.verification_report(broken, "ts"))


