from __future__ import annotations

import glob
import os

import pytest
from conftest import SF_DIR, assert_same_rows, plan_of
from pyspark.sql import functions as F

import tableship as ts
from tableship.functions.hashing import fingerprint
from tableship.operators import layout
from tableship.operators.layout import arrange_ordered, file_start, files_per_task, rows_cap
from tableship.sources.resolve import EmptySourceError


def source(spark, name):
    return ts.resolve_source(spark, path=f"{SF_DIR}/{name}.parquet")


def parts(path):
    return sorted(glob.glob(f"{path}/*.parquet"))


@pytest.mark.parametrize(
    "rows, files",
    [(0, 1), (1, 1), (99_999, 1), (100_000, 1), (199_999, 1), (200_000, 2), (1_846, 1), (600_000, 6)],
)
def test_row_rule(rows, files):
    assert ts.target_files(rows) == files


def test_one_rule_at_every_size():
    tib = 1 << 40
    assert ts.target_files(10**12) == 10**7
    assert ts.target_files(30_000, rows_per_file=10) == 3_000
    assert ts.target_files(10**12, total_bytes=100 * tib) == 10**7
    assert ts.target_files(10**12, total_bytes=100 * tib, file_bytes=128 << 20) == 819_200
    assert ts.target_files(600_000, total_bytes=10, file_bytes=128 << 20) == 1
    with pytest.raises(ValueError):
        ts.target_files(1, file_bytes=1)


def test_rows_cap():
    assert rows_cap(10, 3, 3) == 0 and rows_cap(10, 3, 2) == 4
    assert rows_cap(10**12, 10**6, 10**4) == 10**6


@pytest.mark.parametrize("ordered", [True, False])
def test_files_are_as_many_as_planned_beyond_a_thousand(spark, folder, ordered):
    export = ts.export_dataset(
        ts.resolve_source(spark, path=f"{SF_DIR}/lineitem.parquet"),
        folder,
        "l",
        order_by="l_shipdate" if ordered else None,
        rows_per_file=5,
    )
    assert export.planned_files == 1_200 == len(parts(export.path))


def test_a_version_is_never_overwritten(spark, folder):
    given = {"root": folder, "name": "orders", "version": "20240101_000000"}
    ts.export_dataset(source(spark, "orders"), **given)
    with pytest.raises(Exception, match="(?i)exists"):
        ts.export_dataset(source(spark, "orders"), **given)


def test_more_files_than_ranges(spark, folder):
    """Files cut from fewer ranges still follow each other in order."""
    export = ts.export_dataset(
        source(spark, "lineitem"), folder, "l", order_by="l_shipdate", rows_per_file=600, ranges=2
    )
    dates = []
    for file in parts(export.path):
        found = [r[0] for r in spark.read.parquet(file).select("l_shipdate").collect()]
        assert len(found) <= 600
        dates += found
    assert len(parts(export.path)) >= 10
    assert dates == sorted(dates, reverse=True) and len(dates) == 6000


def test_ordered_export_layout(spark, folder):
    export = ts.export_dataset(
        source(spark, "lineitem"), folder, "lineitem", order_by="l_shipdate", rows_per_file=1_000
    )
    files = parts(export.path)
    assert len(files) == export.planned_files == 6
    previous = None
    for file in files:
        dates = [r[0] for r in spark.read.parquet(file).select("l_shipdate").collect()]
        assert dates == sorted(dates, reverse=True)
        assert previous is None or dates[0] <= previous
        assert 500 < len(dates) < 2_000
        previous = dates[-1]
    assert_same_rows(spark.read.parquet(export.path), source(spark, "lineitem").frame)


def test_export_record(spark, folder):
    export = ts.export_dataset(
        source(spark, "events"), folder, "events", order_by="ts", version="20240101_000000"
    )
    assert export.path == f"{folder}/events/20240101_000000"
    assert (export.row_count, export.column_count) == (1000, 6)
    seen = fingerprint(source(spark, "events").frame).first()
    assert export.content_hash == seen["content_hash"]
    summary = ts.export_summary(spark, export).first()
    assert summary["file_count"] == len(parts(export.path))
    assert summary["total_bytes"] == sum(map(os.path.getsize, parts(export.path)))
    assert summary["version"] == "20240101_000000"


def test_observed_rows_do_not_count_the_sampling_pass(spark, folder):
    export = ts.export_dataset(
        source(spark, "lineitem"), folder, "l", order_by="l_shipdate", rows_per_file=500
    )
    assert export.planned_files == 12 and export.row_count == 6000


@pytest.mark.parametrize("hot", ["time", "row"])
def test_one_value_in_a_third_of_the_rows_is_spread(spark, load, hot):
    """A third of all rows share the time, or are copies of one row."""
    events = load("events")
    if hot == "time":
        events = events.withColumn(
            "ts", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-15").cast("timestamp_ntz")).otherwise(F.col("ts"))
        )
    else:
        copies = F.explode(F.sequence(F.lit(1), F.lit(500))).alias("n")
        one = events.where("event_id = 7").select("*", copies).drop("n")
        events = events.unionByName(one)
    arranged = arrange_ordered(events, 10, "ts")
    sizes = [r["count"] for r in arranged.groupBy(F.spark_partition_id()).count().collect()]
    mean = events.count() / 10
    assert len(sizes) == 10 and max(sizes) < 2 * mean
    assert_same_rows(arranged, events)


def test_ties_are_ordered_by_the_tie_break(spark, folder):
    export = ts.export_dataset(
        source(spark, "orders"),
        folder,
        "orders",
        order_by="o_orderdate",
        tie_break=["o_orderkey"],
        rows_per_file=300,
    )
    rows = []
    for file in parts(export.path):
        rows += [tuple(r) for r in spark.read.parquet(file).select("o_orderdate", "o_orderkey").collect()]
    assert rows == sorted(rows, reverse=True) and len(rows) == 1500


def test_nulls_of_the_sort_key_come_last(spark, instances, folder):
    df = instances.withColumn("created_on", F.when(F.col("id") > 3, F.col("created_on")))
    export = ts.export_dataset(
        ts.resolve_source(spark, frame=df), folder, "i", order_by="created_on", rows_per_file=10
    )
    last = spark.read.parquet(parts(export.path)[-1]).collect()
    assert [r["created_on"] for r in last[-4:]] == [None] * 4
    assert_same_rows(spark.read.parquet(export.path), df)


def test_rows_are_hashed_after_the_shuffle(spark, load):
    """The sampling pass and the shuffle carry the rows and one number, no hashes."""
    assert "xxhash64" not in plan_of(arrange_ordered(load("lineitem"), 10, "l_shipdate"))


def test_unordered_export_of_many_small_files(spark, folder):
    frame = source(spark, "lineitem").frame
    frame.repartition(40).write.parquet(f"{folder}/many")
    export = ts.export_dataset(
        ts.resolve_source(spark, path=f"{folder}/many"), folder, "one", rows_per_file=100_000
    )
    assert len(parts(export.path)) == 1
    assert_same_rows(spark.read.parquet(export.path), frame)


def test_query_is_computed_once_and_exported(spark, load, folder):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(x):
        seen.add(1)
        return x

    df = load("orders").select(counted("o_orderkey").alias("k"), "o_orderdate")
    export = ts.export_dataset(
        ts.resolve_source(spark, frame=df), folder, "q", order_by="o_orderdate", rows_per_file=200
    )
    assert seen.value == 1500 and len(parts(export.path)) == 7


def test_every_type_survives(spark, all_types, folder):
    export = ts.export_dataset(
        ts.resolve_source(spark, frame=all_types), folder, "t", order_by="ts", rows_per_file=1
    )
    assert_same_rows(spark.read.parquet(export.path), all_types)
    assert ts.verify_export(spark, export, all_types).first()["matches"]


def test_odd_column_names(spark, folder):
    df = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "`a b` int, `a.b` int, `select` int")
    export = ts.export_dataset(
        ts.resolve_source(spark, frame=df), folder, "t", order_by="a.b", tie_break=["a b"]
    )
    assert_same_rows(spark.read.parquet(export.path), df)


def test_empty_source_is_refused(spark, load, folder):
    empty = ts.resolve_source(spark, frame=load("events").where("false"))
    with pytest.raises(EmptySourceError):
        ts.export_dataset(empty, folder, "e")


def test_target_may_not_overlap_the_source(spark, load, folder):
    load("region").write.parquet(f"{folder}/region/v1")
    inner = ts.resolve_source(spark, path=f"{folder}/region/v1")
    with pytest.raises(ValueError, match="overlaps"):
        ts.export_dataset(inner, folder, "region", version="v1")
    assert spark.read.parquet(f"{folder}/region/v1").count() == 5


def test_verify_export_notices_tampering(spark, load, folder):
    export = ts.export_dataset(source(spark, "orders"), folder, "o", order_by="o_orderdate", rows_per_file=300)
    assert ts.verify_export(spark, export).first()["matches"]
    assert ts.verify_export(spark, export, load("orders")).first()["matches"]
    os.remove(parts(export.path)[2])
    for given in (None, load("orders")):
        with pytest.raises(ValueError, match="rows"):
            ts.verify_export(spark, export, given)


def test_hot_time_is_cut_by_the_tie_break_and_then_by_place(spark):
    """A third of the rows has one time, half of these one identifier as well, and some have no
    time: ranges still have about equal shares and follow each other in order."""
    n = 9_000
    when = F.expr(
        "CASE WHEN id % 3 = 0 THEN TIMESTAMP_NTZ'2024-01-02 00:00:00.5'"
        " WHEN id % 50 = 1 THEN NULL"
        " ELSE TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) END"
    )
    tie = F.expr("CASE WHEN id % 6 = 0 THEN 7 ELSE id END").alias("tie")
    df = spark.range(0, n, 1, 3).select(F.col("id"), when.alias("t"), tie)
    arranged = arrange_ordered(df, 30, "t", ["tie"])
    rows = arranged.withColumn("part", F.spark_partition_id()).collect()
    assert len(rows) == n and len({r["id"] for r in rows}) == n
    shares = [0] * 30
    for r in rows:
        shares[r["part"]] += 1
    assert min(shares) > 0 and max(shares) <= 2 * n / 30
    keys = [(r["part"], r["t"], r["tie"]) for r in rows]
    keys.sort(key=lambda k: k[0])
    by_part = [[k[1:] for k in keys if k[0] == p] for p in range(30)]

    def older(key):
        return (key[0] is None, -key[0].timestamp() if key[0] else 0, -key[1])

    flat = [older(k) for part in by_part for k in sorted(part, key=older)]
    assert flat == sorted(flat)


def test_bounds_read_the_keys_alone(spark):
    """The only scan of whole rows is the one that is shuffled."""
    df = source(spark, "lineitem").frame
    arranged = arrange_ordered(df, 6, "l_shipdate", ["l_orderkey", "l_linenumber"])
    plan = plan_of(arranged)
    assert "rangepartitioning" not in plan.lower() and plan.count("FileScan") <= 1
    df = df.withColumn("row_no", F.monotonically_increasing_id())
    numbers = layout.range_numbers(df, 6, [layout._place(df, "l_shipdate"), F.col("row_no")])
    assert df.select(numbers.alias("n")).distinct().count() == 6


def test_keys_without_a_whole_number_use_the_range_shuffle(spark):
    df = source(spark, "orders").frame
    assert layout._place(df, "o_orderstatus") is None
    parts_of = arrange_ordered(df, 4, "o_orderpriority", ["o_orderkey"])
    rows = parts_of.select("o_orderpriority", F.spark_partition_id().alias("part")).collect()
    bounds = [
        (min(v), max(v))
        for p in range(4)
        if (v := [r["o_orderpriority"] for r in rows if r["part"] == p])
    ]
    assert all(a[0] >= b[1] for a, b in zip(bounds, bounds[1:], strict=False))


def tasks_of(path):
    """How many tasks wrote the files, by the numbers in their names."""
    return len({os.path.basename(p).split("-")[1] for p in parts(path)})


def test_few_tasks_write_small_files_of_equal_shares(spark, folder):
    """Dates fill many files each, and a task writes several of them, yet all are there."""
    export = ts.export_dataset(
        source(spark, "lineitem"), folder, "l", order_by="l_shipdate", rows_per_file=70
    )
    files = parts(export.path)
    assert len(files) == export.planned_files == 85 and tasks_of(export.path) == 2
    rows = [spark.read.parquet(f).select("l_shipdate").collect() for f in files]
    # Only the last file of a task makes up for the cap.
    assert max(map(len, rows)) == 71 and sum(len(r) < 71 for r in rows) <= 2
    flat = [r[0] for of_file in rows for r in of_file]
    assert flat == sorted(flat, reverse=True) and len(flat) == 6000
    assert_same_rows(spark.read.parquet(export.path), source(spark, "lineitem").frame)


def test_ranges_are_cut_exactly_within_hot_values(spark):
    """Two keys with few values each: shares still differ by no more than one row."""
    df = spark.range(0, 10_007, 1, 5).select(
        "id", (F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("b")
    )
    rows = arrange_ordered(df, 40, "a", ["b"]).withColumn("part", F.spark_partition_id()).collect()
    shares = [sum(r["part"] == p for r in rows) for p in range(40)]
    assert set(shares) == {250, 251} and len({r["id"] for r in rows}) == 10_007


def test_few_tasks_write_small_files_without_an_order(spark, folder):
    """From a source of several files, so positions run over the tasks of its scan."""
    frame = source(spark, "lineitem").frame
    frame.repartition(3).write.parquet(f"{folder}/three")
    three = ts.resolve_source(spark, path=f"{folder}/three")
    export = ts.export_dataset(three, folder, "l", rows_per_file=70)
    assert len(parts(export.path)) == export.planned_files == 85 and tasks_of(export.path) == 2
    rows = [spark.read.parquet(f).count() for f in parts(export.path)]
    assert max(rows) == 71 and sum(n < 71 for n in rows) <= 2
    assert_same_rows(spark.read.parquet(export.path), frame)


@pytest.mark.parametrize("rows, files", [(9, 4), (3_000_001, 3_000), (600_999, 600), (10**12, 10**7)])
def test_files_of_a_task_are_cut_by_one_cap(rows, files):
    per_task, cap = files_per_task(rows, files), rows_cap(rows, files, 1)
    for first in (0, (files // 2) // per_task * per_task, (files - 1) // per_task * per_task):
        after = min(files, first + per_task)
        share = file_start(after, rows, files) - file_start(first, rows, files)
        assert -(-share // cap) == after - first
    assert file_start(files, rows, files) == rows and files_per_task(rows, files, 10**18) == 1


@pytest.mark.parametrize("ordered", [True, False])
def test_wide_rows_are_not_left_to_one_task(spark, folder, monkeypatch, ordered):
    """Fewer rows than one file takes, but more bytes than one task should read; the source
    is given as a pattern."""
    assert ts.target_files(150_000, total_bytes=262 << 20) == 3
    assert ts.target_files(2, total_bytes=1 << 40) == 2 and ts.target_files(0, total_bytes=1) == 1
    whole = f"{SF_DIR}/documents.parquet"
    monkeypatch.setattr(layout, "MOST_FILE_BYTES", os.path.getsize(whole) // 4 + 1)
    wide = ts.resolve_source(spark, path=f"{SF_DIR}/document*.parquet")
    order = {"order_by": "doc_id"} if ordered else {}
    export = ts.export_dataset(wide, folder, "d", **order)
    assert len(parts(export.path)) == export.planned_files == 4
    assert_same_rows(spark.read.parquet(export.path), spark.read.parquet(whole))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_few_keys_are_counted_and_not_sorted(spark, monkeypatch, zone):
    """Times of both kinds, nulls among the keys, ties over many blocks: rows get the numbers
    that the sorted keys give, cut within ties by the running number."""
    monkeypatch.setattr(layout, "_BLOCK_BITS", 5)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        n = 10_007
        df = spark.range(0, n, 1, 5).select(
            "id",
            F.expr(
                "CASE WHEN id % 7 > 0 THEN TIMESTAMP_NTZ'2024-11-03 00:30:00'"
                " + make_dt_interval(0, CAST(id % 3 AS INT)) END AS t"
            ),
            F.expr("CASE WHEN id % 2 = 0 THEN timestamp_micros(id % 3 * 1000000) END AS u"),
        )
        rows = df.withColumn("row_no", F.monotonically_increasing_id())
        places = [layout._place(df, "t"), layout._place(df, "u"), F.col("row_no")]
        sorted_numbers = layout.range_numbers(rows, 60, places)
        expected = rows.select("id", sorted_numbers.alias("part")).collect()
        with monkeypatch.context() as patch:
            patch.setattr(layout, "_last_of_ranges", None)
            arranged = arrange_ordered(df, 60, "t", ["u"])
        found = arranged.select("id", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(found) == n and dict(map(tuple, found)) == dict(map(tuple, expected))


@pytest.mark.parametrize("bound", [10, 10_000])
def test_many_keys_are_sorted_though_few_were_expected(spark, monkeypatch, bound):
    """The guess from some rows only chooses the way; shares are exact either way."""
    monkeypatch.setattr(layout, "_MOST_KEYS", bound)
    monkeypatch.setattr(layout, "_few_keys", lambda *_: True)
    df = spark.range(0, 3_001, 1, 3).select("id", (F.col("id") % 1_000).alias("a"))
    rows = arrange_ordered(df, 20, "a").withColumn("part", F.spark_partition_id()).collect()
    shares = [sum(r["part"] == p for r in rows) for p in range(20)]
    assert set(shares) == {150, 151} and len({r["id"] for r in rows}) == 3_001
    assert all(a["a"] >= b["a"] for a, b in zip(rows, rows[1:], strict=False))
