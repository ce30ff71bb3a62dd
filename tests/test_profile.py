from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import tableship as ts
from tableship.functions.columns import temporal_columns
from tableship.operators import profile
from tableship.operators.profile import _at_least_kth_newest


def test_null_counts(spark, instances):
    row = ts.null_counts(instances).first().asDict()
    assert row == {"id": 0, "created_on": 0, "updated_by": 0, "status": 32}


def test_null_counts_of_odd_names_and_empty_input(spark):
    df = spark.createDataFrame([(1, None, 3)], "`a b` int, `a.b` int, `select` int")
    assert tuple(ts.null_counts(df).first()) == (0, 1, 0)
    assert tuple(ts.null_counts(df.where("false")).first()) == (0, 0, 0)


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v string")
    assert tuple(ts.null_counts(df).first()) == (0, 2)


def test_footer_null_counts_equal_scanned_ones(spark, load, instances, folder):
    instances.write.parquet(f"{folder}/t")
    assert ts.footer_null_counts(spark, f"{folder}/t").first() == ts.null_counts(instances).first()
    # Long texts have no null counts in the footers.
    load("documents").write.parquet(f"{folder}/d")
    assert set(ts.footer_null_counts(spark, f"{folder}/d").first()) == {0}


def test_temporal_columns_go_by_type(spark, instances):
    assert temporal_columns(instances) == ["created_on"]
    named = instances.selectExpr("created_on", "id AS end_date", "1 AS Time_a", "2 AS time_b")
    assert temporal_columns(named, 2, by_name=True) == ["end_date", "Time_a"]


def test_temporal_profile(instances):
    row = ts.temporal_profile(instances).first()
    assert row["created_on_min"] == dt.datetime(2024, 1, 1)
    with pytest.raises(ValueError, match="no temporal"):
        ts.temporal_profile(instances.select("id"))


def test_quality_summary(instances):
    row = ts.quality_summary(instances, "updated_by", "created_on").first()
    assert (row["total_records"], row["unique_ids"]) == (40, 3)
    near = ts.quality_summary(instances, "updated_by", "created_on", approximate=True).first()
    assert near["unique_ids"] == 3


def test_date_distribution_newest_first(spark):
    days = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP'2024-01-01 01:00:00'), (TIMESTAMP'2024-01-03 00:00:00'), "
        "(TIMESTAMP'2024-01-03 23:59:59'), (null) AS t(ts)"
    )
    rows = [tuple(r) for r in ts.date_distribution(days, "ts").collect()]
    assert rows == [(dt.date(2024, 1, 3), 2), (dt.date(2024, 1, 1), 1), (None, 1)]
    assert len(ts.date_distribution(days, "ts", days=2).collect()) == 2


def test_day_depends_on_the_zone_asked_for(spark):
    late = spark.sql("SELECT TIMESTAMP'2024-01-01 20:00:00' AS ts, TIMESTAMP_NTZ'2024-01-01 20:00:00' AS n")
    utc = ts.date_distribution(late, "ts").first()["date"]
    tokyo = ts.date_distribution(late, "ts", tz="Asia/Tokyo").first()["date"]
    assert (utc, tokyo) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    with pytest.raises(ValueError, match="no time zone"):
        ts.date_distribution(late, "n", tz="Asia/Tokyo")


@pytest.mark.parametrize("prune", [True, False])
def test_recent_records_in_order_with_ties(instances, prune):
    rows = ts.recent_records(instances, "created_on", 5, ["id"], prune=prune).collect()
    assert [r["id"] for r in rows] == [39, 38, 37, 36, 35]


@pytest.mark.parametrize("prune", [True, False])
def test_recent_records_fall_back_to_rows_without_time(spark, prune):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01'), (2, null), (3, null) AS t(id, d)")
    rows = ts.recent_records(df, "d", 2, ["id"], prune=prune).collect()
    assert [r["id"] for r in rows] == [1, 3]
    assert ts.recent_records(df, "d", 9, ["id"], prune=prune).count() == 3


def test_recent_records_without_tie_break_are_stable(load):
    orders = load("orders").withColumn("o_orderdate", F.lit(dt.date(2024, 1, 1)))
    first = ts.recent_records(orders, "o_orderdate", 7).collect()
    assert ts.recent_records(orders.repartition(5), "o_orderdate", 7).collect() == first


def test_sample_and_preview(load):
    documents = load("documents")
    assert ts.sample_rows(documents, 5).exceptAll(documents).count() == 0
    assert ts.sample_rows(documents, 5).count() == 5
    shown = ts.preview(ts.sample_rows(documents, 5), width=20)
    assert shown.agg(F.max(F.length("text"))).first()[0] <= 20


def test_table_schema_and_column_profile(instances):
    assert [tuple(r) for r in ts.table_schema(instances).collect()][:2] == [
        (0, "id", "bigint"),
        (1, "created_on", "timestamp"),
    ]
    rows = {r["col_name"]: r for r in ts.column_profile(instances).collect()}
    assert (rows["status"]["row_count"], rows["status"]["null_count"]) == (40, 32)


def test_plans(spark, load):
    events = load("events")
    assert "ReadSchema: struct<>" in plan_of(ts.row_count(events))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan_of(ts.date_range(events, "ts"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan_of(ts.date_distribution(events, "ts"))
    assert "TakeOrderedAndProject" in plan_of(ts.recent_records(events, "ts", 5, ["event_id"]))
    pruned = plan_of(ts.recent_records(events, "ts", 5, ["event_id"], prune=True))
    assert "GreaterThanOrEqual(ts," in pruned
    assert plan_of(ts.temporal_profile(events)).count("Scan parquet") == 2  # tree and detail


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
@pytest.mark.parametrize("ordered", [True, False])
def test_pruning_opens_only_files_with_new_rows(spark, load, folder, kind, ordered):
    events = load("events").withColumn("ts", F.col("ts").cast(kind))
    path = f"{folder}/100% odd+name"
    if ordered:
        events = events.repartitionByRange(10, F.desc("ts"))
    else:
        events = events.repartition(10, "event_id")
    events.write.parquet(path)
    written = spark.read.parquet(path)
    newest = written.orderBy(F.desc("ts"), F.desc("event_id")).limit(3).collect()
    assert ts.recent_records(written, "ts", 3, ["event_id"], prune=True).collect() == newest
    if kind != "date":
        assert "GreaterThanOrEqual(ts," in plan_of(_at_least_kth_newest(written, "ts", 3))
