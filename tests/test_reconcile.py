from __future__ import annotations

from collections import Counter

import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tableship as ts
from tableship.operators import difference
from tableship.operators import reconcile as by_rows
from tableship.operators.export import CountMismatchError
from tableship.operators.reconcile import SchemaMismatchError


@pytest.fixture(scope="module")
def orders(load):
    return load("orders")


def tampered(orders, how: str):
    one, other = orders.where("o_orderkey = 5"), orders.where("o_orderkey = 6")
    return {
        "row dropped": orders.where("o_orderkey <> 5"),
        "value changed": orders.withColumn(
            "o_totalprice", F.when(F.col("o_orderkey") == 5, 0.5).otherwise(F.col("o_totalprice"))
        ),
        "one dropped, one doubled": orders.where("o_orderkey <> 5").unionByName(other),
        "extra row": orders.unionByName(one),
        "null for a value": orders.withColumn(
            "o_orderstatus", F.when(F.col("o_orderkey") != 5, F.col("o_orderstatus"))
        ),
    }[how]


HOW = [
    "row dropped",
    "value changed",
    "one dropped, one doubled",
    "extra row",
    "null for a value",
]


def statuses(df):
    return {r["status"]: r["n"] for r in df.collect()}


@pytest.mark.parametrize("how", HOW)
def test_totals_notice(orders, how):
    assert not ts.reconcile_totals(orders, tampered(orders, how)).first()["matches"]
    with pytest.raises(CountMismatchError):
        ts.verify_import(orders, tampered(orders, how))
    assert not ts.verify_import(orders, tampered(orders, how), strict=False).first()["matches"]


def test_totals_of_equal_sides(orders):
    row = ts.verify_import(orders, orders.repartition(5)).first()
    assert (row["source_rows"], row["target_rows"], row["matches"]) == (1500, 1500, True)


def test_null_swapped_between_columns(spark):
    left = spark.createDataFrame([(None, "a"), ("b", "c")], "x string, y string")
    right = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    assert not ts.reconcile_totals(left, right).first()["matches"]
    assert statuses(ts.reconcile(left, right)) == {"same": 1, "missing": 1, "extra": 1}


@pytest.mark.parametrize(
    "how, keyed, bagged",
    [
        ("row dropped", {"same": 1499, "missing": 1}, {"same": 1499, "missing": 1}),
        ("value changed", {"same": 1499, "changed": 1}, {"same": 1499, "missing": 1, "extra": 1}),
        (
            "one dropped, one doubled",
            {"same": 1498, "missing": 1, "changed": 1},
            {"same": 1499, "missing": 1, "extra": 1},
        ),
        ("extra row", {"same": 1499, "changed": 1}, {"same": 1500, "extra": 1}),
    ],
)
def test_statuses(orders, how, keyed, bagged):
    assert statuses(ts.reconcile(orders, tampered(orders, how), ["o_orderkey"])) == keyed
    assert statuses(ts.reconcile(orders, tampered(orders, how))) == bagged


def test_extra_keys(orders):
    assert statuses(ts.reconcile(orders.where("o_orderkey > 5"), orders, ["o_orderkey"]))["extra"] > 0


def test_key_differences_name_the_keys(orders):
    for how, status in (("row dropped", "missing"), ("value changed", "changed")):
        rows = ts.key_differences(orders, tampered(orders, how), ["o_orderkey"]).collect()
        assert [(r["o_orderkey"], r["status"]) for r in rows] == [(5, status)]
    assert ts.key_differences(orders, orders, ["o_orderkey"]).isEmpty()


def test_null_keys_and_keys_that_recur(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k int, v int")
    swapped = spark.createDataFrame([(None, 2), (None, 1), (3, 3)], "k int, v int")
    assert statuses(ts.reconcile(left, swapped, ["k"])) == {"same": 3}
    other = spark.createDataFrame([(None, 1), (None, 1), (3, 3)], "k int, v int")
    assert statuses(ts.reconcile(left, other, ["k"])) == {"same": 1, "changed": 2}
    assert [tuple(r) for r in ts.duplicate_keys(left, ["k"]).collect()] == [(None, 2)]


@pytest.mark.parametrize("buckets", [1, 8, 4096])
@pytest.mark.parametrize("keys", [None, ["o_orderkey"]])
def test_any_number_of_buckets_gives_the_same_counts(orders, buckets, keys):
    target = tampered(orders, "value changed").where("o_orderkey % 50 <> 1")
    wanted = statuses(ts.reconcile(orders, target, keys))
    assert statuses(ts.reconcile(orders, target, keys, buckets)) == wanted
    assert sum(wanted.values()) in (1500, 1501)


def test_rows_are_not_shuffled_when_the_sides_agree(orders):
    """The second step falls away at run time."""
    compared = ts.reconcile(orders, orders)
    assert statuses(compared) == {"same": 1500}
    final = compared._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("Initial Plan")]
    assert "isFinalPlan=true" in final and "BroadcastHashJoin" not in final


def test_bag_against_except_all(load):
    """The counts of whole rows against Spark's own exact set operation."""
    lineitem = load("lineitem")
    target = lineitem.where("l_linenumber <> 3").unionByName(lineitem.where("l_linenumber = 1"))
    found = statuses(ts.reconcile(lineitem, target))
    assert found["missing"] == lineitem.exceptAll(target).count()
    assert found["extra"] == target.exceptAll(lineitem).count()
    assert found["same"] == lineitem.intersectAll(target).count()


bags = st.lists(
    st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a", "b"])), max_size=12
)


@settings(max_examples=8, deadline=None)
@given(left=bags, right=bags)
def test_bag_against_brute_force(spark, left, right):
    schema = "k int, v string"
    source, target = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    a, b = Counter(left), Counter(right)
    wanted = {"same": (a & b).total(), "missing": (a - b).total(), "extra": (b - a).total()}
    assert statuses(ts.reconcile(source, target, buckets=4)) == {k: n for k, n in wanted.items() if n}
    assert ts.reconcile_totals(source, target).first()["matches"] == (a == b)


def test_schemas_have_to_agree(orders):
    with pytest.raises(SchemaMismatchError):
        ts.reconcile_totals(orders, orders.drop("o_orderstatus"))
    with pytest.raises(SchemaMismatchError):
        ts.reconcile(orders, orders.withColumn("o_custkey", F.col("o_custkey").cast("int")))


def test_every_type(all_types):
    assert statuses(ts.reconcile(all_types, all_types)) == {"same": 3}
    assert statuses(ts.reconcile(all_types, all_types, ["i64"])) == {"same": 3}


def test_totals_shuffle_no_rows(orders):
    totals = plan_of(ts.reconcile_totals(orders, orders))
    assert "hashpartitioning" not in totals and "Join" not in totals


@pytest.mark.parametrize("how", HOW)
@pytest.mark.parametrize("keys", [None, ["o_orderkey"]])
def test_sketch_gives_the_same_counts(orders, how, keys):
    target = tampered(orders, how).where("o_orderkey % 300 <> 7")
    wanted = statuses(ts.reconcile(orders, target, keys))
    assert statuses(ts.reconcile(orders, target, keys, sketch_bits=12)) == wanted
    assert statuses(ts.reconcile(orders, target, keys, sketch_bits=1)) == wanted


@settings(max_examples=8, deadline=None)
@given(left=bags, right=bags)
def test_sketch_of_bags_against_brute_force(spark, left, right):
    schema = "k int, v string"
    source, target = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    a, b = Counter(left), Counter(right)
    wanted = {"same": (a & b).total(), "missing": (a - b).total(), "extra": (b - a).total()}
    found = statuses(ts.reconcile(source, target, sketch_bits=4))
    assert found == {k: n for k, n in wanted.items() if n}
    a, b = (Counter(k for k, _ in rows) for rows in (left, right))
    differ = {k for k in a | b if Counter(r for r in left if r[0] == k) != Counter(r for r in right if r[0] == k)}
    rows = ts.key_differences(source, target, ["k"], sketch_bits=4).collect()
    assert {(r["k"], r["in_source"], r["in_target"]) for r in rows} == {(k, a[k], b[k]) for k in differ}


def scattered(spark, n):
    """``n`` rows of which every 40th is changed, missing or followed by an extra one."""
    source = spark.range(n).select("id", (F.col("id") * 3).alias("v"), F.lit("x").alias("w"))
    changed = F.when(F.col("id") % 40 == 5, -F.col("v")).otherwise(F.col("v")).alias("v")
    target = source.where("id % 80 <> 9").select("id", changed, "w")
    extra = source.where("id % 80 = 33").select((F.col("id") + n).alias("id"), "v", "w")
    wanted = {k: "changed" for k in range(5, n, 40)}
    wanted |= {k: "missing" for k in range(9, n, 80)} | {k + n: "extra" for k in range(33, n, 80)}
    return source, target.unionByName(extra), wanted


def test_scattered_changes_are_decoded_without_a_shuffle_of_rows(spark, monkeypatch):
    source, target, wanted = scattered(spark, 200_000)
    assert len(wanted) == 10_000
    monkeypatch.setattr(by_rows, "_in_unsettled_buckets", None)
    found = ts.key_differences(source, target, ["id"], sketch_bits=14)
    assert {r["id"]: r["status"] for r in found.collect()} == wanted
    plan = plan_of(found)
    assert "BroadcastHashJoin LeftSemi BuildRight" in plan and "SortMergeJoin" not in plan
    counts = statuses(ts.reconcile(source, target, ["id"], sketch_bits=14))
    assert counts == {"same": 192_500, "changed": 5_000, "missing": 2_500, "extra": 2_500}


def test_too_many_differences_fall_back_to_buckets(spark):
    source, target, wanted = scattered(spark, 20_000)
    stacked = by_rows._stacked(source, target, ["id"], 4096)
    for bits, enough in ((6, False), (12, True)):
        cells = difference.sketch(stacked, by_rows.KEY_HASH, by_rows.HASH, by_rows.SIGN, bits)
        assert (difference.decode(cells, bits) is not None) == enough
        found = ts.key_differences(source, target, ["id"], sketch_bits=bits)
        assert {r["id"]: r["status"] for r in found.collect()} == wanted


def test_sketch_holds_pairs_with_their_counts(spark):
    rows = [(5, -7, 1)] * 3 + [(5, -7, -1)] + [(-(2**63), 2**63 - 1, -1)] * 2 + [(1, 2, 1), (1, 2, -1)]
    frame = spark.createDataFrame(rows, "k long, r long, s int")
    decoded = difference.decode(difference.sketch(frame, "k", "r", "s", 5), 5)
    assert sorted(map(tuple, decoded.pairs.tolist())) == [(-(2**63), 2**63 - 1, -2), (5, -7, 2)]
    assert decoded.source_rows == 4 and decoded.keys.tolist() == [-(2**63), 5]
    empty = difference.decode(difference.sketch(frame.limit(0), "k", "r", "s", 5), 5)
    assert len(empty.pairs) == 0 and empty.source_rows == 0
    with pytest.raises(ValueError):
        difference.sketch(frame, "k", "r", "s", 21)


def test_sketch_of_every_type_and_of_nothing(all_types):
    assert statuses(ts.reconcile(all_types, all_types, ["i64"], sketch_bits=8)) == {"same": 3}
    assert statuses(ts.reconcile(all_types, all_types.limit(0), sketch_bits=8)) == {"missing": 3}
    assert statuses(ts.reconcile(all_types.limit(0), all_types.limit(0), sketch_bits=8)) == {}
