from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter

import pytest
from conftest import SF_DIR, assert_same_rows
from pyspark.cloudpickle import dumps

import tableship as ts
from tableship.operators import transfer
from tableship.plans import migrate as plan
from tableship.plans.migrate import MigrationError


def passed(report):
    return {r["check_name"]: r["passed"] for r in report.collect()}


def move(spark, source, folder, table_name, **options):
    return ts.migrate(
        spark, source, f"{folder}/out", f"{folder}/in", "t", table_name, **options
    )


@pytest.mark.parametrize("mode", ["rewrite", "files", "none"])
def test_table_arrives(spark, load, folder, table_name, mode):
    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    done = move(
        spark, source, folder, table_name,
        time_column="ts", id_column="event_id", transfer_mode=mode, check_export=True,
    )
    assert set(passed(done.report).values()) == {True}
    assert list(passed(done.report)) == [
        "row_count", "table_schema", "recent_records", "date_range", "date_distribution",
        "unique_ids", "content", "published",
    ]
    assert_same_rows(spark.table(table_name), load("events"))
    assert ts.table_properties(spark, table_name)["tableship.version"] == done.export.version


def test_second_migration_replaces_the_first(spark, load, folder, table_name):
    part = ts.resolve_source(spark, frame=load("events").where("event_id < 100"))
    move(spark, part, folder, table_name, time_column="ts", version="20240101_000000")
    whole = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    move(spark, whole, folder, table_name, time_column="ts", version="20240102_000000")
    assert_same_rows(spark.table(table_name), load("events"))
    assert os.path.isdir(f"{folder}/in/t/20240101_000000")


def test_ids_need_not_be_counted(spark, folder, table_name):
    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    done = move(
        spark, source, folder, table_name, time_column="ts", id_column="event_id", check_ids=False
    )
    assert "unique_ids" not in passed(done.report)


def test_table_to_table(spark, load, folder, table_name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tableship_tests")
    load("orders").write.saveAsTable(f"{table_name}_source")
    source = ts.resolve_source(spark, table=f"{table_name}_source")
    move(spark, source, folder, table_name, time_column="o_orderdate", ordered=False)
    assert_same_rows(spark.table(table_name), load("orders"))


def test_every_type_arrives(spark, all_types, folder, table_name):
    source = ts.resolve_source(spark, frame=all_types)
    done = move(spark, source, folder, table_name, time_column="ts", strict=False)
    assert passed(done.report)["content"]
    assert_same_rows(spark.table(table_name), all_types)


STEPS = ["export_dataset", "verify_export", "transfer_dataset", "verification_report", "publish_table"]


@pytest.mark.parametrize("ended", [False, True])
@pytest.mark.parametrize("step, mode", [*((s, "rewrite") for s in STEPS), (STEPS[2], "files")])
def test_resume_after_a_failure_in_each_step(
    spark, load, folder, table_name, monkeypatch, step, ended, mode
):
    """Each step fails once, before or after its work; what has ended is not done again."""
    calls = Counter()

    def counted(name):
        real = getattr(plan, name)

        def call(*args, **options):
            calls[name] += 1
            failing = name == step and calls[name] == 1
            if failing and not ended:
                raise RuntimeError("lost")
            result = real(*args, **options)
            if failing:
                raise RuntimeError("lost")
            return result

        monkeypatch.setattr(plan, name, call)

    for name in STEPS:
        counted(name)
    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    options = {"time_column": "ts", "id_column": "event_id", "check_export": True, "transfer_mode": mode}
    with pytest.raises(RuntimeError, match="lost") as lost:
        move(spark, source, folder, table_name, version="20240101_000000", **options)
    assert lost.value.__notes__ == ["migrate(resume='20240101_000000') goes on from here"]
    done = move(spark, source, folder, table_name, resume="20240101_000000", **options)
    assert set(passed(done.report).values()) == {True} and len(passed(done.report)) == 8
    assert calls == {name: 2 if name == step else 1 for name in STEPS}
    assert_same_rows(spark.table(table_name), load("events"))
    again = move(spark, source, folder, table_name, resume="20240101_000000", **options)
    assert calls.total() == len(STEPS) + 1 and again.export == done.export
    assert passed(again.report) == passed(done.report)


def test_resume_writes_half_done_folders_anew(spark, load, folder, table_name, monkeypatch):
    def half(source, root, name, *, version, **_):
        source.frame.limit(3).write.parquet(f"{root}/{name}/{version}")
        raise RuntimeError("lost")

    def half_copy(spark, source, target, **_):
        spark.read.parquet(source).limit(3).write.parquet(target)
        os.remove(f"{target}/_SUCCESS")
        raise RuntimeError("lost")

    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    go = {"resume": "20240101_000000", "time_column": "ts"}
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(plan, "export_dataset", half)
        move(spark, source, folder, table_name, version="20240101_000000", time_column="ts")
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(plan, "transfer_dataset", half_copy)
        move(spark, source, folder, table_name, **go)
    assert not spark.catalog.tableExists(table_name)
    done = move(spark, source, folder, table_name, **go)
    assert set(passed(done.report).values()) == {True}
    assert_same_rows(spark.table(table_name), load("events"))


def test_resume_needs_the_run_it_names(spark, load, folder, table_name):
    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    first = move(spark, source, folder, table_name, time_column="ts", version="20240101_000000")
    for other in ({"resume": "20240101_000001"}, {"resume": "20240101_000000", "ordered": False}):
        with pytest.raises(ValueError, match="no run of version"):
            move(spark, source, folder, table_name, time_column="ts", **other)
    with pytest.raises(ValueError, match="cannot go on"):
        move(spark, source, folder, table_name, time_column="ts", resume="1", version="2")
    with pytest.raises(FileExistsError):
        move(spark, source, folder, table_name, time_column="ts", version="20240101_000000")
    # An older run does not take the table back from a newer one.
    part = ts.resolve_source(spark, frame=load("events").where("event_id < 100"))
    move(spark, part, folder, table_name, time_column="ts", version="20240102_000000")
    report = move(spark, source, folder, table_name, time_column="ts", resume=first.export.version).report
    assert [k for k, ok in passed(report).items() if not ok] == ["published"]
    assert_same_rows(spark.table(table_name), part.frame)


def test_failed_checks_are_made_again(spark, load, folder, table_name, monkeypatch):
    """A report with a failed check is no outcome to go on with."""
    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    failing = spark.createDataFrame([("content", False, "")], plan.REPORT)
    with monkeypatch.context() as patched, pytest.raises(MigrationError):
        patched.setattr(plan, "verification_report", lambda *_, **__: failing)
        move(spark, source, folder, table_name, time_column="ts", version="20240101_000000")
    done = move(spark, source, folder, table_name, time_column="ts", resume="20240101_000000")
    assert set(passed(done.report).values()) == {True}


@pytest.mark.parametrize("strict", [True, False])
def test_changed_copy(spark, load, folder, table_name, strict, monkeypatch):
    """A value changes on the way; the number of rows does not."""

    def corrupting(spark, source, target, **_):
        altered = spark.read.parquet(source).selectExpr(
            "event_id", "ts", "user_id", "event_type",
            "CASE WHEN event_id = 3 THEN value + 1 ELSE value END AS value", "props",
        )
        altered.write.parquet(target)

    monkeypatch.setattr(plan, "transfer_dataset", corrupting)
    source = ts.resolve_source(spark, path=f"{SF_DIR}/events.parquet")
    if strict:
        with pytest.raises(MigrationError, match="content"):
            move(spark, source, folder, table_name, time_column="ts")
        assert not spark.catalog.tableExists(table_name)
    else:
        done = move(spark, source, folder, table_name, time_column="ts", strict=False)
        assert [k for k, ok in passed(done.report).items() if not ok] == ["content"]
        assert spark.catalog.tableExists(table_name)


def test_report_isolates_errors(load):
    report = ts.verification_report(load("region"), "no_such_time")
    outcome = passed(report)
    assert outcome["row_count"] and outcome["table_schema"]
    assert not (outcome["recent_records"] or outcome["date_range"] or outcome["date_distribution"])
    details = {r["check_name"]: r["detail"] for r in report.collect()}
    assert "no_such_time" in details["recent_records"]


def test_report_of_nothing(load):
    outcome = passed(ts.verification_report(load("events").where("false"), "ts", id_column="event_id"))
    assert not outcome["row_count"] and not outcome["date_range"]
    assert outcome["recent_records"] and outcome["unique_ids"]


def test_report_against_expectations(load):
    events = load("events")
    outcome = passed(
        ts.verification_report(events, "ts", expected_rows=999, expected_columns=["a"], expected_hash=1)
    )
    assert not (outcome["row_count"] or outcome["table_schema"] or outcome["content"])


def test_profile_source(spark, load):
    row = ts.profile_source(ts.resolve_source(spark, frame=load("orders"))).first()
    assert (row["source"], row["row_count"], row["column_count"]) == ("dataframe", 1500, 6)
    with pytest.raises(ValueError, match="no rows"):
        ts.profile_source(ts.resolve_source(spark, frame=load("orders").where("false")))


def test_task_functions_need_no_package_on_the_workers(folder):
    """Workers unpickle the copying functions without importing this package."""
    functions = [
        transfer._chunk_copier("/b", "id", 1, True),
        transfer._file_finisher("/b", "id"),
    ]
    with open(f"{folder}/functions", "wb") as f:
        f.write(dumps(functions))
    script = (
        "import pickle, sys, pyspark.cloudpickle\n"
        "made = pickle.load(open('functions', 'rb'))\n"
        "assert [list(f(iter([]))) for f in made] == [[], []]\n"
        "assert not any(m.startswith('tableship') for m in sys.modules)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", script], cwd=folder, env=env, check=True)
