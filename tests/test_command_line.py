from __future__ import annotations

import glob

import pytest
from conftest import SF_DIR, assert_same_rows

from tableship.__main__ import main


def test_steps_one_by_one(spark, load, folder, table_name, capsys):
    events = f"{SF_DIR}/events.parquet"
    root = ["--root", f"{folder}/out", "--name", "events", "--version", "20240101_000000"]
    export = ["export", "--path", events, "--time", "ts", "--tie-break", "event_id", *root]
    assert main([*export, "--rows-per-file", "300"]) == 0
    exported = f"{folder}/out/events/20240101_000000"
    assert len(glob.glob(f"{exported}/*.parquet")) == 3
    assert main(["transfer", exported, f"{folder}/in"]) == 0
    assert main(["transfer", exported, f"{folder}/bytes", "--mode", "files"]) == 0
    assert main(["import", f"{folder}/in", table_name]) == 0
    assert main(["verify", table_name, "--time", "ts", "--id", "event_id"]) == 0
    assert_same_rows(spark.table(table_name), load("events"))
    shown = capsys.readouterr().out
    assert "date_distribution" in shown and "20240101_000000" in shown and "1,000 rows" in shown
    assert main(["verify", table_name, "--time", "ts", "--id", "user_id"]) == 1


def test_migrate(spark, load, folder, table_name):
    load("orders").createOrReplaceTempView("orders_to_move")
    arguments = [
        "migrate", "--sql", "SELECT * FROM orders_to_move", "--root", f"{folder}/out",
        "--import-root", f"{folder}/in", "--name", "orders", "--target-table", table_name,
        "--time", "o_orderdate", "--id", "o_orderkey",
    ]
    assert main(arguments) == 0
    assert_same_rows(spark.table(table_name), load("orders"))


def test_a_source_is_required(capsys):
    with pytest.raises(SystemExit):
        main(["export", "--root", "/x", "--name", "y"])
