from __future__ import annotations

import glob
import hashlib
import os

import pandas as pd
import pytest
from conftest import SF_DIR, assert_same_rows
from pyspark.sql import functions as F

import tableship as ts
from tableship.operators.transfer import TransferError


@pytest.fixture
def dataset(spark, load, folder):
    path = f"{folder}/source data"
    load("lineitem").repartition(6).write.parquet(path)
    return path


def digests(root):
    found = {}
    for base, _, names in os.walk(root):
        for name in names:
            file = os.path.join(base, name)
            rel = os.path.relpath(file, root)
            if not any(part.startswith(("_", ".")) for part in rel.split(os.sep)):
                with open(file, "rb") as f:
                    found[rel] = hashlib.sha256(f.read()).hexdigest()
    return found


def test_rewrite(spark, load, dataset, folder):
    copy = ts.transfer_dataset(spark, dataset, f"{folder}/copy")
    assert_same_rows(copy, load("lineitem"))


def test_rewrite_keeps_partition_columns(spark, load, folder):
    load("nation").write.partitionBy("n_regionkey").parquet(f"{folder}/p")
    copy = ts.transfer_dataset(spark, f"{folder}/p", f"{folder}/copy")
    text = F.col("n_regionkey").cast("string")
    assert_same_rows(copy, spark.read.parquet(f"{folder}/p").withColumn("n_regionkey", text))
    assert os.path.isdir(f"{folder}/copy/n_regionkey=3")


@pytest.mark.parametrize("split", [1 << 30, 10_000])
def test_files(spark, load, dataset, folder, split):
    outcomes = ts.copy_files(spark, dataset, f"{folder}/copy", split_bytes=split)
    assert digests(f"{folder}/copy") == digests(dataset)
    summary = ts.transfer_summary(outcomes).first()
    assert (summary["total_files"], summary["copied"], summary["complete"]) == (6, 6, True)
    assert summary["total_bytes"] == sum(map(os.path.getsize, glob.glob(f"{dataset}/*.parquet")))
    chunks = {r["chunks"] for r in outcomes.collect()}
    assert chunks == {1} if split > 1 << 20 else min(chunks) > 1
    assert_same_rows(spark.read.parquet(f"{folder}/copy"), load("lineitem"))


def test_files_keep_directories_and_empty_files(spark, load, folder):
    load("nation").write.partitionBy("n_regionkey").parquet(f"{folder}/p")
    open(f"{folder}/p/n_regionkey=0/nothing.parquet", "wb").close()
    outcomes = ts.copy_files(spark, f"{folder}/p", f"{folder}/copy")
    assert outcomes.count() == 6 and outcomes.where("NOT ok").count() == 0
    assert digests(f"{folder}/copy") == digests(f"{folder}/p")


def test_odd_file_names(spark, folder):
    os.makedirs(f"{folder}/s/x=1 %20+y")
    for name, content in (("100% +a b.bin", b"abc"), ("50%25 c+d.bin", b""), ("ü.bin", b"")):
        with open(f"{folder}/s/x=1 %20+y/{name}", "wb") as f:
            f.write(content)
    outcomes = ts.copy_files(spark, f"{folder}/s", f"{folder}/t")
    assert outcomes.count() == 3 and outcomes.where("NOT ok").count() == 0
    assert digests(f"{folder}/t") == digests(f"{folder}/s")


def test_a_single_file(spark, load, folder):
    outcomes = ts.copy_files(spark, f"{SF_DIR}/region.parquet", f"{folder}/t")
    assert [r["rel_path"] for r in outcomes.collect()] == ["region.parquet"]
    assert_same_rows(spark.read.parquet(f"{folder}/t"), load("region"))


def test_outcomes_do_not_copy_again(spark, dataset, folder):
    outcomes = ts.copy_files(spark, dataset, f"{folder}/copy")
    victim = glob.glob(f"{folder}/copy/*.parquet")[0]
    os.remove(victim)
    assert outcomes.count() == outcomes.count() == 6
    assert not os.path.exists(victim)


def test_copying_twice_replaces_files(spark, dataset, folder):
    ts.copy_files(spark, dataset, f"{folder}/copy")
    victim = glob.glob(f"{folder}/copy/*.parquet")[0]
    with open(victim, "wb") as f:
        f.write(b"broken")
    ts.copy_files(spark, dataset, f"{folder}/copy")
    assert digests(f"{folder}/copy") == digests(dataset)


def test_one_file_that_cannot_arrive(spark, dataset, folder):
    """A folder stands where one file has to go."""
    blocked = sorted(os.path.basename(f) for f in glob.glob(f"{dataset}/*.parquet"))[0]
    os.makedirs(f"{folder}/copy/{blocked}/x")
    outcomes = ts.copy_files(spark, dataset, f"{folder}/copy", strict=False)
    summary = ts.transfer_summary(outcomes).first()
    assert (summary["total_files"], summary["copied"], summary["complete"]) == (6, 5, False)
    assert [r["rel_path"] for r in outcomes.where("error IS NOT NULL").collect()] == [blocked]
    with pytest.raises(TransferError, match=blocked):
        ts.copy_files(spark, dataset, f"{folder}/copy")


def test_lost_and_truncated_files_show_in_the_manifests(spark, dataset, folder):
    ts.copy_files(spark, dataset, f"{folder}/copy")
    lost, cut = sorted(glob.glob(f"{folder}/copy/*.parquet"))[:2]
    os.remove(lost)
    os.truncate(cut, 100)
    outcome = ts.compare_manifests(
        ts.file_manifest(spark, dataset), ts.file_manifest(spark, f"{folder}/copy")
    )
    bad = {r["rel_path"]: r["status"] for r in outcome.where("status <> 'same'").collect()}
    assert bad == {os.path.basename(lost): "missing", os.path.basename(cut): "resized"}


def test_overlapping_roots_and_unknown_modes(spark, dataset):
    with pytest.raises(ValueError, match="overlaps"):
        ts.transfer_dataset(spark, dataset, f"{dataset}/inner")
    with pytest.raises(ValueError, match="unknown mode"):
        ts.transfer_dataset(spark, dataset, "/tmp/elsewhere", mode="magic")


def test_transfer_of_a_single_file_dataset(spark, load, folder):
    copy = ts.transfer_dataset(spark, f"{SF_DIR}/region.parquet", f"{folder}/copy")
    assert_same_rows(copy, load("region"))


def begun(spark, source, target, chunks, split=10_000):
    """What a copy leaves behind whose driver was lost after so many chunks."""
    from tableship.functions.paths import plain_name
    from tableship.operators import transfer

    root = f"{target}/_transfer/lost"
    os.makedirs(f"{root}/journal")
    mark = f"{target}/_transfer/mark-lost"
    with open(mark, "w") as f:
        f.write("lost")
    rows = []
    manifest = ts.file_manifest(spark, source)
    files = manifest.select("rel_path", plain_name(F.col("path")).alias("path"), "length", F.unix_micros("modified").alias("m"))
    for f in files.orderBy("rel_path").collect():
        for start in range(0, f["length"], split):
            size = min(split, f["length"] - start)
            rows.append((f["rel_path"], f["path"], start, size, f["length"], f["m"]))
    columns = ["rel_path", "source", "start", "size", "length", "modified"]
    copier = transfer._chunk_copier(target, "lost", 1, mark, f"{root}/journal")
    done = list(copier(iter([pd.DataFrame(rows[:chunks], columns=columns)])))
    assert done[0]["error"].isna().all()
    return len(rows)


def test_a_lost_copy_is_resumed(spark, dataset, folder):
    target = f"{folder}/copy"
    n = begun(spark, dataset, target, 7)
    with open(glob.glob(f"{target}/_transfer/lost/journal/*")[0], "a") as f:
        f.write('{"rel_path": "unfini')  # a line the lost task did not get to end
    outcomes = ts.copy_files(spark, dataset, target, split_bytes=10_000, resume=True)
    seen = outcomes.agg(F.sum("chunks").alias("chunks"), F.sum("reused").alias("reused")).first()
    assert (seen["chunks"], seen["reused"]) == (n, 7)
    assert digests(target) == digests(dataset)


def test_resume_copies_again_what_is_damaged_gone_or_changed(spark, dataset, folder):
    target = f"{folder}/copy"
    ts.copy_files(spark, dataset, target)
    files = sorted(os.path.basename(f) for f in glob.glob(f"{dataset}/*.parquet"))
    os.remove(f"{target}/{files[0]}")
    with open(f"{target}/{files[1]}", "r+b") as f:
        f.seek(100)
        f.write(b"damaged")
    with open(f"{dataset}/{files[2]}", "r+b") as f:
        f.truncate(50)
    outcomes = {r["rel_path"]: r for r in ts.copy_files(spark, dataset, target, resume=True).collect()}
    assert [outcomes[f]["reused"] for f in files] == [0, 0, 0, 1, 1, 1]
    assert all(r["ok"] for r in outcomes.values())
    assert digests(target) == digests(dataset)


def test_resume_without_an_earlier_copy(spark, dataset, folder):
    outcomes = ts.copy_files(spark, dataset, f"{folder}/copy", resume=True)
    assert outcomes.where("ok AND reused = 0").count() == 6
