"""Files as rows: listing, statistics and comparison of datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableship.functions.paths import (
    decoded_path,
    file_name,
    megabytes_of,
    path_version,
    plain_path,
    relative_path,
)
from tableship.session import sibling_session


def file_manifest(
    spark: SparkSession, path: str, glob: str | None = None, include_empty: bool = False
) -> DataFrame:
    """One row per visible file below ``path``:
    ``rel_path, file_name, length, modified, version, path``.

    Markers and other hidden files are left out. A missing path raises. Contents are
    never read: only ``path``, ``length`` and the time are selected. A scan passes over
    files of zero bytes; ``include_empty`` adds them, without a time, for folders that all
    executors mount: tasks look through the folders below ``path`` for them.
    """
    found = _listing(spark, path, glob)
    if include_empty:
        empty = _empty_files(found.sparkSession, plain_path(path))
        found = found.unionByName(empty, allowMissingColumns=True)
    return found.select(
        relative_path(F.col("path"), path).alias("rel_path"),
        file_name(F.col("path")).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
        path_version(F.col("path")).alias("version"),
        "path",
    )


def _listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    # Scans are split by file size, so a listing of 100 TB would be planned as hundreds of
    # thousands of tasks although it opens no file; a cap keeps it at a few per core.
    tasks = max(8, 4 * spark.sparkContext.defaultParallelism)
    session = sibling_session(spark, spark__sql__files__maxPartitionNum=str(tasks))
    reader = session.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def _empty_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and ``length`` 0 of visible empty files. Folders are taken level by level, so
    tasks share the work and no file name reaches the driver."""
    folders = spark.createDataFrame([(root,)], "folder string")
    kind = "folder string, path string"

    def look(batches):
        import os

        import pandas as pd

        for batch in batches:
            rows = []
            for folder in batch["folder"]:
                if os.path.isfile(folder):
                    entries = [(folder, True, False)]
                elif os.path.isdir(folder):
                    with os.scandir(folder) as found:
                        entries = [(e.path, e.is_file(), e.is_dir()) for e in found]
                else:
                    entries = []
                for path, is_file, is_dir in entries:
                    name = os.path.basename(path)
                    if name.startswith(".") or (name.startswith("_") and "=" not in name):
                        continue
                    if is_dir:
                        rows.append((path, None))
                    elif is_file and os.path.getsize(path) == 0:
                        rows.append((None, path))
            yield pd.DataFrame(rows, columns=["folder", "path"])

    empty = spark.createDataFrame([], "path string")
    while True:
        level = folders.repartition("folder").mapInPandas(look, kind)
        empty = empty.unionByName(level.where("path IS NOT NULL").select("path"))
        folders = level.where("folder IS NOT NULL").select("folder")
        if folders.isEmpty():
            return empty.withColumn("length", F.lit(0).cast("bigint"))


def file_stats(manifest: DataFrame) -> DataFrame:
    """One row ``file_count, total_bytes, total_mb, mean_mb``; zeros for no files."""
    total = F.coalesce(F.sum("length"), F.lit(0).cast("bigint"))
    mean = F.coalesce(F.avg("length"), F.lit(0.0))
    return manifest.agg(
        F.count(F.lit(1)).alias("file_count"),
        total.alias("total_bytes"),
        megabytes_of(total).alias("total_mb"),
        megabytes_of(mean).alias("mean_mb"),
    )


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``, which may be a pattern."""
    return _listing(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """Manifest of a Parquet dataset with ``row_count`` per file, 0 for files without rows."""
    # A read without partition discovery sees the same files as the manifest.
    data = spark.read.option("recursiveFileLookup", "true").parquet(path)
    counts = data.groupBy(F.col("_metadata.file_path").alias("encoded")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    # Never null, or else the optimizer would test it for null on every row of the scan.
    rel_path = F.coalesce(relative_path(decoded_path("encoded"), path), F.lit(""))
    counts = counts.select(rel_path.alias("rel_path"), "row_count")
    return (
        file_manifest(spark, path)
        .join(counts, "rel_path", "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    )


def compare_manifests(source: DataFrame, target: DataFrame) -> DataFrame:
    """Outcome per file: ``rel_path, source_bytes, target_bytes, status`` with the status
    ``same``, ``resized``, ``missing`` (not in the target) or ``extra``."""
    left = source.select("rel_path", F.col("length").alias("source_bytes"))
    right = target.select("rel_path", F.col("length").alias("target_bytes"))
    status = (
        F.when(F.col("target_bytes").isNull(), "missing")
        .when(F.col("source_bytes").isNull(), "extra")
        .when(F.col("source_bytes") != F.col("target_bytes"), "resized")
        .otherwise("same")
    )
    return left.join(right, "rel_path", "full_outer").withColumn("status", status)
