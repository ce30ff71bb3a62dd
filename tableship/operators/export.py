"""Export of a source as a versioned Parquet dataset."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableship.functions.columns import unused_name
from tableship.functions.hashing import hash_total, row_hash
from tableship.functions.paths import dataset_path, default_store, inside, new_version
from tableship.operators.layout import (
    ROWS_PER_FILE,
    arrange_ordered,
    arrange_unordered,
    file_start,
    files_per_task,
    has_places,
    rows_cap,
    target_files,
)
from tableship.session import timestamp_statistics
from tableship.sources.manifest import file_manifest, file_stats, stored_bytes
from tableship.sources.resolve import EmptySourceError, Source, stage


class CountMismatchError(ValueError):
    """Source and target do not hold the same rows."""


@dataclass(frozen=True)
class Export:
    """What was written: ``content_hash`` was taken from the rows on their way into the files."""

    source: str
    path: str
    version: str
    row_count: int
    content_hash: Decimal
    column_count: int
    planned_files: int


def export_dataset(
    source: Source,
    root: str,
    name: str,
    *,
    version: str | None = None,
    order_by: str | None = None,
    tie_break: list[str] | tuple[str, ...] = (),
    rows_per_file: int = ROWS_PER_FILE,
    file_bytes: int | None = None,
    ranges: int | None = None,
    mode: str = "errorifexists",
) -> Export:
    """Write ``source`` to ``{root}/{name}/{version}`` as snappy Parquet.

    With ``order_by`` the files hold consecutive ranges, newest rows first; this costs a
    range shuffle into ``ranges`` partitions (by default as many files to one as
    ``files_per_task`` says; they are cut into files by the writer). Without it one even shuffle
    gives each file its share. A version that is already there is never overwritten unless
    ``mode`` says so.

    Passes over the source: one count (answered from Parquet footers), where ordered one over
    the keys alone (see ``arrange_ordered``), and the write. Row count and content hash
    of the written rows are observed during the write itself.
    """
    version = version or new_version()
    path = dataset_path(root, name, version)
    spark = source.frame.sparkSession
    store = default_store(spark)
    if source.location and (
        inside(path, source.location, store) or inside(source.location, path, store)
    ):
        raise ValueError(f"{path} overlaps the source {source.location}")

    source = stage(source)
    df = source.frame
    rows = df.count()
    if rows == 0:
        raise EmptySourceError(f"no rows in {source.label}")

    total_bytes = stored_bytes(spark, source.location) if source.location else None
    files = target_files(rows, rows_per_file, total_bytes, file_bytes)
    per_task = files_per_task(rows, files, total_bytes)

    if not order_by:
        ranges = -(-files // per_task)
        arranged = arrange_unordered(df, files, per_task)
    elif ranges or not has_places(df, [order_by, *tie_break]):
        ranges = min(files, ranges or files)
        arranged = arrange_ordered(df, ranges, order_by, tie_break)
    else:
        starts = [file_start(i, rows, files) for i in range(per_task, files, per_task)]
        ranges = len(starts) + 1
        arranged = arrange_ordered(df, ranges, order_by, tie_break, starts)

    # Observed last, right under the write: earlier it would also see the sampling pass,
    # and only tasks of the final stage are counted once when repeated.
    hash_name = unused_name(df, "_row_hash")
    written = Observation("written")
    observed = arranged.withColumn(hash_name, row_hash(df)).observe(
        written,
        F.count(F.lit(1)).alias("row_count"),
        hash_total(F.col(hash_name)).alias("content_hash"),
    )
    writer = (
        observed.drop(hash_name)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_cap(rows, files, ranges))
    )
    with timestamp_statistics(spark):
        writer.parquet(path)

    seen = written.get
    if seen["row_count"] != rows:
        raise CountMismatchError(f"{source.label}: {rows} rows read, {seen['row_count']} written")
    return Export(
        source.label, path, version, rows, seen["content_hash"], len(df.columns), files
    )


def export_summary(spark: SparkSession, export: Export) -> DataFrame:
    """One row: where the export came from and went to, its rows, columns, files and sizes."""
    stats = file_stats(file_manifest(spark, export.path, glob="*.parquet"))
    return stats.select(
        F.lit(export.source).alias("source"),
        F.lit(export.path).alias("location"),
        F.lit(export.version).alias("version"),
        F.lit(export.row_count).cast("bigint").alias("row_count"),
        F.lit(export.column_count).cast("bigint").alias("column_count"),
        "file_count",
        "total_bytes",
        "total_mb",
        "mean_mb",
    )
