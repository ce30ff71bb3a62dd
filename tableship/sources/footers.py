"""The footers of a Parquet dataset as a table: read once, asked many times.

Schemas, row counts, null counts and ranges of a dataset are in the footers of its files. One
job reads them in tasks, as many files to a task as there are cores for, and writes what they
say to the shared folder; what follows reads that small table and no file again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableship.functions.columns import unused_name
from tableship.functions.paths import default_store, plain_name, store_of
from tableship.session import fresh_folder
from tableship.sources.manifest import file_manifest

FOOTERS = (
    "rel_path string, bytes bigint, row_count bigint, row_groups int, schema_digest string, "
    "schema_text string, columns array<struct<name:string,encoded_bytes:bigint,"
    "null_count:bigint,low:bigint,high:bigint>>, error string"
)


class FooterError(ValueError):
    """A file has no readable footer, or its footer does not say what was asked."""


@dataclass(frozen=True)
class FooterIndex:
    """``files``: one row per file, with an entry per top-level column. ``null_count``, ``low`` and
    ``high`` of a column are null where the writer left them out. Ranges are kept for whole numbers,
    dates (days) and timestamps (microseconds)."""

    files: DataFrame
    schema: T.StructType


def footer_index(spark: SparkSession, path: str) -> FooterIndex:
    """The index of the dataset ``path``, a folder that all executors mount. Other stores are
    refused: there, Spark's own scans read footers (``footer_null_counts``). A file that is no
    Parquet file raises with its name."""
    if store_of(path, default_store(spark)) != "file://":
        raise FooterError(f"{path} is not a mounted folder")
    files = file_manifest(spark, path, include_empty=True).select(
        "rel_path", plain_name(F.col("path")).alias("source"), "length"
    )
    folder = fresh_folder(spark, "footers")
    tasks = max(8, 4 * spark.sparkContext.defaultParallelism)
    read = files.repartition(tasks).mapInPandas(_footer_reader(), FOOTERS)
    read.write.parquet(folder)
    index = spark.read.schema(FOOTERS).parquet(folder)
    broken = index.where("error IS NOT NULL").orderBy("rel_path").head(1)
    if broken:
        raise FooterError(f"{broken[0]['rel_path']}: {broken[0]['error']}")
    return FooterIndex(index.drop("error"), spark.read.parquet(path).schema)


def schema_versions(index: FooterIndex) -> DataFrame:
    """One row per schema among the files: ``schema_digest, files, row_count, example, schema_text``,
    the most frequent first. One row means that no file differs."""
    return (
        index.files.groupBy("schema_digest")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("row_count").alias("row_count"),
            F.min("rel_path").alias("example"),
            F.min("schema_text").alias("schema_text"),
        )
        .orderBy(F.desc("files"), "example")
    )


def indexed_row_count(index: FooterIndex) -> DataFrame:
    return index.files.agg(F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("total_rows"))


def indexed_null_counts(index: FooterIndex) -> DataFrame:
    """One row with the number of nulls of each column; null where a file does not say. A column
    that a file does not have is null in all its rows."""
    names = [f.name for f in index.schema.fields]
    counts = []
    for name in names:
        entry = _entry(name)
        nulls = F.when(entry.isNull(), F.col("row_count")).otherwise(entry["null_count"])
        unknown = F.count_if(nulls.isNull()) > 0
        total = F.coalesce(F.sum(nulls), F.lit(0).cast("bigint"))
        counts.append(F.when(~unknown, total).alias(name))
    return index.files.agg(*counts)


def indexed_range(index: FooterIndex, column: str) -> DataFrame:
    """``earliest`` and ``latest`` of a column, in its own type; raises where a file with values
    does not say them."""
    kind, entry = index.schema[column].dataType, _entry(column)
    has_values = entry.isNotNull() & F.coalesce(entry["null_count"] < F.col("row_count"), F.col("row_count") > 0)
    row = index.files.agg(
        F.count_if(has_values & (entry["low"].isNull() | entry["high"].isNull())).alias("unknown"),
        F.min(entry["low"]).alias("low"),
        F.max(entry["high"]).alias("high"),
    )
    if row.first()["unknown"]:
        raise FooterError(f"some files do not say the range of {column}")
    return row.select(
        _typed(F.col("low"), kind).alias("earliest"), _typed(F.col("high"), kind).alias("latest")
    )


def column_bytes(index: FooterIndex) -> DataFrame:
    """Encoded bytes and bytes per row of each column: what a projection of it reads."""
    entry = unused_name(index.files, "column")
    return (
        index.files.select("row_count", F.explode("columns").alias(entry))
        .groupBy(F.col(f"{entry}.name").alias("col_name"))
        .agg(F.sum(f"{entry}.encoded_bytes").alias("encoded_bytes"), F.sum("row_count").alias("rows"))
        .select("col_name", "encoded_bytes", (F.col("encoded_bytes") / F.col("rows")).alias("bytes_per_row"))
    )


def _entry(name: str) -> Column:
    return F.get(F.filter("columns", lambda c: c["name"] == name), F.lit(0))


def _typed(number: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(number)
    if isinstance(kind, T.TimestampNTZType):
        second = F.pmod(number, F.lit(60_000_000)).cast("decimal(20,0)") / 1_000_000
        minutes = F.floor(number / F.lit(60_000_000)).cast("int")
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return start + F.make_dt_interval(mins=minutes, secs=second.cast("decimal(18,6)"))
    return number.cast(kind)


# Runs inside tasks and imports what it needs itself, so that workers do not need this package.


def _footer_reader():
    def read_batches(batches):
        import datetime as dt
        import hashlib

        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        def number(value):
            if isinstance(value, dt.datetime):
                since = value.replace(tzinfo=None) - dt.datetime(1970, 1, 1)
                return since // dt.timedelta(microseconds=1)
            if isinstance(value, dt.date):
                return (value - dt.date(1970, 1, 1)).days
            return value if isinstance(value, int) and not isinstance(value, bool) else None

        def described(footer, field, places):
            """Sums and ranges over the row groups; None where one of them does not say."""
            size, nulls, low, high = 0, 0, None, None
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                parts = [group.column(k) for k in places]
                size += sum(part.total_compressed_size for part in parts)
                stats = parts[0].statistics if len(parts) == 1 and not pa.types.is_nested(field.type) else None
                known = stats is not None and stats.has_null_count
                nulls = nulls + stats.null_count if known and nulls is not None else None
                if known and stats.null_count == group.num_rows:
                    continue
                ends = stats is not None and stats.has_min_max
                ends = (number(stats.min), number(stats.max)) if ends else (None, None)
                if None in ends or low is False:
                    low = high = False
                else:
                    low = ends[0] if low is None else min(low, ends[0])
                    high = ends[1] if high is None else max(high, ends[1])
            return {
                "name": field.name,
                "encoded_bytes": size,
                "null_count": nulls,
                "low": None if low is False else low,
                "high": None if high is False else high,
            }

        def footer_of(rel_path, source, length):
            try:
                footer = pq.read_metadata(source)
                schema = footer.schema.to_arrow_schema()
            except (OSError, pa.ArrowInvalid) as e:
                return rel_path, length, None, None, None, None, None, f"{type(e).__name__}: {e}"
            leaves = {}
            for k in range(footer.num_columns):
                leaves.setdefault(footer.schema.column(k).path.split(".")[0], []).append(k)
            # A name with dots is found by its whole path.
            for k in range(footer.num_columns):
                leaves.setdefault(footer.schema.column(k).path, [k])
            columns = [described(footer, field, leaves.get(field.name, [])) for field in schema if leaves.get(field.name)]
            text = "; ".join(sorted(f"{field.name} {field.type}" for field in schema))
            digest = hashlib.sha256(text.encode()).hexdigest()
            rows = footer.num_rows, footer.num_row_groups
            return rel_path, length, *rows, digest, text, columns, None

        names = ["rel_path", "bytes", "row_count", "row_groups", "schema_digest", "schema_text"]
        for batch in batches:
            rows = [footer_of(*row) for row in zip(batch["rel_path"], batch["source"], batch["length"])]
            frame = pd.DataFrame(rows, columns=[*names, "columns", "error"], dtype=object)
            yield frame

    return read_batches
