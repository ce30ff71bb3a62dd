"""Profiles of a table. Each takes a DataFrame and returns one; none moves a row to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableship.functions.columns import (
    FIXED_WIDTH_TYPES,
    col,
    day_of,
    newest_first,
    temporal_columns,
    unused_name,
)
from tableship.functions.hashing import row_hash
from tableship.session import sibling_session


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of every column, from a single scan.

    Written as all rows less non-null rows, a form that a Parquet reader with aggregate
    pushdown can answer from footers (see ``footer_null_counts``).
    """
    return df.agg(*[(F.count(F.lit(1)) - F.count(col(c))).alias(c) for c in df.columns])


def footer_null_counts(spark: SparkSession, path: str) -> DataFrame:
    """``null_counts`` of a Parquet dataset, reading no data of its fixed-width columns.

    Those are answered from the null counts in the file footers. Writers leave these out
    for long strings, so columns of other types are scanned.
    """
    plain = spark.read.parquet(path)
    fixed = [f.name for f in plain.schema.fields if isinstance(f.dataType, FIXED_WIDTH_TYPES)]
    other = [name for name in plain.columns if name not in fixed]
    footers = sibling_session(
        spark,
        spark__sql__sources__useV1SourceList="",
        spark__sql__parquet__aggregatePushdown="true",
    ).read.parquet(path)
    found = {}
    if fixed:
        found |= null_counts(footers.select(*map(col, fixed))).first().asDict()
    if other:
        found |= null_counts(plain.select(*map(col, other))).first().asDict()
    schema = T.StructType([T.StructField(c, T.LongType()) for c in plain.columns])
    return spark.createDataFrame([tuple(found[c] for c in plain.columns)], schema)


def date_range(df: DataFrame, time_column: str) -> DataFrame:
    c = col(time_column)
    return df.agg(F.min(c).alias("earliest"), F.max(c).alias("latest"))


def quality_summary(
    df: DataFrame, id_column: str, time_column: str, approximate: bool = False
) -> DataFrame:
    """Rows, distinct ids and time range in one row.

    The exact distinct count removes repeated ids inside each task before it shuffles,
    so a frequent id costs no more than a rare one. ``approximate`` shuffles sketches only.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct(col(id_column)).alias("unique_ids"),
        F.min(col(time_column)).alias("earliest_date"),
        F.max(col(time_column)).alias("latest_date"),
    )


def temporal_aggregates(df: DataFrame, limit: int | None = None, by_name: bool = False) -> list:
    pairs = []
    for name in temporal_columns(df, limit, by_name):
        pairs += [F.min(col(name)).alias(f"{name}_min"), F.max(col(name)).alias(f"{name}_max")]
    return pairs


def temporal_profile(df: DataFrame, limit: int | None = None, by_name: bool = False) -> DataFrame:
    """Smallest and largest value of every temporal column, all from one scan."""
    pairs = temporal_aggregates(df, limit, by_name)
    if not pairs:
        raise ValueError("no temporal columns")
    return df.agg(*pairs)


def date_distribution(
    df: DataFrame, time_column: str, days: int | None = 10, tz: str | None = None
) -> DataFrame:
    """Rows per calendar day, newest days first. Counted inside each task before shuffling."""
    per_day = df.groupBy(day_of(df, time_column, tz).alias("date")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    ordered = per_day.orderBy(F.col("date").desc_nulls_last())
    return ordered if days is None else ordered.limit(days)


def recent_records(
    df: DataFrame,
    time_column: str,
    k: int = 10,
    tie_break: list[str] | tuple[str, ...] | None = None,
    prune: bool = False,
) -> DataFrame:
    """The ``k`` newest rows. Ties fall to ``tie_break`` (descending), without one to the row hash.

    ``prune`` looks up the ``k`` newest times first, reading that one column; the wide scan
    then skips the files and row groups that are older by their statistics.
    """
    if prune:
        df = _at_least_kth_newest(df, time_column, k)
    keys = newest_first(time_column, list(tie_break or ()))
    if tie_break:
        return df.orderBy(*keys).limit(k)
    marker = unused_name(df, "_row_hash")
    return df.withColumn(marker, row_hash(df)).orderBy(*keys, marker).limit(k).drop(marker)


def _at_least_kth_newest(df: DataFrame, time_column: str, k: int) -> DataFrame:
    """Only rows that can be among the ``k`` newest; all rows where fewer have a time."""
    c = col(time_column)
    newest = df.select(c.alias("t")).where(F.col("t").isNotNull())
    newest = newest.orderBy(F.col("t").desc()).limit(k)
    bound = newest.agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t")).first()
    if bound["n"] < k:
        return df
    return df.where(c >= F.lit(bound["t"]))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def preview(df: DataFrame, width: int = 100) -> DataFrame:
    """Every column as text of at most ``width`` characters, for display."""
    return df.select(*[F.substring(col(c).cast("string"), 1, width).alias(c) for c in df.columns])


def table_schema(df: DataFrame) -> DataFrame:
    """One row per column: ``position, col_name, data_type``."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, col_name string, data_type string")


def column_profile(df: DataFrame) -> DataFrame:
    """``table_schema`` with the ``row_count`` and ``null_count`` of each column, from one scan."""
    described = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("col_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            (F.count(F.lit(1)) - F.count(col(f.name))).alias("null_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*described).alias("columns"))
    return counts.select("row_count", F.inline("columns")).select(
        "position", "col_name", "data_type", "row_count", "null_count"
    )
