"""Where the rows come from: a catalog table, SQL text, a Parquet directory or a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tableship.functions.columns import quoted
from tableship.session import fresh_folder


class EmptySourceError(ValueError):
    """The data to be moved has no rows."""


class MixedSchemaError(ValueError):
    """The files of one directory do not share a schema."""


@dataclass(frozen=True)
class Source:
    """Rows to be moved.

    ``repeatable`` is true for a plain file scan: reading it again costs one scan and
    a repeated task sees the same rows in the same order. A query, a view or a
    caller's DataFrame promises neither and is staged before it is read twice.
    """

    frame: DataFrame
    label: str
    repeatable: bool
    location: str | None = None


def resolve_source(
    spark: SparkSession,
    *,
    table: str | None = None,
    sql: str | None = None,
    path: str | None = None,
    frame: DataFrame | None = None,
    merge_schema: bool = False,
) -> Source:
    """Exactly one of ``table``, ``sql``, ``path`` and ``frame`` as a ``Source``."""
    if sum(x is not None for x in (table, sql, path, frame)) != 1:
        raise ValueError("give exactly one of table, sql, path and frame")
    if table is not None:
        location = table_location(spark, table)
        return Source(spark.table(table), table, location is not None, location)
    if sql is not None:
        return Source(spark.sql(sql), "query", False)
    if path is not None:
        return Source(read_dataset(spark, path, merge_schema), path, True, path)
    return Source(frame, "dataframe", False)


def read_dataset(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet directory as a DataFrame.

    Without ``merge_schema`` Spark takes the first file's schema and silently leaves out
    columns that only other files have; a directory where this would happen is refused.
    """
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    if merge_schema:
        return merged
    single = spark.read.parquet(path)
    if _shape(single) != _shape(merged):
        raise MixedSchemaError(f"{path} holds files of different schemas; pass merge_schema=True")
    return single


def parquet_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Temporary view over a Parquet directory, usable from SQL text."""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {quoted(name)} "
        f"USING PARQUET OPTIONS (path '{location}')"
    )
    return spark.table(quoted(name))


def require_rows(df: DataFrame, label: str = "source") -> DataFrame:
    """``df`` itself, or an error where it is empty. Reads no more than the first row."""
    if df.isEmpty():
        raise EmptySourceError(f"no rows in {label}")
    return df


def stage(source: Source) -> Source:
    """The source as files in the shared folder, computed once.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation,
    and every further pass reads columnar files.
    """
    if source.repeatable:
        return source
    spark = source.frame.sparkSession
    path = fresh_folder(spark, "staged")
    source.frame.write.parquet(path)
    return Source(spark.read.parquet(path), source.label, True, path)


def table_location(spark: SparkSession, table: str) -> str | None:
    """Directory of a file-backed table; None for a view or a table without files."""
    if spark.catalog.getTable(table).tableType in ("VIEW", "TEMPORARY"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").head(1)
    return rows[0]["data_type"] if rows else None


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked through Spark, so in any store it reads."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
