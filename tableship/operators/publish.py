"""Publishing a dataset as a catalog table, replacing what was there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableship.functions.columns import quoted
from tableship.functions.paths import dataset_path, new_version, version_of
from tableship.operators.profile import temporal_aggregates
from tableship.operators.reconcile import same_schema
from tableship.session import timestamp_statistics
from tableship.sources.resolve import read_dataset, require_rows


def ensure_namespace(spark: SparkSession, table: str) -> None:
    """Create the schema a qualified table name belongs to, if it is not there."""
    namespace = table.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")


def publish_table(
    spark: SparkSession,
    table: str,
    *,
    path: str | None = None,
    frame: DataFrame | None = None,
    root: str | None = None,
    version: str | None = None,
    properties: dict[str, str] | None = None,
    provider: str = "parquet",
    validate_source: bool = True,
) -> str:
    """Make ``table`` show exactly the rows of ``path`` or ``frame``; returns their location.

    ``path`` is taken over where it lies: no byte moves, the table is pointed at it. A
    ``frame`` is first written to ``{root}/{table}/{version}``. The old version's files
    stay untouched, readers see the old rows until the switch and the new ones after it.
    Properties already on the table are kept, given ones are added.

    ``validate_source=False`` skips the check for rows before the switch. A ``provider``
    other than Parquet replaces the table through that provider's own atomic
    create-or-replace, which the catalog has to support.
    """
    if (path is None) == (frame is None):
        raise ValueError("give exactly one of path and frame")
    if spark.catalog.tableExists(table) and table_kind(spark, table)[0] in _VIEWS:
        raise ValueError(f"{table} is a view; drop it or publish under another name")
    ensure_namespace(spark, table)

    if provider != "parquet":
        data = frame if frame is not None else read_dataset(spark, path)
        if validate_source:
            require_rows(data, table)
        writer = data.writeTo(table).using(provider)
        for key, value in (properties or {}).items():
            writer = writer.tableProperty(key, value)
        writer.createOrReplace()
        return table

    if frame is not None:
        if root is None:
            raise ValueError("a frame needs a root folder to be written to")
        version = version or new_version()
        path = dataset_path(root, table, version)
        with timestamp_statistics(spark):
            frame.write.mode("errorifexists").parquet(path)
    data = read_dataset(spark, path)
    if validate_source:
        require_rows(data, path)

    version = version or version_of(path)
    exists = spark.catalog.tableExists(table)
    kept = table_properties(spark, table) if exists else {}
    wanted = {**kept, **(properties or {}), "tableship.version": version}
    kind, stored_as = table_kind(spark, table) if exists else (None, None)
    external = kind == "EXTERNAL"
    if external and stored_as == "parquet" and same_schema(spark.table(table), data):
        # The location is the switch; properties only describe what is there already.
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
        set_table_properties(spark, table, wanted)
    elif exists:
        _swap(spark, table, path, wanted, drop_old=external)
    else:
        _create_table(spark, table, path, wanted)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return path


_VIEWS = ("VIEW", "TEMPORARY")


def table_kind(spark: SparkSession, table: str) -> tuple[str, str]:
    """Type of a table (``EXTERNAL``, ``MANAGED``, ``VIEW``, ``TEMPORARY``) and the format of its
    files in lower case."""
    kind = spark.catalog.getTable(table).tableType
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").head(1)
    return kind, rows[0]["data_type"].lower() if rows else ""


def _swap(
    spark: SparkSession, table: str, path: str, properties: dict[str, str], drop_old: bool
) -> None:
    """A new entry takes the name over, since a new location can change neither columns nor
    the format. The old entry is put aside first and, if external, dropped last; an error on
    the way gives it its name back. No files are deleted: those of an external table outlive
    its entry, and a managed table stays under its other name."""
    suffix = uuid.uuid4().hex[:8]
    old, new = f"{table}__old_{suffix}", f"{table}__new_{suffix}"
    _create_table(spark, new, path, properties)
    try:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if drop_old:
        spark.sql(f"DROP TABLE {old}")


def _create_table(spark: SparkSession, table: str, path: str, properties: dict[str, str]) -> None:
    spark.sql(
        f"CREATE TABLE {table} USING PARQUET LOCATION {_text(path)} "
        f"TBLPROPERTIES ({_pairs(properties)})"
    )


def set_table_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_pairs(properties)})")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """User properties of a table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith("option.")}


def target_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """One row ``table_name, table_exists, row_count, column_count`` of what is there now."""
    name = F.lit(table).alias("table_name")
    if not spark.catalog.tableExists(table):
        nothing = F.lit(None).cast("bigint")
        return spark.range(1).select(
            name,
            F.lit(False).alias("table_exists"),
            nothing.alias("row_count"),
            nothing.alias("column_count"),
        )
    df = spark.table(table)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        name,
        F.lit(True).alias("table_exists"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
    )


def table_info(spark: SparkSession, table: str, temporal_limit: int | None = None) -> DataFrame:
    """One row: name, rows, columns, properties and the range of each temporal column,
    all from one scan of the temporal columns."""
    df = spark.table(table)
    properties = F.lit(None).cast(T.MapType(T.StringType(), T.StringType()))
    pairs = [F.lit(x) for kv in table_properties(spark, table).items() for x in kv]
    if pairs:
        properties = F.create_map(*pairs)
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"), *temporal_aggregates(df, temporal_limit)
    )
    ranges = [F.col(quoted(c)) for c in counted.columns[1:]]
    return counted.select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        properties.alias("properties"),
        *ranges,
    )


def _pairs(properties: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
