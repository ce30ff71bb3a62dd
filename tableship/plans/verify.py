"""Checks of a migration, as rows ``(check_name, passed, detail)``."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableship.functions.columns import col, day_of
from tableship.functions.hashing import fingerprint, hash_total, row_hash
from tableship.operators.export import CountMismatchError, Export
from tableship.operators.profile import recent_records
from tableship.operators.reconcile import reconcile_totals
from tableship.sources.resolve import Source, require_rows

REPORT = "check_name string, passed boolean, detail string"


def profile_source(source: Source) -> DataFrame:
    """One row ``source, row_count, column_count, content_hash, table_schema``; an empty source
    raises. Some rows of it are shown by ``preview(sample_rows(...))``."""
    df = require_rows(source.frame, source.label)
    return fingerprint(df).select(
        F.lit(source.label).alias("source"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "content_hash",
        F.lit(df.schema.simpleString()).alias("table_schema"),
    )


def verify_export(spark: SparkSession, export: Export, source: DataFrame | None = None) -> DataFrame:
    """One row ``source_rows, target_rows, matches``; raises where they do not match.

    The files are read back and compared with what was observed during the write, one
    pass over the export; given the ``source``, with a fresh pass over that.
    """
    written = spark.read.parquet(export.path)
    if source is not None:
        compared = reconcile_totals(source, written).select(
            "source_rows", "target_rows", "matches"
        )
    else:
        read_back = fingerprint(written)
        compared = read_back.select(
            F.lit(export.row_count).cast("bigint").alias("source_rows"),
            F.col("row_count").alias("target_rows"),
            (
                (F.col("row_count") == export.row_count)
                & (F.col("content_hash") == F.lit(export.content_hash).cast("decimal(38,0)"))
            ).alias("matches"),
        )
    return _checked(compared, strict=True, label=export.path)


def verify_import(source: DataFrame, target: DataFrame, strict: bool = True) -> DataFrame:
    """``reconcile_totals`` of source and target. A mismatch raises, or with
    ``strict=False`` is a row whose ``matches`` is false."""
    return _checked(reconcile_totals(source, target), strict, "target")


def _checked(compared: DataFrame, strict: bool, label: str) -> DataFrame:
    """The comparison as a local row, so that looking at it again costs no second scan."""
    row = compared.first()
    if strict and not row["matches"]:
        raise CountMismatchError(
            f"{label}: {row['source_rows']} source rows, {row['target_rows']} target rows, "
            "or equal counts of different rows"
        )
    return compared.sparkSession.createDataFrame([row], compared.schema)


def verification_report(
    df: DataFrame,
    time_column: str,
    *,
    id_column: str | None = None,
    check_ids: bool = True,
    expected_rows: int | None = None,
    expected_hash: Decimal | None = None,
    expected_columns: list[str] | None = None,
    expected_schema: StructType | None = None,
    recent: int = 5,
) -> DataFrame:
    """One row per check of a table; a check that fails with an error is a failed row and
    does not stop the others.

    ``row_count``: not empty and as expected. ``table_schema``: columns have the expected
    names, with an ``expected_schema`` the expected types too. ``recent_records``: the newest
    rows can be read with all their columns, and are those the time range ends with.
    ``date_range``: some row has a time. ``date_distribution``: the rows that have a day are
    all rows. With an ``id_column``, ``unique_ids``: no id twice. With an ``expected_hash``,
    ``content``: same rows. Counts, range, days and hash come from one scan.
    """
    spark = df.sparkSession
    found: dict[str, object] = {}

    def totals() -> dict[str, object]:
        # One scan shared by the checks below; nothing in it needs a shuffle of rows.
        if not found:
            wanted = [F.count(F.lit(1)).alias("rows")]
            if time_column in df.columns:
                c = col(time_column)
                wanted += [
                    F.min(c).alias("earliest"),
                    F.max(c).alias("latest"),
                    F.count(day_of(df, time_column)).alias("dated"),
                ]
            if expected_hash is not None:
                wanted.append(hash_total(row_hash(df)).alias("content_hash"))
            found.update(df.agg(*wanted).first().asDict())
        return found

    def check_rows():
        rows = totals()["rows"]
        if expected_rows is None:
            return rows > 0, f"{rows:,} rows"
        return rows == expected_rows and rows > 0, f"{rows:,} rows, {expected_rows:,} expected"

    def check_schema():
        described = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        as_named = expected_columns is None or df.columns == expected_columns
        typed = lambda s: [(f.name, f.dataType.simpleString()) for f in s]
        as_typed = expected_schema is None or typed(df.schema) == typed(expected_schema)
        return as_named and as_typed, described

    def check_recent():
        newest = recent_records(df, time_column, recent, [id_column] if id_column else None)
        rows = newest.collect()  # at most ``recent`` rows, read in full
        wanted, latest = min(recent, totals()["rows"]), totals()["latest"]
        newest_first = not rows or rows[0][time_column] == latest
        return len(rows) == wanted and newest_first, f"{len(rows)} of {wanted} newest rows"

    def check_range():
        seen = totals()
        return seen["earliest"] is not None, f"{seen['earliest']} to {seen['latest']}"

    def check_days():
        seen = totals()
        return seen["dated"] == seen["rows"], f"{seen['dated']:,} of {seen['rows']:,} rows have a day"

    def check_unique():
        rows = totals()["rows"]
        ids = df.agg(F.count_distinct(col(id_column)).alias("n")).first()["n"]
        return ids == rows, f"{ids:,} ids in {rows:,} rows"

    def check_content():
        content = totals()["content_hash"]
        return content == expected_hash, f"content hash {content}"

    checks: list[tuple[str, Callable]] = [
        ("row_count", check_rows),
        ("table_schema", check_schema),
        ("recent_records", check_recent),
        ("date_range", check_range),
        ("date_distribution", check_days),
    ]
    if id_column and check_ids:
        checks.append(("unique_ids", check_unique))
    if expected_hash is not None:
        checks.append(("content", check_content))
    rows = [(name, *_isolated(check)) for name, check in checks]
    return spark.createDataFrame(rows, REPORT)


def _isolated(check: Callable) -> tuple[bool, str]:
    try:
        passed, detail = check()
        return bool(passed), detail
    except Exception as e:  # any failure of one check is that check's result
        return False, f"{type(e).__name__}: {str(e).splitlines()[0]}"
