"""Does the target hold exactly the rows of the source?

Rows are compared through their hashes, in two steps. First both sides are summed up in
a few thousand buckets; after a good copy all buckets agree, and the comparison of two
tables of any size has shuffled no more than those sums. Only rows of buckets that
differ are then grouped one by one. Groups are combined inside each task before they are
shuffled, so neither a frequent key nor a row copied very often is a burden.

Changes scattered over more than some thousand buckets would send every row to the second
step. ``sketch_bits`` replaces the first step by a sketch from which the keys that differ are
decoded, so that the second step groups the rows of these keys alone.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableship.functions.columns import col, quoted
from tableship.functions.hashing import fingerprint, hash_parts, row_hash
from tableship.operators.difference import Differences, decode, sketch

BUCKETS = 4096


class SchemaMismatchError(ValueError):
    """Source and target differ in column names, types or their order."""


def same_schema(left: DataFrame, right: DataFrame) -> bool:
    """Equal names and types in equal order; nullability is not compared."""
    return [(f.name, f.dataType.simpleString()) for f in left.schema.fields] == [
        (f.name, f.dataType.simpleString()) for f in right.schema.fields
    ]


def require_same_schema(source: DataFrame, target: DataFrame) -> None:
    if not same_schema(source, target):
        raise SchemaMismatchError(
            f"{source.schema.simpleString()} against {target.schema.simpleString()}"
        )


def reconcile_totals(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row ``source_rows, target_rows, same_content, matches``.

    ``matches`` holds only if counts and content hashes agree, so changed values or a row
    lost and another doubled show. One scan of each side, one partial row per task.
    """
    require_same_schema(source, target)
    sides = (
        fingerprint(source)
        .withColumn("side", F.lit("source"))
        .unionByName(fingerprint(target).withColumn("side", F.lit("target")))
    )

    def of(side: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    same_content = of("source", "content_hash") == of("target", "content_hash")
    same_rows = of("source", "row_count") == of("target", "row_count")
    return sides.agg(
        of("source", "row_count").alias("source_rows"),
        of("target", "row_count").alias("target_rows"),
        same_content.alias("same_content"),
        (same_rows & same_content).alias("matches"),
    )


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: list[str] | tuple[str, ...] | None = None,
    buckets: int = BUCKETS,
    sketch_bits: int | None = None,
) -> DataFrame:
    """Rows per status, ``(status, n)``, statuses without rows left out.

    Without ``keys`` whole rows are compared as a bag, copies counted: ``same``,
    ``missing`` from the target, ``extra`` in the target. With ``keys``, rows whose key is
    on both sides with other contents are ``changed``; ``n`` then counts rows of the
    source, for ``extra`` those of the target.

    ``sketch_bits`` looks for the rows that differ by a sketch, as ``key_differences`` does.
    """
    require_same_schema(source, target)
    stacked = _stacked(source, target, keys, buckets)
    decoded = _decoded(stacked, sketch_bits)
    if decoded is None:
        per_bucket = _balance(stacked, [BUCKET])
        settled = per_bucket.where(_balanced()).select(
            F.lit("same").alias("status"), F.col(IN_SOURCE).alias("n")
        )
        suspects = _balance(_in_unsettled_buckets(stacked, per_bucket), _group_columns(keys))
    else:
        suspects = _balance(_of_keys(stacked, decoded), _group_columns(keys))
        total = F.lit(decoded.source_rows).cast("bigint")
        settled = suspects.agg(
            F.lit("same").alias("status"), (total - F.coalesce(F.sum(IN_SOURCE), F.lit(0))).alias("n")
        )
    if keys:
        in_detail = suspects.select(
            _key_status().alias("status"), F.greatest(IN_SOURCE, _only_target()).alias("n")
        )
    else:
        gap = F.col(IN_SOURCE) - F.col(IN_TARGET)
        in_detail = suspects.select(
            F.inline(
                F.array(
                    _status_row("same", F.least(IN_SOURCE, IN_TARGET)),
                    _status_row("missing", F.greatest(gap, F.lit(0).cast("bigint"))),
                    _status_row("extra", F.greatest(-gap, F.lit(0).cast("bigint"))),
                )
            )
        )
    counted = settled.unionByName(in_detail).groupBy("status").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") > 0)


def key_differences(
    source: DataFrame,
    target: DataFrame,
    keys: list[str] | tuple[str, ...],
    buckets: int = BUCKETS,
    sketch_bits: int | None = None,
) -> DataFrame:
    """One row per key that is not the same on both sides: the key, ``in_source`` and
    ``in_target`` (row counts) and ``status`` (``missing``, ``extra`` or ``changed``).

    A key need not be unique: its rows are compared as a bag.

    ``sketch_bits=b`` reads both sides at once into a sketch of 3 * 2 ** b cells, which finds
    up to about 2 ** (b + 1) rows that differ (a changed row counts on either side), wherever
    they stand; 14 is enough for 16,000 changed rows. With more of them the buckets are used.
    """
    require_same_schema(source, target)
    stacked = _stacked(source, target, keys, buckets)
    decoded = _decoded(stacked, sketch_bits)
    if decoded is None:
        suspects = _in_unsettled_buckets(stacked, _balance(stacked, [BUCKET]))
    else:
        suspects = _of_keys(stacked, decoded)
    outcome = _balance(suspects, _group_columns(keys)).select(
        *map(col, keys),
        F.col(IN_SOURCE).alias("in_source"),
        F.col(IN_TARGET).alias("in_target"),
        _key_status().alias("status"),
    )
    return outcome.where(F.col("status") != "same")


def duplicate_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    counted = df.groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)


# Helpers. Names start with two underscores so that they meet no column of the data.

BUCKET, HASH, HASH2, SIGN = "__bucket", "__hash", "__hash2", "__sign"
KEY_HASH = "__key_hash"
IN_SOURCE, IN_TARGET = "__in_source", "__in_target"
GAPS = [f"__gap{i}" for i in range(4)]


def _stacked(source: DataFrame, target: DataFrame, keys, buckets: int) -> DataFrame:
    """Rows of both sides: bucket, grouping columns, row hash and side (1 or -1).

    Without keys rows are grouped by 128 hash bits: at 10^12 rows 64 bits would already
    confuse some thousands of pairs.
    """

    if buckets & (buckets - 1):
        raise ValueError("the number of buckets has to be a power of two")

    def side(df: DataFrame, sign: int) -> DataFrame:
        hashed = row_hash(df)
        if keys:
            group = list(map(col, keys))
            bucket = key_hash = row_hash(df.select(*group))
        else:
            key_hash = row_hash(df, seed=1)
            group = [key_hash.alias(HASH2)]
            bucket = hashed
        return df.select(
            *group,
            # A column that cannot be null: with another one the optimizer would guard the
            # join below by a filter, and the bucket sums would be computed twice over.
            bucket.bitwiseAND(F.lit(buckets - 1).cast("bigint")).alias(BUCKET),
            key_hash.alias(KEY_HASH),
            hashed.alias(HASH),
            F.lit(sign).cast("bigint").alias(SIGN),
        )

    return side(source, 1).unionByName(side(target, -1))


def _group_columns(keys) -> list[str]:
    return [quoted(k) for k in keys] if keys else [HASH, HASH2]


def _balance(stacked: DataFrame, by: list[str]) -> DataFrame:
    """Row counts of each side per group, and by how much their hash sums differ."""
    from_source = F.col(SIGN) > 0
    gaps = [
        F.sum(part * F.col(SIGN)).alias(name)
        for part, name in zip(hash_parts(F.col(HASH)), GAPS)
    ]
    return stacked.groupBy(*by).agg(
        F.count_if(from_source).alias(IN_SOURCE), F.count_if(~from_source).alias(IN_TARGET), *gaps
    )


def _balanced() -> Column:
    same = F.col(IN_SOURCE) == F.col(IN_TARGET)
    for gap in GAPS:
        same = same & (F.col(gap) == 0)
    return same


def _in_unsettled_buckets(stacked: DataFrame, per_bucket: DataFrame) -> DataFrame:
    """Rows of buckets whose sides differ. The list of these buckets is safe to broadcast:
    it has at most as many entries as there are buckets."""
    unsettled = per_bucket.where(~_balanced()).select(BUCKET)
    return stacked.join(F.broadcast(unsettled), BUCKET, "left_semi")


def _decoded(stacked: DataFrame, bits: int | None) -> Differences | None:
    if bits is None:
        return None
    return decode(sketch(stacked, KEY_HASH, HASH, SIGN, bits), bits)


def _of_keys(stacked: DataFrame, decoded: Differences) -> DataFrame:
    """Rows of the keys that differ. A sketch holds no more keys than cells, so their list is
    safe to broadcast; a key that only shares its hash is found to be the same afterwards."""
    spark = stacked.sparkSession
    keys = spark.createDataFrame(pa.table({KEY_HASH: pa.array(decoded.keys, pa.int64())}))
    return stacked.join(F.broadcast(keys), KEY_HASH, "left_semi")


def _key_status() -> Column:
    return (
        F.when(F.col(IN_TARGET) == 0, "missing")
        .when(F.col(IN_SOURCE) == 0, "extra")
        .when(_balanced(), "same")
        .otherwise("changed")
    )


def _only_target() -> Column:
    return F.when(F.col(IN_SOURCE) == 0, F.col(IN_TARGET)).otherwise(0)


def _status_row(status: str, n: Column) -> Column:
    return F.struct(F.lit(status).alias("status"), n.alias("n"))
