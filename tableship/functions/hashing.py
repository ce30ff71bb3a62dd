"""Row hashes and table fingerprints that see every null, type and position.

``xxhash64`` skips nulls, so ``(null, 'a')`` and ``('a', null)`` hash alike. Each row
hash therefore starts with a bitmap of its null columns, and nested values are first
brought to a form in which nulls and lengths are explicit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableship.functions.columns import col

_BITS = 63


def row_hash(df: DataFrame, seed: int | None = None) -> Column:
    """64-bit hash of a whole row. Different ``seed`` values give independent hashes."""
    fields = df.schema.fields
    parts = [] if seed is None else [F.lit(seed)]
    for start in range(0, len(fields), _BITS):
        parts.append(_null_bitmap(fields[start : start + _BITS]))
    parts += [_comparable(col(f.name), f.dataType) for f in fields]
    return F.xxhash64(*parts)


def hash_parts(hashes: Column) -> list[Column]:
    """A hash as four numbers of 16 bits, the first one signed, lowest bits last.

    Their sums are plain 64-bit additions that hold for 10^14 rows, where the hashes
    themselves would overflow after two and decimals would cost several times more.
    """
    low = F.lit(0xFFFF).cast("bigint")
    return [
        F.shiftright(hashes, 48),
        F.shiftright(hashes, 32).bitwiseAND(low),
        F.shiftright(hashes, 16).bitwiseAND(low),
        hashes.bitwiseAND(low),
    ]


def hash_total(hashes: Column) -> Column:
    """Order-free sum of row hashes as ``decimal(38,0)``; 0 for no rows."""
    total = F.lit(0).cast("decimal(38,0)")
    for shift, part in zip((48, 32, 16, 0), hash_parts(hashes)):
        weight = F.lit(1 << shift).cast("decimal(15,0)")
        total = total + F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * weight
    return total.cast("decimal(38,0)")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row ``(row_count, content_hash)``, independent of row order and partitioning."""
    hashed = df.select(row_hash(df).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("row_count"),
        hash_total(F.col("h")).alias("content_hash"),
    )


def _null_bitmap(fields: list[T.StructField]) -> Column:
    bitmap = F.lit(0).cast("bigint")
    for i, field in enumerate(fields):
        bitmap = bitmap.bitwiseOR(F.shiftleft(col(field.name).isNull().cast("bigint"), i))
    return bitmap


def _comparable(value: Column, dtype: T.DataType) -> Column:
    """A hashable value that is equal exactly when ``value`` is equal."""
    if isinstance(dtype, T.NullType):
        return F.lit(True)
    if isinstance(dtype, T.VariantType):
        return F.to_json(value)
    if isinstance(dtype, T.StructType):
        parts = []
        for field in dtype.fields:
            member = value.getField(field.name)
            parts += [member.isNull(), _comparable(member, field.dataType)]
        return F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    if isinstance(dtype, T.ArrayType):
        return _comparable_array(value, dtype)
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _comparable(e["key"], dtype.keyType).alias("k"),
                e["value"].isNull().alias("n"),
                _comparable(e["value"], dtype.valueType).alias("v"),
            ),
        )
        return F.struct(F.size(value).alias("size"), F.array_sort(entries).alias("entries"))
    return value


def _comparable_array(value: Column, dtype: T.ArrayType) -> Column:
    size = F.size(value).alias("size")
    element = dtype.elementType
    if isinstance(element, (T.ArrayType, T.StructType, T.MapType, T.VariantType, T.NullType)):
        items = F.transform(
            value,
            lambda x: F.struct(x.isNull().alias("n"), _comparable(x, element).alias("v")),
        )
        return F.struct(size, items.alias("items"))
    if not dtype.containsNull:
        return F.struct(size, value.alias("items"))
    # Plain elements are hashed in place; positions of nulls are added only where there are any.
    nulls = F.when(
        F.exists(value, lambda x: x.isNull()), F.transform(value, lambda x: x.isNull())
    )
    return F.struct(size, value.alias("items"), nulls.alias("nulls"))
