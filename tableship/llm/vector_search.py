"""Exact top-k search by inner product over a vector-approximation file.

Every component is quantised to one of a few cells of its dimension's range. For a query the
cells bound each inner product from below and above. A scan of the cells alone finds the
k-th largest lower bound, and only vectors whose upper bound reaches it are candidates. Their
exact vectors are read in the order of their bounds: first the most promising ones, whose
k-th exact score then decides which of the rest could still be among the results.

Queries and vectors meet in pairs of blocks of bounded size. Equal rows are counted first.
Equal vectors are one entry that keeps its k + 1 smallest identifiers, each with the number of
its rows, which is all that a result can need of them.

Vectors that are null or hold null or non-finite components, and rows without an identifier,
take no part. Only vectors of equal dimension are compared. Rows that repeat an identifier
are separate vectors, equal ones too, but none is a result for a query with that identifier.
Equal rows among the queries have the results of each, one after the other. An empty table, or
no queries, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableship.llm.common import runs, staged


@dataclass(frozen=True)
class Options:
    """``k`` results per query; components are taken as floor(``scale`` * x); ``cells`` per
    dimension, at most 256; ``first``: exact vectors read before the bound is set; queries and
    vectors of a pair of blocks."""

    k: int = 5
    scale: int = 256
    cells: int = 64
    first: int = 16
    query_block: int = 512
    vector_block: int = 8192


DEFAULTS = Options()


def integer_vectors(
    rows: DataFrame, id_column: str, vector: str, options: Options = DEFAULTS
) -> DataFrame:
    """``id`` and ``values`` (little-endian 64-bit integers) of the vectors that take part."""
    values = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * options.scale))

    def bad(x: Column) -> Column:
        number = x.cast("double")
        return x.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))

    usable = F.col(id_column).isNotNull() & F.col(vector).isNotNull()
    usable &= ~F.coalesce(F.exists(F.col(vector), bad), F.lit(True))
    kept = rows.where(usable).select(
        F.col(id_column).cast("long").alias("id"), values.cast("array<bigint>").alias("values")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(v, "<i8").tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], ["id", "values"]
            )

    return kept.mapInArrow(pack, "id long, values binary")


def search(
    rows: DataFrame,
    queries: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    options: Options = DEFAULTS,
) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` of the ``k`` vectors with the largest inner
    products, ties to smaller identifiers. ``queries`` is a condition on the column ``id``."""
    vectors = integer_vectors(rows, id_column, vector, options).groupBy("id", "values")
    vectors = staged(vectors.agg(F.count("*").alias("rows")), "vectors")
    order = Window.partitionBy("values").orderBy("id")
    # Spark keeps the first rows of each group before it shuffles, so copies cost nothing.
    few = vectors.withColumn("n", F.row_number().over(order)).where(F.col("n") <= options.k + 1)
    held = F.struct("id", F.least("rows", F.lit(options.k)).cast("int").alias("rows"))
    entries = few.groupBy("values").agg(F.array_sort(F.collect_list(held)).alias("held"))
    # Numbers of entries and queries are written once, so they stay whatever is read again.
    entries = entries.select(
        F.monotonically_increasing_id().alias("entry"),
        F.col("held.id").alias("ids"),
        F.flatten(F.transform("held", lambda h: F.array_repeat(h["id"], h["rows"]))).alias("each"),
        "values",
    )
    entries = staged(entries, "entries")
    asked = vectors.where(queries).select(
        F.col("id").alias("query_id"),
        F.monotonically_increasing_id().alias("number"),
        F.col("values").alias("query"),
        "rows",
    )
    asked = staged(asked, "queries")

    bounds = staged(_bounds(entries, asked, options), "bounds")
    kth = Window.partitionBy("query_id", "number").orderBy(F.desc("low"))
    least = (
        bounds.withColumn("n", F.row_number().over(kth))
        .where(F.col("n") == options.k)
        .select("query_id", "number", F.col("low").alias("least"))
    )
    keys = ["query_id", "number"]
    candidates = bounds.join(least, keys, "left").where(
        F.col("least").isNull() | (F.col("high") >= F.col("least"))
    )
    by_bound = Window.partitionBy(*keys).orderBy(F.desc("high"), "entry")
    candidates = candidates.withColumn("place", F.row_number().over(by_bound))
    candidates = staged(candidates.select(*keys, "entry", "high", "place"), "candidates")

    first = _exact(candidates.where(F.col("place") <= options.first), entries, asked)
    first = staged(first, "exact-first")
    certain = (
        first.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"))))
        .where(F.col("n") == options.k)
        .select(*keys, F.col("score").alias("certain"))
    )
    rest = candidates.where(F.col("place") > options.first).join(certain, keys, "left").where(
        F.col("certain").isNull() | (F.col("high") >= F.col("certain"))
    )
    found = first.unionByName(_exact(rest, entries, asked))
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= options.k)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    return (
        found.join(asked.select(*keys, "rows"), keys)
        .select("query_id", "rank", "id", "score", times.alias("time"))
        .drop("time")
    )


def _exact(candidates: DataFrame, entries: DataFrame, asked: DataFrame) -> DataFrame:
    """``query_id``, ``number``, ``id`` and ``score`` of candidates, from the exact vectors."""
    pairs = candidates.join(entries, "entry").join(asked, ["query_id", "number"])
    pairs = pairs.select("query_id", "number", "each", "query", "values")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                [np.frombuffer(v, "<i8") for v in batch.column(k).to_pylist()] for k in (3, 4)
            )
            scores = [int(np.dot(x, y)) for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(scores, pa.int64())],
                ["query_id", "number", "each", "score"],
            )

    scored = pairs.mapInArrow(
        multiply, "query_id long, number long, each array<long>, score long"
    )
    return scored.select("query_id", "number", F.explode("each").alias("id"), "score").where(
        "id <> query_id"
    )


def _bounds(entries: DataFrame, asked: DataFrame, options: Options) -> DataFrame:
    """``query_id``, ``number``, ``entry``, ``low`` and ``high`` for the entries that a scan of
    the cells of a pair of blocks does not rule out."""
    spark = entries.sparkSession
    ranges = spark.sparkContext.broadcast(_ranges(entries))

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for raw in batch.column(1).to_pylist():
                v = np.frombuffer(raw, "<i8")
                low, width = _grid(ranges.value[len(v)], options.cells)
                codes.append((((v - low) // width).astype(np.uint8)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(codes, pa.binary())],
                ["entry", "ids", "cells"],
            )

    cells = entries.select("entry", "values", "ids").mapInArrow(
        approximate, "entry long, ids array<long>, cells binary"
    )
    query_blocks = max(1, -(-asked.count() // options.query_block))
    vector_blocks = max(1, -(-entries.count() // options.vector_block))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = asked.select(
        every(vector_blocks).alias("v"),
        F.pmod(F.xxhash64("query_id", "number"), F.lit(query_blocks)).cast("int").alias("q"),
        F.lit(0).alias("side"),
        F.col("query_id").alias("a"),
        F.col("number").alias("b"),
        F.col("query").alias("data"),
        F.array().cast("array<long>").alias("ids"),
    )
    right = cells.select(
        F.pmod(F.xxhash64("entry"), F.lit(vector_blocks)).cast("int").alias("v"),
        every(query_blocks).alias("q"),
        F.lit(1).alias("side"),
        F.col("entry").alias("a"),
        F.lit(0).cast("long").alias("b"),
        F.col("cells").alias("data"),
        "ids",
    )
    met = left.unionByName(right).repartition("v", "q").sortWithinPartitions("v", "q", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "number", "entry", "low", "high"]
        for part, starts in runs(batches, 2):
            for start, stop in zip(starts, starts[1:], strict=False):
                group = part.slice(start, stop - start)
                for columns in _block_bounds(group, ranges.value, options):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return met.mapInArrow(
        compare, "query_id long, number long, entry long, low double, high double"
    )


def _grid(limits: tuple[np.ndarray, np.ndarray], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest value and width of the cells of each dimension."""
    low, high = limits
    return low, (high - low) // cells + 1


def _ranges(entries: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Smallest and largest value per number of dimensions and dimension, over all vectors."""

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, list[np.ndarray]] = {}
            for raw in batch.column(0).to_pylist():
                v = np.frombuffer(raw, "<i8")
                low, high = found.setdefault(len(v), [v, v])
                found[len(v)] = [np.minimum(low, v), np.maximum(high, v)]
            rows = [
                (n, k, low[k], high[k]) for n, (low, high) in found.items() for k in range(n)
            ] + [(n, -1, 0, 0) for n in found]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x) for x in c], pa.int64()) for c in columns],
                ["n", "k", "low", "high"],
            )

    rows = (
        entries.select("values")
        .mapInArrow(extremes, "n long, k long, low long, high long")
        .groupBy("n", "k")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("n", "k")
        .collect()
    )  # one row per dimension
    out: dict[int, tuple[list, list]] = {}
    for row in rows:
        low, high = out.setdefault(row["n"], ([], []))
        if row["k"] >= 0:
            low.append(row["low"])
            high.append(row["high"])
    return {n: (np.array(a, np.int64), np.array(b, np.int64)) for n, (a, b) in out.items()}


def _block_bounds(group: pa.RecordBatch, ranges: dict, options: Options) -> Iterator[tuple]:
    side = group.column(2).to_numpy()
    data = np.array(group.column(5).to_pylist(), object)
    ids = group.column(6).to_pylist()
    a, b = group.column(3).to_numpy(), group.column(4).to_numpy()
    # Queries hold 8 bytes per dimension, cells one.
    dimension = np.array([len(x) for x in data]) // np.where(side == 0, 8, 1)
    for n in np.unique(dimension[side == 0]).tolist():
        asked = np.flatnonzero((side == 0) & (dimension == n))
        held = np.flatnonzero((side == 1) & (dimension == n))
        if not len(held):
            continue
        query = np.frombuffer(b"".join(data[asked]), "<i8").reshape(len(asked), n).astype(float)
        cell = np.frombuffer(b"".join(data[held]), np.uint8).reshape(len(held), n)
        start, width = _grid(ranges[n], options.cells)
        floor = start + cell.astype(np.int64) * width
        middle = (floor + (width - 1) / 2).astype(float)
        centre = query @ middle.T
        reach = (np.abs(query) @ ((width - 1) / 2.0))[:, None]
        # Sums of products of large numbers are rounded: widen by more than that.
        slack = 1e-12 * n * (np.abs(query) @ np.abs(middle).T + reach)
        low, high = centre - reach - slack, centre + reach + slack
        # Entries that are nothing but rows of the query's identifier are no candidates.
        alone: dict[int, list[int]] = {}
        for place, k in enumerate(held):
            if len(ids[k]) == 1:
                alone.setdefault(ids[k][0], []).append(place)
        for row, k in enumerate(asked):
            if a[k] in alone:
                low[row, alone[a[k]]] = high[row, alone[a[k]]] = -np.inf
        if len(held) > options.k:
            least = np.partition(low, -options.k, axis=1)[:, -options.k][:, None]
        else:
            least = np.full((len(asked), 1), -np.inf)
        row, column = np.nonzero((high >= least) & (high > -np.inf))
        yield a[asked[row]], b[asked[row]], a[held[column]], low[row, column], high[row, column]
