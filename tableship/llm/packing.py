"""Packing documents into sequences of a fixed number of tokens, by patterns.

Only the histogram of lengths decides: it has one count per length, so it fits anywhere.
Lengths are put into size classes, and all patterns of a few classes that fill a sequence are
enumerated. Non-negative least squares fits how often each pattern is repeated so that the
classes of the histogram come out; the repeats are rounded down, and each is filled with
lengths of its classes that add up to a sequence exactly, as far as there are any. What is left
is put into the best-fitting gaps, longest first. The shortest documents take no part in
patterns, since they close gaps best; up to which length, a few values are tried and the plan
with the fewest sequences is taken. The plan is a table of ranges - documents number so-and-so
of this length go here - that a numbering of the documents within each length is joined with.

A null text is an empty one and has the end token alone. Repeated rows are packed as often as
they stand there, those with equal identifiers and texts in any order among themselves; an empty
table gives no rows. A very long text is encoded whole in one task and cut into many pieces. Only the identifier is taken from other
columns, so their names are free.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tableship.llm.common import slices, staged, texts
from tableship.llm.tokens import encoder

PIECE_COLUMNS = ("piece", "start", "length", "ids_crc32")


@dataclass(frozen=True)
class Options:
    """``capacity``: tokens of a sequence; ``end``: id after each document; ``classes``: size
    classes of lengths; ``depth``: documents of a pattern, at most; ``reserves``: shares of
    the capacity up to which documents are left out of the patterns; each one is tried."""

    capacity: int = 2048
    end: int = 0
    classes: int = 128
    depth: int = 3
    reserves: tuple[float, ...] = (1 / 32, 1 / 16, 1 / 4)


DEFAULTS = Options()


def pieces(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    options: Options = DEFAULTS,
) -> DataFrame:
    """``id`` and ``PIECE_COLUMNS``: one row per piece of a document's ids. Pieces but the
    first have the full length."""
    fields = [StructField(name, LongType()) for name in PIECE_COLUMNS]
    schema = StructType([StructField("id", docs.schema[id_column].dataType), *fields])
    end = np.array([options.end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches, 64):
            rows, owners = [], []
            found = encode([raw.decode() for raw in texts(batch, text)])
            for owner, ids in enumerate(found):
                of_document = list(_cut(ids + end, options.capacity))
                rows += of_document
                owners += [owner] * len(of_document)
            ids = batch.column(batch.schema.get_field_index(id_column)).take(pa.array(owners))
            arrays = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *arrays], schema.names)

    return docs.select(id_column, text).mapInArrow(run, schema)


def _cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    n = len(ids) // 4
    first = n - capacity * ((n - 1) // capacity)
    places = [0, *range(first, n + 1, capacity)]
    for piece, (start, stop) in enumerate(zip(places, places[1:], strict=False)):
        yield piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])


def pack(cut: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """``cut`` (as ``pieces`` gives it) with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    cut = staged(cut, "pieces")
    histogram = {
        r["length"]: r["count"] for r in cut.groupBy("length").count().collect()
    }  # at most ``capacity`` rows
    ranges = plan(histogram, options)
    schema = "length long, low long, high long, first long, offset long"
    # The plan has a few rows per length, however many documents there are.
    planned = F.broadcast(spark.createDataFrame(ranges, schema))

    # Documents of a length are numbered in shards; a shard starts where those before end. With
    # the root of their number as shards, neither a shard nor the list of shards gets long.
    shards = [(n, math.isqrt(count - 1) + 1) for n, count in histogram.items()]
    shards = F.broadcast(spark.createDataFrame(shards, "length long, shards long"))
    shard = F.pmod(F.xxhash64("id", *PIECE_COLUMNS), F.col("shards"))
    cut = cut.join(shards, "length").withColumn("shard", shard).drop("shards")
    within = Window.partitionBy("length", "shard").orderBy("id", "piece", "ids_crc32")
    sizes = cut.groupBy("length", "shard").count()
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "length", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip")
    )
    numbered = cut.withColumn("number", F.row_number().over(within) - 1).join(
        starts, ["length", "shard"]
    )
    number = F.col("number") + F.col("skip")
    placed = numbered.join(
        planned,
        (numbered["length"] == planned["length"])
        & (number >= F.col("low"))
        & (number < F.col("high")),
    )
    return placed.select(
        "id",
        "piece",
        "start",
        numbered["length"],
        "ids_crc32",
        (F.col("first") + number - F.col("low")).alias("sequence_id"),
        "offset",
    )


def plan(
    histogram: dict[int, int], options: Options = DEFAULTS
) -> list[tuple[int, int, int, int, int]]:
    """(length, low, high, first, offset): documents ``low`` to ``high`` of a length stand in
    the sequences from number ``first`` on, at ``offset``."""
    lengths = {n: c for n, c in histogram.items() if c > 0}
    # No packing can have fewer sequences than the tokens fill.
    fewest = -(-sum(n * c for n, c in lengths.items()) // options.capacity)
    groups = None
    for reserve in options.reserves:
        left = Counter(lengths)
        full = _from_patterns(left, options, int(reserve * options.capacity))
        tried = _best_fit(full, left, options)
        if groups is None or _sequences(tried) < _sequences(groups):
            groups = tried
        if _sequences(groups) == fewest:
            break
    used: Counter = Counter()
    ranges, first = [], 0
    for lengths, count in groups:
        offset = 0
        for n in lengths:
            ranges.append((n, used[n], used[n] + count, first, offset))
            used[n] += count
            offset += n
        first += count
    return ranges


def _sequences(groups: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(count for _, count in groups)


def _from_patterns(
    left: Counter, options: Options, reserve: int
) -> list[tuple[tuple[int, ...], int]]:
    """Groups of equal, full sequences (their lengths and number) taken out of ``left``, of
    documents longer than ``reserve``."""
    width = -(-options.capacity // options.classes)
    classes = -(-options.capacity // width)
    supply = np.zeros(classes)
    by_class: dict[int, list[int]] = {}
    for n in sorted((n for n in left if n > reserve), reverse=True):
        size = -(-n // width)
        supply[size - 1] += left[n]
        by_class.setdefault(size, []).append(n)
    patterns = [p for p in _patterns(classes, options.depth) if all(s in by_class for s in p)]
    if not patterns:
        return []
    matrix = np.zeros((classes, len(patterns)))
    for column, pattern in enumerate(patterns):
        for size in pattern:
            matrix[size - 1, column] += 1
    # Long documents are hardest to place late, so misses of large classes weigh more.
    weights = np.arange(1, classes + 1, dtype=float) ** 2
    fitted = non_negative_least_squares(matrix * weights[:, None], supply * weights)
    repeats = np.floor(fitted + 1e-9).astype(np.int64)

    groups = []
    for column in np.argsort(-repeats, kind="stable").tolist():
        times = int(repeats[column])
        while times > 0:
            lengths = _full(patterns[column][::-1], by_class, left, options.capacity)
            if lengths is None:
                break  # the classes are used up, or what is left in them does not add up
            taken = Counter(lengths)
            run = min([times, *(left[n] // k for n, k in taken.items())])
            for n, k in taken.items():
                left[n] -= run * k
            groups.append((tuple(sorted(lengths)), run))
            times -= run
    return groups


def _full(
    sizes: tuple[int, ...],
    by_class: dict[int, list[int]],
    left: Counter,
    room: int,
    taken: tuple[int, ...] = (),
) -> tuple[int, ...] | None:
    """Lengths of documents left that fill ``room`` exactly, longest first: one of each of the
    classes, but for the last of any length that closes the sequence."""
    if len(sizes) == 1:
        return (*taken, room) if room > 0 and left[room] > taken.count(room) else None
    for n in by_class[sizes[0]]:
        if n < room and left[n] > taken.count(n):
            found = _full(sizes[1:], by_class, left, room - n, (*taken, n))
            if found:
                return found
    return None


def _patterns(total: int, depth: int, least: int = 1) -> Iterator[tuple[int, ...]]:
    """Non-decreasing sizes, at most ``depth`` of them, that add up to ``total``."""
    if total >= least:
        yield (total,)
    if depth > 1:
        for size in range(least, total // 2 + 1):
            for rest in _patterns(total - size, depth - 1, size):
                yield (size, *rest)


def non_negative_least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 with the least ``|matrix @ x - target|``: the active-set method of Lawson and
    Hanson."""
    x = np.zeros(matrix.shape[1])
    active = np.zeros(matrix.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max()))
    for _ in range(3 * matrix.shape[1]):
        gradient = matrix.T @ (target - matrix @ x)
        gradient[active] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            columns = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, columns], target, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[columns] = solved
                break
            old, bad = x[columns], solved <= 0
            gap = old[bad] - solved[bad]
            step = float(np.min(np.where(gap > 0, old[bad] / np.where(gap > 0, gap, 1), 0)))
            x[columns] = old + step * (solved - old)
            drop = columns[bad & (x[columns] <= tolerance)]
            if not len(drop):
                drop = columns[bad][[int(np.argmin(x[columns][bad]))]]
            x[drop] = 0
            active[drop] = False
    return x


def _best_fit(
    groups: list[tuple[tuple[int, ...], int]], left: Counter, options: Options
) -> list[tuple[tuple[int, ...], int]]:
    """``groups`` with all lengths of ``left`` added, longest first, each to the sequences
    with the smallest gap that holds it, or to new ones."""
    open_groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def put(lengths: tuple[int, ...], count: int) -> None:
        gap = options.capacity - sum(lengths)
        if gap not in open_groups:
            open_groups[gap] = []
            bisect.insort(gaps, gap)
        open_groups[gap].append((lengths, count))

    for lengths, count in groups:
        put(lengths, count)
    for n in sorted(left, reverse=True):
        count = left[n]
        while count > 0:
            place = bisect.bisect_left(gaps, n)
            if place == len(gaps):
                per = min(options.capacity // n, count)
                put((n,) * per, count // per)
                count -= per * (count // per)
                continue
            gap = gaps[place]
            lengths, many = open_groups[gap].pop()
            if not open_groups[gap]:
                del open_groups[gap]
                gaps.pop(place)
            run = min(many, count)
            if many > run:
                put(lengths, many - run)
            put((*lengths, n), run)
            count -= run
    return [group for gap in gaps for group in open_groups[gap]]
