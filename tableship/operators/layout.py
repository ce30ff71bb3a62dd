"""How many files to write and which rows go into which file."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableship.functions.columns import col, newest_first, unused_name
from tableship.session import fresh_folder

# Fixed value: rows per output file.
ROWS_PER_FILE = 100_000

#: Stored bytes of the source that one output file takes at most: one task writes a file, so
#: with wide rows it would have to read them all.
MOST_FILE_BYTES = 128 << 20

#: A task writes small files one after the other, up to so many rows, bytes and files.
_TASK_ROWS = 100_000
_TASK_BYTES = 128 << 20
_TASK_FILES = 100

#: Up to so many different sort keys are counted on their own to cut ranges.
_MOST_KEYS = 50_000

#: Rows of one key are counted by blocks of 2 to this power of their running numbers.
_BLOCK_BITS = 18


def target_files(
    rows: int,
    rows_per_file: int = ROWS_PER_FILE,
    total_bytes: int | None = None,
    file_bytes: int | None = None,
) -> int:
    """Number of output files, by one rule at every size: one for each ``rows_per_file`` rows,
    at least one, and where ``total_bytes`` is known no fewer than one for each
    ``MOST_FILE_BYTES``; or, where ``file_bytes`` is given, one for each of so many of
    ``total_bytes``. Never more than rows."""
    if file_bytes is None:
        of_bytes = min(rows, -(-(total_bytes or 0) // MOST_FILE_BYTES))
        return max(1, rows // rows_per_file, of_bytes)
    if total_bytes is None:
        raise ValueError("file_bytes needs total_bytes")
    return max(1, min(rows, -(-total_bytes // file_bytes)))


def files_per_task(rows: int, files: int, total_bytes: int | None = None) -> int:
    """How many of ``files`` a task may write. The writer begins a new file after
    ``rows_cap`` rows; files differ by one row, so it makes as many of them as planned where
    a task has no more files than a file has rows."""
    of_file = rows // files
    if of_file < 2:
        return 1
    fitting = [_TASK_ROWS // of_file, _TASK_FILES, of_file]
    if total_bytes:
        fitting.append(_TASK_BYTES * files // total_bytes)
    return max(1, min(fitting))


def file_start(file: int, rows: int, files: int) -> int:
    """Rows before a file: shares differ by one row, the larger ones come first."""
    return file * (rows // files) + min(file, rows % files)


def arrange_ordered(
    df: DataFrame,
    ranges: int,
    order_by: str,
    tie_break: list[str] | tuple[str, ...] = (),
    starts: list[int] | None = None,
) -> DataFrame:
    """``ranges`` partitions of consecutive ranges of ``order_by``, newest first, each sorted.

    Written out, file ``i`` holds no older rows than file ``i + 1``. Below the keys the
    ranges are cut by a running number, so neither one time nor one row repeated for a third
    of the table ends up in one partition. A repeated task must number its rows as before, so
    ``df`` has to be a plain file scan (see ``stage``).

    Where all keys are times, dates or whole numbers, ranges are cut exactly: into equal shares,
    or at the row positions ``starts`` of all ranges but the first. Where there are few different
    keys they are counted for it, otherwise the keys alone are sorted; whole rows are read
    once, with the number of their range. Keys of other types go through Spark's range
    shuffle, whose sampling pass reads whole rows as well.
    """
    names = [order_by, *tie_break]
    keys = newest_first(order_by, list(tie_break))
    row_no = unused_name(df, "_row_no")
    if ranges > 1 and has_places(df, names):
        # A column of its own: it must not be counted inside another expression.
        rows = df.withColumn(row_no, F.monotonically_increasing_id())
        number = unused_name(rows, "_range")
        numbered = None
        if _few_keys(df, names):
            numbered = _numbered_by_keys(rows, names, row_no, number, ranges, starts)
        if numbered is None:
            places = [*(_place(df, name) for name in names), col(row_no)]
            numbered = rows.withColumn(number, range_numbers(rows, ranges, places, starts))
        arranged = numbered.drop(row_no).repartitionById(ranges, number)
        return arranged.sortWithinPartitions(*keys).drop(number)
    return (
        df.withColumn(row_no, F.monotonically_increasing_id())
        .repartitionByRange(ranges, *keys, row_no)
        .sortWithinPartitions(*keys)
        .drop(row_no)
    )


def _few_keys(df: DataFrame, names: list[str]) -> bool:
    """Whether it pays to count the rows of each key: some rows tell. Where they are wrong, only
    time is lost."""
    share = 4 * _MOST_KEYS / max(1, df.count())
    some = df.select(*map(col, names))
    some = some.sample(share, seed=7) if share < 1 else some
    different = F.approx_count_distinct(F.xxhash64(*map(col, names)))
    return some.agg(different.alias("n")).first()["n"] <= _MOST_KEYS


def _numbered_by_keys(
    rows: DataFrame,
    names: list[str],
    row_no: str,
    number: str,
    ranges: int,
    starts: list[int] | None,
) -> DataFrame | None:
    """``rows`` with the number of their range, from the rows of each key. Only where a range
    ends among rows of one key, the running number of its last row is looked up. The driver
    has one row per key and one per range, and they are joined to the rows as a small table;
    None where there are more keys than the driver should hold."""
    spark = rows.sparkSession
    places = [f"p{i}" for i in range(len(names))]
    block = F.shiftright(col(row_no), _BLOCK_BITS)
    grouped = rows.groupBy(*map(col, names), block.alias(number)).agg(
        F.count(F.lit(1)).alias(row_no)
    )
    folder = fresh_folder(spark, "keys")
    grouped.select(
        *(_place(rows, name).alias(place) for name, place in zip(names, places, strict=True)),
        col(number).alias("block"),
        col(row_no).alias("n"),
    ).write.parquet(folder)
    counted = spark.read.parquet(folder)
    totals = counted.groupBy(*places).agg(F.sum("n").alias("n"))
    table = totals.limit(_MOST_KEYS + 1).toArrow()
    if len(table) > _MOST_KEYS:
        return None
    table = table.sort_by([(place, "ascending") for place in places])
    before = np.concatenate([[0], np.cumsum(table["n"].to_numpy())])
    if starts is None:
        starts = [file_start(i, int(before[-1]), ranges) for i in range(1, ranges)]
    starts = np.array(starts, np.int64)
    first = np.searchsorted(starts, before[:-1], "right")
    # Ranges that begin after the first row of a key and before its end.
    after = np.searchsorted(starts, before[1:], "left")
    at = np.flatnonzero(first < after)
    keys = list(zip(*(table[place].to_pylist() for place in places), strict=True))
    wanted = {keys[g]: (starts[first[g] : after[g]] - before[g]).tolist() for g in at}

    found = unused_name(rows, "_found")
    key = [unused_name(rows, f"_p{i}") for i in range(len(names))]
    rows = rows.withColumns({k: _place(rows, name) for k, name in zip(key, names, strict=True)})
    narrow = rows.select(*key, row_no).toDF(*places, "row_no")
    ends = _last_of_keys(narrow, counted, places, wanted)
    kind = T.StructType().add("first", T.IntegerType()).add("ends", T.ArrayType(T.LongType()))
    known = pa.table({
        **{k: table[place] for k, place in zip(key, places, strict=True)},
        found: pa.StructArray.from_arrays(
            [
                pa.array(first, pa.int32()),
                pa.array([ends.get(k) for k in keys], pa.list_(pa.int64())),
            ],
            ["first", "ends"],
        ),
    })
    known = spark.createDataFrame(known, T.StructType([*(T.StructField(k, T.LongType()) for k in key), T.StructField(found, kind)]))
    # Every key is known, so the join neither loses nor repeats a row.
    numbered = rows.join(F.broadcast(known), key, "left").withColumn(number, F.lit(0))
    # Bisection, a step a column: how many of the key's ranges end before a row.
    for bit in reversed(range(max(map(len, ends.values()), default=0).bit_length())):
        end = F.get(F.col(found)["ends"], col(number) + ((1 << bit) - 1))
        passed = F.when(end < col(row_no), 1 << bit).otherwise(0)
        numbered = numbered.withColumn(number, col(number) + passed)
    numbered = numbered.withColumn(number, col(number) + F.col(found)["first"])
    return numbered.drop(*key, found)


def _last_of_keys(
    rows: DataFrame, counted: DataFrame, places: list[str], wanted: dict[tuple, list[int]]
) -> dict[tuple, list[int]]:
    """The running number of the ``n``-th row of a key, for all wanted ``n`` in order. Rows are
    counted by key and block, and only those of blocks that hold a wanted row are sorted."""
    if not wanted:
        return {}
    spark = rows.sparkSession
    asked = pa.table({
        **{p: pa.array(values, pa.int64()) for p, values in zip(places, zip(*wanted), strict=True)},
        "wanted": pa.array(list(wanted.values()), pa.list_(pa.int64())),
    })
    # No key and the smallest number share a place.
    blocks = counted.groupBy(*places, "block").agg(F.sum("n").alias("n"))
    blocks = blocks.join(F.broadcast(spark.createDataFrame(asked)), places)
    upto = F.sum("n").over(Window.partitionBy(*places).orderBy("block"))
    blocks = blocks.withColumn("before", upto - F.col("n"))
    ranks = F.transform(
        F.filter("wanted", lambda w: (w > F.col("before")) & (w <= F.col("before") + F.col("n"))),
        lambda w: (w - F.col("before")).cast("int"),
    )
    blocks = blocks.select(*places, "block", ranks.alias("ranks")).where(F.size("ranks") > 0)
    blocks = F.broadcast(spark.createDataFrame(blocks.toArrow()))
    rows = rows.withColumn("block", F.shiftright("row_no", _BLOCK_BITS))
    held = rows.join(blocks, [*places, "block"]).groupBy(*places, "block", "ranks").agg(
        F.array_sort(F.collect_list("row_no")).alias("row_nos")
    )
    last = F.transform("ranks", lambda n: F.get("row_nos", n - 1))
    found: dict[tuple, list[int]] = {}
    for *key, _, row_nos in sorted(held.select(*places, "block", last).collect()):
        found.setdefault(tuple(key), []).extend(row_nos)
    return found


def has_places(df: DataFrame, names: list[str]) -> bool:
    """Whether ranges of these keys can be cut exactly."""
    return all(_place(df, name) is not None for name in names)


def range_numbers(
    df: DataFrame, ranges: int, places: list[Column], starts: list[int] | None = None
) -> Column:
    """Number of the range a row belongs to, 0 to ``ranges - 1``, by whole numbers ``places`` that
    ascend in the wished order; the last one should differ from row to row.

    The places are sorted by a range shuffle of their own into the shared folder, where the
    files' row counts say at which row of which file a range ends. The driver gets one row per
    sorted file and one per range.
    """
    last = _last_of_ranges(df, ranges, places, starts)
    return F.pandas_udf(_numbering(last), "int")(*places) if len(last) else F.lit(0)


def _last_of_ranges(df, ranges: int, places: list[Column], starts: list[int] | None) -> np.ndarray:
    """The places of the last row of each range but the last one."""
    spark = df.sparkSession
    names = [f"p{i}" for i in range(len(places))]
    narrow = df.select(*[place.alias(name) for place, name in zip(places, names, strict=True)])
    folder = fresh_folder(spark, "keys")
    narrow.repartitionByRange(*names).sortWithinPartitions(*names).write.parquet(folder)
    # The file scan tells the position of a row in its file.
    rows = spark.read.schema(narrow.schema).parquet(folder).select(
        *names, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    found = rows.groupBy("file").agg(F.min(F.struct(*names)).alias("low"), F.count(F.lit(1)).alias("n"))
    files = sorted(found.collect(), key=lambda f: tuple(f["low"]))
    before = [0, *accumulate(f["n"] for f in files)]
    if starts is None:
        starts = [file_start(i, before[-1], ranges) for i in range(1, ranges)]
    # Nothing lies before a range that begins at no row.
    last = np.full((len(starts), len(places)), np.iinfo(np.int64).min)
    ends = {start: bisect_right(before, start - 1) - 1 for start in starts if start > 0}
    wanted = pa.table({
        "file": pa.array([files[f]["file"] for f in ends.values()], pa.string()),
        "at": pa.array([start - 1 - before[f] for start, f in ends.items()], pa.int64()),
        "start": pa.array(list(ends), pa.int64()),
    })
    wanted = F.broadcast(spark.createDataFrame(wanted))
    values = {r["start"]: [r[n] for n in names] for r in rows.join(wanted, ["file", "at"]).collect()}
    for i, start in enumerate(starts):
        if start > 0:
            last[i] = values[start]
    return last


# Runs inside tasks and imports what it needs itself, so that workers do not need this package.


def _numbering(last: np.ndarray):
    """How many ranges end before a row, by bisection over all rows of a batch at once."""
    columns = [np.ascontiguousarray(column) for column in last.T]

    def number(first, *rest):
        import numpy as np
        import pandas as pd

        keys = [place.to_numpy() for place in (first, *rest)]
        low = np.searchsorted(columns[0], keys[0], "left")
        high = np.searchsorted(columns[0], keys[0], "right")
        tied = np.flatnonzero(low < high)
        while len(tied):
            middle = (low[tied] + high[tied]) // 2
            ended, same = np.zeros(len(tied), bool), np.ones(len(tied), bool)
            for column, key in zip(columns[1:], keys[1:]):
                bound, place = column[middle], key[tied]
                ended |= same & (bound < place)
                same &= bound == place
            low[tied[ended]] = middle[ended] + 1
            high[tied[~ended]] = middle[~ended]
            tied = tied[low[tied] < high[tied]]
        return pd.Series(low.astype("int32"))

    import pandas as pd

    number.__annotations__ = {"first": pd.Series, "rest": pd.Series, "return": pd.Series}
    return number


def _place(df: DataFrame, name: str) -> Column | None:
    """A whole number that ascends from the newest to the oldest row, nulls last; None for types
    that have none."""
    kind, value = df.schema[name].dataType, col(name)
    if isinstance(kind, T.TimestampType):
        number = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        # Without a zone: the days and the time of day as they are written.
        seconds = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        # In every zone a second has the same parts.
        micros = F.pmod(F.unix_micros(value.cast("timestamp")), F.lit(1_000_000))
        days = F.unix_date(value.cast("date")).cast("bigint")
        number = (days * 86_400 + seconds) * 1_000_000 + micros
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("bigint")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = value.cast("bigint")
    else:
        return None
    return F.coalesce(F.bitwise_not(number), F.lit(2**63 - 1))


def arrange_unordered(df: DataFrame, files: int, per_task: int = 1) -> DataFrame:
    """Partitions of ``files`` files of nearly equal size, by one even shuffle; ``df`` has to be a
    plain file scan. ``coalesce`` is not used: it would pull the scan itself into as few tasks as
    there are files.

    With ``per_task`` files to a partition rows are dealt by their position, so that each
    partition has exactly the rows of its files; positions need the rows of each task of the
    scan, a count that reads no column."""
    if per_task <= 1:
        return df.repartition(files)
    row_no = unused_name(df, "_row_no")
    rows = df.withColumn(row_no, F.monotonically_increasing_id())
    task, place = F.shiftright(row_no, 33), col(row_no).bitwiseAND(F.lit((1 << 33) - 1))
    counts = dict(rows.groupBy(task.alias("task")).agg(F.count(F.lit(1))).collect())
    before = [0, *accumulate(counts.get(i, 0) for i in range(max(counts) + 1))]
    small, larger = divmod(before[-1], files)
    at = F.get(F.lit(before), task.cast("int")) + place
    # The first files have one row more.
    file = F.when(at < larger * (small + 1), F.floor(at / (small + 1))).otherwise(
        larger + F.floor((at - larger * (small + 1)) / small)
    )
    number = unused_name(rows, "_range")
    numbered = rows.withColumn(number, F.floor(file / per_task).cast("int"))
    return numbered.repartitionById(-(-files // per_task), number).drop(number, row_no)


def rows_cap(rows: int, files: int, ranges: int) -> int:
    """Most rows in one file: 0, no cap, where each file has a partition of its own; the even
    share where partitions hold several files, which are then cut by the writer."""
    return 0 if ranges >= files else max(1, -(-rows // files))
