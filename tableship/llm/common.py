"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableship.session import fresh_folder

#: Words are runs of anything but space and the ASCII controls TAB to CR; ``bytes.split()``
#: without arguments cuts UTF-8 text at exactly these.
SPACES = b" \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: a lost executor costs a
    re-read, and the size of the files is known to the planner."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that new columns cannot clash with theirs."""
    return docs.select(F.struct("*").alias("row"))


def packed_texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """Texts of a batch of ``packed`` rows as UTF-8; null is empty."""
    return _bytes(batch.column(0).field(text))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts of a batch as UTF-8; null is empty."""
    return _bytes(batch.column(batch.schema.get_field_index(name)))


def _bytes(values: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in values.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds what Python holds at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Sorted rows in batches that end where a run of equal values in the first ``keys``
    columns ends, with the starts of the runs and the number of rows."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.concat_batches([*rest, batch]) if rest else batch
        starts = _starts(batch, keys)
        last = starts[-1]
        if last:
            yield batch.slice(0, last), starts
        rest = [batch.slice(last)]
    if rest:
        yield rest[0], [*_starts(rest[0], keys), rest[0].num_rows]


def _starts(batch: pa.RecordBatch, keys: int) -> list[int]:
    change = np.zeros(batch.num_rows, bool)
    change[0] = True
    for k in range(keys):
        values = batch.column(k).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change).tolist()


def id_remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of the identifier as text, modulo ``divisor``; a null identifier counts as ''."""
    as_text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % divisor


class IdMarks:
    """A bit array that says of an identifier that it is not among those given, or that it may
    be. It has at least 16 bits for each identifier, 128 KB at least and 16 MB at most, and goes
    to every worker. From some ten million identifiers on it lets more and more others through
    by chance, so whoever asks has to settle those by a join; no identifier given is missed."""

    LEAST, MOST = 20, 27  # bits as powers of two

    def __init__(self, rows: DataFrame, column: str) -> None:
        marked = rows.select(self._hash(F.col(column).cast("long"), self.MOST).alias("place"))
        bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
        word = F.expr("CAST(place DIV 64 AS INT)")
        found = marked.where("place IS NOT NULL").groupBy(word.alias("word"))
        words = found.agg(F.bit_or(bit).alias("bits")).toArrow()  # 2^21 rows of 12 bytes at most
        marks = np.zeros(1 << self.MOST - 6, np.int64)
        marks[words["word"].to_numpy()] = words["bits"].to_numpy()
        marks = marks.view(np.uint64)
        wanted = 16 * int(np.bitwise_count(marks).sum())
        self.bits = min(max(self.LEAST, wanted.bit_length()), self.MOST)
        # A place in a shorter array is the place in the longest one without its upper bits.
        marks = np.bitwise_or.reduce(marks.reshape(-1, 1 << self.bits - 6), axis=0)
        self._marks = rows.sparkSession.sparkContext.broadcast(marks)

    @staticmethod
    def _hash(ids: Column, bits: int) -> Column:
        return F.when(ids.isNotNull(), F.pmod(F.xxhash64(ids), F.lit(1 << bits)))

    def place(self, ids: Column) -> Column:
        """Place of an identifier in the array; null for null."""
        return self._hash(ids, self.bits)

    def hit(self, places: pa.Array) -> np.ndarray:
        known = places.is_valid().to_numpy(zero_copy_only=False)
        at = places.fill_null(0).to_numpy().astype(np.int64)
        bits = self._marks.value[at >> 6] >> (at & 63).astype(np.uint64)
        return known & ((bits & np.uint64(1)) == 1)
