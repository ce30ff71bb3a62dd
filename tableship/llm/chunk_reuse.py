"""Encoding with content-defined chunks that documents share.

A rolling hash over the bytes cuts each text where its value has a fixed ending, so equal
passages get equal chunks wherever they stand. Chunks that several documents share are
counted over the whole corpus; those that save most are encoded once, and every document
takes their ids from there. Inside a chunk, only the part between its first and last sure
word boundary is taken over: around each join the text from the last boundary before it to
the first one after it is encoded again, which is as far as a join can reach, so the ids
agree with those of the whole text exactly.

The dictionary is bounded (``shared`` chunks), so it is broadcast; all other chunks are
encoded where they stand, once per worker while its bounded cache holds them. Texts are
never shuffled: what is shuffled is one digest per chunk, and the texts of the dictionary.

Null texts are empty and have no ids; repeated rows are separate rows; an empty table gives an
empty dictionary. Very long texts are cut like others, at most ``most`` bytes a chunk; of chunks
that save equally much, those with the smallest digests are taken. Only the identifier is taken from other columns, so their names are free.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tableship.llm.common import slices, staged, texts
from tableship.llm.tokens import encoder

#: A space before a byte that starts a visible character other than "<". Bytes above 0xDF
#: may start Unicode spaces, so they are left out: a missed boundary costs time, not truth.
_BOUNDARY = re.compile(rb" (?=[!-;=-~\xc3-\xdf])")


@dataclass(frozen=True)
class Options:
    """``bits``: a cut every 2 ** bits bytes on average; ``least`` and ``most``: bounds on the
    bytes of a chunk; ``shared``: chunks of the dictionary, at most; ``window``: bytes of the
    rolling hash."""

    bits: int = 8
    least: int = 64
    most: int = 4096
    shared: int = 65_536
    window: int = 8


DEFAULTS = Options()
_GEAR = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "big") for b in range(256)],
    np.uint32,
)


def cut(raw: bytes, options: Options = DEFAULTS) -> list[bytes]:
    """The chunks of a text. No cut depends on more than the bytes of the window before it
    and the last cut, and none splits a character."""
    if len(raw) <= options.least:
        return [raw] if raw else []
    data = np.frombuffer(raw, np.uint8)
    gear = _GEAR[data]
    rolling = gear.copy()
    for shift in range(1, options.window):
        rolling[shift:] += gear[:-shift] << np.uint32(shift)
    # The top bits depend on the whole window.
    marks = rolling[:-1] >> np.uint32(32 - options.bits) == 0
    marks &= (data[1:] & 0xC0) != 0x80
    chunks, last = [], 0
    for place in (np.flatnonzero(marks) + 1).tolist():
        while place - last > options.most:
            last = _forced(raw, chunks, last, options)
        if place - last >= options.least:
            chunks.append(raw[last:place])
            last = place
    while len(raw) - last > options.most:
        last = _forced(raw, chunks, last, options)
    if last < len(raw):
        chunks.append(raw[last:])
    return chunks


def _forced(raw: bytes, chunks: list[bytes], last: int, options: Options) -> int:
    end = last + options.most
    while raw[end] & 0xC0 == 0x80:
        end -= 1
    chunks.append(raw[last:end])
    return end


def core(chunk: bytes) -> tuple[int, int]:
    """Start and end of what a chunk can give away: from its first to its last boundary."""
    first = _BOUNDARY.search(chunk)
    if first is None:
        return 0, 0
    end = len(chunk)
    while True:
        end = chunk.rfind(b" ", 0, end)
        if end <= first.start():
            return 0, 0
        if _BOUNDARY.match(chunk, end):
            return first.start(), end


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def shared_chunks(docs: DataFrame, text: str = "text", options: Options = DEFAULTS) -> DataFrame:
    """``digest`` of the chunks that stand in several documents and save most bytes, at most
    ``options.shared`` of them: whole classes of what they save, and of the class that does not
    fit as a whole those with the smallest digests."""
    schema = StructType(
        [StructField("digest", BinaryType()), StructField("n", LongType()), StructField("size", LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            seen: Counter = Counter()
            for raw in texts(batch, text):
                seen.update({c for c in cut(raw, options) if len(c) >= options.least})
            digests = [digest(c) for c in seen]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array(list(seen.values()), pa.int64()),
                    pa.array([len(c) for c in seen], pa.int64()),
                ],
                schema.names,
            )

    counted = docs.select(text).mapInArrow(count, schema)
    saved = (F.sum("n") - 1) * F.first("size")
    chunks = counted.groupBy("digest").agg(F.sum("n").alias("n"), saved.alias("saved"))
    chunks = chunks.where("n > 1").withColumn(
        "class", F.floor(F.log2("saved") * 8).cast("int")
    )
    chunks = staged(chunks.select("digest", "class"), "shared-chunks")
    classes = chunks.groupBy("class").count().orderBy(F.desc("class")).collect()  # ~500 rows
    total = 0
    for row in classes:
        wanted = options.shared - total
        if row["count"] > wanted:
            whole = chunks.where(F.col("class") > row["class"]).select("digest")
            part = _smallest(chunks.where(F.col("class") == row["class"]), row["count"], wanted)
            return whole.unionByName(part)
        total += row["count"]
    return chunks.select("digest")


def _smallest(chunks: DataFrame, count: int, wanted: int) -> DataFrame:
    """The ``wanted`` smallest digests among ``count``. Digests are even, so that all but about
    as many as are wanted can be left out of the sort by their first 32 bits."""
    share = (wanted + 6 * wanted**0.5 + 64) / count
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    near = chunks.where(first <= int(min(share, 1.0) * 0xFFFFFFFF))
    return near.select("digest").orderBy("digest").limit(wanted)


def reuse(docs: DataFrame, text: str = "text", options: Options = DEFAULTS) -> DataFrame:
    """One row: ``bytes`` of all texts, ``shared_bytes`` of those that the dictionary gives
    the ids of, and ``chunks`` and ``shared_chunks``. ``options.shared`` bounds the dictionary at
    every size, so this says how much of a corpus it still covers."""
    known = docs.sparkSession.sparkContext.broadcast(
        {bytes(r["digest"]) for r in shared_chunks(docs, text, options).collect()}
    )
    names = ["bytes", "shared_bytes", "chunks", "shared_chunks"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(names), np.int64)
        for batch in slices(batches, 2000):
            for raw in texts(batch, text):
                chunks = cut(raw, options)
                cores = [core(c) for c in chunks if digest(c) in known.value]
                given = sum(end - start for start, end in cores)
                sums += (len(raw), given, len(chunks), len(cores))
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums.tolist()], names)

    sums = docs.select(text).mapInArrow(measure, ", ".join(f"{n} long" for n in names))
    return sums.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))


def dictionary(
    docs: DataFrame, path: str, text: str = "text", options: Options = DEFAULTS
) -> dict[bytes, bytes]:
    """Ids of the cores of the shared chunks, each encoded once in the cluster."""
    spark = docs.sparkSession
    wanted = {bytes(r["digest"]) for r in shared_chunks(docs, text, options).collect()}
    if not wanted:
        return {}
    known = spark.sparkContext.broadcast(wanted)
    pair = StructType([StructField("digest", BinaryType()), StructField("value", BinaryType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in slices(batches, 2000):
            found = {}
            for raw in texts(batch, text):
                for chunk in cut(raw, options):
                    key = digest(chunk)
                    if key in known.value and key not in sent:
                        sent.add(key)
                        found[key] = chunk
            yield _pairs(found)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches, 2000):
            chunks = batch.column(1).to_pylist()
            cores = [c[slice(*core(c))].decode() for c in chunks]
            yield _pairs(dict(zip(batch.column(0).to_pylist(), encode(cores), strict=True)))

    found = docs.select(text).mapInArrow(find, pair)
    # Each worker sends a chunk once; of what arrives, one copy is kept.
    once = found.groupBy("digest").agg(F.max("value").alias("value"))
    rows = once.mapInArrow(encode, pair).collect()  # at most options.shared rows
    known.unpersist()
    return {bytes(r["digest"]): bytes(r["value"]) for r in rows}


def _pairs(found: dict[bytes, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
        ["digest", "value"],
    )


def encode_chunks(
    encode, documents: list[bytes], shared: dict[bytes, bytes], cache: dict[bytes, bytes],
    options: Options = DEFAULTS,
) -> list[bytes]:
    """Ids of whole texts, put together from shared chunks, cached chunks and joins."""
    plans, loose = [], []  # per text: ids, or numbers of texts to encode

    def later(raw: bytes) -> int:
        loose.append(raw.decode())
        return len(loose) - 1

    waiting: dict[bytes, int] = {}
    for raw in documents:
        plan, pending = [], b""
        for chunk in cut(raw, options):
            start, end = core(chunk)
            if start == end:
                pending += chunk
                continue
            if pending or start:
                plan.append(later(pending + chunk[:start]))
            ids = cache.get(chunk)
            if ids is None and shared:
                ids = shared.get(digest(chunk))
            if ids is None:
                if chunk not in waiting:
                    waiting[chunk] = later(chunk[start:end])
                plan.append(waiting[chunk])
            else:
                plan.append(ids)
            pending = chunk[end:]
        if pending:
            plan.append(later(pending))
        plans.append(plan)
    encoded = encode(loose)
    if len(cache) + len(waiting) > 20_000:
        cache.clear()
    cache.update((chunk, encoded[number]) for chunk, number in waiting.items())
    return [b"".join(x if isinstance(x, bytes) else encoded[x] for x in plan) for plan in plans]


def encode_documents(
    docs: DataFrame,
    path: str,
    use,
    fields: list[StructField],
    id_column: str = "doc_id",
    text: str = "text",
    options: Options = DEFAULTS,
) -> DataFrame:
    """``id`` and what ``use(encoder, ids)`` makes of each document's ids: a tuple of values
    for ``fields``. ``ids`` are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionary(docs, path, text, options))
    schema = StructType([StructField("id", docs.schema[id_column].dataType), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, cache = encoder(path), {}
        for batch in slices(batches, 64):
            ids = encode_chunks(worker.encode, texts(batch, text), shared.value, cache, options)
            columns = zip(*(use(worker, one) for one in ids), strict=True)
            arrays = [batch.column(batch.schema.get_field_index(id_column)), *map(pa.array, columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(id_column, text).mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text",
            options: Options = DEFAULTS) -> DataFrame:
    """``id`` and ``ids`` (binary, little-endian unsigned 32-bit) of every document."""
    fields = [StructField("ids", BinaryType())]
    return encode_documents(docs, path, lambda _, ids: (ids,), fields, id_column, text, options)
