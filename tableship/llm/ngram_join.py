"""Exact Jaccard join of word n-gram sets, filtered under several global orders.

Two sets with a similarity of at least t share a token among the first
``n - ceil(t * n) + 1`` of each, whatever the order of tokens, as long as it is the same for
all sets. So pairs must pass such a filter under every one of several orders. The first order
puts tokens that are frequent in the corpus last and drives the search: documents are
gathered by their first tokens. The other orders are applied where candidates meet, before
anything is verified. Then the sets themselves are intersected.

Groups are what makes such joins fail, so no step writes all pairs of a group:

* documents with equal sets are one class from the start, joined through its smallest id;
* a group of documents that share a token is cut into blocks, pairs of blocks are compared
  by size and by a bitmap of each set (its difference bounds the overlap from above), and
  only a spanning forest of what may be similar is kept;
* the connected parts of that are few and tight. Their sets are fetched once, again in pairs
  of blocks, filtered and verified, and again only a spanning forest of the links is kept.
  That loses nothing: a component needs no more links than a tree.

Which tokens are frequent is counted over the whole corpus, but only tokens of more than one
in ``frequent`` of all are listed, so the list is bounded and can be broadcast. The order is
valid with any list; a better list only makes groups smaller.

Null texts and texts without words have an empty set and link with nothing; a text with
fewer words than the n-gram is one token. Rows with equal texts link. A null identifier is
the smallest of none: its row is linked only through other ids of its class. Other columns
are not read, so their names are free. Tokens are 64-bit hashes of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from tableship.llm.common import IdMarks, packed, runs, staged, texts
from tableship.llm.components import Parts, components

#: Groups of at most so many rows are compared together with others.
_FEW = 8
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


@dataclass(frozen=True)
class Options:
    """Similarity as a percentage, words per token, number of orders, share of all tokens from
    which on one is listed as frequent, documents per block of a comparison."""

    percent: int = 90
    words: int = 3
    orders: int = 3
    frequent: int = 1 << 20
    token_block: int = 256
    cluster_block: int = 512


DEFAULTS = Options()


# Sets


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _MIX[0]
    x ^= x >> np.uint64(32)
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(29))


def token_set(raw: bytes, words: int = 3) -> np.ndarray:
    """Sorted distinct tokens (64-bit) of a text."""
    found = raw.lower().split()  # of bytes: A to Z and ASCII white space alone
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    tokens = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        tokens = _mix(tokens + hashes[k : k + len(tokens)])
    return np.unique(tokens)


def prefix_length(n: int | np.ndarray, percent: int):
    return n - -(-percent * n // 100) + 1


def _order(tokens: np.ndarray, number: int) -> np.ndarray:
    """Ranks of tokens under order ``number``."""
    return _mix(tokens + np.uint64(number * int(_MIX[1]) % 2**64))


def prefix(tokens: np.ndarray, percent: int, number: int, frequent=None) -> np.ndarray:
    """The first tokens of a set under an order; the first order has the frequent ones last."""
    p = prefix_length(len(tokens), percent)
    ranks = _order(tokens, number)
    if frequent is not None and len(frequent[0]):
        listed, counts = frequent
        at = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
        often = listed[at] == tokens
        # The top bit, then how often, then the rank: frequent tokens come last, by count.
        weight = np.minimum(counts[at[often]], 2**31 - 1).astype(np.uint64)
        ranks >>= np.uint64(1)
        ranks[often] = np.uint64(2**63) | (weight << np.uint64(32)) | (ranks[often] >> np.uint64(31))
    return tokens[np.argpartition(ranks, p - 1)[:p]] if p < len(tokens) else tokens


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens per place: two bitmaps differ in no more places than
    the sets differ in tokens. It has 1,024 bits or, for large sets, about half as many as
    tokens; the exclusive or of its halves is the bitmap of half the size."""
    bits = max(1024, 1 << (len(tokens) // 2).bit_length())
    places = _order(tokens, 99) & np.uint64(bits - 1)
    odd = np.bincount(places.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def frequent_tokens(
    docs: DataFrame, text: str, options: Options
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted tokens that more than one in ``options.frequent`` of all tokens is, and how often
    they occur. At most ``options.frequent`` tokens can be, so the list is bounded. A token
    that stands once in a batch of a task counts in the total alone."""
    schema = StructType([StructField("token", LongType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = 0, [], 0

        def listed():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], schema.names
            )

        for batch in batches:
            for raw in texts(batch, text):
                found = token_set(raw, options.words)
                total += len(found)
                size += len(found)
                held.append(found)
                if size > 4_000_000:
                    yield listed()
                    held, size = [], 0
        if held:
            yield listed()
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([total], pa.int64())], schema.names
        )

    counted = staged(
        docs.select(text).mapInArrow(count, schema).groupBy("token").agg(F.sum("n").alias("n")),
        "token-counts",
    )
    row = counted.where("token IS NULL").head()
    least = (row["n"] if row else 0) // options.frequent
    rows = counted.where(F.col("token").isNotNull() & (F.col("n") > max(1, least))).collect()
    tokens = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def describe(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """``id``, ``class`` (digest of the set; null for an empty one), ``n``, ``prefix`` under the
    first order and ``bitmap`` per document."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_tokens(docs, text, options))
    schema = StructType(
        [
            StructField("id", docs.schema[id_column].dataType),
            StructField("class", BinaryType()),
            StructField("n", LongType()),
            StructField("prefix", ArrayType(LongType())),
            StructField("bitmap", BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, prefixes, bitmaps = [], [], [], []
            for raw in texts(batch, text):
                tokens = token_set(raw, options.words)
                sizes.append(len(tokens))
                if len(tokens):
                    first = prefix(tokens, options.percent, 0, frequent.value)
                    prefixes.append(first.view(np.int64))
                    classes.append(_digest(tokens))
                    bitmaps.append(bitmap(tokens))
                else:
                    prefixes.append(None)
                    classes.append(None)
                    bitmaps.append(None)
            ids = batch.column(batch.schema.get_field_index(id_column))
            arrays = [
                ids,
                pa.array(classes, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64())),
                pa.array(bitmaps, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(id_column, text).mapInArrow(run, schema)


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


# Joins


def join(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """``id``, ``n`` (size of its set) and ``component``, the smallest identifier that a
    document is linked with over any number of links, itself included. Identifiers are longs."""
    described = staged(describe(docs, id_column, text, options), "token-sets")
    classes = staged(
        described.where(F.col("class").isNotNull() & F.col("id").isNotNull())
        .groupBy("class")
        .agg(F.min("id").alias("first")),
        "classes",
    )
    firsts = described.join(
        classes.select(F.col("class").alias("c"), "first"),
        (F.col("class") == F.col("c")) & (F.col("id") == F.col("first")),
    ).select("first", "class", "n", "prefix", "bitmap")
    firsts = staged(firsts, "first-sets")
    maybe = components(_similar(firsts, options))
    linked = components(_links(docs, id_column, text, firsts, maybe, options))

    labels = classes.join(linked, classes["first"] == linked["node"], "left").select(
        F.col("class").alias("c"), F.coalesce("component", "first").alias("component")
    )
    return described.join(labels, described["class"] == F.col("c"), "left").select(
        "id", "n", F.coalesce("component", "id").alias("component")
    )


def keep(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest identifier, and
    one row of it. Documents without words stay, as do rows without an identifier.

    Most documents stay and are recognised by a bit array of the identifiers that need a
    decision, so their texts are passed on as they are read; only the others are joined.
    """
    joined = join(docs, id_column, text, options).where("n > 0 AND id IS NOT NULL")
    found = joined.groupBy("id").agg(
        F.min("component").alias("component"), F.count("*").alias("copies")
    )
    decided = staged(
        found.where("component <> id OR copies > 1").select(
            F.col("id").alias("decided_id"), (F.col("component") != F.col("id")).alias("out")
        ),
        "decided",
    )
    marks = IdMarks(decided, "decided_id")
    ids = F.col("row").getField(id_column).cast("long")
    rows = packed(docs).select("row", marks.place(ids).alias("place"))
    schema = StructType([*rows.schema, StructField("marked", BooleanType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = pa.array(marks.hit(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, marked], schema.names)

    worded = F.coalesce(F.col("row").getField(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    open_case = F.col("marked") & worded & ids.isNotNull()
    rows = rows.mapInArrow(mark, schema)
    passed = rows.where(~open_case).select("row.*")
    judged = rows.where(open_case).join(decided, ids == F.col("decided_id"), "left")
    # Not decided upon: marked by chance. Not out: repeated, of which one row stays.
    chance = judged.where(F.col("out").isNull()).select("row.*")
    repeated = judged.where(~F.col("out")).dropDuplicates(["decided_id"]).select("row.*")
    return passed.unionByName(chance).unionByName(repeated)


def _similar(firsts: DataFrame, options: Options) -> DataFrame:
    """The connected parts, as stars, of the pairs that share a first token and that sizes and
    bitmaps do not rule out. A part that meets under many tokens gives the same star for each."""
    places = firsts.select(F.explode("prefix").alias("token"), "first")
    # One exchange by token serves both the counts and the join.
    places = places.repartition("token")
    counts = places.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    shared = places.join(counts, "token")
    blocks = _block_pairs(shared, "token", "first", options.token_block)
    sets = firsts.select("first", "n", "bitmap")
    rows = blocks.join(sets, "first").select("token", "low", "high", "block", "first", "n", "bitmap")
    rows = rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts()
        for rows, starts in runs(batches, 3):
            parts.add(*_bitmap_pairs(rows, starts, options))
            if parts.full():
                yield _edges(*parts.stars())
        yield _edges(*parts.stars())

    return rows.mapInArrow(compare, "a long, b long")


def _links(
    docs: DataFrame,
    id_column: str,
    text: str,
    firsts: DataFrame,
    maybe: DataFrame,
    options: Options,
) -> DataFrame:
    """The connected parts, as stars, of the verified links within each part of ``maybe``."""
    sizes = maybe.groupBy("component").agg(F.count("*").alias("m"))
    members = maybe.join(sizes, "component").select(
        F.col("component").alias("token"), F.col("node").alias("first"), "m"
    )
    blocks = _block_pairs(members, "token", "first", options.cluster_block)
    sets = _sets(docs, id_column, text, members.select("first"), options)
    # A row of another text under the same identifier is not the one that was described.
    known = firsts.select("first", F.col("class").alias("c"))
    sets = sets.join(known, (sets["id"] == known["first"]) & (sets["class"] == known["c"]))
    rows = blocks.join(sets.select("first", "tokens"), "first").select(
        "token", "low", "high", "block", "first", "tokens"
    )
    rows = rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts()
        for rows, starts in runs(batches, 3):
            for start, stop in zip(starts, starts[1:], strict=False):
                if stop - start > 1:
                    group = rows.slice(start, stop - start)
                    parts.add(*_verified_forest(group, options))
            if parts.full():
                yield _edges(*parts.stars())
        yield _edges(*parts.stars())

    return rows.mapInArrow(verify, "a long, b long")


def _sets(
    docs: DataFrame, id_column: str, text: str, wanted: DataFrame, options: Options
) -> DataFrame:
    """``id``, ``class`` and ``tokens`` of at least the documents in ``wanted``.

    A bit array says which identifiers may be wanted, so texts are not shuffled to find out; the join that follows drops what it lets through by chance.
    """
    marks = IdMarks(wanted, "first")
    schema = StructType(
        [StructField("id", LongType()), StructField("class", BinaryType()), StructField("tokens", BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(marks.hit(batch.column(0))))
            sets = [token_set(raw, options.words) for raw in texts(chosen, text)]
            arrays = [
                chosen.column(1),
                pa.array([_digest(tokens) for tokens in sets], pa.binary()),
                pa.array([tokens.tobytes() for tokens in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    ids = F.col(id_column).cast("long")
    rows = docs.where(F.col(id_column).isNotNull()).select(
        marks.place(ids).alias("place"), ids.alias("id"), text
    )
    return rows.mapInArrow(run, schema)


def _block_pairs(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """``rows`` (with the group's size ``m``) once for each pair of blocks a row takes part in:
    ``low``, ``high`` and its own ``block``. A group has ceil(m / size) blocks, so each pair
    of members meets once and no task holds more than about two blocks of a group."""
    parts = F.ceil(F.col("m") / size).cast("int")
    rows = rows.withColumn("parts", parts).withColumn(
        "block", F.pmod(F.xxhash64(member), F.col("parts")).cast("int")
    )
    other: Column = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("other", other)
    return rows.select(
        key,
        member,
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )


def _edges(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
    )


def _forest(ids: np.ndarray, near: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the graph with this symmetric matrix."""
    left = np.ones(len(ids), bool)
    a, b = [], []
    for root in range(len(ids)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            node = stack.pop()
            found = np.flatnonzero(near[node] & left)
            left[found] = False
            a += [int(ids[node])] * len(found)
            b += ids[found].tolist()
            stack += found.tolist()
    return a, b


def _apart(block: np.ndarray, low: int, high: int) -> np.ndarray | bool:
    """Pairs that this pair of blocks is for: across the two, or within the one."""
    return True if low == high else block[:, None] != block[None, :]


def _may_link(n: np.ndarray, m: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many tokens may be linked:
    ``100 * shared >= t * (total - shared)`` with shared at most ``(total - differ) / 2``."""
    total = n + m
    shared = np.minimum(total - differ, 2 * np.minimum(n, m))
    return (100 + percent) * shared >= 2 * percent * total


def _bitmap_pairs(
    rows: pa.RecordBatch, starts: list[int], options: Options
) -> tuple[list[int], list[int]]:
    """Pairs that may be linked, or a spanning forest of them, for each group of ``rows``.

    Groups of a few rows, which most are, are compared all at once: each row with the next
    one, the one after that and so on, as long as they are of one group.
    """
    ids, n = rows.column(4).to_numpy(), rows.column(5).to_numpy()
    low, high, block = (rows.column(k).to_numpy() for k in (1, 2, 3))
    maps = rows.column(6).to_pylist()
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    few = (sizes <= _FEW)[group]
    a, b = [], []
    for step in range(1, _FEW):
        at = np.flatnonzero(few[:-step] & (group[step:] == group[:-step])) if step < len(ids) else []
        if not len(at):
            break
        to = at + step
        apart = (low[at] == high[at]) | (block[at] != block[to])
        sized = _may_link(n[at], n[to], np.zeros(len(at), np.int64), options.percent)
        pick = np.flatnonzero(apart & sized & (ids[at] != ids[to]))
        at, to = at[pick], to[pick]
        differ = _differences([maps[k] for k in at], [maps[k] for k in to])
        near = _may_link(n[at], n[to], differ, options.percent)
        a += ids[at[near]].tolist()
        b += ids[to[near]].tolist()
    for k in np.flatnonzero(sizes > _FEW).tolist():
        part = slice(starts[k], starts[k + 1])
        near = _near_bitmaps(n[part], maps[part], options.percent)
        near &= ids[part, None] != ids[None, part]
        near &= _apart(block[part], low[starts[k]], high[starts[k]])
        more = _forest(ids[part], near)
        a += more[0]
        b += more[1]
    return a, b


def _differences(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """Places in which bitmaps differ, pair by pair; the larger is folded to the smaller."""
    differ = np.zeros(len(one), np.int64)
    kinds: dict[tuple[int, int], list[int]] = {}
    for k, (x, y) in enumerate(zip(one, two, strict=True)):
        kinds.setdefault((len(x), len(y)), []).append(k)
    for (p, q), at in kinds.items():
        x = _fold(np.frombuffer(b"".join([one[k] for k in at]), np.uint64).reshape(len(at), -1), q)
        y = _fold(np.frombuffer(b"".join([two[k] for k in at]), np.uint64).reshape(len(at), -1), p)
        differ[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return differ


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    while 8 * bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _near_bitmaps(n: np.ndarray, maps: list[bytes], percent: int) -> np.ndarray:
    """All pairs of a block. Bitmaps of other than equal or adjacent sizes belong to sets too
    different in size to be linked."""
    near = np.zeros((len(n), len(n)), bool)
    lengths = np.array([len(m) for m in maps])
    for size in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == size)
        x = np.frombuffer(b"".join([maps[k] for k in own]), np.uint64).reshape(len(own), -1)
        for other in (size, 2 * size):
            to = np.flatnonzero(lengths == other)
            if not len(to):
                continue
            y = np.frombuffer(b"".join([maps[k] for k in to]), np.uint64).reshape(len(to), -1)
            y = _fold(y, size)
            for row, k in enumerate(own):
                differ = np.bitwise_count(x[row] ^ y).sum(axis=1, dtype=np.int64)
                near[k, to] = _may_link(n[k], n[to], differ, percent)
            near[np.ix_(to, own)] |= near[np.ix_(own, to)].T
    return near


def _verified_forest(group: pa.RecordBatch, options: Options) -> tuple[list[int], list[int]]:
    ids = group.column(4).to_numpy()
    sets = [np.frombuffer(raw, np.uint64) for raw in group.column(5).to_pylist()]
    n = np.array([len(s) for s in sets])
    t = options.percent
    total = n[:, None] + n[None, :]
    near = (100 + t) * np.minimum(n[:, None], n[None, :]) >= t * total
    near &= ids[:, None] != ids[None, :]
    block = group.column(3).to_numpy()
    near &= _apart(block, group.column(1)[0].as_py(), group.column(2)[0].as_py())
    # Pairs must share one of the first tokens under each further order.
    for number in range(1, options.orders):
        if not near.any():
            break
        near &= _shared([prefix(s, t, number) for s in sets]) > 0
    if near.any():
        shared = _shared(sets)
        near &= 100 * shared >= t * (total - shared)
    return _forest(ids, near)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections within a block, exact."""
    if len(sets) == 2:
        k = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), k], [k, len(sets[1])]])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts[codes] > 1
    owner, codes = owner[several], np.cumsum(counts > 1)[codes[several]] - 1
    shared = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    width = 4096  # columns at a time, so that the matrix stays small
    for start in range(0, int(codes[-1]) + 1 if len(codes) else 0, width):
        a, b = np.searchsorted(codes, (start, start + width))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[a:b], codes[a:b] - start] = 1
        shared += matrix @ matrix.T
    return np.rint(shared).astype(np.int64)
