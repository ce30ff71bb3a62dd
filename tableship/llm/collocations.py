"""Phrases whose words stand together more often than their counts explain, per language.

Every n-gram gets a Rabin-Karp fingerprint: prefix sums of a polynomial over the bytes give the
value of each word, prefix sums of a second one over these values give the value of each run of
words, both in numpy for many texts at once. Tasks count fingerprints in chunks and the shuffle
adds them up; a row carries the fingerprint (64 bits), a check of another kind (a polynomial
modulo a prime, 31 bits), the count and a pointer to one text where it stands, and no words.

Longer phrases are counted level by level: a phrase of m words can only be frequent if both
its runs of m - 1 words are, which a bit array of the frequent ones tells. The array has 16 bits
for each of them, up to ``BitMarks.MOST`` (32 MB); with more of them it rules out less, and
nothing is lost.

Texts that frequent fingerprints point at are read again, and only there words are cut out,
after the fingerprint and the check have been found in the text once more. A fingerprint whose
occurrences differ in the check, or that its text does not bear out, stands for several phrases:
its occurrences are counted again by their words, so counts are exact whatever collides.

A cut phrase's parts are looked up in the same counts. Parts that stand for more than one in
65,536 of all words are at most so many for each length and are broadcast; others belong to
few phrases each. Scores are compared as whole numbers, exact to 38 digits.

Null texts are empty, a null language is ``und``; texts without words count nothing, and a table
without rows gives no phrases. Rows with equal texts count as often as they occur. Equal scores
fall to the larger count and then to the smaller phrase in UTF-8. Texts are taken whole; a
very long one is hashed in blocks of words. Columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tableship.llm.common import staged, texts

# Fixed values of the contract: what parts pieces, what parts words.
CUTS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"

_KINDS = np.zeros(256, np.uint8)
_KINDS[list(BLANKS)] = 1
_KINDS[list(CUTS)] = 2

_PRIME = 2**31 - 1
#: Bases of the polynomials over bytes and over words, for either arithmetic.
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_BYTE_P, _WORD_P = 1_102_115_627, 884_123_021
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes of text that are counted together, and that are hashed together.
CHUNK, BLOCK = 4 << 20, 1 << 19


@dataclass(frozen=True)
class Options:
    """Longest phrase in words; least count of a phrase; percentage of its count from which on
    a longer phrase replaces it; phrases per language; bits of a fingerprint."""

    words: int = 3
    least: int = 10
    inside: int = 50
    top: int = 2000
    bits: int = 64


DEFAULTS = Options()


# Fingerprints


class Powers:
    """Powers of a base and of its inverse, modulo 2**64 or the prime, as many as were needed."""

    def __init__(self, base: int, modulus: int) -> None:
        self._steps = (base, pow(base, -1, modulus))
        self._modulus = modulus
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        for k, step in enumerate(self._steps):
            while len(table := self._tables[k]) < n:
                by = np.uint64(pow(step, len(table), self._modulus))
                more = table * by
                if self._modulus == _PRIME:
                    more %= np.uint64(_PRIME)
                self._tables[k] = np.concatenate([table, more])
        return self._tables[0][:n], self._tables[1][:n]


_POWERS = {
    "byte": (Powers(_BYTE, 2**64), Powers(_BYTE_P, _PRIME)),
    "word": (Powers(_WORD, 2**64), Powers(_WORD_P, _PRIME)),
}


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def runs_of(values: np.ndarray, checks: np.ndarray, start, stop, kind: str):
    """Polynomial values of the runs ``start`` to ``stop`` (exclusive), from prefix sums; equal runs
    have equal values wherever they stand."""
    full, prime = _POWERS[kind]
    up, down = full.get(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    found = (sums[stop] - sums[start]) * down[start]
    up, down = prime.get(len(values))
    np.cumsum(checks * up % np.uint64(_PRIME), out=sums[1:])
    # Fewer than 2**32 values below 2**31 each, so the sums do not wrap.
    check = (sums[stop] - sums[start]) % np.uint64(_PRIME) * down[start] % np.uint64(_PRIME)
    return found, check


class Chunk:
    """The words of some texts: where they start and stop, the piece and the text they are of,
    and their values."""

    def __init__(self, raws: list[bytes]) -> None:
        joined = b"\n".join(raws).lower()  # of bytes: A to Z alone
        self.raw = joined
        data = np.frombuffer(joined, np.uint8)
        kinds = _KINDS[data]
        edges = np.diff(np.concatenate([[0], kinds == 0, [0]]).astype(np.int8))
        self.start, self.stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        cuts = np.flatnonzero(kinds == 2)
        self.piece = np.searchsorted(cuts, self.start)
        firsts = np.cumsum([0, *(len(raw) + 1 for raw in raws)])
        self.text = np.searchsorted(firsts, self.start, "right") - 1
        self.value = np.zeros(len(self.start), np.uint64)
        self.check = np.zeros(len(self.start), np.uint64)
        first = 0
        while first < len(self.start):
            last = max(first + 1, np.searchsorted(self.stop, self.start[first] + BLOCK))
            part, base = slice(first, last), self.start[first]
            block = data[base : self.stop[last - 1]].astype(np.uint64)
            start, stop = self.start[part] - base, self.stop[part] - base
            value, check = runs_of(block, block, start, stop, "byte")
            length = (stop - start).astype(np.uint64)
            self.value[part] = _mix(value + length * _LENGTH)
            self.check[part] = (check + length) % np.uint64(_PRIME)
            first = last

    def grams(self, n: int, languages: np.ndarray, options: Options):
        """First words, fingerprints and checks of the runs of ``n`` words within pieces."""
        last = len(self.start) - n + 1
        if last < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[:last] == self.piece[n - 1 :])
        value, check = runs_of(self.value, self.check, at, at + n, "word")
        seed = _mix(languages.view(np.uint64) + np.uint64(n * int(_LENGTH) % 2**64))[self.text[at]]
        return at, _masked(_mix(value ^ seed), options), check

    def totals(self, languages: np.ndarray, options: Options):
        """Texts, fingerprints and numbers of words: one entry per text that has any. The number
        of all words of a language is counted like a phrase of no words."""
        counts = np.bincount(self.text, minlength=len(languages))
        at = np.flatnonzero(counts)
        return at, _masked(_mix(languages[at].view(np.uint64)), options), counts[at]

    def phrase(self, first: int, n: int) -> str:
        cut = [self.raw[self.start[k] : self.stop[k]] for k in range(first, first + n)]
        return b" ".join(cut).decode()


def _masked(x: np.ndarray, options: Options) -> np.ndarray:
    return x & np.uint64(2**options.bits - 1)


#: The check of the number of all words, which no phrase has.
_TOTAL = _PRIME


# Bit arrays


class BitMarks:
    """Says of a number that it is not among those marked, or that it may be: 16 bits for each,
    at most ``MOST`` in all. The array is put together in tasks and broadcast."""

    MOST = 1 << 28
    _BLOCK = 1 << 20

    def __init__(self, rows: DataFrame, column: str) -> None:
        wanted = max(16 * rows.count(), 1)
        self._size = size = min(self.MOST, max(1 << 16, 1 << (wanted - 1).bit_length()))
        width = min(size, self._BLOCK)
        marked = rows.select(F.pmod(F.xxhash64(column), F.lit(size)).alias("place"))
        marked = marked.repartition(F.expr(f"place DIV {width}")) if size > width else marked

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks: dict[int, np.ndarray] = {}
            for batch in batches:
                places = batch.column(0).to_numpy()
                for block in np.unique(places // width).tolist():
                    bits = blocks.setdefault(block, np.zeros(width, bool))
                    bits[places[places // width == block] % width] = True
            held = [np.packbits(bits, bitorder="little").tobytes() for bits in blocks.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(blocks), pa.int64()), pa.array(held, pa.binary())], ["block", "bits"]
            )

        marks = np.zeros(size // 8, np.uint8)
        for row in marked.mapInArrow(fill, "block long, bits binary").toLocalIterator():
            at = row["block"] * width // 8
            marks[at : at + width // 8] |= np.frombuffer(row["bits"], np.uint8)
        self._marks = rows.sparkSession.sparkContext.broadcast(marks)

    def hit(self, numbers: np.ndarray) -> np.ndarray:
        at = _xxhash64(numbers) & np.uint64(self._size - 1)
        bits = self._marks.value[(at >> np.uint64(3)).astype(np.int64)]
        return (bits >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _xxhash64(numbers: np.ndarray) -> np.ndarray:
    """``xxhash64`` of longs as Spark has it: the public algorithm for eight bytes, seed 42."""
    # Fixed values of that algorithm.
    p1, p2, p3, p4, p5 = (
        np.uint64(p)
        for p in (
            0x9E3779B185EBCA87,
            0xC2B2AE3D27D4EB4F,
            0x165667B19E3779F9,
            0x85EBCA77C2B2AE63,
            0x27D4EB2F165667C5,
        )
    )
    x = numbers.view(np.uint64) * p2
    x = np.uint64(42) + p5 + np.uint64(8) ^ _rotated(x, 31) * p1
    x = _rotated(x, 27) * p1 + p4
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return x ^ (x >> np.uint64(32))


# Counts

_COUNTS = StructType(
    [
        StructField("fingerprint", LongType()),
        StructField("check", IntegerType()),
        StructField("n", LongType()),
        StructField("pointer", LongType()),
    ]
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``CHUNK`` bytes of text, the last column."""
    held, size = [], 0
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        lengths = pc.fill_null(pc.binary_length(column), 0)
        start = 0
        for row, length in enumerate(lengths.to_pylist()):
            size += length
            if size >= CHUNK:
                yield pa.concat_batches([*held, batch.slice(start, row + 1 - start)])
                held, size, start = [], 0, row + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy()


def _counted(fingerprints, checks, pointers, counts=None) -> pa.RecordBatch:
    """One row for each fingerprint and check, in the order of the texts they stand in."""
    order = np.argsort(fingerprints, kind="stable")
    sorted_, check = fingerprints[order], checks[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sorted_[1:] != sorted_[:-1]) | (check[1:] != check[:-1])
    starts = np.flatnonzero(fresh)
    if counts is None:
        n = np.diff(np.append(starts, len(order)))
    else:
        n = np.add.reduceat(counts[order], starts) if len(starts) else counts
    first = order[starts]
    again = np.argsort(first)
    first, n = first[again], n[again]
    columns = [
        pa.array(fingerprints[first].view(np.int64)),
        pa.array(checks[first].astype(np.int32)),
        pa.array(n.astype(np.int64)),
        pa.array(pointers[first]),
    ]
    return pa.RecordBatch.from_arrays(columns, _COUNTS.names)


def _frequent(rows: DataFrame, lengths: list[int], marks: BitMarks | None, options: Options):
    """Fingerprints of phrases of these lengths that occur often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            chunk, languages = Chunk(texts(batch)), _longs(batch, "language")
            pointers = _longs(batch, "pointer")
            if 1 in lengths:
                at, total, n = chunk.totals(languages, options)
                yield _counted(total, np.full(len(at), _TOTAL, np.uint64), pointers[at], n)
            for length in lengths:
                at, found, check = chunk.grams(length, languages, options)
                if marks:
                    first, shorter, _ = chunk.grams(length - 1, languages, options)
                    known = np.zeros(len(chunk.start) + 1, bool)
                    known[first] = marks.hit(shorter)
                    often = known[at] & known[at + 1]
                    at, found, check = at[often], found[often], check[often]
                yield _counted(found, check, pointers[chunk.text[at]])

    # Tasks have counted already, so rows go straight to the shuffle.
    counts = rows.mapInArrow(count, _COUNTS).repartition("fingerprint").groupBy("fingerprint")
    summed = counts.agg(
        F.sum("n").alias("n"),
        F.min("check").alias("check"),
        F.max("check").alias("other_check"),
        F.min("pointer").alias("pointer"),
    )
    return staged(summed.where(F.col("n") >= options.least), "frequent-fingerprints")


def phrase_counts(
    docs: DataFrame, language: str = "lang", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``n``, the number of its occurrences, for phrases of up to
    ``options.words`` words that occur ``options.least`` times. Phrases of no words have the
    number of all words of a language."""
    lang = F.coalesce(F.col(language), F.lit("und")).alias("lang")
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = docs.select(lang, body).select(
        "lang",
        F.xxhash64("lang").alias("language"),
        F.xxhash64("lang", "text").alias("pointer"),
        "text",
    )
    levels = [_frequent(rows, [1, 2][: options.words], None, options)]
    for length in range(3, options.words + 1):
        marks = BitMarks(levels[-1], "fingerprint")
        levels.append(_frequent(rows, [length], marks, options))
    frequent = levels[0]
    for more in levels[1:]:
        frequent = frequent.unionByName(more)
    # Lengths of other levels may share a fingerprint, too.
    lone = frequent.groupBy("fingerprint").agg(
        F.count("*").alias("levels"),
        *(F.any_value(c).alias(c) for c in ("n", "check", "other_check", "pointer")),
    )
    lone = staged(lone, "lone-fingerprints")
    sound = lone.where("levels = 1 AND check = other_check")
    found = staged(_read(rows, sound, options), "phrases")
    borne_out = found.select("fingerprint")
    unclear = staged(lone.select("fingerprint").join(borne_out, "fingerprint", "left_anti"), "unclear")
    found = found.select("lang", "words", "phrase", "n")
    if unclear.isEmpty():
        return found
    return found.unionByName(_recount(rows, unclear, options))


def _read(rows: DataFrame, wanted: DataFrame, options: Options) -> DataFrame:
    """The words of fingerprints, each from the text it points at. Fingerprints that this text
    does not have with the same check are left out."""
    marks = BitMarks(wanted.select("pointer").distinct(), "pointer")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marks.hit(_longs(batch, "pointer"))))

    pointed = rows.mapInArrow(keep, rows.schema)
    pointed = pointed.groupBy("pointer").agg(
        *(F.any_value(c).alias(c) for c in ("lang", "language", "text"))
    )
    # At most one entry for each phrase that stands in the text.
    asked = wanted.groupBy("pointer").agg(
        F.collect_list("fingerprint").alias("fingerprints"),
        F.collect_list(F.struct("check", "n")).alias("known"),
    )
    joined = pointed.join(asked, "pointer").select("lang", "language", "fingerprints", "known", "text")
    schema = "fingerprint long, lang string, words int, phrase string, n long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            chunk, languages = Chunk(texts(batch)), _longs(batch, "language")
            names = batch.column(0).to_pylist()
            lists = batch.column(2)
            asked = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            known = batch.column(3).flatten()
            check, n = known.field("check").to_numpy(), known.field("n").to_numpy()
            order = np.argsort(asked)
            asked, owner, check, n = asked[order], owner[order], check[order], n[order]
            out = []

            def match(found, text, checks, asked=asked, owner=owner, check=check):
                """Places in ``asked`` of the first of each found, and where it was found."""
                if not len(asked) or not len(found):
                    return ()
                at = np.minimum(np.searchsorted(asked, found), len(asked) - 1)
                same = (asked[at] == found) & (owner[at] == text) & (check[at] == checks)
                place, first = np.unique(at[same], return_index=True)
                return zip(place.tolist(), np.flatnonzero(same)[first].tolist(), strict=True)

            at, total, _ = chunk.totals(languages, options)
            for place, k in match(total, at, np.int64(_TOTAL)):
                out.append((place, 0, at[k], ""))
            for length in range(1, options.words + 1):
                at, found, checks = chunk.grams(length, languages, options)
                for place, k in match(found, chunk.text[at], checks.astype(np.int64)):
                    out.append((place, length, chunk.text[at[k]], chunk.phrase(at[k], length)))
            place = np.array([x[0] for x in out], np.int64)
            columns = [
                pa.array(asked[place].view(np.int64)),
                pa.array([names[x[2]] for x in out], pa.string()),
                pa.array([x[1] for x in out], pa.int32()),
                pa.array([x[3] for x in out], pa.string()),
                pa.array(n[place]),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["fingerprint", "lang", "words", "phrase", "n"]
            )

    return joined.mapInArrow(read, schema)


def _recount(rows: DataFrame, unclear: DataFrame, options: Options) -> DataFrame:
    """Phrases of these fingerprints, counted by their words."""
    marks = BitMarks(unclear, "fingerprint")
    schema = "fingerprint long, lang string, words int, phrase string, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            chunk, languages = Chunk(texts(batch)), _longs(batch, "language")
            names = batch.column(0).to_pylist()
            counts: dict[tuple, int] = {}
            at, total, n = chunk.totals(languages, options)
            for k in np.flatnonzero(marks.hit(total)):
                key = (int(total[k].view(np.int64)), names[at[k]], 0, "")
                counts[key] = counts.get(key, 0) + int(n[k])
            for length in range(1, options.words + 1):
                at, found, _ = chunk.grams(length, languages, options)
                for k in np.flatnonzero(marks.hit(found)):
                    lang = names[chunk.text[at[k]]]
                    key = (int(found[k].view(np.int64)), lang, length, chunk.phrase(at[k], length))
                    counts[key] = counts.get(key, 0) + 1
            columns = {
                "fingerprint": pa.array([key[0] for key in counts], pa.int64()),
                "lang": pa.array([key[1] for key in counts], pa.string()),
                "words": pa.array([key[2] for key in counts], pa.int32()),
                "phrase": pa.array([key[3] for key in counts], pa.string()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    found = rows.mapInArrow(count, schema).join(unclear, "fingerprint", "left_semi")
    summed = found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= options.least)


# Phrases


def phrases(
    docs: DataFrame, language: str = "lang", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """The first ``options.top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the count of the phrase, ``l`` and ``r`` are those of its parts where it is cut at the
    lowest score, and ``n`` is the number of all words of the language."""
    counts = staged(phrase_counts(docs, language, text, options), "phrase-counts")
    found = counts.where("words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w")
    )
    scored = _scored(_without_parts(found, options), counts)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= options.top
    )
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _run(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _without_parts(found: DataFrame, options: Options) -> DataFrame:
    """Phrases that no longer one replaces."""
    size = F.size("w")
    # Every shorter run of two words or more: (start, length).
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda k: _run(F.col("w"), k, n)),
        )
    )
    longest = (
        found.where("size(w) > 2")
        .select(F.col("lang").alias("its_lang"), F.explode(runs).alias("part"), F.col("a").alias("most"))
        .groupBy("its_lang", "part")
        .agg(F.max("most").alias("most"))
    )
    same = (F.col("lang") == F.col("its_lang")) & (F.col("phrase") == F.col("part"))
    inside = F.coalesce(100 * F.col("most") >= options.inside * F.col("a"), F.lit(False))
    return found.join(longest, same, "left").where(~inside).select("lang", "phrase", "a", "w")


def _scored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases with their lowest-scoring cut."""
    size = F.size("w")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        k.alias("k"),
        F.array(_run(F.col("w"), 1, k), _run(F.col("w"), k + 1, size - k)).alias("parts"),
    ))
    sides = found.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select(
        "lang", "phrase", "a", "cut.k", F.posexplode("cut.parts").alias("side", "part")
    )
    known = _looked_up(sides, counts).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"),
    )
    score = F.expr(
        "(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0)))"
        " DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    cut = known.groupBy("lang", "phrase", "a").agg(lowest)
    return cut.select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score")


def _looked_up(sides: DataFrame, counts: DataFrame) -> DataFrame:
    """``sides`` with the count ``f`` of their ``part``."""
    counted = counts.where("words > 0").select(
        F.col("lang").alias("its_lang"), F.col("phrase").alias("its_phrase"), F.col("n").alias("f")
    )
    words = counts.where("words = 0").agg(F.sum("n")).first()[0] or 0
    hot = F.col("f") > (words >> 16)
    same = (F.col("lang") == F.col("its_lang")) & (F.col("part") == F.col("its_phrase"))
    quick = sides.join(F.broadcast(counted.where(hot)), same, "left").drop("its_lang", "its_phrase")
    slow = quick.where("f IS NULL").drop("f").join(counted.where(~hot), same)
    return quick.where("f IS NOT NULL").unionByName(slow.drop("its_lang", "its_phrase"))
