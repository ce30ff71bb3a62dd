"""Which keys differ, decoded from sketches of both sides instead of found by a shuffle of rows.

An invertible Bloom lookup table sums up (key hash, row hash) pairs in cells: each pair is
counted in three of them, with plus one for a row of the source and minus one for a row of
the target, so rows that both sides hold cancel out. What remains are the rows that differ.
A cell with a single pair left gives that pair away; taking it out of its two other cells
frees further ones, until all cells are empty. Tables of any size with some ten thousand
changes anywhere in them thus shuffle one row per cell and task, not their rows.

More differences than the cells can hold leave cells that free no further one; that is always
seen, since the cells do not become empty, and the caller has to go another way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableship.functions.hashing import hash_parts

#: A cell is addressed by 20 bits of a hash at most, three times.
MOST_BITS = 20
PARTS = ["k0", "k1", "k2", "k3", "r0", "r1", "r2", "r3", "c0", "c1"]


@dataclass(frozen=True)
class Differences:
    """``pairs``: rows of key hash, row hash and how many more of them the source has."""

    pairs: np.ndarray
    source_rows: int

    @property
    def keys(self) -> np.ndarray:
        return np.unique(self.pairs[:, 0])


def sketch(rows: DataFrame, key: str, row: str, sign: str, bits: int) -> DataFrame:
    """``cell``, ``n``, sums of the parts of both hashes and of a check, and ``source_rows``.

    ``bits`` gives 3 * 2 ** bits cells. Sums are of 16-bit parts, which hold for 10^14 rows in
    a cell; tasks add up their rows before anything is shuffled, so a hot row is no burden.
    """
    if not 1 <= bits <= MOST_BITS:
        raise ValueError(f"bits has to be 1 to {MOST_BITS}")
    cells = F.array(
        *(
            F.shiftright(row, MOST_BITS * table).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
            + F.lit(table << bits).cast("bigint")
            for table in range(3)
        )
    )
    placed = rows.select(F.explode(cells).alias("cell"), key, row, sign)
    check = hash_parts(_check(F.col(key), F.col(row)))[2:]
    parts = [*hash_parts(F.col(key)), *hash_parts(F.col(row)), *check]
    of_first_table = (F.col("cell") < (1 << bits)) & (F.col(sign) > 0)
    return placed.groupBy("cell").agg(
        F.sum(sign).alias("n"),
        *(F.sum(p * F.col(sign)).alias(name) for p, name in zip(parts, PARTS, strict=True)),
        F.count_if(of_first_table).alias("source_rows"),
    )


def decode(cells: DataFrame, bits: int) -> Differences | None:
    """The differences a sketch holds, or ``None`` where they are too many for its cells.
    The cells come to the driver: 3 * 2 ** bits rows of 13 numbers, whatever the tables hold."""
    table = cells.toArrow()
    sums = np.zeros((3 << bits, len(PARTS) + 1), np.int64)
    at = _numbers(table, "cell")
    for i, name in enumerate(["n", *PARTS]):
        sums[at, i] = _numbers(table, name)
    found = [np.zeros((0, 3), np.int64)]
    taken = 0
    left = np.flatnonzero(sums.any(axis=1))
    while len(left):
        pairs = _single(sums, left, bits)
        taken += len(pairs)
        # More pairs than cells can only come from a sum that was mistaken for a pair.
        if not len(pairs) or taken > len(sums):
            return None
        _take_out(sums, pairs, bits)
        found.append(pairs)
        left = np.flatnonzero(sums.any(axis=1))
    return Differences(np.concatenate(found), int(_numbers(table, "source_rows").sum()))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _check(key: Column, row: Column) -> Column:
    """Bits that are no linear function of a pair, so that sums of several pairs fail them:
    the middle of a product of two 31-bit numbers. ``_check_of`` is the same for arrays."""
    low = F.lit(0x7FFFFFFF).cast("bigint")
    mixed = F.shiftleft(key, 1).bitwiseXOR(row)
    product = mixed.bitwiseAND(low) * F.shiftright(mixed, 32).bitwiseAND(low)
    return F.shiftright(product, 20)


def _check_of(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    mixed = key << 1 ^ row
    return (mixed & 0x7FFFFFFF) * (mixed >> 32 & 0x7FFFFFFF) >> 20


def _parts_of(hashes: np.ndarray) -> list[np.ndarray]:
    return [hashes >> 48, hashes >> 32 & 0xFFFF, hashes >> 16 & 0xFFFF, hashes & 0xFFFF]


def _places(row: np.ndarray, bits: int) -> np.ndarray:
    """The three cells of each row hash."""
    mask = (1 << bits) - 1
    return np.stack([(row >> MOST_BITS * t & mask) + (t << bits) for t in range(3)], axis=1)


def _single(sums: np.ndarray, left: np.ndarray, bits: int) -> np.ndarray:
    """Pairs that stand alone in one of the cells ``left``, each once."""
    cells = sums[left]
    n = cells[:, 0]
    left, cells, n = left[n != 0], cells[n != 0], n[n != 0]
    mean = cells[:, 1:] // n[:, None]
    whole = (mean * n[:, None] == cells[:, 1:]).all(axis=1)
    first = [0, 4]  # the upper parts of both hashes are signed
    rest = [i for i in range(len(PARTS)) if i not in first]
    whole &= ((mean[:, rest] >= 0) & (mean[:, rest] <= 0xFFFF)).all(axis=1)
    whole &= ((mean[:, first] >= -0x8000) & (mean[:, first] <= 0x7FFF)).all(axis=1)
    left, mean, n = left[whole], mean[whole], n[whole]
    key, row = (
        mean[:, i] << 48 | mean[:, i + 1] << 32 | mean[:, i + 2] << 16 | mean[:, i + 3]
        for i in first
    )
    check = _parts_of(_check_of(key, row))[2:]
    right = (mean[:, 8] == check[0]) & (mean[:, 9] == check[1])
    right &= (_places(row, bits) == left[:, None]).any(axis=1)
    return np.unique(np.stack([key[right], row[right], n[right]], axis=1), axis=0)


def _take_out(sums: np.ndarray, pairs: np.ndarray, bits: int) -> None:
    key, row, n = pairs.T
    check = _parts_of(_check_of(key, row))[2:]
    parts = np.stack([np.ones_like(n), *_parts_of(key), *_parts_of(row), *check], axis=1)
    for cells in _places(row, bits).T:
        np.subtract.at(sums, cells, parts * n[:, None])
