"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text becomes a short vector of statistics, transformed so that they are roughly normal.
Each class gets a mean and a covariance, shrunk towards the pooled covariance and a multiple
of the identity; a text's score comes from the difference of the two log densities, whose
Mahalanobis distances use Cholesky factors computed once.

Every labelled row outside the held-out fold is used, through sums that Spark adds up: two
rows of moments reach the driver, whatever the size of the corpus. Null and empty texts have
a vector of their own and get a score; labels that are null or not 0 or 1 are left out;
repeated rows and repeated labels count as often as they stand there. With fewer than two
examples of a class every text gets the smoothed share of label 1. Input columns travel in a
struct, so their names are free.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tableship.llm.common import id_remainder, packed, packed_texts, staged

SYMBOLS = b"#*$%&<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = b"0123456789"
_HIGH = bytes(range(0x80, 0x100))

STATISTICS = (
    "length", "word_length", "word_spread", "distinct", "doubled", "symbols", "bars", "shouts",
    "upper", "digits", "lines", "repeated_lines", "stops", "high",
)


@dataclass(frozen=True)
class Options:
    """``pooling`` and ``ridge``: weights of the pooled covariance and of the identity;
    ``cut``: score from which on a text is accepted."""

    pooling: float = 0.05
    ridge: float = 0.01
    cut: float = 0.5


DEFAULTS = Options()


@dataclass(frozen=True)
class Model:
    """Means and inverse Cholesky factors of the classes 0 and 1, log densities' constants,
    or the constant ``share`` where a class is missing."""

    share: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    constants: np.ndarray | None = None

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(vectors), self.share)
        logs = [
            constant - 0.5 * np.square((vectors - mean) @ factor.T).sum(axis=1)
            for mean, factor, constant in zip(
                self.means, self.factors, self.constants, strict=True
            )
        ]
        # Divided by the dimension, so that scores keep their order short of 0 and 1.
        gap = np.clip((logs[1] - logs[0]) / vectors.shape[1], -500, 500)
        return 1 / (1 + np.exp(-gap))


def statistics(raw: bytes) -> tuple[float, ...]:
    words = raw.split()
    n, size = len(words) or 1, len(raw) or 1
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    upper = len(raw) - len(raw.translate(None, _UPPER))
    lower = len(raw) - len(raw.translate(None, _LOWER))
    rate = lambda count, of: np.log(count + 0.5) - np.log(of + 1.0)
    return (
        np.log1p(len(raw)),
        np.log(lengths.mean() + 1),
        np.log(lengths.std() + 1),
        np.log((len(set(words)) + 1) / np.sqrt(n + 1.0)),
        rate(sum(map(operator.eq, words, words[1:])), n),
        rate(sum(raw.count(symbol) for symbol in SYMBOLS), n),
        rate(raw.count(b"|"), n),
        rate(raw.count(b"!"), n),
        rate(upper, upper + lower),
        rate(len(raw) - len(raw.translate(None, _DIGITS)), size),
        rate(len(lines), n),
        rate(len(lines) - len(set(lines)), len(lines)),
        rate(raw.count(b".") + raw.count(b","), n),
        rate(len(raw) - len(raw.translate(None, _HIGH)), size),
    )


def describe(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``held_out``-independent statistics as columns; one row per document."""
    rows = packed(docs)
    fields = [StructField(name, DoubleType()) for name in STATISTICS]
    schema = StructType([StructField("id", docs.schema[id_column].dataType), *fields])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(packed_texts(batch, text))
            arrays = [pa.array(column) for column in vectors.T]
            ids = batch.column(0).field(id_column)
            yield pa.RecordBatch.from_arrays([ids, *arrays], ["id", *STATISTICS])

    return rows.mapInArrow(compute, schema)


def fit(
    described: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    label: str = "quality",
    options: Options = DEFAULTS,
) -> Model:
    """Model from the rows of ``described`` (as ``describe`` gives them) that ``labels`` has a
    0 or 1 for and for which ``held_out`` (over the column ``id``) is not true."""
    marks = (
        labels.select(F.col(id_column).alias("id"), F.col(label).alias("label"))
        .where(F.col("label").isin(0, 1))
        .groupBy("id", "label")
        .agg(F.count("*").alias("weight"))
    )
    rows = described.where(~held_out).join(marks, "id")
    w = F.col("weight")
    sums = [F.sum(w).alias("n")]
    sums += [F.sum(w * F.col(a)).alias(f"s_{a}") for a in STATISTICS]
    sums += [
        F.sum(w * F.col(a) * F.col(b)).alias(f"s_{a}_{b}")
        for i, a in enumerate(STATISTICS)
        for b in STATISTICS[i:]
    ]
    found = {r["label"]: r for r in rows.groupBy("label").agg(*sums).collect()}  # two rows
    n = [float(found[k]["n"]) if k in found else 0.0 for k in (0, 1)]
    share = (n[1] + 1) / (sum(n) + 2)
    if min(n) < 2:
        return Model(share)

    p = len(STATISTICS)
    means, scatters = [], []
    for k in (0, 1):
        mean = np.array([found[k][f"s_{a}"] for a in STATISTICS]) / n[k]
        second = np.zeros((p, p))
        for i, a in enumerate(STATISTICS):
            for j in range(i, p):
                second[i, j] = second[j, i] = found[k][f"s_{a}_{STATISTICS[j]}"]
        means.append(mean)
        scatters.append(second - n[k] * np.outer(mean, mean))
    pooled = (scatters[0] + scatters[1]) / (n[0] + n[1] - 2)
    identity = np.eye(p) * max(np.trace(pooled) / p, 1e-9)
    factors, constants = [], []
    for k in (0, 1):
        own = scatters[k] / (n[k] - 1)
        # Few examples lean on the pooled covariance.
        pooling = max(options.pooling, p / (p + n[k]))
        shrunk = (1 - pooling) * own + pooling * pooled
        factor = np.linalg.cholesky(
            (1 - options.ridge) * shrunk + options.ridge * identity
        )
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(n[k] / sum(n)) - np.log(np.diag(factor)).sum())
    return Model(share, np.array(means), np.array(factors), np.array(constants))


def score(described: DataFrame, model: Model, options: Options = DEFAULTS) -> DataFrame:
    """``described`` with ``score`` and ``accepted``."""
    schema = StructType(
        [*described.schema, StructField("score", DoubleType()), StructField("accepted", BooleanType())]
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.column_stack([batch.column(a).to_numpy() for a in STATISTICS])
            scores = model.scores(vectors)
            arrays = [*batch.columns, pa.array(scores), pa.array(scores >= options.cut)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return described.mapInArrow(compute, schema)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    divisor: int = 3,
    fold: int = 1,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    options: Options = DEFAULTS,
) -> DataFrame:
    """``id``, ``held_out``, ``score`` and ``accepted`` per document. Held out are identifiers
    whose crc32 as text is ``fold`` modulo ``divisor``. Texts are read once."""
    described = staged(describe(docs, id_column, text), "quality-statistics")
    held_out = id_remainder(F.col("id"), divisor) == fold
    model = fit(described, labels, held_out, id_column, label, options)
    return score(described, model, options).select(
        "id", held_out.alias("held_out"), "score", "accepted"
    )


def keep(
    docs: DataFrame, model: Model, text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """The accepted documents with their own columns, in one pass and without a shuffle."""
    rows = packed(docs)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_vectors(packed_texts(batch, text)))
            yield batch.filter(pa.array(scores >= options.cut))

    return rows.mapInArrow(select, rows.schema).select("row.*")


def _vectors(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(raw) for raw in texts]).reshape(-1, len(STATISTICS))
