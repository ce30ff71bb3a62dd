"""Quality rules with verdicts on hosts.

Each text is held against a few count rules. The share of failing documents of each host is
shrunk towards a beta prior fitted to all hosts, so that a host with three documents is not
judged by chance; hosts beyond a limit are rejected, and the verdicts are joined back.

Null and empty texts count 0 everywhere and so fail the rule on short texts. Documents with a
null host share no host: they are judged by their own text alone. Repeated rows count as
often as they stand there. Input columns may have any names: they travel in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tableship.llm.common import SPACES, packed, packed_texts, staged

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_lower",
)
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Limits:
    """A document fails where a count passes its limit; a host where its shrunk rate passes both
    its limit and the overall rate, by ``caution`` posterior standard deviations."""

    min_words: int = 20
    repeat_percent: int = 30
    symbol_percent: int = 10
    dup_line_percent: int = 30
    min_word_length: int = 2
    max_word_length: int = 15
    host_rate: float = 0.50
    caution: float = 2.0
    max_prior_weight: float = 1e6


DEFAULTS = Limits()


def count_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and the counts named in ``COUNTS``."""
    rows = packed(docs)
    schema = StructType([*rows.schema, *(StructField(name, LongType()) for name in COUNTS)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_counts(raw) for raw in packed_texts(batch, text)]
            columns = zip(*found, strict=True) if found else [[] for _ in COUNTS]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["row", *COUNTS])

    return rows.mapInArrow(count, schema)


def failures(counted: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """``counted`` with ``base_failed`` and ``failed`` (base or any other rule)."""
    n = F.col("n_words")
    base = (n < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * n
    )
    rules = [
        100 * F.col("n_symbols") > limits.symbol_percent * n,
        100 * F.col("n_dup_lines") > limits.dup_line_percent * F.col("n_lines"),
        F.col("word_chars") < limits.min_word_length * n,
        F.col("word_chars") > limits.max_word_length * n,
        F.col("n_upper") > F.col("n_lower"),
    ]
    failed = base
    for rule in rules:
        failed = failed | rule
    return counted.withColumns({"base_failed": base, "failed": failed})


def host_verdicts(judged: DataFrame, host: str, limits: Limits = DEFAULTS) -> DataFrame:
    """One row per host of ``judged`` (column ``failed``): documents, failures, shrunk rate
    and ``rejected``.

    The prior's mean is the overall rate; its weight comes from how much more the rates of
    hosts differ than binomial chance explains (method of moments, hosts weighted by size).
    """
    hosts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("n_docs"), F.count_if("failed").alias("n_failed"))
    )
    n, f = F.col("n_docs"), F.col("n_failed")
    moments = hosts.agg(
        F.sum(n).alias("n"),
        F.sum(f).alias("f"),
        F.sum(f * f / n).alias("ff"),
        F.sum(n * n).alias("nn"),
        F.count("*").alias("k"),
    )
    total, mean = F.col("n"), F.col("f") / F.col("n")
    chance = mean * (1 - mean)
    # Between-host variance: sum n (rate - mean)^2 less its expectation under chance alone.
    spread = F.col("ff") - F.col("f") * mean
    between = (spread - (F.col("k") - 1) * chance) / (total - F.col("nn") / total)
    weight = F.when(
        (F.col("k") > 1) & (between > 0) & (chance > 0),
        F.least(F.lit(limits.max_prior_weight), chance / between - 1),
    ).otherwise(F.lit(limits.max_prior_weight))
    prior = moments.select(mean.alias("mean"), F.greatest(F.lit(0.0), weight).alias("weight"))
    rate = (f + F.col("mean") * F.col("weight")) / (n + F.col("weight"))
    spread_of_rate = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (n + F.col("weight") + 1))
    return (
        hosts.join(F.broadcast(prior))  # one row
        .select("host", "n_docs", "n_failed", "mean", "weight", rate.alias("rate"))
        .withColumn("least", F.col("rate") - limits.caution * spread_of_rate)
        .withColumn("rejected", F.col("least") > F.greatest(F.lit(limits.host_rate), F.col("mean")))
        .select("host", "n_docs", "n_failed", "rate", "rejected")
    )


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limits: Limits = DEFAULTS,
) -> DataFrame:
    """Per document its identifier, host, counts, ``base_failed``, ``failed`` and ``kept``.

    The counts are written once, without texts, and read for both the hosts and the result.
    """
    counted = failures(count_rules(docs, text), limits).select(
        F.col("row").getField(id_column).alias("id"),
        F.col("row").getField(host).alias("host"),
        *COUNTS,
        "base_failed",
        "failed",
    )
    counted = staged(counted, "quality-counts")
    return _with_verdicts(counted, counted, "host", limits)


def keep(
    docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = DEFAULTS
) -> DataFrame:
    """The documents that pass, with their own columns.

    The first pass leaves only counts per host; the second one reads the texts again and
    drops what fails before anything is joined.
    """
    judged = failures(count_rules(docs, text), limits).withColumn(
        "host", F.col("row").getField(host)
    )
    hosts = judged.select("host", "failed")
    kept = _with_verdicts(judged.where(~F.col("failed")), hosts, "host", limits)
    return kept.where("kept").select("row.*")


def _with_verdicts(
    judged: DataFrame, hosts: DataFrame, host: str, limits: Limits
) -> DataFrame:
    rejected = staged(
        host_verdicts(hosts, host, limits).where("rejected").select(F.col("host").alias("bad")),
        "rejected-hosts",
    )
    # A small list of hosts is broadcast by its file size; a long one is a sort-merge join,
    # of which Spark splits the partition of a host that holds much of the corpus.
    out = judged.join(rejected, judged[host] == rejected["bad"], "left")
    return out.withColumn("kept", ~F.col("failed") & F.col("bad").isNull()).drop("bad")


def _counts(raw: bytes) -> tuple[int, ...]:
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    spaces = len(raw) - len(raw.translate(None, SPACES))
    return (
        len(words),
        len(raw.translate(None, _CONTINUATION)) - spaces,
        sum(raw.count(symbol) for symbol in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LOWER)),
    )


def _repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of eight words that stand in the text at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    order = np.sort(windows)
    if not (order[1:] == order[:-1]).any():  # equal windows have equal hashes
        return 0
    seen: dict[bytes, int] = {}
    ranks = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    width = 1
    while width < WINDOW:  # ranks of windows twice as wide, exact at each step
        pairs = ranks[:-width] * (ranks.max() + 1) + ranks[width:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    repeated = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, repeated, 1)
    np.add.at(edges, repeated + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())
