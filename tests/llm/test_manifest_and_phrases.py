from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import replace
from fractions import Fraction
from itertools import groupby
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableship.llm import collocations, merkle_manifest
from tableship.llm import queries as named

from .conftest import SCHEMA, full, prose


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(digests, fanout=8):
    """Root of a list of digests and for each its siblings, as (before, after) per level."""
    paths = [[] for _ in digests]
    under = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        runs = [range(k, min(k + fanout, len(digests))) for k in range(0, len(digests), fanout)]
        for run in runs:
            for k in run:
                step = ("".join(digests[run[0] : k]), "".join(digests[k + 1 : run[-1] + 1]))
                for leaf in under[k]:
                    paths[leaf].append(step)
        under = [sum((under[k] for k in run), []) for run in runs]
        digests = [H(*digests[run[0] : run[-1] + 1]) for run in runs]
    return (digests or [None])[0], paths


def wanted_manifest(rows):
    """Rows of op12, by hand."""

    def leaf(r, text):
        return H(*(field(x) for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def low(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    def first(value):
        return (value is not None, value.encode() if isinstance(value, str) else value or 0)

    ordered = sorted(rows, key=lambda r: (first(r["lang"]), first(r["doc_id"]), leaf(r, r["text"])))
    parts = [list(p) for _, p in groupby(ordered, key=lambda r: r["lang"])]
    trees = [climb([leaf(r, r["text"]) for r in part]) for part in parts]
    root, tops = climb([subroot for subroot, _ in trees])
    found = []
    for part, (subroot, paths), top in zip(parts, trees, tops, strict=True):
        for r, path in zip(part, paths, strict=True):
            path = path + top
            changed = crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 3 == 0
            folded = leaf(r, low(r["text"]) if changed else r["text"])
            for before, after in path:
                folded = H(before, folded, after)
            proof = H(*(before + after for before, after in path))
            found.append(
                (r["doc_id"], leaf(r, r["text"]), subroot, root, proof, folded, folded == root)
            )
    return found


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(spark, sf_of, rows):
    return sorted(map(tuple, named.op12_merkle_manifest(spark, sf_of(rows)).select(COLUMNS).collect()), key=repr)


def test_manifest_by_hand(spark, sf_of):
    """Parts of 1, 2, 8, 9 and 70 rows, a null part, null columns, ties and a repeated row."""
    sizes = {"a": 1, "b": 2, "c": 8, "d": 9, "é": 70, None: 65}
    rows, k = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((k * 7 % 101, f"Text {k}" if k % 5 else None, lang, None if k % 4 else "s", k))
            k += 1
    rows += [rows[-1], (None, "", "b", "s", 0), (3, "x" * 100_000, "b", "s", 1)]
    whole = [(a, b, c, d, e, "r", 1, 2, 3, 4, "s", "w") for a, b, c, d, e in rows]
    wanted = wanted_manifest(
        [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]
    )
    got = rows_of(spark, sf_of, whole)
    assert got == sorted(wanted, key=repr)
    assert {r[6] for r in got} == {True, False}


def test_manifest_of_no_rows_and_of_one(spark, sf_of, no_docs):
    assert rows_of(spark, sf_of, [full(1, "Abc")])[0][2] == rows_of_one(full(1, "Abc"))
    digest = merkle_manifest.leaf_digest(F.col("doc_id"))
    empty = merkle_manifest.build(no_docs, digest, F.col("lang"), F.col("doc_id"))
    assert empty.root.first()["root"] is None and merkle_manifest.proofs(empty).count() == 0


def rows_of_one(row):
    doc_id, text, lang, source, n_chars = row[:5]
    return H(*(field(x) for x in (doc_id, source, lang, n_chars, text)))


def test_other_fanouts(spark, edge_docs):
    digest = merkle_manifest.leaf_digest(F.col("doc_id"), F.col("text"))
    for fanout in (2, 3):
        made = merkle_manifest.build(edge_docs, digest, F.col("lang"), F.col("doc_id"), fanout=fanout)
        folded = merkle_manifest.fold(F.col("leaf"), F.col("path"))
        seen = merkle_manifest.proofs(made).select((folded == F.col("root")).alias("same")).collect()
        assert len(seen) == edge_docs.count() and all(r["same"] for r in seen)


# Phrases


def wanted_phrases(rows, options=collocations.DEFAULTS):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, options.words + 1):
                for k in range(len(words) - n + 1):
                    counts[lang, tuple(words[k : k + n])] += 1
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= options.least}
    best: dict = {}
    for (lang, words), a in found.items():
        inside = any(
            other == lang
            and len(longer) > len(words)
            and 100 * f >= options.inside * a
            and any(longer[k : k + len(words)] == words for k in range(len(longer) - len(words) + 1))
            for (other, longer), f in found.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((int(Fraction(1_000_000 * a * a, left * right)), k, left, right))
        score, _, left, right = min(cuts)
        phrase = " ".join(words)
        best.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, left, right))
    return sorted(
        (lang, rank, phrase, -a, left, right, totals[lang], -score)
        for lang, listed in best.items()
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(listed)[: options.top], 1)
    )


def phrase_rows():
    rows = [(prose(k, 200), ("en", "fr", None, "und")[k % 4]) for k in range(12)]
    rows += [("New  York\tCity hall. new york city, NEW york\x0bcity " * 15, "en")] * 3
    rows += [(None, "en"), ("", None), ("...", "fr"), ("a" * 60_000, "en"), ("x\x00y \x00 " * 30, "fr")]
    rows += [("the river stone the river stone the river " * 40, "en")] * 2
    return rows


@pytest.mark.parametrize("bits", [64, 9])
def test_phrases_by_hand(spark, bits):
    """Also with fingerprints of nine bits, of which nearly all stand for several phrases."""
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, g, 1, "w") for t, g in rows], "text string, lang string, n int, words string")
    options = replace(collocations.DEFAULTS, bits=bits)
    got = collocations.phrases(docs.repartition(3), options=options).collect()
    assert sorted(map(tuple, got)) == wanted_phrases(rows)


def test_longer_phrases_and_fewer_of_them(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string")
    options = collocations.Options(words=4, least=5, inside=80, top=7)
    got = collocations.phrases(docs, options=options).collect()
    assert sorted(map(tuple, got)) == wanted_phrases(rows, options)


def test_no_phrases(spark, no_docs):
    assert collocations.phrases(no_docs).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_007
    counts = spark.createDataFrame(
        [("en", 0, "", 10 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", big + 1), ("en", 2, "a b", big)],
        "lang string, words int, phrase string, n long",
    )
    found = counts.where("words = 2").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    row = collocations._scored(found, counts).first()
    assert row["score"] == 1_000_000 * big * big // (2 * big * (big + 1))


def test_equal_runs_have_equal_fingerprints_wherever_they_stand():
    chunk = collocations.Chunk([b"one two  three\tone two", b"zero, one two three"])
    languages = np.array([5, 5])
    at, found, check = chunk.grams(2, languages, collocations.DEFAULTS)
    by_words = {}
    for k, f, c in zip(at.tolist(), found.tolist(), check.tolist(), strict=True):
        by_words.setdefault(chunk.phrase(k, 2), set()).add((f, c))
    assert set(by_words) == {"one two", "two three", "three one"}
    assert all(len(values) == 1 for values in by_words.values())
    assert len(set.union(*by_words.values())) == 3


def test_bit_marks_agree_with_spark(spark):
    rows = spark.range(-500, 70_000, 7)
    marks = collocations.BitMarks(rows, "id")
    values = np.arange(-500, 70_000)
    hit = marks.hit(values)
    assert hit[::7].all() and hit.mean() < 0.3
