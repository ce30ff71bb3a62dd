from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableship.llm import gated_lm, quality_classifier, queries

from .conftest import SCHEMA, full, prose


def labelled(n=240):
    rows, labels = [], []
    for k in range(n):
        good = k % 3 > 0
        text = prose(k, 60 + k % 50)
        if not good:
            text = " | ".join(text.split()) if k % 2 else " ".join(w + "$$$" for w in text.split())
        rows.append(full(k, text))
        labels.append((k, int(good), 0))
    return rows, [*labels, (1, None, 0), (None, 1, 0), (2, 7, 0), (5, 1, 1)]


def test_classifier_on_held_out_rows(spark, edge_rows, sf_of):
    rows, labels = labelled()
    edge = [(r[0] + 10_000 if r[0] is not None else None, *r[1:]) for r in edge_rows]
    got = queries.op3_quality_classifier(spark, sf_of(rows + edge, labels)).collect()
    assert len(got) == len(rows + edge)
    truth = {k: int(k % 3 > 0) for k in range(240)}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1)


def plain_statistics(text):
    """The statistics once more, character by character."""
    raw = (text or "").encode()
    words, word = [], b""
    for byte in raw + b" ":
        if byte in b" \t\n\v\f\r":
            words += [word] if word else []
            word = b""
        else:
            word += bytes([byte])
    n, size = max(len(words), 1), max(len(raw), 1)
    lengths = [len(w) for w in words] or [0]
    mean = sum(lengths) / len(lengths)
    spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths))
    lines = [x for x in raw.split(b"\n") if any(b not in b" \t\n\v\f\r" for b in x)]
    upper = sum(65 <= b <= 90 for b in raw)
    letters = upper + sum(97 <= b <= 122 for b in raw)
    rate = lambda count, of: math.log((count + 0.5) / (of + 1))
    count = lambda signs: sum(b in signs for b in raw)
    return [
        math.log(1 + len(raw)), math.log(mean + 1), math.log(spread + 1),
        math.log((len(set(words)) + 1) / math.sqrt(n + 1)),
        rate(sum(words[k] == words[k - 1] for k in range(1, len(words))), n),
        rate(count(b"#*$%&<>"), n), rate(count(b"|"), n), rate(count(b"!"), n),
        rate(upper, letters), rate(count(b"0123456789"), size), rate(len(lines), n),
        rate(len(lines) - len(set(lines)), len(lines)), rate(count(b".,"), n),
        rate(sum(b >= 128 for b in raw), size),
    ]


def plain_scores(rows, labels):
    """Shrunk covariances from centred rows, and densities by inverses and determinants."""
    learns = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 3 != 1
    vectors = [np.array(plain_statistics(r[1])) for r in rows]
    groups = [
        np.array([
            v for r, v in zip(rows, vectors, strict=True) for i, mark, _ in labels
            if r[0] is not None and i == r[0] and mark == k and learns(i)
        ])
        for k in (0, 1)
    ]
    total, p = sum(map(len, groups)), len(vectors[0])
    pooled = sum((g - g.mean(axis=0)).T @ (g - g.mean(axis=0)) for g in groups) / (total - 2)
    logs = []
    for g in groups:
        pooling = max(0.05, p / (p + len(g)))
        shrunk = (1 - pooling) * np.cov(g.T) + pooling * pooled
        cov = 0.99 * shrunk + 0.01 * np.eye(p) * np.trace(pooled) / p
        inverse, (_, log_det) = np.linalg.inv(cov), np.linalg.slogdet(cov)
        logs.append([
            math.log(len(g) / total) - 0.5 * log_det
            - 0.5 * (v - g.mean(axis=0)) @ inverse @ (v - g.mean(axis=0))
            for v in vectors
        ])
    gaps = [(one - zero) / p for zero, one in zip(*logs, strict=True)]
    return [1 / (1 + math.exp(-min(max(gap, -500), 500))) for gap in gaps]


def test_classifier_equals_plain_densities(spark, edge_rows, sf_of):
    rows, labels = labelled()
    rows += [(r[0] + 10_000 if r[0] is not None else None, *r[1:]) for r in edge_rows]
    labels.append((10_000, 0, 0))  # a row that stands there twice counts twice
    got = queries.op3_quality_classifier(spark, sf_of(rows, labels)).collect()
    key = lambda x: (repr(x[0]), x[1])
    found = sorted(((r.doc_id, r.score) for r in got), key=key)
    plain = zip((r[0] for r in rows), plain_scores(rows, labels), strict=True)
    for one, two in zip(found, sorted(plain, key=key), strict=True):
        assert one[0] == two[0] and one[1] == pytest.approx(two[1], abs=1e-6)


def test_classifier_without_a_class_or_rows(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    scores = quality_classifier.classify(edge_docs, none).select("score").distinct().collect()
    assert [r.score for r in scores] == [0.5]
    assert quality_classifier.classify(no_docs, none).count() == 0
    described = quality_classifier.describe(edge_docs)
    model = quality_classifier.fit(described, none, F.lit(False))
    assert quality_classifier.keep(edge_docs, model).schema == edge_docs.schema


def test_classifier_scores_do_not_see_other_columns(spark, sf_of):
    rows, labels = labelled(90)
    docs = spark.createDataFrame(rows, SCHEMA)
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one, two = (
        sorted((r.id, r.score) for r in quality_classifier.classify(d, marks).collect())
        for d in (docs, other)
    )
    assert one == two


def base(rows):
    tokens = lambda text: [*(text or "").encode().lower().split(), None]
    trains = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    counts = Counter(t for r in rows if trains(r[0]) for t in tokens(r[1]))
    total, kinds = sum(counts.values()), len(counts)
    return sorted(
        (repr(r[0]), not trains(r[0]), len(t), sum(counts[w] > 0 for w in t), total,
         round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t), 6))
        for r in rows
        for t in [tokens(r[1])]
    )


def test_language_model_base_equals_plain_counts(spark, edge_rows, sf_of):
    rows = edge_rows + [full(100 + k, prose(k, 90)) for k in range(60)]
    got = queries.op8_gated_lm(spark, sf_of(rows)).collect()
    assert sorted(
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in got
    ) == base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_rare_words_are_joined_with_their_counts(spark):
    rows = [full(k, prose(k, 50) + f" only{k} pair{k // 2}") for k in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    options = gated_lm.Options(frequent=200, classes=4, members=4)
    scored = gated_lm.score(docs, F.col("doc_id") % 7 != 2, options=options)
    plain = gated_lm.score(docs, F.col("doc_id") % 7 != 2)
    key = lambda d: sorted((r.id, r.n_known, round(r.base_score, 6)) for r in d.collect())
    assert key(scored) == key(plain)


def test_order_helps_the_model(spark):
    rng = random.Random(2)
    follow = {w: rng.sample("abcdefghij", 2) for w in "abcdefghij"}

    def chain(k):
        rng, words = random.Random(k), ["a"]
        for _ in range(80):
            words.append(rng.choice(follow[words[-1]]))
        return " ".join(words)

    docs = spark.createDataFrame([full(k, chain(k)) for k in range(900)], SCHEMA).repartition(2)
    scored = gated_lm.score(docs, F.col("doc_id") % 7 != 2, options=gated_lm.Options(lanes=64, first_share=4))
    row = scored.where("NOT trains").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).head()
    assert row.s > 0.75 * row.b  # logarithms: less is worse


def test_word_probabilities_of_a_state_add_up_to_one():
    lex = gated_lm.Lexicon(
        {}, np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64),
        [gated_lm.END, b"a", b"b"], np.array([3.0, 2.0, 1.0]), np.ones(gated_lm.SHAPES), np.ones(gated_lm.SHAPES), 9, 5, 0,
    )
    options = gated_lm.Options(hidden=4, classes=2, members=3)
    model = gated_lm.Model.start(lex, options)
    symbols = np.array([0, 1, 2, *range(6, 6 + gated_lm.SHAPES)], np.int32)
    state = np.tile(np.random.default_rng(0).normal(size=(1, 4)).astype(np.float32), (len(symbols), 1))
    logs, _ = model.outputs(symbols, state)
    # The second class has no members, so its share is what is missing.
    rest = 1 - np.exp(logs).sum()
    assert -1e-5 < rest < 0.2


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    lex = gated_lm.Lexicon(
        {}, np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64),
        [gated_lm.END, b"a", b"b", b"c"], np.ones(4), np.ones(gated_lm.SHAPES), np.ones(gated_lm.SHAPES), 9, 5, 0,
    )
    options = gated_lm.Options(hidden=3, classes=2, members=2, window=8)
    start = gated_lm.Model.start(lex, options)
    documents = [rng.integers(0, 6, n).astype(np.int32) for n in (8, 5, 3)]
    tokens = sum(map(len, documents))
    batch = gated_lm.Lanes.of(documents, 2)
    assert batch.active == [2] * 8

    def loss(model):
        return -model.log10s(batch).sum() * np.log(10) / tokens

    squares = [np.full_like(a, 1e12) for a in start.arrays()]  # one step of gradient / 1e6
    model = start.load(np.frombuffer(start.dump(), "<f4"))
    before = [a.astype(float) for a in model.arrays()]
    model.options = gated_lm.Options(hidden=3, classes=2, members=2, window=8, rate=1e6)
    model.train(batch, squares)
    for name, old, new in zip(model.NAMES, before, model.arrays(), strict=True):
        gradient = old - new
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        values = []
        for sign in (1, -1):
            moved = start.load(np.frombuffer(start.dump(), "<f4"))
            getattr(moved, name)[at] += sign * 1e-2
            values.append(loss(moved))
        assert (values[0] - values[1]) / 2e-2 == pytest.approx(gradient[at], rel=0.08, abs=2e-3), name


def small_model(**kind):
    lex = gated_lm.Lexicon(
        {}, np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64),
        [gated_lm.END, b"a", b"b", b"c"], np.ones(4), np.ones(gated_lm.SHAPES), np.ones(gated_lm.SHAPES), 9, 5, 0,
    )
    return gated_lm.Model.start(lex, gated_lm.Options(hidden=3, classes=2, members=2, **kind))


def test_one_very_long_text_takes_no_more_memory_than_its_words():
    rng = np.random.default_rng(3)
    model = small_model()
    documents = [rng.integers(0, 6, n).astype(np.int32) for n in [1_000_000, *[20] * 600]]
    tracemalloc.start()
    try:
        lanes = gated_lm.Lanes.of(documents, 512)
        for _ in islice(model.windows(lanes, 64), 20):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100e6  # all steps by all lanes are 6 GB
    last = lanes.window(999_990, 64)
    assert last[0] == [1] * 10
    assert (lanes.symbols[last[1][:, 0]] == documents[0][-10:]).all()


def test_scores_do_not_depend_on_lanes_and_windows():
    rng = np.random.default_rng(4)
    documents = [rng.integers(0, 6, n).astype(np.int32) for n in (40, 1, 7, 13, 90, 2, 2, 21)]
    alone = [small_model().log10s(gated_lm.Lanes.of([d], 1))[0] for d in documents]
    for count in (1, 3, 8):
        got = small_model(window=2).log10s(gated_lm.Lanes.of(documents, count))
        assert got == pytest.approx(alone, rel=1e-5)


def test_words_with_a_place_of_their_own_and_shapes():
    options = gated_lm.DEFAULTS
    assert options.classes * options.members >= 2048
    words = ["short", "muchlonger", "end.", "longerend.", "a,", "7", "(", "größe", "größenordnung", "été", "señor", "слово"]
    kinds = [gated_lm.shape(w.encode()) for w in words]
    assert len(set(kinds)) == len(words) and max(kinds) < gated_lm.SHAPES == 50


def test_shapes_of_many_words_are_those_of_each():
    words = [w.encode() for w in "a 7 x. größe größenordnung éé, Œuvre œ señor¿ ó слово 中文字 ² ½ ª x² été.😀 Ünïcode ß1".split()]
    words += [bytes([k]) for k in range(33, 256)]  # alone, most of these are no characters
    words += [b"ab\xc3", b"\xa4b", b"\xc3\xa4\xa4", b"\xc0\xaf", b"\xc3", b"\xa4", b"\xe2\x82", b"\xf0\x9f\x98\x80.", b"\xc3\xb1" * 9]
    assert gated_lm.shapes(words).tolist() == [gated_lm.shape(w) for w in words]
    assert gated_lm.shapes([]).tolist() == [] and gated_lm.shapes([b"end."]).tolist() == [2]


def test_words_are_those_of_lower_case_texts_cut_at_ascii_space():
    kept = ["", " ", "A b", "\t\x0b x\x0c\r\n", "Größe\u00a0É\u2003Z \x1c", " lead", "trail ", "\x00 a\x85b"]
    batch = pa.RecordBatch.from_arrays([pa.array(["cut off", *kept, None])], ["text"]).slice(1)
    words, owner = gated_lm.words_of(batch)
    plain = [(w, k) for k, t in enumerate(kept) for w in t.encode().lower().split()]
    assert list(zip(words.to_pylist(), owner.tolist())) == plain


def test_texts_are_read_for_counts_and_for_symbols_alone(spark):
    read = spark.sparkContext.accumulator(0)

    def make(batches):
        for batch in batches:
            read.add(batch.num_rows)
            ids = batch.column(0)
            made = [f"word{k % 7} and word{k % 11} again {k}" for k in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(made)], ["doc_id", "text"])

    docs = spark.range(0, 2_000, 1, 2).mapInArrow(make, "doc_id long, text string")
    assert gated_lm.score(docs, F.col("doc_id") % 7 != 2).count() == 2_000
    assert read.value == 2 * 2_000  # neither training nor scores need them again


def test_language_model_of_nothing(no_docs):
    assert gated_lm.score(no_docs, F.lit(True)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_training_helps_on_held_out_documents(spark, sf):
    """Documents of very different lengths: the model must beat the counts it starts from."""
    rows = queries.op8_gated_lm(spark, f"/root/testdata/{sf}").where("held_out").collect()
    tokens = sum(r["n_tokens"] for r in rows)
    base, model = (sum(r[c] for r in rows) / tokens for c in ("base_score", "score"))
    assert model > base + (0.05 if sf == "sf0.01" else 0.0)


def test_segments_lose_nothing():
    documents = [np.arange(n) for n in (0, 1, 5, 40_000, 700)]
    options = gated_lm.Options(lane_tokens=100, lanes=64)
    cut, lanes = gated_lm.segments(documents, options)
    assert lanes == 64 and max(map(len, cut)) <= -(-40_706 // 64)
    assert np.concatenate(cut).tolist() == np.concatenate(documents).tolist()
    assert gated_lm.segments([], options) == ([], 16)
