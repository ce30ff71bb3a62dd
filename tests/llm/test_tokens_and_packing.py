from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableship.llm import chunk_reuse, packing, queries
from tableship.llm.tokens import Encoder, decode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def small_cache():
    return Encoder(PATH, capacity=50)


PARTS = st.sampled_from(
    ["a", "the", "Hello", " ", "  ", "\n", "\t", "<|endoftext|>", "<", "'s", "é", "ß", "12", "...",
     "　", "\U0001f600", "\x1c", "\x85", "!", " x", "İ", "﻿", "​", "\r\n", "_", "²"]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(PARTS, max_size=80).map("".join))
def test_ids_of_any_text_equal_the_tokenizer(small_cache, tokenizer, text):
    options = chunk_reuse.Options(bits=3, least=8, most=40)
    wanted = tokenizer.encode(text, add_special_tokens=False).ids
    plain = small_cache.encode([text])[0]
    shared = {chunk_reuse.digest(c): small_cache.encode([c[slice(*chunk_reuse.core(c))].decode()])[0]
              for c in chunk_reuse.cut(text.encode(), options)[::2]}
    chunked = chunk_reuse.encode_chunks(small_cache.encode, [text.encode()] * 2, shared, {}, options)
    for ids in (plain, *chunked):
        assert np.frombuffer(ids, "<u4").tolist() == wanted
    back = tokenizer.decode(wanted, skip_special_tokens=False)
    assert decode(small_cache, plain) == back.encode()


def test_chunks_follow_the_content():
    tail = " ".join(f"word{k}" for k in range(3000)).encode()
    one, two = (chunk_reuse.cut(head + tail) for head in (b"", b"another beginning, "))
    assert b"".join(one) == tail
    assert len(set(one) & set(two)) > 0.9 * len(one)


def test_chunk_reuse_equals_the_tokenizer(spark, edge_rows, sf_of, tokenizer):
    got = queries.op7_chunk_reuse(spark, sf_of(edge_rows)).collect()
    wanted = []
    for row in edge_rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        wanted.append((repr(row[0]), len(ids), hashlib.sha256(raw).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((repr(r[0]), *r[1:]) for r in got) == sorted(wanted)


def test_shared_chunks_are_those_of_several_documents(spark, edge_docs, no_docs):
    known = chunk_reuse.dictionary(edge_docs, PATH)
    assert known
    few = chunk_reuse.dictionary(edge_docs, PATH, options=chunk_reuse.Options(shared=3))
    assert len(few) == min(3, len(known)) and set(few) <= set(known)
    one = chunk_reuse.dictionary(edge_docs, PATH, options=chunk_reuse.Options(shared=1))
    assert len(one) == 1 and set(one) < set(known)
    assert chunk_reuse.dictionary(no_docs, PATH) == {}
    assert chunk_reuse.encoded(no_docs, PATH).count() == 0


def test_chunks_that_save_equally_much_are_broken_by_digest(spark):
    """One class holds more chunks than fit: a part of it is taken, not none."""
    options = chunk_reuse.Options(bits=3, least=8, most=40, shared=50)
    texts = [" ".join(f"w{k * 97 + j:05d}" for j in range(40)) for k in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(4)
    every = [c for t in texts for c in chunk_reuse.cut(t.encode(), options) if len(c) >= 8]
    saved = Counter(every)  # each text stands there twice
    by_class = defaultdict(list)
    for chunk, n in saved.items():
        by_class[math.floor(math.log2((2 * n - 1) * len(chunk)) * 8)].append(chunk_reuse.digest(chunk))
    wanted = [d for c in sorted(by_class, reverse=True) for d in sorted(by_class[c])][:50]
    got = [bytes(r["digest"]) for r in chunk_reuse.shared_chunks(docs, options=options).collect()]
    assert sorted(got) == sorted(wanted)
    row = chunk_reuse.reuse(docs, options=options).first()
    chunks = [c for t in texts * 2 for c in chunk_reuse.cut(t.encode(), options)]
    known = [c for c in chunks if chunk_reuse.digest(c) in set(wanted)]
    assert row.asDict() == {
        "bytes": 2 * sum(map(len, texts)),
        "shared_bytes": sum(len(c[slice(*chunk_reuse.core(c))]) for c in known),
        "chunks": len(chunks),
        "shared_chunks": len(known),
    }
    nothing = chunk_reuse.reuse(docs.limit(0), options=options).first()
    assert tuple(nothing) == (0, 0, 0, 0)


def check_packing(rows, capacity=2048):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_are_gapless_and_whole(spark, edge_rows, sf_of, tokenizer):
    rows = queries.op2_pattern_packing(spark, sf_of(edge_rows)).collect()
    check_packing(rows)
    wanted = Counter()
    for row in edge_rows:
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted[row[0], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted


def test_empty_tables_pack_to_nothing(no_docs):
    assert packing.pack(packing.pieces(no_docs, PATH)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30))
def test_any_histogram_is_placed_once(histogram):
    options = packing.Options(capacity=64, classes=16)
    ranges = packing.plan(histogram, options)
    placed, fill = Counter(), Counter()
    for length, low, high, first, offset in ranges:
        assert high > low
        for k in range(high - low):
            placed[length, low + k] += 1
            fill[first + k] += length
            assert offset + length <= 64
    assert placed == Counter({(n, k): 1 for n, c in histogram.items() for k in range(c)})
    assert not fill or max(fill.values()) <= 64
    total = sum(n * c for n, c in histogram.items())
    assert len(fill) <= 1.25 * -(-total // 64) + 6 or len(fill) <= sum(
        c for n, c in histogram.items() if n > 21
    ) + 6


def test_many_documents_come_close_to_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6, 1, 50_000).astype(int), 1, 2048)
    ranges = packing.plan(Counter(lengths.tolist()))
    used = max(first + high - low for _, low, high, first, _ in ranges)
    assert used <= 1.01 * lengths.sum() / 2048


# Patterns of three documents cannot place most of a corpus whose documents are mostly short.
@pytest.mark.parametrize(
    "mean, spread, n, share", [(6, 1, 12_000, 0.6), (6.5, 0.7, 20_000, 0.6), (5, 1.5, 60_000, 0.4)]
)
def test_patterns_place_most_and_need_no_more_than_best_fit(mean, spread, n, share):
    rng = np.random.default_rng(3)
    lengths = Counter(np.clip(rng.lognormal(mean, spread, n).astype(int), 1, 2048).tolist())
    left = Counter(lengths)
    full = packing._from_patterns(left, packing.DEFAULTS, 64)
    assert all(sum(group) == 2048 for group, _ in full)
    longer = sum(c for k, c in lengths.items() if k > 64)
    assert sum(len(group) * count for group, count in full) >= share * longer
    ranges = packing.plan(lengths)
    used = max(first + high - low for _, low, high, first, _ in ranges)
    alone = packing._best_fit([], Counter(lengths), packing.DEFAULTS)
    assert used <= sum(count for _, count in alone)


def test_non_negative_least_squares_meets_its_conditions():
    rng = np.random.default_rng(0)
    matrix, target = rng.random((8, 30)), rng.random(8)
    x = packing.non_negative_least_squares(matrix, target)
    gradient = matrix.T @ (target - matrix @ x)
    assert (x >= 0).all() and (gradient <= 1e-6).all() and abs(gradient[x > 0]).max() < 1e-6
