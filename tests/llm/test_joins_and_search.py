from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableship.llm import ngram_join, queries, vector_search
from tableship.llm.common import IdMarks
from tableship.llm.components import Parts, components, contracted

from .conftest import SCHEMA, full, prose


def shingles(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[k:] for k in range(words)), strict=False))


def labels(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def wanted_components(rows, percent=90, words=3):
    sets = {(r[0], r[1]): shingles(r[1], words) for r in rows if r[0] is not None}
    edges = []
    for (a, s), (b, t) in combinations(sets.items(), 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            edges.append((a[0], b[0]))
    return labels(edges, {i for i, _ in sets}), sets


def near_copies(n, seed=0):
    """Copies with a few changed words each, about 0.7 to 1 alike, and unrelated texts."""
    rng = random.Random(seed)
    words = prose(9, 150).split()
    rows = []
    for k in range(n):
        own = list(words)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
        rows.append(full(1000 + k, " ".join(own)))
        rows.append(full(5000 + k, prose(100 + k, 80) + " " + " ".join(words[:30])))
    return rows


@pytest.mark.parametrize("block", [4, 512])
def test_components_equal_all_pairs(spark, edge_rows, block):
    rows = edge_rows + near_copies(60)
    docs = spark.createDataFrame(rows, SCHEMA)
    options = ngram_join.Options(token_block=block, cluster_block=block)
    got = ngram_join.join(docs, options=options).collect()
    wanted, sets = wanted_components(rows)
    assert len(got) == len(rows)
    assert len(set(wanted.values())) < len(wanted)
    for r in got:
        if r.id is not None:
            assert r.component == wanted[r.id]
    sizes = sorted((r.id, r.n) for r in got if r.id is not None)
    assert sizes == sorted((r[0], len(sets[r[0], r[1]])) for r in rows if r[0] is not None)


def test_query_and_empty_table(spark, edge_rows, sf_of, no_docs):
    got = queries.op4_ngram_jaccard_join(spark, sf_of(edge_rows)).collect()
    assert {r.doc_id: r.component_id for r in got}[1] == 0
    assert ngram_join.join(no_docs).count() == 0
    assert ngram_join.keep(no_docs).count() == 0


def test_keep_leaves_one_row_of_each_group(spark, edge_rows):
    rows = edge_rows + near_copies(20)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = ngram_join.keep(docs, options=ngram_join.Options(percent=80, words=5))
    wanted, sets = wanted_components(rows, 80, 5)
    stay = [i for (i, _), s in sets.items() if not s or wanted[i] == i]
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(stay)
    assert kept.where("doc_id IS NULL").count() == 1


def test_prefixes_of_linked_sets_meet_under_every_order():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 120))
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = one[rng.random(len(one)) < 0.95]
        two = np.unique(np.concatenate([keep, rng.integers(0, 2**63, 3).astype(np.uint64)]))
        shared = len(np.intersect1d(one, two))
        linked = 100 * shared >= 90 * (len(one) + len(two) - shared)
        frequent = (np.sort(one[::3]), np.arange(1, len(one[::3]) + 1))
        for number, often in ((0, frequent), (1, None), (2, None)):
            a, b = (ngram_join.prefix(s, 90, number, often) for s in (one, two))
            assert not linked or len(np.intersect1d(a, b))
        differ = ngram_join._differences([ngram_join.bitmap(one)], [ngram_join.bitmap(two)])
        assert differ[0] <= len(one) + len(two) - 2 * shared


def test_long_chains_become_one_component(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(chain.union(spark.createDataFrame([(900, 901), (7, 7)], "a long, b long")))
    assert {r.node: r.component for r in found.collect()} == {
        **{k: 0 for k in range(201)}, 900: 900, 901: 900
    }


VECTOR_SCHEMA = "vec_id long, embedding array<float>, id long, values string, entry long"


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 0.2, (400, 6)).astype(np.float32)
    vectors[100:250] = vectors[0]  # ties among many copies
    rows = [(k, v.tolist(), 1, "v", 2) for k, v in enumerate(vectors)]
    rows += [(500, None, 1, "v", 2), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "v", 2), (600, [float("nan")] * 6, 1, "v", 2),
             (650, [float("inf")] * 6, 1, "v", 2), (None, [1.0] * 6, 1, "v", 2), (700, [0.5, 0.5], 1, "v", 2),
             (701, [0.25, 1.0], 1, "v", 2), (750, [], 1, "v", 2), (800, [1e6] * 6, 1, "v", 2)]
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA)
    options = vector_search.Options(query_block=4, vector_block=64, first=6)
    got = {}
    for r in vector_search.search(frame, F.col("id") % 50 == 0, options=options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    good = {
        r[0]: [int(np.floor(256 * float(np.float32(x)))) for x in r[1]]
        for r in rows
        if r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])
    }
    for q in (q for q in good if q % 50 == 0):
        scored = sorted(
            (-sum(x * y for x, y in zip(good[q], v, strict=True)), i)
            for i, v in good.items()
            if i != q and len(v) == len(good[q])
        )[:5]
        assert sorted(got.get(q, [])) == [(k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert not {500, 550, 600, 650} & set(got)


def test_repeated_rows_are_separate_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-60, 60, (90, 4)) / 256
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [rows[50]] * 2  # a query three times
    rows += [(50, (vectors[50] * 1.5).tolist())]  # another vector under its identifier
    rows += [(7, vectors[8].tolist()), (7, vectors[9].tolist())]  # one identifier, other vectors
    top = vectors[50] * 3
    rows += [(20, top.tolist())] * 8 + [(k, top.tolist()) for k in (21, 22, 50, 50)]
    rows += [(60, (vectors[0] * 2).tolist())] * 3
    rows = [(k, v, 1, "v", 2) for k, v in rows]
    for near in (rows, [r for r in rows if r[0] in (50, 51, 52, 53, 54, 55, 56)]):
        frame = spark.createDataFrame(near, VECTOR_SCHEMA).repartition(3)
        options = vector_search.Options(query_block=2, vector_block=16, first=3)
        got = vector_search.search(frame, F.col("id") % 50 == 0, options=options).collect()
        whole = [(i, [round(256 * x) for x in v]) for i, v, *_ in near]
        wanted = []
        for q, a in (r for r in whole if r[0] % 50 == 0):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q)
            wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
        assert sorted((r.query_id, r["rank"], r.id, r.score) for r in got) == sorted(wanted)


def test_search_of_an_empty_table(spark):
    empty = spark.createDataFrame([], VECTOR_SCHEMA)
    assert vector_search.search(empty, F.col("id") % 50 == 0).count() == 0


def test_near_copies_give_no_more_pairs_than_documents(spark):
    """Each near copy shares many first tokens with all others."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for k in range(300):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    options = ngram_join.Options(percent=80, words=5)
    firsts = ngram_join.describe(docs, options=options).select(F.col("id").alias("first"), "class", "n", "prefix", "bitmap")
    edges = ngram_join._similar(firsts, options)
    tasks = edges.select(F.spark_partition_id()).distinct().count()
    assert edges.count() <= 300 * tasks
    assert contracted(edges).count() < 300 + 10 * tasks
    assert ngram_join.join(docs, options=options).select("component").distinct().count() == 1


def test_parts_of_a_task_become_stars():
    parts = Parts()
    parts.add([5, 9, 3], [9, 7, 4])
    parts.add([7, 1], [8, 1])
    assert sorted(zip(*parts.stars(), strict=True)) == [(3, 4), (5, 7), (5, 8), (5, 9)]
    assert parts.stars() == ([], [])


@pytest.mark.parametrize("n", [0, 1, 300_000])
def test_marks_miss_no_identifier_and_few_others_hit(spark, n):
    ids = spark.range(n).select((F.col("id") * 7 - 900).alias("x"))
    marks = IdMarks(ids.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS x")), "x")
    probe = spark.range(n + 100_000).select((F.col("id") * 7 - 900).alias("x"))
    places = probe.orderBy("x").select(marks.place(F.col("x")).alias("p")).toArrow()["p"]
    hits = marks.hit(places.combine_chunks())
    assert hits[:n].all() and hits[n:].mean() < 0.1
    assert not marks.hit(pa.array([None], pa.int64())).any()
    assert 1 << marks.bits >= 16 * n
