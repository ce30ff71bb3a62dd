from __future__ import annotations

import datetime as dt
import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tableship.llm import warc_revisits

from .conftest import SCHEMA, full, prose
from .test_joins_and_search import wanted_components
from .test_scans import base_spans
from .test_tokens_and_packing import check_packing

RECORD = warc_revisits.RECORD + ", id long, canonical string, slot long, hit string"


def at(day, second=0):
    return dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(days=day, seconds=second)


def record(i, kind, url, time, headers, body=None):
    return (i, kind, url, time, headers, body, 1, "c", 2, "h")


@pytest.mark.parametrize(
    ("url", "canonical"),
    [
        ("HTTP://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#top", "example.com/a?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("https://example.com/?ref=x", "example.com"),
        ("example.com/A", "example.com/A"),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, canonical):
    row = spark.createDataFrame([(url,)], "u string").select(
        warc_revisits.canonical_url(F.col("u")).alias("c")
    )
    assert row.head().c == canonical


def test_revisits_take_the_latest_earlier_response(spark):
    u = "http://a.com/x"
    rows = [
        record(1, "response", u, at(0), {"ETag": '"1"', "Content-Type": "text/html", "Age": "1"}, "one"),
        record(2, "response", "https://www.a.com/x/", at(3), {"etag": 'W/"2"'}, "two"),
        record(2, "response", "https://www.a.com/x/", at(3), {"etag": 'W/"2"'}, "two"),
        record(3, "revisit", u, at(1), {"ETag": '"1"', "Age": "9", "Content-Type": "no"}),
        record(4, "revisit", u, at(3, 5), {"ETag": '"2"'}),
        record(5, "revisit", u, at(3, 6), {"ETag": '"1"', "Last-Modified": "m"}),
        record(6, "revisit", u, at(-1), {}),
        record(7, "revisit", u, at(90), None),
        record(8, "revisit", None, at(90), {}),
        record(9, "revisit", u, None, {}),
        record(10, "revisit", u, at(3), {"Last-Modified": "m"}),
        record(11, None, u, at(2), {"k": None}, "odd"),
        record(0, "revisit", u, at(3), {"ETag": '"1"'}),
    ]
    got = {r.record_id: r for r in warc_revisits.resolve(spark.createDataFrame(rows, RECORD)).collect()}
    wanted = {3: (1, "matched", "one"), 4: (2, "matched", "two"), 5: (2, "mismatch", None),
              6: (None, "unresolved", None), 7: (2, "unchecked", "two"), 8: (None, "unresolved", None),
              9: (None, "unresolved", None), 10: (2, "mismatch", None), 0: (1, "matched", "one")}
    assert {k: (r.response_id, r.outcome, r.body) for k, r in got.items()} == wanted
    assert got[3].headers == {"etag": '"1"', "content-type": "text/html", "age": "9"}


def test_names_of_headers_in_several_cases(spark):
    u = "http://a.com/x"
    rows = [
        record(1, "response", u, at(0), {"etag": '"0"', "ETag": '"1"', "Set-Cookie": None, "set-cookie": "a"}, "one"),
        record(2, "revisit", u, at(1), {"ETAG": None, "etag": '"1"', "X": None, "x": None}),
        record(3, "revisit", u, at(2), {"etag": '"1"', "Etag": '"2"'}),
    ]
    got = {r.record_id: r for r in warc_revisits.resolve(spark.createDataFrame(rows, RECORD)).collect()}
    assert {k: (r.response_id, r.outcome, r.body) for k, r in got.items()} == {
        2: (1, "matched", "one"), 3: (1, "mismatch", None)
    }
    assert got[2].headers == {"etag": '"1"', "set-cookie": "a"}
    assert got[3].headers == {"etag": '"2"'}


def test_one_url_over_many_slots_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [
        record(k, rng.choice(["response", "revisit"]), f"http://a.com/{int(rng.random() < 0.2)}",
               at(rng.randrange(20), rng.randrange(3) * 40_000), {})
        for k in range(300)
    ]
    got = warc_revisits.resolve(spark.createDataFrame(rows, RECORD))
    for r in got.select("record_id", "response_id").collect():
        me = rows[r.record_id]
        earlier = [(x[3], x[0]) for x in rows if x[1] == "response" and x[2] == me[2] and (x[3], x[0]) < (me[3], me[0])]
        assert r.response_id == (max(earlier)[1] if earlier else None)


def test_no_records(spark):
    assert warc_revisits.resolve(spark.createDataFrame([], RECORD)).count() == 0


def test_stages_keep_documents_as_they_are(spark, edge_rows, sf_of):
    rows = edge_rows + [full(100 + k, prose(k, 80)) for k in range(40)]
    rows += [full(200 + k, prose(k, 80) + " more") for k in range(10)]
    rows += [full(300 + k, " | ".join(prose(k, 60).split())) for k in range(10)]
    rows += [full(400, prose(77, 90) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end')]
    labels = [(100 + k, 1, 0) for k in range(40)] + [(300 + k, 0, 0) for k in range(10)]
    sf = sf_of(rows, labels)
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("row", F.lit("extra"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "pattern_packing":
            assert out.columns == docs.columns
        docs = out.cache()
        seen[name] = docs.collect()
    ids = {name: [r.doc_id for r in found] for name, found in seen.items()}
    assert len(corpus_pipeline.STAGES) == 5
    assert set(range(100, 140)) <= set(ids["quality_rules"])
    assert not set(range(300, 310)) & set(ids["quality_rules"])
    assert set(range(100, 140)) <= set(ids["quality_classifier"])
    before = [(r.doc_id, r.text) for r in seen["quality_classifier"]]
    wanted, sets = wanted_components(before, 80, 5)
    stay = sorted(i for (i, _), s in sets.items() if not s or wanted[i] == i)
    assert sorted(i for i in ids["near_duplicates"] if i is not None) == stay
    assert not set(range(200, 210)) & set(stay)
    assert sorted(map(repr, ids["secret_scan"])) == sorted(map(repr, ids["near_duplicates"]))
    for r in seen["secret_scan"]:
        assert not base_spans(r.text) and r.n_chars == len(r.text)
    assert "[secret]" in next(r.text for r in seen["secret_scan"] if r.doc_id == 400)
    check_packing(seen["pattern_packing"])
    assert {r.doc_id for r in seen["pattern_packing"]} == set(ids["secret_scan"])


def test_run_over_an_empty_table(spark, sf_of):
    assert corpus_pipeline.run(spark, sf_of([])).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
