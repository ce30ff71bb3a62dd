from __future__ import annotations

import re

from pyspark.sql import functions as F

from tableship.llm import quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen: dict[tuple, list[int]] = {}
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_and_verdicts_equal_plain_python(spark, edge_rows, sf_of):
    rows = queries.op6_quality_rules(spark, sf_of(edge_rows)).collect()
    assert len(rows) == len(edge_rows)
    wanted = sorted((repr(r[0]), *counts(r[1])) for r in edge_rows)
    got = sorted(
        (repr(r[0]), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in rows
    )
    assert got == wanted
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in rows if r.kept}
    assert {2, 4} <= kept and 16 not in kept


def test_a_bad_host_takes_its_documents_with_it_and_a_small_one_does_not(spark):
    judged = spark.createDataFrame(
        [("bad", k < 90) for k in range(100)]
        + [(f"good{h}", k < 5) for h in range(20) for k in range(100)]
        + [("small", True), (None, True)],
        "host string, failed boolean",
    )
    found = {r.host: r for r in quality_rules.host_verdicts(judged, "host").collect()}
    assert found["bad"].rejected and found["bad"].rate < 0.9
    assert not found["small"].rejected and not found["good3"].rejected
    assert None not in found


def test_keep_returns_the_columns_of_the_input(edge_docs, no_docs):
    kept = quality_rules.keep(edge_docs)
    assert kept.schema == edge_docs.schema
    assert kept.where(F.col("doc_id") == 4).count() == 1
    assert quality_rules.keep(no_docs).count() == 0
    assert quality_rules.judge(no_docs).count() == 0
