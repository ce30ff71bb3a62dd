"""The operators as named queries over the test tables, and the SQL for some of them."""

from __future__ import annotations

import hashlib
import string

import public_tokenizers
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tableship.llm import (
    chunk_reuse,
    collocations,
    gated_lm,
    license_scan,
    merkle_manifest,
    ngram_join,
    packing,
    pii_scan,
    quality_classifier,
    quality_rules,
    secret_scan,
    vector_search,
    warc_revisits,
)
from tableship.llm.common import id_remainder, table
from tableship.llm.tokens import decode

QUERIES = {}
ORACLES = {}


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"


@query(
    f"""
    WITH w AS (
        SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS.format("text")} AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS shown
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)
    ), repeated AS (
        SELECT doc_id, i FROM windows
        QUALIFY count(*) OVER (PARTITION BY doc_id, shown) > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
        FROM repeated, range(0, 8) AS offsets(j) GROUP BY doc_id
    ), c AS (
        SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
               coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT
                   AS n_symbols,
               len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
               length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
               length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower
        FROM w LEFT JOIN covered USING (doc_id)
    ), f AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
               OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_upper > n_lower AS failed
        FROM c
    ), hosts AS (
        SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (failed))::DOUBLE AS x
        FROM f WHERE source IS NOT NULL GROUP BY source
    ), moments AS (
        SELECT sum(n) AS n, sum(x) / sum(n) AS mean, count(*) AS k,
               (sum(x * x / n) - sum(x) * sum(x) / sum(n)
                - (count(*) - 1) * (sum(x) / sum(n)) * (1 - sum(x) / sum(n)))
               / nullif(sum(n) - sum(n * n) / sum(n), 0) AS between
        FROM hosts
    ), prior AS (
        SELECT mean, CASE WHEN k > 1 AND between > 0 AND mean * (1 - mean) > 0
               THEN greatest(0, least(1e6, mean * (1 - mean) / between - 1)) ELSE 1e6 END AS weight
        FROM moments
    ), rejected AS (
        SELECT source FROM (
            SELECT source, mean, (x + mean * weight) / (n + weight) AS rate,
                   rate - 2 * sqrt(rate * (1 - rate) / (n + weight + 1)) AS least_rate
            FROM hosts, prior
        ) WHERE least_rate > greatest(0.5, mean)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT failed AND (source IS NULL OR source NOT IN (SELECT source FROM rejected)) AS kept
    FROM f
    """
)
def op6_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _span_digests(found, base_kinds):
    """Counts of the base kinds, the digest of their spans, and all spans as text."""

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def count(kind):
        of_kind = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*base_kinds))
    return found.select(
        F.col("id").alias("doc_id"),
        *map(count, base_kinds),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query()
def op10_secret_scan(spark, sf_dir):
    found = secret_scan.scan_narrow(table(spark, sf_dir, "documents"))
    return _span_digests(found, secret_scan.KINDS[:3])


@query()
def op9_license_scan(spark, sf_dir):
    found = license_scan.scan(table(spark, sf_dir, "documents"))

    def labels(places):
        names = F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"])))
        return F.array_join(names, ",")

    found = found.withColumns(
        {
            "base": F.filter("places", lambda p: p["base"]),
            "kept": F.filter("places", lambda p: p["kept"]),
        }
    )
    starts = F.transform("base", lambda p: p["start"].cast("long"))
    trust = F.array_max(F.transform("kept", lambda p: p["trust"]))
    return found.select(
        F.col("row").getField("doc_id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.col("kept")).alias("labels"),
        F.coalesce(trust.cast("double"), F.lit(0.0)).alias("score"),
    )


@query()
def op3_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_classifier.classify(docs, labels)
    return scored.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "score",
        F.col("accepted").cast("int").alias("predicted"),
    )


@query()
def op7_chunk_reuse(spark, sf_dir):
    def digests(encoder, ids):
        text = decode(encoder, ids)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()

    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    docs = table(spark, sf_dir, "documents")
    found = chunk_reuse.encode_documents(docs, TOKENIZER, digests, fields)
    return found.withColumnRenamed("id", "doc_id")


@query()
def op2_pattern_packing(spark, sf_dir):
    cut = packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER)
    return packing.pack(cut).withColumnRenamed("id", "doc_id")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, {_WORDS.format(_LOWER)} AS words FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN []
               WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
               ELSE list_distinct(list_transform(range(1, len(words) - 1),
                    lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS tokens
        FROM w
    ), rows AS (
        SELECT doc_id, len(tokens) AS n, unnest(tokens) AS token FROM sets
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
        FROM rows a JOIN rows b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared WHERE 100 * i >= 90 * (na + nb - i)
    ), both_ways AS (
        SELECT a, b FROM links UNION SELECT b, a FROM links
    ), reach AS (
        SELECT a, b FROM both_ways
        UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
    )
    SELECT s.doc_id, len(s.tokens)::BIGINT AS n_shingles,
           least(s.doc_id, min(r.b)) AS component_id
    FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.tokens
    """
)
def op4_ngram_jaccard_join(spark, sf_dir):
    joined = ngram_join.join(table(spark, sf_dir, "documents"))
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )


@query(
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id
        WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r
        FROM scored
    )
    SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
    """
)
def op1_vector_search(spark, sf_dir):
    found = vector_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query()
def op8_gated_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = gated_lm.score(docs, id_remainder(F.col("doc_id"), 7) != 2)
    return scored.select(
        F.col("id").alias("doc_id"),
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def archive_records(pages):
    """Records of an archive made of ``pages``: each page is a full response, every third one
    was visited again later, and of those every seventh had changed since."""
    start = 1_704_067_200  # the first second of 2024
    tag = F.md5("html")

    def record(number, kind, seconds, etag, body):
        headers = F.create_map(
            F.lit("ETag"), etag,
            F.lit("Date"), F.concat(F.lit("second "), seconds.cast("string")),
            F.lit("Content-Type"), F.lit(f"text/html; {kind}"),
        )
        return (
            number.alias("record_id"),
            F.lit(kind).alias("kind"),
            F.col("url"),
            F.timestamp_seconds(seconds + start).alias("time"),
            headers.alias("headers"),
            body.alias("body"),
        )

    crawled = F.pmod(F.col("page_id") * 7919, F.lit(2_592_000))
    again = crawled + F.pmod(F.col("page_id") * 104_729, F.lit(864_000)) + 1
    changed = F.col("page_id") % 21 == 0
    responses = pages.select(
        *record(F.col("page_id") * 2, "response", crawled, tag, F.col("html"))
    )
    revisits = pages.where("page_id % 3 = 0").select(
        *record(
            F.col("page_id") * 2 + 1,
            "revisit",
            again,
            F.when(changed, F.md5(F.concat("html", F.lit("x")))).otherwise(tag),
            F.lit(None).cast("string"),
        )
    )
    return responses.unionByName(revisits)


@query(
    """
    WITH p AS (
        SELECT *, (page_id * 7919) % 2592000 AS crawled,
               (page_id * 7919) % 2592000 + (page_id * 104729) % 864000 + 1 AS again,
               regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^https?://', '', 'i') AS bare
        FROM pages
    ), c AS (
        SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)),
                 ':(80|443)$', ''), '^www\\.', '')
               || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
               list_sort(list_filter(string_split(regexp_extract(bare, '\\?(.*)$', 1), '&'),
                 lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|fbclid|gclid|ref)(=|$)')))
                 AS asked
        FROM p
    ), k AS (
        SELECT *, base || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END
               AS canonical
        FROM c
    ), m AS (
        SELECT r.page_id * 2 + 1 AS record_id, r.canonical, r.page_id AS asker, s.page_id AS hit,
               row_number() OVER (PARTITION BY r.page_id ORDER BY s.crawled DESC, s.page_id DESC) AS n
        FROM k r LEFT JOIN k s ON s.canonical = r.canonical
             AND (s.crawled, s.page_id * 2) < (r.again, r.page_id * 2 + 1)
        WHERE r.page_id % 3 = 0
    )
    SELECT m.record_id, m.canonical, m.hit * 2 AS response_id,
           CASE WHEN hit IS NULL THEN 'unresolved'
                WHEN asker % 21 <> 0 AND md5(a.html) = md5(h.html) THEN 'matched'
                ELSE 'mismatch' END AS outcome,
           CASE WHEN asker % 21 <> 0 AND md5(a.html) = md5(h.html) THEN md5(h.html) END AS body_md5,
           CASE WHEN asker % 21 <> 0 AND md5(a.html) = md5(h.html)
                THEN 'text/html; response' ELSE 'text/html; revisit' END AS content_type
    FROM m LEFT JOIN pages a ON a.page_id = asker LEFT JOIN pages h ON h.page_id = hit
    WHERE n = 1
    """
)
def op5_warc_revisits(spark, sf_dir):
    resolved = warc_revisits.resolve(archive_records(table(spark, sf_dir, "pages")))
    return resolved.select(
        "record_id",
        "canonical",
        "response_id",
        "outcome",
        F.md5("body").alias("body_md5"),
        F.col("headers")["content-type"].alias("content_type"),
    )


def _field(name, text):
    return f"coalesce(octet_length(encode({text}))::VARCHAR || ':' || {text}, '-')".replace("$", name)


_LEAF = " || ".join(
    [_field(c, "$::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars")] + ["{}"]
)
_TEXT_FIELD = _field("text", "$")
_LOWER_FIELD = _field(_LOWER, "$")

#: crc32 of an identifier in decimal digits, bit by bit; 3988292384 is its polynomial, reversed.
_CRC32 = """
    xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT,
                     list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                                lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))
"""


@query(
    f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, lang, sha256({_LEAF.format(_TEXT_FIELD)}) AS leaf,
               CASE WHEN coalesce({_CRC32}, 0) % 3 = 0
                    THEN sha256({_LEAF.format(_LOWER_FIELD)}) END AS tampered
        FROM documents
    ), placed AS (
        SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS key,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM leaves
    ), trees AS (
        SELECT key, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY key) AS n FROM placed
        UNION ALL
        SELECT key, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
        FROM trees WHERE n > 1 GROUP BY key, level, pos // 8
    ), subroots AS (
        SELECT key, digest AS subroot FROM trees WHERE n = 1
    ), top AS (
        SELECT 0 AS level, key AS pos, subroot AS digest, count(*) OVER () AS n FROM subroots
        UNION ALL
        SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
        FROM top WHERE n > 1 GROUP BY level, pos // 8
    ), runs AS (
        SELECT false AS on_top, key, level, pos // 8 AS parent, list(digest ORDER BY pos) AS run
        FROM trees WHERE n > 1 GROUP BY key, level, pos // 8
        UNION ALL
        SELECT true, 0, level, pos // 8, list(digest ORDER BY pos)
        FROM top WHERE n > 1 GROUP BY level, pos // 8
    ), climb AS (
        SELECT false AS on_top, key, 0 AS level, pos, doc_id, leaf, key AS tree,
               (row_number() OVER ())::BIGINT AS row_no, '' AS proof, coalesce(tampered, leaf) AS folded
        FROM placed
        UNION ALL
        SELECT CASE WHEN r.run IS NULL THEN true ELSE c.on_top END,
               CASE WHEN r.run IS NULL THEN 0 ELSE c.key END,
               CASE WHEN r.run IS NULL THEN 0 ELSE c.level + 1 END,
               CASE WHEN r.run IS NULL THEN c.tree ELSE c.pos // 8 END,
               doc_id, leaf, tree, row_no,
               CASE WHEN r.run IS NULL THEN proof ELSE
                    proof || array_to_string(r.run[:c.pos % 8] || r.run[c.pos % 8 + 2:], '') END,
               CASE WHEN r.run IS NULL THEN folded ELSE
                    sha256(array_to_string(r.run[:c.pos % 8], '') || folded
                           || array_to_string(r.run[c.pos % 8 + 2:], '')) END
        FROM climb c LEFT JOIN runs r
             ON r.on_top = c.on_top AND r.key = c.key AND r.level = c.level AND r.parent = c.pos // 8
        WHERE r.run IS NOT NULL OR NOT c.on_top
    ), ends AS (
        SELECT * FROM climb WHERE on_top QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY level DESC) = 1
    ), root AS (
        SELECT digest AS root FROM top WHERE n = 1
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
           folded = root AS verified
    FROM ends JOIN subroots ON subroots.key = ends.tree, root
    """
)
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")

    def leaf(text):
        return merkle_manifest.leaf_digest(
            F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text
        )

    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(id_remainder(F.col("doc_id"), 3) == 0, leaf(lowered))
    manifest = merkle_manifest.build(
        docs,
        leaf(F.col("text")),
        part=F.col("lang"),
        order=F.col("doc_id"),
        carried={"doc_id": F.col("doc_id"), "tampered": tampered},
    )
    folded = merkle_manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return merkle_manifest.proofs(manifest).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle_manifest.path_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


@query(
    f"""
    WITH pieces AS (
        SELECT doc_id, coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, piece_text
        FROM (SELECT doc_id, lang,
                     unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece_text
              FROM documents WHERE text IS NOT NULL)
    ), worded AS (
        SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i
        FROM (SELECT lang, piece, regexp_extract_all(piece_text, '[^\\x20\\x09]+') AS w FROM pieces)
    ), followed AS (
        SELECT lang, w1, lead(w1) OVER following AS w2, lead(w1, 2) OVER following AS w3
        FROM worded WINDOW following AS (PARTITION BY piece ORDER BY i)
    ), grams AS (
        SELECT lang, 1 AS len, w1 AS phrase FROM followed
        UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM followed WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM followed WHERE w3 IS NOT NULL
    ), counts AS MATERIALIZED (
        SELECT lang, len, phrase, count(*) AS f FROM grams GROUP BY ALL
    ), totals AS (
        SELECT lang, count(*) AS n FROM grams WHERE len = 1 GROUP BY lang
    ), found AS (
        SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w
        FROM counts WHERE len > 1 AND f >= 10
    ), parts AS MATERIALIZED (
        SELECT *, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, len)) AS k FROM found)
    ), cuts AS (
        SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
               ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM parts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head
                     JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
    ), scored AS (
        SELECT * FROM cuts
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), longest AS (
        SELECT lang, phrase, max(a) AS most FROM (
            SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase
            FROM found WHERE len = 3)
        GROUP BY lang, phrase
    ), ranked AS (
        SELECT s.*, row_number() OVER (PARTITION BY s.lang
                    ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
        FROM scored s LEFT JOIN longest g ON g.lang = s.lang AND g.phrase = s.phrase
        WHERE most IS NULL OR 100 * most < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang)
    WHERE rank <= 2000
    """
)
def op11_collocations(spark, sf_dir):
    return collocations.phrases(table(spark, sf_dir, "documents"))


@query()
def op13_pii_scan(spark, sf_dir):
    return _span_digests(pii_scan.scan_narrow(table(spark, sf_dir, "documents")), pii_scan.BASE)
