"""The registered queries of this package: opN_<name> -> (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import cut, drop_folder, scratch, table
from . import bpe, decontaminate, exact_dedup, hard_negatives, html_extract, jaccard_join, pii, pivot_index, resample, sharding, substring_dedup, toxicity, warc


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_pii(spark, sf_dir):
    out = pii.find(table(spark, sf_dir, "documents"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k))
    counts = [of(k).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return out.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
                      pii.spans_text(F.col("spans")).alias("spans"))


def public_vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extract(spark, sf_dir):
    out = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_sharding(spark, sf_dir):
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = bpe.encode(docs, public_vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_warc(spark, sf_dir):
    folder = scratch(spark, "warc")
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    out = cut(warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    drop_folder(spark, folder)
    return out


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_resample(spark, sf_dir):
    out = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_near_vectors(spark, sf_dir):
    return pivot_index.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_pii, op3_jaccard_join, op4_decontaminate, op5_html_extract, op6_sharding, op7_substring_dedup, op8_bpe, op9_warc, op10_exact_dedup, op11_resample,
                                  op12_hard_negatives, op13_near_vectors)}

# CRC-32 of bytes in SQL: a table built from the polynomial, then one step a byte.
_CRC = """
        WITH RECURSIVE t(v, c, k) AS (
          SELECT unnest(range(0, 256)), unnest(range(0, 256)), 0 UNION ALL
          SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM t WHERE k < 8),
        crc AS (SELECT list(c ORDER BY v) AS t FROM t WHERE k = 8),"""

ORACLE_SQL = {
    "op3_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        s AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
          FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
          SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (shingle)
          JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
          WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
        FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op6_sharding": _CRC + r"""
        b AS (
          SELECT doc_id, coalesce('=' || source, 'null') AS source, strlen(coalesce(text, '')) + 16 AS size,
                 xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(coalesce(text, ''))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
                   lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)]::BIGINT))) AS text_crc32,
                 ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
          FROM documents, crc),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS LAST, text_crc32, size) AS rank, count(*) OVER (PARTITION BY source) AS n FROM b),
        p AS (SELECT *, row_number() OVER (ORDER BY (2 * rank - 1) / (2 * n)::DOUBLE, source, rank) - 1 AS place, count(*) OVER () AS total FROM r),
        s AS (SELECT *, place * 40 // total AS shard FROM p)
        SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, (place - (shard * total + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
        FROM s""",
    "op7_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        v AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM w)),
        again AS (SELECT doc_id, i FROM v QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1),
        gone AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM again) GROUP BY doc_id),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM w),
        kept AS (
          SELECT words.doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM words
          LEFT JOIN (SELECT doc_id, unnest(gone) AS j, true AS hit FROM gone) g USING (doc_id, j) WHERE hit IS NULL GROUP BY words.doc_id)
        SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op9_warc": r"""
        WITH h AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (
          SELECT *, strlen(html) AS payload_bytes,
                 array_to_string(list_transform(range(0, 8), lambda i: list_transform([('0x' || substr(sha1(html), 5 * i + 1, 5))::BIGINT], lambda v:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v // 32768)::INT, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v // 1024 % 32)::INT, 1)
                   || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v // 32 % 32)::INT, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v % 32)::INT, 1))[1]), '') AS payload_digest,
                 max(page_id) OVER (PARTITION BY html) AS keep
          FROM h)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keep THEN keep END AS refers_to
        FROM d""",
    "op11_resample": _CRC + r"""
        d AS (
          SELECT doc_id, true AS own, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark),
        w AS (SELECT doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
        f AS (
          SELECT doc_id, own, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                     list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS g FROM w),
        c AS (SELECT doc_id, own, g, count(*) AS n FROM f GROUP BY ALL),
        h AS (
          SELECT g, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(g)), lambda i: ('0x' || substr(hex(encode(g)), 2 * i + 1, 2))::BIGINT)),
                   lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)]::BIGINT))) % 10000 AS bucket
          FROM (SELECT DISTINCT g FROM c), crc),
        s AS (SELECT bucket, sum(n) FILTER (WHERE own) AS s, sum(n) FILTER (WHERE NOT own) AS t FROM c JOIN h USING (g) GROUP BY bucket),
        total AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM s),
        gain AS (SELECT bucket, floor(1000 * ln((coalesce(s.t, 0) + 1) * (total.s + 10000) / ((coalesce(s.s, 0) + 1) * (total.t + 10000))))::BIGINT AS gain FROM s, total),
        x AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM c JOIN h USING (g) JOIN gain USING (bucket) WHERE own GROUP BY doc_id),
        y AS (
          SELECT w.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
          FROM w LEFT JOIN x USING (doc_id) WHERE own)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_words >= 20 AND row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) <= 5 * count(*) OVER (PARTITION BY n_words >= 20) // 100
                    THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS rank
        FROM y""",
    "op10_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256,
                 length(coalesce(text, '')) AS n FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""",
    "op12_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS vec_id, b.label AS label,
                 list_inner_product(a.c, b.c)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0),
        p AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s
          WHERE label = anchor_label AND vec_id <> anchor_id
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE s.label <> s.anchor_label AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op13_near_vectors": """
        WITH RECURSIVE v AS (
          SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
        c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
        n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM c LEFT JOIN n USING (vec_id)""",
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE_SQL)
