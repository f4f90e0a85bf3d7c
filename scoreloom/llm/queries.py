"""The corpus operators as named queries over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.common import table
from scoreloom.llm.decontaminate import decontaminate
from scoreloom.llm.exact_dedup import exact_dedup
from scoreloom.llm.language import held_out, identify, train
from scoreloom.llm.licences import TEMPLATES, licence_scan
from scoreloom.llm.near_dedup import near_duplicates
from scoreloom.llm.negatives import hard_negatives
from scoreloom.llm.packing import best_fit_packing
from scoreloom.llm.quality import sample_good
from scoreloom.llm.substrings import per_document, substring_dedup
from scoreloom.llm.token_counts import token_counts
from scoreloom.llm.toxicity import fit_severity, grade_severity
from scoreloom.llm.variants import spelling_variants
from scoreloom.llm.warc import warc_round_trip

TOKENIZER = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), size=1024, end_id=2)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = sample_good(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return sampled.select("row.doc_id", "n_grams", "log_weight", "score", "sample_key", "kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_severity(docs, table(spark, sf_dir, "labels"))
    return grade_severity(docs.select("doc_id", "text"), model)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = identify(docs.select("doc_id", "text"), train(docs))
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), every=97)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = substring_dedup(docs, window=35)
    return per_document(docs, found.select("h1", "h2", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, anchors=F.col("vec_id") % 50 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_warc": op6_warc,
    "op7_licence_scan": op7_licence_scan,
    "op8_near_dedup": op8_near_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

_LISTED = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)

ORACLES: dict[str, str] = {
    "op6_warc": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
             f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM d)
        SELECT page_id, n AS payload_bytes, h AS payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM f""",
    "op7_licence_scan": rf"""
        WITH w AS (SELECT name, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM (VALUES {_LISTED}) AS v(name, t)),
             t AS (SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own FROM w),
             l AS (SELECT doc_id, unnest(list_distinct(list_append(string_split(text, chr(10)), text))) AS s FROM documents),
             sw AS (SELECT doc_id, regexp_extract_all(lower(s), '[a-z0-9]+') AS w FROM l),
             b AS (SELECT doc_id, row_number() OVER () AS n,
                          list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
                   FROM sw WHERE len(w) > 1),
             d AS (SELECT doc_id, n, name, 2.0::DOUBLE * len(list_intersect(own, b)) / (len(own) + len(b)) AS dice
                   FROM b JOIN t ON 200 * least(len(own), len(b)) >= 85 * (len(own) + len(b))),
             best AS (SELECT doc_id, n, first(name ORDER BY dice DESC, name) AS licence, max(dice) AS dice
                      FROM d WHERE dice >= 0.85 GROUP BY doc_id, n)
        SELECT doc_id, licence, round(max(dice), 6) AS dice, count(*) AS n_segments FROM best GROUP BY doc_id, licence""",
    "op9_decontamination": r"""
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             bi AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
                    FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
             sizes AS (SELECT DISTINCT size FROM bi),
             di AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS t
                    FROM dw, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)),
             hits AS (SELECT doc_id, i, di.size, item_id FROM di JOIN bi ON di.size = bi.size AND di.t = bi.t),
             cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM hits, unnest(range(i, i + size)) AS u(p) GROUP BY doc_id),
             named AS (SELECT doc_id, count(DISTINCT item_id) AS n,
                              array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids
                       FROM hits GROUP BY doc_id)
        SELECT dw.doc_id, len(w) AS n_words, coalesce(cover.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
        FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",
    "op12_substring_dedup": r"""
        WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS t FROM w, unnest(range(1, len(w) - 33)) AS u(i)),
             d AS (SELECT r, i FROM s QUALIFY count(*) OVER (PARTITION BY t) > 1),
             g AS (SELECT DISTINCT r, p FROM d, unnest(range(i, i + 35)) AS u(p)),
             k AS (SELECT r, p, w[p] AS word FROM w, unnest(range(1, len(w) + 1)) AS u(p)),
             j AS (SELECT k.r, count(g.p) AS n, string_agg(word, ' ' ORDER BY k.p) FILTER (g.p IS NULL) AS left_over
                   FROM k LEFT JOIN g ON k.r = g.r AND k.p = g.p GROUP BY k.r)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
        FROM w LEFT JOIN j USING (r)""",
    "op13_hard_negatives": r"""
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.l = b.l AS same, list_dot_product(a.v, b.v)::BIGINT AS score
                   FROM r AS a JOIN r AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3""",
}
