"""One query per operator over the whole table it is meant for, and the SQL of those that have any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.common import table
from reelgauge.llm.decontamination import benchmark_matches
from reelgauge.llm.filter_audit import audit
from reelgauge.llm.hard_negatives import hard_negatives
from reelgauge.llm.html_extraction import extract_text
from reelgauge.llm.ngram_jaccard import linked_documents
from reelgauge.llm.personal_data import BASE_KINDS, find_personal_data, listed
from reelgauge.llm.quality_classifier import held_out, learn, quality_scores
from reelgauge.llm.sentencepiece_codec import encode_decode
from reelgauge.llm.sharding import sharded_documents
from reelgauge.llm.substring_dedup import deduplicated
from reelgauge.llm.token_counts import token_counts
from reelgauge.llm.topk_search import top_k
from reelgauge.llm.url_filters import judged

PIECES = "piece_bpe_32k.model"

# The rules of the URL query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document: 4-word n-grams, similarity 0.85."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linked_documents(documents, n=4, similarity=(85, 100))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of equal counts that keep equal texts together as far as they fit."""
    return sharded_documents(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the given rules, else what FP-growth mines from their verdicts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their text again, as digests."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_decode(documents, public_tokenizers.path(PIECES))
    ids = F.array_join("ids", ",").cast("binary")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place in a document where a benchmark item occurs, with its edits."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_matches(documents, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that a document with a smaller id has too."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("kept").cast("binary"), 256)
    return deduplicated(documents).select(
        "doc_id", "n_words", "n_removed", kept.alias("kept_sha256")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labelled rows that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(documents, table(spark, sf_dir, "labels"))
    scored = quality_scores(documents.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(documents, public_tokenizers.path(PIECES))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors of every 50th vector, by the threshold algorithm."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 positives of every 100th vector and up to 5 hard negatives of each, by shared lists."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans counted and digested, and all spans."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(documents)
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}")
        for kind in BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters on every document, in all 120 orders, per language."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return audit(documents, table(spark, sf_dir, "labels"))


LLM_QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_sharding": op2_sharding,
    "op3_html_extraction": op3_html_extraction,
    "op4_url_filters": op4_url_filters,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_decontamination": op6_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_topk_search": op10_topk_search,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_personal_data": op12_personal_data,
    "op13_filter_audit": op13_filter_audit,
}

LLM_ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i
                  FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common >= 85 * (x.n + y.n - common)),
        reach AS (
            SELECT a AS doc_id, a AS other FROM links
            UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT d.doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles,
               least(d.doc_id, min(other)) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach USING (doc_id)
        GROUP BY d.doc_id""",
    "op7_substring_dedup": """
        WITH words AS (
            SELECT doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS passage
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i
                  FROM words WHERE len(w) >= 50)),
        firsts AS (SELECT passage, min(doc_id) AS first FROM windows GROUP BY passage),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p
            FROM windows JOIN firsts USING (passage) WHERE first < doc_id),
        places AS (
            SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words),
        kept AS (
            SELECT doc_id, count(*) AS left_over, string_agg(word, ' ' ORDER BY p) AS text
            FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(len(w) - coalesce(left_over, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)""",
    "op10_topk_search": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE len(embedding) > 0 AND len(
                [x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT DISTINCT ON (vec_id) vec_id, label, e
            FROM (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10
                                           ELSE label END AS BIGINT) AS label,
                         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
                  FROM embeddings
                  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(
                      [x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)
            ORDER BY vec_id, label, e),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
            FROM scored WHERE same),
        ranked AS (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score,
                   score AS negative_score, CAST(row_number() OVER (
                       PARTITION BY anchor_id, positive_id
                       ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM positives JOIN scored USING (anchor_id)
            WHERE r <= 5 AND NOT same
              AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 5""",
    "op13_filter_audit": """
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        fails AS (
            SELECT part, doc_id,
                   {'A': len(w) < 200,
                    'B': 100 * len(list_distinct(w)) < 50 * len(w),
                    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                    'D': regexp_matches(t, '[#$%&*|]'),
                    'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
            FROM words),
        marks AS (
            SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good,
                   coalesce(bool_or(toxic = 1), false) AS toxic
            FROM labels GROUP BY doc_id),
        cells AS (
            SELECT part, concat(CASE WHEN f.A THEN 'A' ELSE '' END,
                                CASE WHEN f.B THEN 'B' ELSE '' END,
                                CASE WHEN f.C THEN 'C' ELSE '' END,
                                CASE WHEN f.D THEN 'D' ELSE '' END,
                                CASE WHEN f.E THEN 'E' ELSE '' END) AS failing,
                   count(*) AS n, count(*) FILTER (WHERE good) AS n_good,
                   count(*) FILTER (WHERE toxic) AS n_toxic
            FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL),
        orders AS (
            SELECT concat(a, b, c, d, e) AS filter_order
            FROM unnest(['A', 'B', 'C', 'D', 'E']) p(a), unnest(['A', 'B', 'C', 'D', 'E']) q(b),
                 unnest(['A', 'B', 'C', 'D', 'E']) r(c), unnest(['A', 'B', 'C', 'D', 'E']) s(d),
                 unnest(['A', 'B', 'C', 'D', 'E']) u(e)
            WHERE len(list_distinct([a, b, c, d, e])) = 5),
        steps AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own,
                   left(filter_order, step - 1) AS before
            FROM orders, unnest([1, 2, 3, 4, 5]) t(step)),
        judged AS (
            SELECT c.*, s.*, contains(failing, own) AS fails,
                   len(translate(failing, before, '')) < len(failing) AS gone
            FROM cells c CROSS JOIN steps s),
        counted AS (
            SELECT part, filter_order, step, own,
                   sum(n) FILTER (WHERE NOT gone AND NOT fails) AS kept,
                   sum(n) FILTER (WHERE NOT gone AND fails) AS removed,
                   sum(n) FILTER (WHERE gone AND fails) AS redundant,
                   sum(n) FILTER (WHERE failing = own) AS unique_fails,
                   sum(n_good) FILTER (WHERE NOT gone AND fails) AS good_lost,
                   sum(n_toxic) FILTER (WHERE NOT gone AND fails) AS toxic_lost
            FROM judged GROUP BY ALL)
        SELECT part, filter_order, step,
               CAST(coalesce(kept, 0) AS BIGINT) AS kept,
               CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
               CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
               CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM counted""",
}
