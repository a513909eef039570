"""Registered queries of this package: each applies one operator to its whole table.

``QUERIES`` and ``ORACLE`` are added to the driver contract only if this package can be
imported.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq.llm import bpe_codec, decontaminate, embedding_dedup, hard_negatives, html_text, jaccard_join, language_id, lexical_search, line_dedup, quality, token_counts, training_order, url_filters
from notifyq.llm.bpe_tables import PRE_TOKEN
from notifyq.llm.common import table
from notifyq.session import checkpoint_dir


def vocabulary() -> str:
    """Path of the byte-level BPE vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_count_report(table(spark, sf_dir, "documents"), vocabulary())


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = html_text.extract_main_text(pages)
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=4, percent=85))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.codec_report(table(spark, sf_dir, "documents"), vocabulary())


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each sequence of 512 ids went; the blocks are written to the shared folder."""
    import public_tokenizers

    folder = f"{checkpoint_dir(spark)}/training-order-{uuid.uuid4().hex}"
    ranks = training_order.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    return training_order.write_training_order(docs, ranks, PRE_TOKEN, folder, key="epoch-0")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return embedding_dedup.near_duplicates(rows)


#: (action, host, path) of the query's contract.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_line_dedup, op3_quality_classifier, op4_html_text, op5_jaccard_join, op6_bpe_codec,
        op7_training_order, op8_decontamination, op9_embedding_dedup, op10_url_filters, op11_hard_negatives,
        op12_language_id, op13_lexical_search,
    )
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op10_url_filters": r"""
WITH parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
judged AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/'
    END AS rule
  FROM parsed)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INT AS rank,
  n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5""",
    "op13_lexical_search": r"""
WITH words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS rid FROM documents)),
lengths AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY rid),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
postings AS (
  SELECT rid, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM items) GROUP BY rid, term),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), total),
scores AS (
  SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (rid), total
  GROUP BY item_id, rid)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN lengths USING (rid) WHERE score > 0 AND doc_id IS NOT NULL)
WHERE rank <= 10""",
}
