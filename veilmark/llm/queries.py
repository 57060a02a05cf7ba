"""The registered queries of this package, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilmark.session import configure

from . import conversations, exact_dup, html, licenses, lm, mixing, near_dup, packing, privacy, topk, warc, whitening
from . import quality as quality_model
from .scratch import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir.rstrip("/"))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_near_duplicates")
def near_duplicates(spark, sf):
    """Component of near copies of every document."""
    return near_dup.near_duplicates(table(spark, sf, "documents"))


@query("op2_quality")
def quality(spark, sf):
    """Quality score of every document."""
    return quality_model.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op3_mixing")
def mix(spark, sf):
    """Words that the mix takes of every document."""
    rows = mixing.mix_sources(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_personal_data")
def personal_data(spark, sf):
    """Personal data of every document and the terms that disclose it."""
    return privacy.personal_data(table(spark, sf, "documents"))


@query("op5_language_model")
def language_model(spark, sf):
    """Log probability of every document."""
    return lm.corpus_scores(table(spark, sf, "documents"))


@query("op6_packing")
def pack(spark, sf):
    """Pieces of all documents and their places in sequences."""
    return packing.pack(table(spark, sf, "documents"), with_ids=False)


@query("op7_main_text")
def main_text(spark, sf):
    """Main text of every page."""
    return html.main_texts(table(spark, sf, "pages"))


@query("op8_license_scan", licenses.oracle_sql())
def license_scan(spark, sf):
    """Known licences of every document."""
    return licenses.license_scan(table(spark, sf, "documents"))


@query(
    "op9_top_k",
    """
WITH vectors AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q, vectors c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5""",
)
def top_k(spark, sf):
    """Five best inner products of every fiftieth vector."""
    vectors = topk.integer_vectors(table(spark, sf, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


@query(
    "op10_exact_duplicates",
    r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)""",
)
def exact_duplicates(spark, sf):
    """Group of equal texts of every document."""
    return exact_dup.exact_duplicates(table(spark, sf, "documents"))


@query(
    "op11_archives",
    """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS size FROM pages
), groups AS (
  SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS kept FROM payloads
)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN kept IS NULL OR page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept IS NULL OR page_id = kept THEN NULL ELSE kept END AS refers_to
FROM groups""",
)
def archives(spark, sf):
    """Every page's record, from the merged index of the archives."""
    index = warc.capture_index(table(spark, sf, "pages"), warc.stand_in_time(F.col("page_id")))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op12_whitening")
def whitening_components(spark, sf):
    """Sixteen whitened components of every usable vector."""
    return whitening.whitened(table(spark, sf, "embeddings"))


@query("op13_conversation_repair")
def conversation_repair(spark, sf):
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    return conversations.repair_damaged(table(spark, sf, "conversations"))
