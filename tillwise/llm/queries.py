"""The registered queries of this package and their SQL equivalents."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.llm import (
    decontamination,
    html,
    manifest,
    mixing,
    pii,
    quality,
    repeats,
    simhash,
    token_counts,
    tokens,
    toxicity,
    warc,
    whitening,
)
from tillwise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract_text(table(spark, folder, "pages"))


def _repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"), with_text=False)


def _pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality.assess(docs, table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "log_ratio",
    )


def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_index(table(spark, folder, "documents"))


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.toxic_passages(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.audit(table(spark, folder, "documents"))


def _whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, folder, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").cast("bigint"))


def _warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages")).drop("url")


def _pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, folder)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": _simhash,
        "op2_decontamination": _decontamination,
        "op3_html": _html,
        "op4_mixing": _mixing,
        "op5_quality": _quality,
        "op6_repeats": _repeats,
        "op7_tokens": _tokens,
        "op8_pii": _pii,
        "op9_toxicity": _toxicity,
        "op10_token_counts": _token_counts,
        "op11_manifest": _manifest,
        "op12_whitening": _whitening,
        "op13_warc": _warc,
        "pipeline": _pipeline,
    }


MIXING_SQL = """
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 16) AS draw
  FROM documents
), sums AS (
  SELECT source, sum(size) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS position
  FROM sizes GROUP BY source
), weighted AS (
  SELECT *, CASE position % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS most,
         (sum(source_size) OVER ()) * 1.5::DOUBLE AS budget
  FROM sums
), steps AS (
  SELECT *, coalesce(sum(most) OVER w, 0) AS full_before,
         (sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM weighted
  WINDOW w AS (ORDER BY most / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT max((budget - full_before) / weight_left) FILTER ((budget - full_before) / weight_left < most / weight) AS low
  FROM steps
), targets AS (
  SELECT source, position, source_size, budget,
         least(most, coalesce(low, 1e300) * weight) AS target
  FROM weighted, levels
), queued AS (
  SELECT s.doc_id, s.size, s.draw, t.position, t.source_size, t.target, t.budget, e.epoch,
         sum(s.size) OVER (PARTITION BY t.position, e.epoch ORDER BY s.draw, s.doc_id, s.size
                           ROWS UNBOUNDED PRECEDING) + e.epoch * t.source_size AS words
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
       CROSS JOIN (VALUES (0), (1)) AS e(epoch)
), emitted AS (
  SELECT *, sum(size) OVER (
    ORDER BY CASE WHEN target > 0 THEN words / target ELSE 0 END, position, epoch, draw, doc_id, size
    ROWS UNBOUNDED PRECEDING) AS emitted
  FROM queued
)
SELECT doc_id, CAST(any_value(size) AS BIGINT) AS size, CAST(any_value(source_size) AS BIGINT) AS source_size,
       any_value(target) AS target,
       CAST(sum(CASE WHEN emitted <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM emitted GROUP BY doc_id
"""


# Base32 from the hexadecimal digest: every five digits are four letters.
WARC_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS digest,
         max(page_id) OVER (PARTITION BY payload) AS response
  FROM payloads
), numbers AS (
  SELECT *, [CAST('0x' || substr(digest, 5 * k + 1, 5) AS INTEGER) FOR k IN range(8)] AS fives FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((fives[1 + k // 4] >> (15 - 5 * (k % 4))) & 31), 1)
                       FOR k IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response OR response IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM numbers
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": MIXING_SQL, "op13_warc": WARC_SQL}
