"""The operators of this package as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.llm import (
    exact_dedup,
    fill_in_middle,
    interpolation,
    licenses,
    mixing,
    outliers,
    packing,
    quality_model,
    simhash,
    token_store,
    toxicity,
    vector_codes,
    warc,
)
from ledgerstrata.llm.common import table, vocabulary


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("text_key")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_round_trip(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), words="spaced"
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_digests(warc.capture_round_trip(table(spark, sf_dir, "pages"), min_bytes=0))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(licenses.documents_as_files(table(spark, sf_dir, "documents")))


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048, words="dropped"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.middle_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            op1_quality_rules,
            op2_exact_dedup,
            op3_token_store,
            op4_simhash_near_dedup,
            op5_warc_transactions,
            op6_quality_classifier,
            op7_mix_to_targets,
            op8_license_scan,
            op9_deleted_interpolation,
            op10_best_fit_packing,
            op11_vector_codes,
            op12_toxicity,
            op13_fill_in_middle,
        )
    }


ASCII_LOWER = (
    "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_SQL = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {ASCII_LOWER.format('text')} AS norm FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM d""",
    # A SHA-1 is eight groups of five hexadecimal digits, each four base32 letters.
    "op5_warc_transactions": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        k AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS keep, sha1(body) AS hex FROM p)
        SELECT page_id,
               octet_length(encode(body)) AS payload_bytes,
               list_aggregate(list_transform(range(0, 32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5))::BIGINT
                         >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), 'string_agg', '')
                   AS payload_digest,
               CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
        FROM k""",
}


def oracle_sql() -> dict[str, str]:
    return _SQL | {
        "op8_license_scan": licenses.licence_sql(),
        "op11_vector_codes": vector_codes.codes_sql(),
        "op13_fill_in_middle": fill_in_middle.middle_sql(),
    }
