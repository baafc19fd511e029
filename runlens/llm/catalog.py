"""The registered queries of this subpackage, each over its whole table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import (
    bpe,
    clusters,
    decontaminate,
    fingerprints,
    langid,
    licenses,
    neardup,
    pseudonyms,
    quality,
    secrets_scan,
    simhash,
    token_files,
    vector_codes,
)
from runlens.llm.shared import fresh_path, table


# A deployment passes its own secret; results of the registered queries are repeatable with this one.
PSEUDONYM_KEY = "registered query"


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return found.select("doc_id", "text", "findings", F.size("findings").alias("n_findings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    token_files.write_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder
    )
    return token_files.read_digests(spark, folder)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_token_files": op6_token_files,
    "op7_bpe": op7_bpe,
    "op8_secrets": op8_secrets,
    "op9_language_id": op9_language_id,
    "op10_fingerprints": op10_fingerprints,
    "op11_vector_codes": op11_vector_codes,
    "op12_clusters": op12_clusters,
    "op13_simhash": op13_simhash,
}

ORACLES: dict[str, str] = {
    "op1_near_duplicates": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []::VARCHAR[]
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
            WHERE 100 * c >= 85 * (sa.n + sb.n - c)
        ), ways AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach(doc_id, root) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT ways.b, reach.root FROM reach JOIN ways ON ways.a = reach.doc_id
        ), lowest AS (
            SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM lowest LEFT JOIN sizes USING (doc_id)
    """,
    "op5_licenses": licenses.oracle(),
    "op11_vector_codes": vector_codes.oracle(),
    "op12_clusters": clusters.oracle(),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
