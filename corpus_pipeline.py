"""A training-data pipeline over the documents table: each stage's result is written and read again.

Language ID drops documents without a language, near-duplicate search keeps one document of each group,
decontamination drops documents that hold a benchmark item, personal values become pseudonyms, and the
last stage turns texts into token ids. All stages but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import bpe, decontaminate, langid, neardup, pseudonyms
from runlens.llm.shared import fresh_path, table

# Percent of shared shingles from which documents of the pipeline are near duplicates.
SIMILARITY = 80
PSEUDONYM_KEY = "registered query"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    findings = "findings"
    while findings in (c.lower() for c in docs.columns):
        findings += "_"
    changed = pseudonyms.pseudonymised(docs, PSEUDONYM_KEY, findings).drop(findings)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*[changed[c] for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

# Language scores and tokens cannot be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
