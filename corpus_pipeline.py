"""Corpus pipeline: quality, near-duplicates, decontamination, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every stage's rows
as Parquet to the shared folder and hands the reread table to the next stage. All stages but the last
return the columns of ``documents``; a stage keeps whole rows, texts are changed by the secret scan only.

The quality and decontamination stages decide row by row. The near-duplicate stage names rows by a row id
of its own: one row of each group stays, also where doc_ids repeat or are null.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlake.llm import decontam, packing, quality, secrets, simhash
from starlake.llm.common import cut, fresh, ship_package, small, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tail probability of the best grade is below one half go."""
    model = quality.fit(docs, quality.ratings(table(spark, sf_dir, "labels")))
    return quality.keep(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the first by doc_id (null last); of rows with the same doc_id, any one."""
    row, key = fresh(docs.columns, "_row", "_key")
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    keyed = rows.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row")).alias(key), "text")
    found = simhash.near_duplicates(keyed, key, k=3, max_bits=3)
    others = cut(found.where("doc_id.row <> component_id.row").select(F.col("doc_id.row").alias(row)))
    return rows.join(small(others, 1_000_000), row, "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy, edited or not, of a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by a mark; n_chars follows the text."""
    clean = secrets.redact(docs)
    changed = F.when(F.col("text").isNotNull() & F.col("n_chars").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed) if "n_chars" in docs.columns else clean


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents left, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality_classifier), ("simhash near-dedup", simhash_near_dedup),
          ("benchmark decontamination", benchmark_decontamination), ("secret scans", secret_scans), ("best-fit packing", best_fit_packing)]
ORACLE_SQL = None  # models, fingerprints and tokenizers are beyond SQL: see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
