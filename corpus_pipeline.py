"""Documents to packed training sequences, one stage after the other.

Each stage takes what the one before kept, as a table with the columns of
``documents``; extra columns pass through, whatever their names. Each learns
only from its own input. Nulls: a text without a letter has no language and
goes; ids may be null. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.llm import common, language, packing, personal, quality, simhash

ORACLE_SQL = None  # trained models, tokenizers and components are beyond SQL


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the labels of all of them train the model."""
    model = language.learn(docs)
    verdict = common.fresh(docs, "language_verdict")
    return docs.withColumn(verdict, language.verdicts(spark, model)(F.col("text"))).where(F.col(f"{verdict}.accepted")).drop(verdict)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and are no outliers of their language and source."""
    counts = common.fresh(docs, "quality_counts")
    distance = common.fresh(docs, "quality_distance")
    counted = quality.with_statistics(docs, counts)
    fitted = quality.fit(common.stored(quality.vectors(counted, counts), "vectors"))
    # texts do not move: the estimates, a row per group, are what Spark joins them with
    passed = counted.where(~quality.base_failed(counts))
    return quality.verdict(passed, counts, fitted, distance).where(quality.accepted(counts, distance)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id (of equal ids, the least fingerprint)."""
    mark = common.fresh(docs, "near_duplicate_mark")
    marked = common.stored(docs.withColumn(mark, simhash.fingerprints("text")), "marked")
    rows = marked.select("doc_id", F.col(mark).alias("fp"))
    key, owner = common.fresh(marked, "owner_id"), common.fresh(marked, "owner_mark")
    owners = simhash.classes(rows).where(F.col("fp") == F.col("owner")).select(F.col("fp").alias(owner), F.col("component_id").alias(key))
    kept = marked.join(owners, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(owner)), "left_semi")
    # rows that repeat a kept document
    place = common.fresh(kept, "near_duplicate_place")
    first = F.row_number().over(W.partitionBy("doc_id", mark).orderBy(mark))
    return kept.withColumn(place, first).where(F.col(place) == 1).select(*docs.columns)


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    found = common.fresh(docs, "personal_spans")
    clean = docs.withColumn(found, personal.spans("text")).withColumn("text", F.when(F.col("text").isNotNull(), personal.redact("text", found)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal", personal_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
