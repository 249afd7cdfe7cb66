"""From raw documents to token ids: rejects low quality, near-duplicates and contaminated texts, masks secrets, encodes.

Each stage takes (spark, docs, sf_dir) and judges all documents its predecessor kept. All but the last return the columns
of ``docs``. ``run`` writes each result to the shared folder as Parquet and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.llm import bpe, decontaminate, quality, secret_scan, simhash
from weekmart.llm.queries import definition, fold, table
from weekmart.session import staging_path

SCORE = "_pipeline_quality"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which label 1 is at least as likely as label 0. Nulls and empty texts score the overall share of label 1."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return quality.score(docs, model, name=SCORE).where(F.col(SCORE) >= 0.5).drop(SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document of smallest doc_id. Texts without words are one group."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark windows; null and empty texts stay."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text and n_chars counted anew where there is one; a null text stays null."""
    masked = secret_scan.masked_text(docs)
    if "n_chars" not in docs.columns:
        return masked
    counted = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", counted)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids of the whole text, and whether they decode to that text; a null text has no ids."""
    coded = bpe.encode_and_decode(docs.select("doc_id", "text"), definition())
    return coded.select(
        "doc_id", F.size("ids").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("encoding", encoding_stage),
]

#: Neither the quality vote nor the fingerprints nor the merges can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
