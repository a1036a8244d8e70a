"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and reread
as the next stage's docs. All but the last return the columns of documents, so a stage can be left out or
repeated. Side tables (labels, benchmark) are read from sf_dir. A very long text is one row: every stage reads it whole, and none
holds more than a batch of rows. Empty tables, null ids and texts, and repeated rows are defined by each stage's operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.llm import decontam, ngram_join, packing, quality, secrets
from doclattice.session import materialize

#: Similarity and shingle of near duplicates.
NEAR = ngram_join.Threshold(80, 100)
NEAR_WORDS = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id. Rows without an id, and texts without words, stay."""
    found = materialize(ngram_join.ngram_components(docs, NEAR_WORDS, NEAR).select("doc_id", "component_id"), "near")
    copies = found.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    # Rows that repeat an id with the same text are copies that ids can't tell apart.
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.limit(1).count():
        return kept
    twice = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(twice.dropDuplicates(["doc_id", "text"]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced, and n_chars follows the text. A null text stays null with its n_chars."""
    clean = secrets.redacted(docs)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(clean.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and the sequence that each is in."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier and the tokenizer aren't expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
