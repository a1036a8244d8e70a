"""Identity of parsed documents, and labels bound to it."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclattice.functions.text import canonical


def _digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def content_hash(payload: Column) -> Column:
    """SHA-256 of a parsed document (JSON), without its snapshot and the parser's statistics; null where it isn't an object."""

    def one(text: str | None) -> str | None:
        try:
            doc = json.loads(text or "")
        except ValueError:
            return None
        if not isinstance(doc, dict):
            return None
        parser = doc.get("parser")
        kept = {k: v for k, v in doc.items() if k != "snapshot"}
        if isinstance(parser, dict):
            kept["parser"] = {k: v for k, v in parser.items() if k != "stats"}
        return _digest(kept)

    return F.pandas_udf(_mapped(one), "string")(payload)


def _mapped(one):
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    return run


def structure_hash(payload: Column) -> Column:
    """SHA-256 of a parsed document's sections and blocks only."""

    def one(text: str | None) -> str | None:
        try:
            doc = json.loads(text or "")
            return _digest({"sections": doc["sections"], "blocks": doc["blocks"]})
        except (ValueError, KeyError, TypeError):
            return None

    return F.pandas_udf(_mapped(one), "string")(payload)


def identity(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """docs with parsed_content_sha256 and snapshot_id."""
    named = docs.withColumn("parsed_content_sha256", content_hash(F.col(payload)))
    return named.withColumn("snapshot_id", F.concat(F.lit("snap_"), "parsed_content_sha256"))


def block_sources(blocks: DataFrame) -> DataFrame:
    """What a label's spans rest on: document, block, page, box, source text, and the hash of the text."""
    return blocks.select("document_id", F.col("id").alias("block_id"), "page", "bbox", "source_text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def unbound(labels: DataFrame, sources: DataFrame) -> DataFrame:
    """Labels (document_id, block_id, page, bbox, source_text, text_sha256) whose references differ from the frozen document's."""
    on = ["document_id", "block_id"]
    fields = [c for c in sources.columns if c not in on]
    both = labels.join(sources.select(*on, F.struct(*fields).alias("frozen")), on, "left")
    same = F.col("frozen").isNotNull()
    for c in fields:
        same = same & F.col(c).eqNullSafe(F.col(f"frozen.{c}"))
    return both.where(~same).select(*labels.columns)


def not_labelable(asked: DataFrame, classes: DataFrame) -> DataFrame:
    """document_id, block_id that are asked for and aren't of class target or table."""
    fit = classes.where(F.col("class").isin("target", "table")).select("document_id", "block_id")
    return asked.select("document_id", "block_id").join(fit, ["document_id", "block_id"], "left_anti")
