"""Choosing what is labelled first: units by section, and the first seed whose draw meets all totals."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.operators.targets import unit_count


@dataclass(frozen=True)
class Draw:
    """How many documents of each category, and what they must add up to."""

    counts: dict[str, int]
    units: tuple[int, int]
    table_rows: int = 0
    headings: int = 0
    topic_docs: int = 0
    topic: str = ""
    seeds: int = 1000
    order: tuple[str, ...] = field(default=("group_id",))


def units_by_section(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """units, table_rows and headings of each section, of blocks of class target or table (columns class, kind, n_rows, section_id)."""
    n = unit_count(F.when(F.col("class") == "table", "table").otherwise(F.col("kind")), F.col("n_rows"))
    judged = blocks.where(F.col("class").isin("target", "table") & F.col("section_id").isNotNull())
    return judged.groupBy(*doc, "section_id").agg(F.sum(n).alias("units"), F.sum(F.when(F.col("class") == "table", n).otherwise(0)).alias("table_rows"), F.count_if(F.col("kind") == "heading").alias("headings"))


def totals(chosen: DataFrame, doc: list[str]) -> DataFrame:
    return chosen.groupBy(*doc).agg(*[F.sum(c).alias(c) for c in ("units", "table_rows", "headings")])


def drawn(candidates: list[dict], seed: int, draw: Draw) -> list[dict]:
    """Documents of one draw: each category in an order of its own, one document of a group only."""
    rng, picked, groups = random.Random(seed), [], set()
    for category, count in draw.counts.items():
        pool = [c for c in candidates if c["category"] == category]
        rng.shuffle(pool)
        taken = 0
        for c in pool:
            if taken < count and c["group_id"] not in groups and c["units"]:
                picked.append(c)
                groups.add(c["group_id"])
                taken += 1
    return picked


def meets(picked: list[dict], draw: Draw) -> bool:
    total = {k: sum(c[k] for c in picked) for k in ("units", "table_rows", "headings")}
    topics = sum(bool(re.search(draw.topic, c["title"])) for c in picked) if draw.topic else draw.topic_docs
    return len(picked) == sum(draw.counts.values()) and draw.units[0] <= total["units"] <= draw.units[1] and total["table_rows"] >= draw.table_rows and total["headings"] >= draw.headings and topics >= draw.topic_docs


def first_draw(spark: SparkSession, candidates: DataFrame, draw: Draw, most: int = 10_000) -> DataFrame:
    """seed, document_id of the first seed from 0 whose draw meets the totals; no rows if none does.

    candidates: document_id, group_id, category, title, units, table_rows, headings, in the order of order and document_id. They are a
    split's labelled documents; more than most are refused, as they go to every task. Seeds are tried by all tasks."""
    listed = candidates.orderBy(*draw.order, "document_id").limit(most + 1).toPandas().to_dict("records")
    if len(listed) > most:
        raise ValueError(f"more than {most} candidates")

    def attempt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(s, c["document_id"]) for s in batch["id"].tolist() for picked in [drawn(listed, s, draw)] if meets(picked, draw) for c in picked]
            yield pd.DataFrame(rows, columns=["seed", "document_id"]).astype({"seed": "int64", "document_id": "object"})

    found = spark.range(draw.seeds).mapInPandas(attempt, "seed long, document_id string")
    return found.groupBy("seed").agg(F.collect_list("document_id").alias("d")).orderBy("seed").limit(1).select("seed", F.explode("d").alias("document_id"))
