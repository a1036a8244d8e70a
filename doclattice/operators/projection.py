"""Blocks and sections as JSON: what is empty is left out, so a reader fills in defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields that are always there, and those that are left out when null, blank, empty or false.
ALWAYS = ("id", "page", "kind", "text", "source_text", "bbox", "line_count")
SPARSE = ("level", "marker", "marker_raw", "marker_normalized", "marker_type", "indent_ta", "parent_id", "section_id", "section_path", "transformations", "rows", "source_rows", "cells", "layout_node_id", "source_fragments", "heading_hint", "excluded_from_retrieval", "requires_vision")


def _sparse(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind.startswith("array"):
        return F.when(F.size(c) > 0, c)
    if kind == "string":
        return F.when(c != "", c)
    return F.when(c, c) if kind == "boolean" else c


def block_json(blocks: DataFrame) -> Column:
    """A block of these columns as JSON; its box to a tenth of a point."""
    kinds = dict(blocks.dtypes)
    fields = [F.transform("bbox", lambda v: F.round(v, 1)).alias("bbox") if c == "bbox" else F.col(c) for c in ALWAYS if c in kinds]
    fields += [_sparse(c, kinds[c]).alias(c) for c in SPARSE if c in kinds]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})


def section_json() -> Column:
    """A section (section_id, head_block_id, head_text, marker, level, child_block_ids, block_ids, first_page, last_page) as JSON, nulls kept."""
    names = ("section_id", "head_block_id", "head_text", "marker", "level", "child_block_ids", "block_ids")
    return F.to_json(F.struct(*names, F.array("first_page", "last_page").alias("page_range")), {"ignoreNullFields": "false"})


def shown_blocks(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """What a reviewer sees of each document: its blocks but the excluded ones, in order."""
    seen = blocks.where("class <> 'excluded'")
    shown = F.array_sort(F.collect_list(F.struct("seq", "block_id", "kind", "class", "text")))
    return seen.groupBy(*doc).agg(shown.alias("blocks"))


def summary_line(blocks: DataFrame, doc: list[str], stats: list[str]) -> DataFrame:
    """'n blocks (kind=n ...) | stat=n ...' of each document; stats are columns that a document's blocks share."""
    kinds = blocks.groupBy(*doc, "kind").agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in stats])
    by_kind = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", "n"))), lambda x: F.concat_ws("=", x["kind"], x["n"].cast("string"))), " ")
    told = F.concat_ws(" ", *[F.concat_ws("=", F.lit(c), F.max(c).cast("string")) for c in stats])
    return kinds.groupBy(*doc).agg(F.concat(F.sum("n").cast("string"), F.lit(" blocks ("), by_kind, F.lit(") | "), told).alias("summary"))
