"""The contract of parsed documents as issue rows (document_id, code, path, message).

Each condition is one filter, anti-join or grouped count over the blocks and sections tables, so a corpus is
checked in a few shuffles on document_id; chains of parents are followed by doubling.

documents: document_id, page_count. blocks: document_id, id, seq, page, kind, text, source_text, bbox, parent_id,
section_id, marker, excluded (boolean). sections: document_id, section_id, head_block_id, block_ids, page_range.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclattice.session import drop_materialized, materialize

from doclattice.operators.validate import duplicate_keys, issues, union

DOC = ["document_id"]
# Kinds of blocks, those left out of retrieval, those that flow, and those whose text has lines.
KINDS = ("heading", "para", "item", "note", "attachment", "table", "figure", "approval", "document_title", "header", "footer", "page_number")
EXCLUDED = ("header", "footer", "page_number")
FLOW = ("para", "item", "heading", "note", "attachment")
LINED = ("table", "approval")
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
# Bullets that stand at the start of an item only.
BULLETS = "□■❑❒▢❐❏☐∎○◦◯❍◎∘⦁●◆◇◈▶▷▸▹▻►★✓➠❙"


def _in_order(part: str, whole: str) -> bool:
    at = 0
    for c in part:
        at = whole.find(c, at) + 1
        if not at:
            return False
    return True


def is_subsequence(part: Column, whole: Column) -> Column:
    """Whether the characters of part occur in whole in that order, white space aside; null for nulls. Linear in the
    two texts, which a fold over characters in an expression isn't: each step there copies or recounts a text."""

    @F.pandas_udf("boolean")
    def judge(parts: pd.Series, wholes: pd.Series) -> pd.Series:
        pairs = zip(parts, wholes, strict=True)
        return pd.Series([_in_order("".join(p.split()), "".join(w.split())) if isinstance(p, str) and isinstance(w, str) else None for p, w in pairs], dtype=object)

    return judge(part, whole)


def box_fault(box: Column) -> Column:
    """Why a box isn't one: shape, number or order; null if it is."""
    odd = F.exists(box, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        F.when(box.isNull() | (F.size(box) != 4), "shape").when(odd, "number")
        .when((F.get(box, F.lit(0)) > F.get(box, F.lit(2))) | (F.get(box, F.lit(1)) > F.get(box, F.lit(3))), "order")
    )


def looping_parents(blocks: DataFrame) -> DataFrame:
    """document_id, id of the blocks whose chain of parents never ends; of a repeated id the largest parent counts.

    Each round follows every chain twice as far and drops the blocks whose chain has ended; a document of n blocks needs log2(n) rounds."""
    rows = blocks.where("id is not null").groupBy("document_id", "id").agg(F.max("parent_id").alias("at")).where("at is not null")
    alive = materialize(rows, "parents")
    longest = alive.groupBy("document_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(longest).bit_length()):
        ahead = alive.select("document_id", F.col("id").alias("at"), F.col("at").alias("further"))
        further = materialize(alive.join(ahead, ["document_id", "at"]).select("document_id", "id", F.col("further").alias("at")), "parents")
        drop_materialized(alive)
        alive = further
        if not alive.limit(1).count():
            break
    return alive.select("document_id", "id")


def block_contract(documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """C04 ids, C05 parents, C10 exclusion, C11 boxes, C12 pages, C13 kinds, C16 empty texts."""
    at = F.coalesce("id", F.lit("?"))
    ids = blocks.select("document_id", F.col("id").alias("parent_id")).distinct()
    with_doc = blocks.join(documents.select("document_id", "page_count"), "document_id", "left")
    faulty = blocks.withColumn("fault", box_fault(F.col("bbox")))
    return union([
        issues("C04", blocks.where("id is null or id = ''"), at, "id missing", DOC),
        issues("C04", duplicate_keys(blocks.where("id <> ''"), [*DOC, "id"]), at, "id repeated", DOC),
        issues("C05", blocks.where("parent_id = id"), at, "own parent", DOC),
        issues("C05", blocks.where("parent_id is not null").join(ids, [*DOC, "parent_id"], "left_anti"), at, "parent unknown", DOC),
        issues("C05", looping_parents(blocks), F.col("id"), "parents loop", DOC),
        issues("C10", blocks.where(F.col("kind").isin(*EXCLUDED) & ~F.coalesce("excluded", F.lit(False))), at, "not excluded", DOC),
        issues("C11", faulty.where("fault is not null"), at, "box", DOC),
        issues("C12", with_doc.where("not coalesce(page between 1 and page_count, false)"), at, "page out of range", DOC),
        issues("C13", blocks.where(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))), at, "unknown kind", DOC),
        issues("C16", blocks.where(F.col("kind").isin("item", "para", "heading") & (F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s", "") == "")), at, "empty text", DOC),
    ])


def section_contract(blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """C06 section ids, C07 members and heads, C08 blocks of several sections, C09 page ranges."""
    at = F.coalesce("section_id", F.lit("?"))
    known = blocks.select("document_id", "id", "page")
    each = sections.select("document_id", "section_id", F.explode("block_ids").alias("id"))
    pages = each.join(known, [*DOC, "id"]).groupBy("document_id", "section_id").agg(F.min("page").cast("long").alias("lo"), F.max("page").cast("long").alias("hi"))
    ranged = sections.join(pages, [*DOC, "section_id"])
    first, last = F.get("page_range", F.lit(0)).cast("long"), F.get("page_range", F.lit(1)).cast("long")
    owned = blocks.where("section_id is not null")
    return union([
        issues("C06", duplicate_keys(sections, [*DOC, "section_id"]), at, "section repeated", DOC),
        issues("C06", owned.join(sections, [*DOC, "section_id"], "left_anti"), F.coalesce("id", F.lit("?")), "section unknown", DOC),
        issues("C07", each.join(known, [*DOC, "id"], "left_anti"), F.concat_ws("/", "section_id", "id"), "member unknown", DOC),
        issues("C07", sections.where(~F.coalesce(F.array_contains("block_ids", F.col("head_block_id")), F.lit(False))), at, "head is no member", DOC),
        issues("C08", duplicate_keys(each, [*DOC, "id"]), F.col("id"), "member of several sections", DOC),
        issues("C09", ranged.where(~(first.eqNullSafe(F.col("lo")) & last.eqNullSafe(F.col("hi")))), at, "page range", DOC),
    ])


def text_contract(blocks: DataFrame) -> DataFrame:
    """P02 and P05 letters that the source lacks, P03 line breaks, P07 control characters, P08 bullets within a block."""
    at = F.coalesce("id", F.lit("?"))
    sourced = blocks.where("source_text is not null")
    later = F.slice(F.split("source_text", "\n"), F.lit(2), F.size(F.split("source_text", "\n")))
    bullet = F.exists(later, lambda x: F.rlike(x, F.lit(rf"^(?U)\s*[{BULLETS}]")))
    return union([
        issues("P02", sourced.where(F.col("text").isNotNull() & ~is_subsequence(F.col("text"), F.col("source_text"))), at, "letters not in the source", DOC),
        issues("P03", sourced.where(F.col("text").contains("\n") & ~F.col("kind").isin(*LINED)), at, "line break", DOC),
        issues("P05", sourced.where((F.col("marker") != "") & ~is_subsequence(F.col("marker"), F.col("source_text"))), at, "marker not in the source", DOC),
        issues("P07", blocks.where(F.rlike("text", F.lit(CONTROL))), at, "control character", DOC),
        issues("P08", sourced.where(F.col("kind").isin(*FLOW) & bullet), at, "bullet within a block", DOC),
    ])


def order_contract(blocks: DataFrame) -> DataFrame:
    """P06: of two flowing blocks that follow each other on one row of a page, the right one comes first."""
    w = Window.partitionBy("document_id").orderBy("seq")
    after = blocks.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in ("page", "kind", "bbox")])
    here, there = (lambda i: F.get("bbox", F.lit(i))), (lambda i: F.get("next_bbox", F.lit(i)))
    level = (F.abs(here(1) - there(1)) < 1) & (F.abs(here(3) - there(3)) < 2) & (there(2) <= here(0) + 1)
    flows = (F.col("page") == F.col("next_page")) & F.col("kind").isin(*FLOW) & F.col("next_kind").isin(*FLOW)
    return issues("P06", after.where(flows & level), F.coalesce("id", F.lit("?")), "right block first", DOC)


def stable_view(rows: DataFrame, volatile: tuple[str, ...] = ("created_at", "elapsed_ms", "path", "parser_stats")) -> DataFrame:
    """Rows without what differs between two runs over the same input."""
    return rows.drop(*volatile)


def reference_contract(children: dict[str, tuple[DataFrame, str]], parents: DataFrame, key: str) -> DataFrame:
    """Rows of any table whose named reference has no parent: (name, value, n), counted for each value."""
    known = parents.select(F.col(key).cast("string").alias("value")).distinct()
    each = [rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).join(known, "value", "left_anti").select(F.lit(name).alias("name"), "value", "n") for name, (rows, c) in children.items()]
    return union(each)
