"""What makes a heading: hints from tables, heads of sections, their titles; and the fields of approval forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclattice.functions import text as T

# Words that name a section, nominal endings of a sentence, and how long heads, labels and values may be.
SECTION_WORD = r"(?:개요|배경|목적|계획|현황|내용|결과|일정|방법|방향|예산|대상|절차|범위|필요성|문제점|성과|경과)$"
SENTENCE_END = r"(함|음|임|됨|짐|옴|바람|할것|하였음|이다|한다|합니다)$"
PREDICATE_END = r"(?:합니다|됩니다|입니다|한다|이다|바랍니다)[.!?。]?$"
NOTE = r"[(（][^)）]*[)）]"
HEAD_CHARS, VALUE_CHARS = 20, 40
STACKED = ("heading", "item", "attachment")


def compact(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", "")


def heading_hint(rows: Column, larger_than_body: Column) -> Column:
    """(status, level, marker, text, evidence) of a table that may be a heading: a number and a title in its only two filled cells. It is confirmed by a
    roman number with large type or a section's word, or by both of these; otherwise it needs review. Null for other tables."""
    found = T.heading_from_grid(rows)
    roman = F.rlike(found["marker"], F.lit("^[Ⅰ-Ⅹ]"))
    label = compact(found["text"])
    named = F.rlike(label, F.lit(SECTION_WORD)) & ~F.rlike(label, F.lit(SENTENCE_END))
    sure = (roman & (larger_than_body | named)) | (named & larger_than_body)
    evidence = F.filter(F.array(F.when(named, "section_label"), F.when(roman, "roman_marker"), F.when(larger_than_body, "larger_than_body")), lambda x: x.isNotNull())
    hint = F.struct(F.when(sure, "confirmed").otherwise("needs_review").alias("status"), F.when(roman, 1).otherwise(2).alias("level"), found["marker"].alias("marker"), found["text"].alias("text"), evidence.alias("evidence"))
    return F.when(found.isNotNull(), hint)


def is_heading(kind: Column, hint: Column) -> Column:
    return (kind == "heading") | ((kind == "table") & F.coalesce(hint["status"] == "confirmed", F.lit(False)))


def head_text(kind: Column, text: Column, hint: Column) -> Column:
    return F.when(is_heading(kind, hint) & hint.isNotNull(), hint["text"]).otherwise(text)


def looks_like_head(kind: Column, level: Column, marker_type: Column, text: Column) -> Column:
    """An attachment; or 1 to 20 characters with a letter among them that don't end as a sentence. Roman heads are measured without notes in parentheses."""
    bare = compact(F.when((level == 1) & marker_type.eqNullSafe(F.lit("roman")), F.regexp_replace(text, NOTE, "")).otherwise(text))
    short = F.rlike(bare, F.lit("[가-힣A-Za-z]")) & (F.length(bare) <= HEAD_CHARS) & (F.endswith(bare, F.lit("붙임")) | ~F.rlike(bare, F.lit(SENTENCE_END)))
    return (kind == "attachment") | F.coalesce(short, F.lit(False))


def head_candidates(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """Blocks (id, parent_id, kind, level, marker_type, text) that may head a section: they have a level and children, and look like heads."""
    parents = blocks.where("parent_id is not null").select(*doc, F.col("parent_id").alias("id")).distinct()
    stacked = F.col("kind").isin(*STACKED) | F.coalesce(F.col("kind") == "table", F.lit(False))
    fit = blocks.where(stacked & (F.coalesce("level", F.lit(0)) > 0) & looks_like_head(F.col("kind"), F.col("level"), F.col("marker_type"), F.col("text")))
    return fit.join(parents, [*doc, "id"], "left_semi")


def head_titles(heads: DataFrame, blocks: DataFrame, doc: list[str]) -> DataFrame:
    """title of each head: its text; a bare attachment takes the largest (then the first) of its first three children, of those on its page that have text."""
    child = blocks.select(*doc, F.col("parent_id").alias("id"), F.col("seq").alias("c_seq"), F.col("page").alias("c_page"), F.col("text").alias("c_text"), F.col("size").alias("c_size"))
    below = F.slice(F.array_sort(F.collect_list(F.struct("c_seq", "c_page", "c_text", "c_size"))), 1, 3)
    first = child.where("id is not null").groupBy(*doc, "id").agg(below.alias("below"))
    named = heads.join(first, [*doc, "id"], "left")
    fit = F.filter(F.coalesce("below", F.array()), lambda c: (c["c_page"] == F.col("page")) & (c["c_text"] != ""))
    best = F.get(F.array_sort(F.transform(fit, lambda c: F.struct((-c["c_size"]).alias("size"), c["c_seq"].alias("seq"), c["c_text"].alias("text")))), F.lit(0))["text"]
    return named.withColumn("title", F.when((F.col("text") != "") | (F.col("kind") != "attachment"), F.col("text")).otherwise(F.coalesce(best, F.lit("")))).drop("below")


def approval_label(text: Column) -> Column:
    """A field's name: 2 to 10 letters, no sentence, no marker, no section's word."""
    bare = compact(text)
    return F.rlike(bare, F.lit("^[가-힣A-Za-z·/]{2,10}$")) & ~F.rlike(bare, F.lit(SENTENCE_END)) & ~T.starts_block(text) & ~F.rlike(bare, F.lit("(?:개요|계획|배경|목적|내용|결과)$"))


def approval_value(text: Column) -> Column:
    bare = compact(text)
    return (F.length(bare) <= VALUE_CHARS) & ~F.rlike(bare, F.lit(SENTENCE_END)) & ~T.starts_block(text) & ~F.rlike(bare, F.lit(PREDICATE_END))


def approval_hits(text: Column) -> Column:
    """How many different names of an approval form's fields a text has."""
    return F.size(F.array_distinct(F.regexp_extract_all(compact(text), F.lit(T.APPROVAL_FIELD), F.lit(0))))


def chapter_number_box(rows: Column, box: Column, outside: Column) -> Column:
    """A table whose only filled cell is a roman number, and a short title (of the lines outside: text, x0, y0, y1, size) to its right on its row."""
    cells = F.filter(F.transform(F.flatten(rows), lambda c: F.trim(F.coalesce(c, F.lit("")))), lambda c: c != "")
    height = lambda o: F.least(box[3] - box[1], o["y1"] - o["y0"])
    beside = lambda o: (height(o) > 0) & ((F.least(box[3], o["y1"]) - F.greatest(box[1], o["y0"])) / height(o) > 0.5)
    title = F.exists(outside, lambda o: beside(o) & (o["x0"] - box[2]).between(F.lit(0.0), o["size"] * 4) & (F.length(o["text"]) <= 30) & F.rlike(o["text"], F.lit("[가-힣A-Za-z]")))
    return (F.size(cells) == 1) & F.rlike(F.get(cells, F.lit(0)), F.lit(r"^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]\.?$")) & title


def title_copies(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """Paragraphs beside a document's title, within 2 points of its ends, all of whose characters the title has: shadows and outlines of it."""
    letters = lambda c: F.array_distinct(F.regexp_extract_all(compact(F.col(c)), F.lit("(?s)."), F.lit(0)))
    title = blocks.where("kind = 'document_title'").select(*doc, "page", letters("text").alias("t"), *[F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")])
    other = blocks.where("kind = 'para'").withColumn("own", letters("text")).join(title, [*doc, "page"])
    least = F.least(F.col("y1") - F.col("y0"), F.col("t_y1") - F.col("t_y0"))
    beside = (least > 0) & ((F.least("y1", "t_y1") - F.greatest("y0", "t_y0")) / least > 0.5)
    fit = (F.size("own") > 0) & (F.size(F.array_except("own", "t")) == 0) & beside & (F.col("t_x0") - 2 <= F.col("x0")) & (F.col("x1") <= F.col("t_x1") + 2)
    return other.where(fit).select(*blocks.columns)
