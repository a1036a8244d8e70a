"""Registered queries of boxes, checks, heads and units, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.functions import boxes, checks
from doclattice.operators import heads, pilot, snapshots, tables, tree
from doclattice.plans.queries import BOXED, LEVELED, PARENTS, doc_lines, docs, query
from doclattice.sources.readers import boxed, leveled, table


@query("url_checks", r"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^https://[^/?#@]+:(\d*)(?:[/?#]|$)', 1) AS port, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host FROM pages) SELECT page_id, coalesce(regexp_matches(url, '^https://[^/?#@:\s]+(:\d*)?([/?][^#]*)?$') AND port IN ('', '443'), false) AS https_source, coalesce(regexp_matches(host, '^([a-z0-9]([a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$'), false) AS exact_host, coalesce(trim(url, ' ') <> '', false) AS filled, coalesce(NOT starts_with(url, '/') AND ends_with(url, '/'), false) AS key_prefix FROM p""")
def url_checks(s: SparkSession, d: str) -> DataFrame:
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1)
    url = F.col("url")
    return table(s, d, "pages").select("page_id", checks.https_source(url).alias("https_source"), checks.exact_host(host).alias("exact_host"), checks.filled(url).alias("filled"), F.coalesce(checks.key_prefix(url), F.lit(False)).alias("key_prefix"))


@query("page_bounds", f"WITH {BOXED}, b AS (SELECT doc_id, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n FROM boxed GROUP BY doc_id, page) SELECT doc_id, page, x0, y0, x1, y1, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, n FROM b")
def page_bounds(s: SparkSession, d: str) -> DataFrame:
    rows = boxed(doc_lines(s, d)).groupBy("doc_id", "page").agg(boxes.bounds().alias("b"), F.count("*").alias("n")).withColumn("c", boxes.center(F.col("b")))
    return rows.select("doc_id", "page", *[F.col("b")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))], F.col("c")[0].alias("cx"), F.col("c")[1].alias("cy"), "n")


@query("head_candidates", f"WITH {PARENTS}, k AS (SELECT *, CASE WHEN level IN (1, 2) THEN 'heading' WHEN level = 6 THEN 'attachment' WHEN level IS NULL THEN 'para' ELSE 'item' END AS kind, regexp_replace(text, '\\s+', '', 'g') AS bare FROM parents) SELECT doc_id, line_no, kind FROM k WHERE kind <> 'para' AND line_no IN (SELECT p.parent FROM parents p WHERE p.doc_id = k.doc_id AND p.parent IS NOT NULL) AND (kind = 'attachment' OR (regexp_matches(bare, '[가-힣A-Za-z]') AND length(bare) <= 20))")
def head_candidates(s: SparkSession, d: str) -> DataFrame:
    rows = tree.with_parent(leveled(doc_lines(s, d)))
    kind = F.when(F.col("level").isin(1, 2), "heading").when(F.col("level") == 6, "attachment").when(F.col("level").isNull(), "para").otherwise("item")
    blocks = rows.select("doc_id", F.col("line_no").alias("id"), F.col("parent").alias("parent_id"), kind.alias("kind"), "level", F.lit("number").alias("marker_type"), "text")
    return heads.head_candidates(blocks, ["doc_id"]).select("doc_id", F.col("id").alias("line_no"), "kind")


@query("section_units", "WITH c AS (SELECT conv_id, role AS section_id, CASE turn % 3 WHEN 0 THEN 'target' WHEN 1 THEN 'table' ELSE 'excluded' END AS class, CASE WHEN turn % 2 = 0 THEN 'heading' ELSE 'para' END AS kind, length(text) % 5 AS n_rows FROM conversations) SELECT conv_id, section_id, sum(CASE WHEN class = 'table' THEN n_rows ELSE 1 END)::BIGINT AS units, sum(CASE WHEN class = 'table' THEN n_rows ELSE 0 END)::BIGINT AS table_rows, count(*) FILTER (kind = 'heading') AS headings FROM c WHERE class <> 'excluded' AND section_id IS NOT NULL GROUP BY ALL")
def section_units(s: SparkSession, d: str) -> DataFrame:
    t = F.col("turn")
    rows = table(s, d, "conversations").select(
        "conv_id", F.col("role").alias("section_id"), F.when(t % 3 == 0, "target").when(t % 3 == 1, "table").otherwise("excluded").alias("class"), F.when(t % 2 == 0, "heading").otherwise("para").alias("kind"), (F.length("text") % 5).alias("n_rows")
    )
    return pilot.units_by_section(rows, ["conv_id"])


@query("unbound_labels", "SELECT l.doc_id::VARCHAR AS document_id, l.doc_id::VARCHAR AS block_id FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR d.lang IS DISTINCT FROM 'en'")
def unbound_labels(s: SparkSession, d: str) -> DataFrame:
    """Labels that claim English text, against the documents as they are."""
    key = F.col("doc_id").cast("string")
    labels = table(s, d, "labels").select(key.alias("document_id"), key.alias("block_id"), F.lit("en").alias("lang"))
    sources = docs(s, d).select(key.alias("document_id"), key.alias("block_id"), "lang")
    return snapshots.unbound(labels, sources).select("document_id", "block_id")


@query("column_positions", f"WITH RECURSIVE {LEVELED}, x AS (SELECT DISTINCT doc_id, (length(text) % 97)::DOUBLE AS x FROM leveled), o AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY x) AS n FROM x), r AS (SELECT doc_id, n, x AS kept, true AS taken FROM o WHERE n = 1 UNION ALL SELECT o.doc_id, o.n, CASE WHEN o.x - r.kept > 2 THEN o.x ELSE r.kept END, o.x - r.kept > 2 FROM r JOIN o ON o.doc_id = r.doc_id AND o.n = r.n + 1) SELECT doc_id, count(*) FILTER (taken) AS n_columns, max(kept) AS last FROM r GROUP BY doc_id")
def column_positions(s: SparkSession, d: str) -> DataFrame:
    rows = doc_lines(s, d).groupBy("doc_id").agg(F.collect_set((F.length("text") % 97).cast("double")).alias("xs")).withColumn("kept", tables.column_positions(F.col("xs")))
    return rows.select("doc_id", F.size("kept").alias("n_columns"), F.element_at("kept", -1).alias("last"))
