"""Registered queries of the document operators, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclattice.functions import text as T
from doclattice.operators import agreement, drawings, grid, labeling, layout, page, requests, rules, summary, targets, tree, validate
from doclattice.operators import lines as L
from doclattice.sources.readers import boxed, leveled, lines, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

LINES = "lines AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10)))))::BIGINT AS line_no, unnest(string_split(text, chr(10))) AS text FROM documents)"
LEVELED = f"{LINES}, leveled AS (SELECT *, CASE WHEN (doc_id * 7 + line_no * 13) % 9 < 6 THEN (doc_id * 7 + line_no * 13) % 9 + 1 END AS level FROM lines)"
BOXED = f"{LINES}, boxed AS (SELECT *, 50.0::DOUBLE AS x0, (line_no * 12)::DOUBLE AS y0, 50.0::DOUBLE + 5 * length(text) AS x1, (line_no * 12 + 10)::DOUBLE AS y1, line_no // 40 + 1 AS page FROM lines)"
# The latest earlier block of each level, as in the window recipe: level k's last sequence number.
LASTS = ", ".join(f"last_value(CASE WHEN level = {k} THEN line_no END IGNORE NULLS) OVER w AS l{k}" for k in range(1, 7))
PARENTS = f"{LEVELED}, lasts AS (SELECT *, {LASTS} FROM leveled WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), parents AS (SELECT doc_id, line_no, level, text, greatest({', '.join(f'CASE WHEN level IS NULL OR level > {k} THEN l{k} END' for k in range(1, 7))}) AS parent, l1, l2 FROM lasts)"
PIPES = f"{LINES}, piped AS (SELECT doc_id, line_no, string_split(text, '|') AS parts FROM lines WHERE contains(text, '|')), cells AS (SELECT doc_id, line_no, unnest(range(len(parts)))::BIGINT AS col, trim(unnest(parts), ' ') AS cell FROM piped)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; whole numbers come as long on both sides."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(spark, sf_dir)
            return out.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in out.dtypes])

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


def doc_lines(s: SparkSession, d: str) -> DataFrame:
    return lines(docs(s, d))


TEMPLATES = f"{LINES}, t AS (SELECT doc_id, regexp_replace(text, '\\d+', '#', 'g') AS template FROM lines WHERE trim(text, ' ') <> ''), running AS (SELECT template, count(DISTINCT doc_id) AS n_pages, count(*) AS n_lines FROM t GROUP BY template HAVING count(DISTINCT doc_id) >= 5)"


@query("running_lines", f"WITH {TEMPLATES} SELECT template, n_pages, n_lines FROM running")
def running_lines(s: SparkSession, d: str) -> DataFrame:
    return L.running_templates(doc_lines(s, d), [], "doc_id", F.lit(5))


@query("body_after_running", f"WITH {TEMPLATES} SELECT doc_id, count(*) AS n_body, sum(length(text))::BIGINT AS body_chars FROM lines WHERE regexp_replace(text, '\\d+', '#', 'g') NOT IN (SELECT template FROM running) GROUP BY doc_id")
def body_after_running(s: SparkSession, d: str) -> DataFrame:
    running = L.running_templates(doc_lines(s, d), [], "doc_id", F.lit(5)).select("template")
    body = doc_lines(s, d).withColumn("template", T.digit_template(F.col("text"))).join(running, "template", "left_anti")
    return body.groupBy("doc_id").agg(F.count("*").alias("n_body"), F.sum(F.length("text")).alias("body_chars"))


@query("running_lines_band", f"WITH {BOXED}, h AS (SELECT doc_id, page, max(y1) AS height, min(y0) AS top FROM boxed GROUP BY doc_id, page), e AS (SELECT b.doc_id, b.page, CASE WHEN y1 - top <= 0.1 * (height - top) THEN 'header' WHEN y0 - top >= 0.9 * (height - top) THEN 'footer' END AS edge, count(*) AS n FROM boxed b JOIN h ON b.doc_id = h.doc_id AND b.page = h.page GROUP BY ALL) SELECT edge, count(*) AS n_pages, sum(n)::BIGINT AS n_lines FROM e GROUP BY edge")
def running_lines_band(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("doc_id", "page")
    rows = boxed(doc_lines(s, d)).withColumn("height", F.max("y1").over(w)).withColumn("top", F.min("y0").over(w))
    edge = L.edge_position(F.col("y0") - F.col("top"), F.col("y1") - F.col("top"), F.col("height") - F.col("top"))
    return rows.groupBy("doc_id", "page", edge.alias("edge")).agg(F.count("*").alias("n")).groupBy("edge").agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_lines"))


@query("line_projection", f"WITH {LINES} SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN contains(text, '|') THEN len(string_split(text, '|')) ELSE 1 END)::BIGINT AS n_units, max(length(text))::BIGINT AS longest FROM lines GROUP BY doc_id")
def line_projection(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.contains("text", F.lit("|")), "table").otherwise("para")
    units = targets.unit_count(kind, F.size(F.split("text", r"\|")))
    return doc_lines(s, d).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(units).alias("n_units"), F.max(F.length("text")).alias("longest"))


@query("normalize_space", "SELECT page_id, regexp_replace(regexp_replace(replace(html, '<', '  <'), '\\s{2,}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS text FROM pages")
def normalize_space(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", T.normalize_space(F.replace("html", F.lit("<"), F.lit("  <"))).alias("text"))


@query("leading_digits_template", "SELECT regexp_replace(url, '\\d+', '#', 'g') AS template, count(*) AS n FROM pages GROUP BY 1")
def leading_digits_template(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").groupBy(T.digit_template(F.col("url")).alias("template")).agg(F.count("*").alias("n"))


@query("nfc_normalize", "SELECT doc_id, sha256(nfc_normalize(text)) AS sha FROM documents")
def nfc_normalize(s: SparkSession, d: str) -> DataFrame:
    return docs(s, d).select("doc_id", F.sha2(T.normalize(F.col("text")), 256).alias("sha"))


@query(
    "collapse_spaced",
    f"WITH {LINES}, spaced AS (SELECT 'url' AS kind, page_id AS id, 0 AS line_no, array_to_string(string_split(url, ''), ' ') AS text FROM pages WHERE url IS NOT NULL UNION ALL SELECT 'line', doc_id, line_no, text FROM lines), p AS (SELECT *, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS parts FROM spaced), c AS (SELECT *, len(parts) > 1 AND len(list_filter(parts, lambda x: length(x) <> 1)) = 0 AS collapsed FROM p) SELECT kind, id, line_no, sha256(CASE WHEN collapsed THEN array_to_string(parts, '') ELSE text END) AS sha, collapsed FROM c",
)
def collapse_spaced(s: SparkSession, d: str) -> DataFrame:
    urls = table(s, d, "pages").where("url is not null").select(F.lit("url").alias("kind"), F.col("page_id").alias("id"), F.lit(0).cast("long").alias("line_no"), F.array_join(F.regexp_extract_all("url", F.lit("(?s)."), F.lit(0)), " ").alias("text"))
    rows = urls.unionByName(doc_lines(s, d).select(F.lit("line").alias("kind"), F.col("doc_id").alias("id"), "line_no", "text"))
    return rows.select("kind", "id", "line_no", T.collapse_spaced(F.col("text")).alias("x")).select("kind", "id", "line_no", F.sha2("x.text", 256).alias("sha"), "x.collapsed")


LOCATE = "q AS (SELECT doc_id, text, substr(text, 11, 3) AS quote FROM documents), chars AS (SELECT doc_id, quote, unnest(string_split(text, '')) AS ch, unnest(range(length(text))) AS i FROM q), runs AS (SELECT doc_id, i, quote, ch, lead(ch) OVER w AS ch2, lead(ch, 2) OVER w AS ch3 FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)), hit AS (SELECT doc_id, count(*) AS n, min(i) AS first, max(i) AS last FROM runs WHERE quote = CASE length(quote) WHEN 1 THEN ch WHEN 2 THEN ch || ch2 WHEN 3 THEN ch || ch2 || ch3 END GROUP BY doc_id), hits AS (SELECT q.doc_id, quote, coalesce(n, 0) AS n, first, last FROM q LEFT JOIN hit ON hit.doc_id = q.doc_id)"


def quoted_docs(s: SparkSession, d: str) -> DataFrame:
    """All documents with a quote of up to three characters; that of a short text is empty."""
    return docs(s, d).select("doc_id", "text", F.substring("text", 11, 3).alias("quote"))


@query("locate_all_overlapping", f"WITH {LOCATE} SELECT doc_id, quote, n, first, last FROM hits")
def locate_all(s: SparkSession, d: str) -> DataFrame:
    rows = quoted_docs(s, d).withColumn("found", T.starts(F.col("text"), F.col("quote")))
    return rows.select("doc_id", "quote", F.size("found").alias("n"), F.get("found", F.lit(0)).alias("first"), F.try_element_at("found", F.lit(-1)).alias("last"))


@query("locate_unique", f"WITH {LOCATE} SELECT doc_id, CASE WHEN n = 1 THEN first END AS start, CASE WHEN n = 1 THEN first + length(quote) END AS \"end\", CASE WHEN quote IS NULL OR quote = '' THEN 'empty_quote' WHEN n > 1 THEN 'ambiguous' END AS reason FROM hits")
def locate_unique(s: SparkSession, d: str) -> DataFrame:
    return quoted_docs(s, d).select("doc_id", T.locate(F.col("text"), F.col("quote"), F.lit(None).cast("int")).alias("x")).select("doc_id", "x.*")


SIZED = f"{LINES}, sized AS (SELECT *, 8 + ((doc_id + line_no) % 5) * 1.5 AS size FROM lines)"


def sized(s: SparkSession, d: str) -> DataFrame:
    return doc_lines(s, d).withColumn("size", (8 + ((F.col("doc_id") + F.col("line_no")) % 5) * 1.5).cast("double"))


@query("weighted_mode_size", f"WITH {SIZED}, w AS (SELECT doc_id, size, sum(length(regexp_replace(text, '\\s', '', 'g'))) AS w, min(line_no) AS seq FROM sized GROUP BY ALL) SELECT doc_id, size::DOUBLE AS body_size FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, seq) = 1")
def weighted_mode_size(s: SparkSession, d: str) -> DataFrame:
    return L.body_size(sized(s, d), ["doc_id"])


@query("median_title_top1", f"WITH {SIZED}, m AS (SELECT doc_id, median(size) AS median FROM sized GROUP BY doc_id) SELECT s.doc_id, line_no AS seq, text AS title FROM sized s JOIN m ON s.doc_id = m.doc_id WHERE size >= 1.2 * median AND length(text) BETWEEN 5 AND 100 QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY size DESC, length(text) DESC, line_no) = 1")
def median_title_top1(s: SparkSession, d: str) -> DataFrame:
    return L.title_line(sized(s, d), ["doc_id"])


HTML = {"h1": "heading", "p": "para", "li": "item", "nav": "figure", "footer": "footer"}


@query("block_kind_html", "WITH t AS (SELECT page_id, unnest(['h1', 'p', 'li', 'nav', 'footer']) AS tag, unnest(['heading', 'para', 'item', 'figure', 'footer']) AS kind, html FROM pages) SELECT page_id, kind, len(regexp_extract_all(html, '<' || tag || '[ >]'))::BIGINT AS n FROM t WHERE len(regexp_extract_all(html, '<' || tag || '[ >]')) > 0")
def block_kind_html(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", F.inline(summary.html_blocks(F.col("html"), HTML))).where("n > 0")


@query("kind_summary", "WITH t AS (SELECT page_id, unnest(['h1', 'p', 'li']) AS tag, unnest(['heading', 'para', 'item']) AS kind, html FROM pages), c AS (SELECT page_id, kind, len(regexp_extract_all(html, '<' || tag || '[ >]')) AS n FROM t) SELECT page_id, string_agg(kind || '=' || n, ' ' ORDER BY kind) AS summary FROM c GROUP BY page_id")
def kind_summary(s: SparkSession, d: str) -> DataFrame:
    shown = {t: k for t, k in HTML.items() if k in ("heading", "para", "item")}
    return table(s, d, "pages").select("page_id", summary.one_line(summary.html_blocks(F.col("html"), shown)).alias("summary"))


@query("block_class_gate", "WITH b AS (SELECT d.doc_id, CASE d.doc_id % 5 WHEN 0 THEN 'table' WHEN 1 THEN 'para' WHEN 2 THEN 'document_title' WHEN 3 THEN 'figure' ELSE 'item' END AS kind, coalesce(l.toxic, 0) = 1 AS excluded, d.doc_id % 7 = 0 AS annex, d.doc_id % 11 = 0 AS vision, d.doc_id % 3 AS n_rows, trim(d.text, ' ') = '' AS blank FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) SELECT doc_id, CASE WHEN excluded THEN 'excluded' WHEN kind = 'table' THEN CASE WHEN annex THEN 'not_targeted' WHEN vision OR n_rows = 0 OR doc_id % 13 = 0 THEN 'unreadable' ELSE 'table' END WHEN kind IN ('para', 'item') THEN CASE WHEN blank THEN 'context' ELSE 'target' END WHEN kind = 'document_title' THEN 'context' ELSE 'excluded' END AS class, CASE WHEN excluded THEN NULL WHEN kind = 'table' THEN CASE WHEN annex THEN 'annex_table' WHEN vision THEN 'requires_vision' WHEN n_rows = 0 THEN 'no_rows' WHEN doc_id % 13 = 0 THEN 'table_structure_warning:table_geometry_ambiguous,table_grid_sparse' END WHEN kind IN ('para', 'item') AND blank THEN 'empty_text' END AS reason FROM b")
def block_class_gate(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    kind = F.when(i % 5 == 0, "table").when(i % 5 == 1, "para").when(i % 5 == 2, "document_title").when(i % 5 == 3, "figure").otherwise("item")
    codes = F.when(i % 13 == 0, F.array_sort(F.array(F.lit("table_grid_sparse"), F.lit("table_geometry_ambiguous"))))
    rows = docs(s, d).join(table(s, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    said = targets.block_class(kind, F.coalesce("toxic", F.lit(0)) == 1, i % 7 == 0, i % 11 == 0, i % 3, codes, F.trim("text") == "")
    return rows.select("doc_id", said.alias("x")).select("doc_id", "x.*")


@query("hierarchy_parent", f"WITH {PARENTS} SELECT doc_id, line_no, level, parent FROM parents")
def hierarchy_parent(s: SparkSession, d: str) -> DataFrame:
    return tree.with_parent(leveled(doc_lines(s, d))).select("doc_id", "line_no", "level", "parent")


@query("section_path", f"WITH {PARENTS} SELECT doc_id, line_no, concat_ws('/', l1::VARCHAR, CASE WHEN l2 > coalesce(l1, -1) THEN l2 END::VARCHAR) AS path FROM parents")
def section_path(s: SparkSession, d: str) -> DataFrame:
    rows = tree.with_section_path(leveled(doc_lines(s, d)))
    return rows.select("doc_id", "line_no", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


@query("section_page_range", f"WITH {BOXED}, h AS (SELECT *, last_value(CASE WHEN (doc_id * 7 + line_no * 13) % 9 IN (0, 1) THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM boxed) SELECT doc_id, section, count(*) AS n_blocks, min(page) AS first_page, max(page) AS last_page FROM h WHERE section IS NOT NULL GROUP BY doc_id, section")
def section_page_range(s: SparkSession, d: str) -> DataFrame:
    rows = leveled(boxed(doc_lines(s, d)))
    return tree.section_table(tree.roots(rows, F.col("level").isin(1, 2)))


@query("ancestor_closure", f"WITH RECURSIVE {PARENTS}, up AS (SELECT doc_id, line_no AS node, parent AS ancestor, 1 AS depth FROM parents WHERE parent IS NOT NULL UNION ALL SELECT u.doc_id, u.node, p.parent, u.depth + 1 FROM up u JOIN parents p ON p.doc_id = u.doc_id AND p.line_no = u.ancestor WHERE p.parent IS NOT NULL AND u.depth < 16) SELECT doc_id, node, ancestor, depth::BIGINT AS depth FROM up")
def ancestor_closure(s: SparkSession, d: str) -> DataFrame:
    return tree.ancestors(tree.with_parent(leveled(doc_lines(s, d))))


LEXICON = [("the", "SEC_OVERVIEW", 0), ("The", "SEC_OVERVIEW", 1), ("Ther", "SEC_RESULT", 2), ("Der", "SEC_STATUS", 3), ("Die", "SEC_STATUS", 4), ("Les", "SEC_PLAN", 5), ("And", "SEC_GROUNDS", 6), ("Ere", "SEC_EFFECT", 7), ("Thand", "SEC_PROBLEM", 8)]
HEADINGS = f"{LINES}, lex AS (SELECT * FROM (VALUES {', '.join(str(x) for x in LEXICON)}) v(word, tag, seq)), heads AS (SELECT doc_id, line_no, regexp_replace(text, '\\s', '', 'g') AS heading FROM lines)"


def headings(s: SparkSession, d: str) -> DataFrame:
    return doc_lines(s, d).select("doc_id", "line_no", F.regexp_replace("text", r"\s", "").alias("heading"))


@query("tag_longest_prefix", f"WITH {HEADINGS} SELECT h.doc_id, h.line_no, coalesce((SELECT tag FROM lex WHERE starts_with(h.heading, word) ORDER BY length(word) DESC, seq LIMIT 1), 'SEC_UNKNOWN') AS tag FROM heads h")
def tag_longest_prefix(s: SparkSession, d: str) -> DataFrame:
    return tree.tag_headings(headings(s, d), s.createDataFrame(LEXICON, "word string, tag string, seq int")).select("doc_id", "line_no", "tag")


@query("pipe_cells", f"WITH {PIPES} SELECT doc_id, line_no, col, cell FROM cells")
def pipe_cells(s: SparkSession, d: str) -> DataFrame:
    return grid.pipe_cells(doc_lines(s, d), ["doc_id", "line_no"])


GRIDS = f"{PIPES}, r AS (SELECT doc_id, line_no, list(CASE WHEN (doc_id + col) % 3 = 0 THEN '' ELSE cell END ORDER BY col) AS row FROM cells GROUP BY doc_id, line_no), g AS (SELECT doc_id, list(row ORDER BY line_no) AS rows, max(len(row)) AS width FROM r GROUP BY doc_id)"


def pipe_grids(s: SparkSession, d: str) -> DataFrame:
    cell = F.when((F.col("doc_id") + F.col("col")) % 3 == 0, "").otherwise(F.col("cell"))
    row = grid.pipe_cells(doc_lines(s, d), ["doc_id", "line_no"]).groupBy("doc_id", "line_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", cell.alias("cell")))), lambda x: x["cell"]).alias("row"))
    return row.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "row"))), lambda x: x["row"]).alias("rows"))


@query("prune_grid", f"WITH {GRIDS}, kept AS (SELECT doc_id, list_filter(rows, lambda r: len(list_filter(r, lambda c: c <> '')) > 0) AS rows, list_filter(range(1, width + 1), lambda j: len(list_filter(rows, lambda r: coalesce(r[j], '') <> '')) > 0) AS cols FROM g) SELECT doc_id, len(rows)::BIGINT AS n_rows, len(cols)::BIGINT AS n_cols, array_to_string(list_transform(rows, lambda r: array_to_string(list_transform(cols, lambda j: coalesce(r[j], '')), ' | ')), chr(10)) AS table_text FROM kept")
def prune_grid(s: SparkSession, d: str) -> DataFrame:
    rows = pipe_grids(s, d).withColumn("kept", grid.prune(F.col("rows")))
    return rows.select("doc_id", F.size("kept").alias("n_rows"), F.coalesce(F.size(F.get("kept", 0)), F.lit(0)).alias("n_cols"), T.block_text(F.col("kept")).alias("table_text"))


@query("markdown_table", f"WITH {GRIDS}, f AS (SELECT doc_id, width, list_transform(rows, lambda r: '| ' || array_to_string(list_concat(r, list_transform(range(0, width - len(r)), lambda i: '')), ' | ') || ' |') AS drawn FROM g) SELECT doc_id, array_to_string(list_concat(drawn[1:1], ['|' || repeat(' --- |', width::INT)], drawn[2:]), chr(10)) AS markdown FROM f")
def markdown_table(s: SparkSession, d: str) -> DataFrame:
    return pipe_grids(s, d).select("doc_id", T.markdown_table(F.col("rows")).alias("markdown"))


SPANS = f"{PIPES}, spans AS (SELECT doc_id, line_no AS row, col, CASE WHEN (doc_id + line_no + col) % 4 = 0 THEN 2 ELSE 1 END AS colspan, 1 AS rowspan, cell, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, col) AS seq, max(col) OVER (PARTITION BY doc_id, line_no) + 1 AS n_cols FROM cells)"


def spanned(s: SparkSession, d: str) -> DataFrame:
    cells = grid.pipe_cells(doc_lines(s, d), ["doc_id", "line_no"])
    span = F.when((F.col("doc_id") + F.col("line_no") + F.col("col")) % 4 == 0, 2).otherwise(1)
    return cells.select(
        "doc_id", F.col("line_no").alias("row"), F.col("col").cast("long").alias("col"), span.alias("colspan"), F.lit(1).alias("rowspan"), "cell",
        F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "col")).alias("seq"), (F.max("col").over(Window.partitionBy("doc_id", "line_no")) + 1).alias("n_cols"),
    )


@query("merged_fill", f"WITH {SPANS}, slots AS (SELECT doc_id, row, unnest(range(col, col + colspan)) AS c, col AS o_col, seq FROM spans), origin AS (SELECT doc_id, row, c, o_col FROM slots QUALIFY row_number() OVER (PARTITION BY doc_id, row, c ORDER BY seq DESC) = 1), texts AS (SELECT doc_id, row, col, CASE WHEN col % 2 = 1 THEN '' ELSE cell END AS text FROM spans) SELECT t.doc_id, t.row, t.col, CASE WHEN t.text = '' AND o.o_col <> t.col THEN coalesce(x.text, '') ELSE t.text END AS text, CASE WHEN t.text = '' AND o.o_col <> t.col THEN o.o_col END AS from_col FROM texts t LEFT JOIN origin o ON o.doc_id = t.doc_id AND o.row = t.row AND o.c = t.col LEFT JOIN texts x ON x.doc_id = t.doc_id AND x.row = t.row AND x.col = o.o_col")
def merged_fill(s: SparkSession, d: str) -> DataFrame:
    cells = spanned(s, d)
    texts = cells.select("doc_id", "row", "col", F.when(F.col("col") % 2 == 1, "").otherwise(F.col("cell")).alias("text"))
    return grid.filled(cells, texts, ["doc_id"]).select("doc_id", "row", "col", "text", "from_col")


@query("cell_overlap_violations", f"WITH {SPANS}, slots AS (SELECT doc_id, row, unnest(range(col, col + colspan)) AS c FROM spans) SELECT doc_id, row, col, 'bounds' AS fault FROM spans WHERE col + colspan > n_cols UNION ALL SELECT doc_id, row, c AS col, 'overlap' AS fault FROM slots GROUP BY doc_id, row, c HAVING count(*) > 1")
def cell_overlap_violations(s: SparkSession, d: str) -> DataFrame:
    return grid.cell_faults(spanned(s, d).withColumn("n_rows", F.lit(1 << 40)), ["doc_id"])


@query("word_cell_assign", f"WITH {BOXED}, cells AS (SELECT doc_id, page, line_no AS cell, x0 - 5 AS x0, y0 - 3 AS y0, x1 + 5 AS x1, y1 + 9 AS y1 FROM boxed WHERE line_no % 3 = 0), m AS (SELECT w.doc_id, w.page, w.line_no AS word, c.cell, round(greatest(least(w.x1, c.x1) - greatest(w.x0, c.x0), 0) * greatest(least(w.y1, c.y1) - greatest(w.y0, c.y0), 0) / nullif(least((w.x1 - w.x0) * (w.y1 - w.y0), (c.x1 - c.x0) * (c.y1 - c.y0)), 0), 9) AS share FROM boxed w JOIN cells c ON w.doc_id = c.doc_id AND w.page = c.page AND (w.x0 + w.x1) / 2 BETWEEN c.x0 AND c.x1 AND (w.y0 + w.y1) / 2 BETWEEN c.y0 AND c.y1) SELECT doc_id, page, word, cell FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, page, word ORDER BY coalesce(share, 0) DESC, cell) = 1")
def word_cell_assign(s: SparkSession, d: str) -> DataFrame:
    rows = boxed(doc_lines(s, d))
    cells = rows.where("line_no % 3 = 0").select("doc_id", "page", F.col("line_no").alias("cell"), (F.col("x0") - 5).alias("x0"), (F.col("y0") - 3).alias("y0"), (F.col("x1") + 5).alias("x1"), (F.col("y1") + 9).alias("y1"))
    return L.assign_to_cells(rows.withColumnRenamed("line_no", "word"), cells, ["doc_id", "page"])


@query("nearest_node", f"WITH {BOXED}, n AS (SELECT doc_id, page, line_no, y0 FROM boxed WHERE (doc_id + line_no) % 7 = 0) SELECT b.doc_id, b.line_no, (SELECT n.line_no FROM n WHERE n.doc_id = b.doc_id AND n.page = b.page ORDER BY abs(n.y0 - b.y0), n.y0, n.line_no LIMIT 1) AS node FROM boxed b WHERE (doc_id + line_no) % 7 <> 0")
def nearest_node(s: SparkSession, d: str) -> DataFrame:
    rows = boxed(doc_lines(s, d))
    return L.nearest_in_order(rows, (F.col("doc_id") + F.col("line_no")) % 7 == 0, ["doc_id", "page"], "y0", "line_no").select("doc_id", "line_no", "node")


TURNS = "turns AS (SELECT conv_id, turn, role, text, CASE WHEN turn % 8 = 5 THEN NULL ELSE (turn // 3) * 10 + (turn % 2) * (conv_id % 2) END AS section, 1 + (conv_id * 5 + turn * 3) % 17 AS units FROM conversations)"


def turns(s: SparkSession, d: str) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    section = F.when(t % 8 == 5, None).otherwise(F.floor(t / 3) * 10 + (t % 2) * (c % 2))
    return table(s, d, "conversations").select("conv_id", "turn", "role", "text", section.cast("long").alias("section"), (1 + (c * 5 + t * 3) % 17).cast("long").alias("units"))


ISLANDS = f"{TURNS}, i AS (SELECT *, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) OR section IS DISTINCT FROM lag(section) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS fresh FROM turns), isl AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS island FROM i)"


@query("islands_sections", f"WITH {ISLANDS} SELECT conv_id, island, count(*) AS n, sum(units)::BIGINT AS units FROM isl GROUP BY conv_id, island")
def islands_sections(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    same = F.col("section").eqNullSafe(F.lag("section").over(w)) & (F.row_number().over(w) > 1)
    return L.islands(turns(s, d), ["conv_id"], "turn", same).groupBy("conv_id", "island").agg(F.count("*").alias("n"), F.sum("units").alias("units"))


# Packing as a recursion over rows: a run that doesn't fit opens a chunk, and a run that is too large alone is cut and shares none.
OPENS = "CASE WHEN r.total > 40 THEN r.fresh = 1 OR f.load + r.units > 40 ELSE r.fresh = 1 AND (f.total > 40 OR f.load + r.total > 40) END"
CHUNKS = f"{ISLANDS}, runs AS (SELECT *, sum(units) OVER (PARTITION BY conv_id, island) AS total, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM isl), fold AS (SELECT conv_id, turn, n, total, 0::BIGINT AS chunk, units::BIGINT AS load FROM runs WHERE n = 1 UNION ALL SELECT r.conv_id, r.turn, r.n, r.total, CASE WHEN {OPENS} THEN f.chunk + 1 ELSE f.chunk END, (CASE WHEN {OPENS} THEN 0 ELSE f.load END + r.units)::BIGINT FROM fold f JOIN runs r ON r.conv_id = f.conv_id AND r.n = f.n + 1)"


@query("chunks_packed", f"WITH RECURSIVE {CHUNKS} SELECT conv_id, turn, chunk FROM fold")
def chunks_packed(s: SparkSession, d: str) -> DataFrame:
    return targets.pack(turns(s, d), ["conv_id"], "turn", "section", "units")


@query("context_neighbours", f"WITH RECURSIVE {CHUNKS} SELECT DISTINCT a.conv_id, a.chunk, b.turn FROM fold a JOIN fold b ON a.conv_id = b.conv_id AND abs(a.n - b.n) <= 3 AND a.chunk <> b.chunk")
def context_neighbours(s: SparkSession, d: str) -> DataFrame:
    return targets.neighbours(targets.pack(turns(s, d), ["conv_id"], "turn", "section", "units"), ["conv_id"], "turn")


@query("document_text_listagg", "SELECT conv_id, string_agg('[' || turn || '] ' || text, chr(10) ORDER BY turn) AS document_text FROM conversations GROUP BY conv_id")
def document_text_listagg(s: SparkSession, d: str) -> DataFrame:
    return targets.document_text(table(s, d, "conversations"), ["conv_id"], "turn", "turn")


@query("request_id_sha", "SELECT doc_id, sha256('{\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}') AS request_id FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def request_id_sha(s: SparkSession, d: str) -> DataFrame:
    payload = F.to_json(F.struct("source", "lang"))
    return docs(s, d).where("lang is not null and source is not null").select("doc_id", T.canonical_sha256(payload).alias("request_id"))


@query("merge_intervals", "WITH e AS (SELECT user_id, epoch(ts) AS a, epoch(ts) + value * 60 AS b FROM events WHERE value IS NOT NULL), r AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e), n AS (SELECT *, sum(CASE WHEN a - reach <= 300 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM r) SELECT user_id, island::BIGINT AS island, count(*) AS n, round(max(b) - min(a), 3) AS seconds FROM n GROUP BY user_id, island")
def merge_intervals(s: SparkSession, d: str) -> DataFrame:
    a = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    e = table(s, d, "events").where("value is not null").select("user_id", a.alias("a"), (a + F.col("value") * 60).alias("b"))
    return L.merge_intervals(e, ["user_id"], "a", "b", 300.0).select("user_id", "island", "n", F.round(F.col("end") - F.col("start"), 3).alias("seconds"))


@query("fk_missing_orders", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey IS NOT NULL)")
def fk_missing_orders(s: SparkSession, d: str) -> DataFrame:
    open_orders = table(s, d, "orders").where("o_orderstatus <> 'F'")
    return validate.missing_keys(table(s, d, "lineitem"), "l_orderkey", open_orders, "o_orderkey").select("l_orderkey", "l_linenumber")


@query("dup_ids", "SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def dup_ids(s: SparkSession, d: str) -> DataFrame:
    return validate.duplicate_keys(docs(s, d), ["text"])


@query("id_sets_diff", "SELECT DISTINCT doc_id, 'missing' AS side FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages) UNION ALL SELECT DISTINCT page_id AS doc_id, 'extra' AS side FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)")
def id_sets_diff(s: SparkSession, d: str) -> DataFrame:
    return validate.key_difference(table(s, d, "labels"), table(s, d, "pages").withColumnRenamed("page_id", "doc_id"), "doc_id")


STEPS = f"{LINES}, s AS (SELECT doc_id, line_no, CASE (doc_id + line_no) % 4 WHEN 0 THEN 'PURPOSE' WHEN 1 THEN 'EFFECT' WHEN 2 THEN 'PROBLEM' ELSE 'UNDETERMINED' END AS move, CASE (doc_id + 2 * line_no) % 5 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['QUANTITATIVE'] WHEN 2 THEN ['GAP', 'CAUSE'] WHEN 3 THEN ['GAP', 'GAP'] ELSE ['QUALITATIVE'] END AS steps, CASE line_no % 4 WHEN 0 THEN 'determined' WHEN 1 THEN 'partial' WHEN 2 THEN 'undetermined' ELSE 'not_applicable' END AS status, CASE WHEN line_no % 3 = 0 THEN 'why' WHEN line_no % 3 = 1 THEN ' ' END AS reason FROM lines), a AS (SELECT *, CASE move WHEN 'EFFECT' THEN ['QUANTITATIVE', 'QUALITATIVE'] WHEN 'PROBLEM' THEN ['GAP', 'DEFECT', 'CONSTRAINT', 'CAUSE'] ELSE []::VARCHAR[] END AS allowed, trim(coalesce(reason, ''), ' ') <> '' AS said FROM s)"


def annotated(s: SparkSession, d: str) -> DataFrame:
    i, n = F.col("doc_id"), F.col("line_no")
    pick = lambda x, *v: F.coalesce(*[F.when(x == k, y) for k, y in enumerate(v)])
    words = lambda *w: F.array(*[F.lit(x) for x in w]).cast("array<string>")
    return doc_lines(s, d).select(
        "doc_id", "line_no",
        pick((i + n) % 4, F.lit("PURPOSE"), F.lit("EFFECT"), F.lit("PROBLEM"), F.lit("UNDETERMINED")).alias("move"),
        pick((i + 2 * n) % 5, words(), words("QUANTITATIVE"), words("GAP", "CAUSE"), words("GAP", "GAP"), words("QUALITATIVE")).alias("steps"),
        pick(n % 4, F.lit("determined"), F.lit("partial"), F.lit("undetermined"), F.lit("not_applicable")).alias("status"),
        F.when(n % 3 == 0, "why").when(n % 3 == 1, " ").alias("reason"),
    )


@query("step_status_truth", f"WITH {STEPS} SELECT doc_id, line_no, CASE WHEN len(list_filter(steps, lambda x: NOT list_contains(allowed, x))) > 0 THEN 'unknown_step' WHEN len(list_distinct(steps)) < len(steps) THEN 'repeated_step' WHEN move = 'UNDETERMINED' THEN NULL WHEN len(allowed) = 0 THEN CASE WHEN NOT (status = 'not_applicable' AND len(steps) = 0 AND NOT said) THEN 'status' END WHEN status = 'determined' AND len(steps) > 0 AND NOT said OR status = 'partial' AND len(steps) > 0 AND said OR status = 'undetermined' AND len(steps) = 0 AND said THEN NULL ELSE 'status' END AS fault FROM a")
def step_status_truth(s: SparkSession, d: str) -> DataFrame:
    return annotated(s, d).select("doc_id", "line_no", validate.step_status_fault(F.col("move"), F.col("steps"), F.col("status"), F.col("reason")).alias("fault"))


@query("json_typed_fields", "SELECT event_id, CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN (props ->> '$.k')::BIGINT END AS k, coalesce(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT'), false) AS valid FROM events")
def json_typed_fields(s: SparkSession, d: str) -> DataFrame:
    props = F.try_parse_json("props")
    whole = F.coalesce(F.schema_of_variant(F.try_variant_get(props, "$.k", "variant")) == "BIGINT", F.lit(False))
    return table(s, d, "events").select("event_id", F.when(whole, F.try_variant_get(props, "$.k", "bigint")).alias("k"), whole.alias("valid"))


@query("context_missing_ratio", "WITH u AS (SELECT conv_id, CASE WHEN (conv_id + turn) % 4 = 0 THEN 1 ELSE 0 END AS hit FROM conversations) SELECT conv_id, round(avg(hit), 9) AS ratio, avg(hit) >= 0.3 AS widen FROM u GROUP BY conv_id")
def context_missing_ratio(s: SparkSession, d: str) -> DataFrame:
    why = F.when((F.col("conv_id") + F.col("turn")) % 4 == 0, F.array(F.lit("AMBIGUOUS"), F.lit("CONTEXT_MISSING"))).otherwise(F.array(F.lit("AMBIGUOUS")))
    out = labeling.context_missing_ratio(table(s, d, "conversations").withColumn("reasons", why), ["conv_id"])
    return out.withColumn("ratio", F.round("ratio", 9))


@query("last_valid_attempt", "WITH a AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events) SELECT user_id, min(attempt) AS attempt FROM a WHERE event_type <> 'error' AND event_type <> 'view' AND attempt <= 3 GROUP BY user_id")
def last_valid_attempt(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    tried = table(s, d, "events").withColumn("attempt", F.row_number().over(w)).withColumn("valid", ~F.col("event_type").isin("error", "view"))
    return agreement.last_valid(tried, ["user_id"], "attempt", "valid")


@query("usage_rollup", "SELECT event_type, 'k' AS name, sum((props ->> '$.k')::BIGINT)::BIGINT AS total, count(*) AS n FROM events WHERE regexp_matches(props ->> '$.k', '^-?[0-9]+$') GROUP BY event_type")
def usage_rollup(s: SparkSession, d: str) -> DataFrame:
    return agreement.usage(table(s, d, "events"), ["event_type"], "props")


UNITS = "l AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 3 END AS row, quality AS sig FROM labels), r AS (SELECT page_id AS doc_id, CASE WHEN page_id % 4 = 0 THEN NULL ELSE page_id % 3 END AS row, length(url) % 2 AS sig FROM pages), u AS (SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, coalesce(l.row, r.row) AS row, l.doc_id IS NOT NULL AS in_left, r.doc_id IS NOT NULL AS in_right, l.doc_id IS NOT NULL AND r.doc_id IS NOT NULL AND l.sig IS NOT DISTINCT FROM r.sig AS matched FROM l FULL JOIN r ON l.doc_id = r.doc_id AND l.row IS NOT DISTINCT FROM r.row)"


def units(s: SparkSession, d: str) -> DataFrame:
    """Two whole tables as two runs: they share some ids, and differ in others by themselves."""
    row = F.when(F.col("doc_id") % 4 != 0, F.col("doc_id") % 3)
    move = lambda x: agreement.signature(F.array(F.struct(x.cast("string").alias("move"), F.array(F.lit("b"), F.lit("a")).alias("steps"))))
    left = table(s, d, "labels").select("doc_id", row.alias("row"), move(F.col("quality")).alias("signature"))
    right = table(s, d, "pages").withColumnRenamed("page_id", "doc_id").select("doc_id", row.alias("row"), move(F.length("url") % 2).alias("signature"))
    return agreement.compare_units(left, right, ["doc_id", "row"])


@query("agreement_units", f"WITH {UNITS} SELECT * FROM u")
def agreement_units(s: SparkSession, d: str) -> DataFrame:
    return units(s, d)


@query("agreement_micro", f"WITH {UNITS} SELECT count(*) AS total, count(*) FILTER (matched) AS matched, count(*) FILTER (in_left AND NOT in_right) AS left_only, count(*) FILTER (in_right AND NOT in_left) AS right_only, round(count(*) FILTER (matched) / count(*), 9) AS agreement FROM u")
def agreement_micro(s: SparkSession, d: str) -> DataFrame:
    return agreement.agreement(units(s, d), []).withColumn("agreement", F.round("agreement", 9))


@query("snapshot_antijoin", "SELECT DISTINCT sha256(text) AS sha FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))")
def snapshot_antijoin(s: SparkSession, d: str) -> DataFrame:
    named = docs(s, d).select("doc_id", F.sha2("text", 256).alias("sha"))
    return summary.unseen(named, named.join(table(s, d, "labels").select("doc_id"), "doc_id", "left_semi"), "sha")


@query("priority_greedy_take", "WITH RECURSIVE o AS (SELECT o_custkey, 1 + o_orderkey % 12 AS u, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS n FROM orders), f AS (SELECT o_custkey, n, u::BIGINT AS s, 1::BIGINT AS taken FROM o WHERE n = 1 UNION ALL SELECT o.o_custkey, o.n, CASE WHEN f.s + o.u <= 37 THEN f.s + o.u ELSE f.s END, CASE WHEN f.s + o.u <= 37 THEN f.taken + 1 ELSE f.taken END FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.n = f.n + 1) SELECT o_custkey, s AS taken_units, taken FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC) = 1")
def priority_greedy_take(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "orders").withColumn("u", 1 + F.col("o_orderkey") % 12)
    return targets.greedy_take(rows, ["o_custkey"], [F.col("o_orderpriority"), F.col("o_orderkey")], "u", 37)


DATED = "dated AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y. %-m. %-d.') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN '2026. 2. ' || (25 + o_orderkey % 7) || '.' ELSE 'none' END AS text FROM orders), found AS (SELECT o_orderkey, unnest(regexp_extract_all(text, '\\d{4}[.\\-/]\\s?\\d{1,2}[.\\-/]\\s?\\d{1,2}\\.?')) AS date FROM dated)"


def dated(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy. M. d.")).when(k % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 4 == 2, F.concat(F.lit("2026. 2. "), (25 + k % 7).cast("string"), F.lit("."))).otherwise("none")
    return table(s, d, "orders").select("o_orderkey", text.alias("text"))


@query("rule_dates", f"WITH {DATED}, hits AS (SELECT o_orderkey, 'FMT-01' AS rule, 'advisory' AS severity, date AS detail FROM found WHERE NOT regexp_matches(date, '^\\d{{4}}\\. [1-9]\\d?\\. [1-9]\\d?\\.$') UNION ALL SELECT o_orderkey, 'FMT-07', 'must_fix', date FROM found WHERE try_strptime(regexp_replace(regexp_replace(date, '[.\\-/]\\s?', '-', 'g'), '-$', ''), '%Y-%m-%d') IS NULL) SELECT * FROM hits WHERE NOT (rule = 'FMT-01' AND o_orderkey IN (SELECT o_orderkey FROM hits WHERE rule = 'FMT-07'))")
def rule_dates(s: SparkSession, d: str) -> DataFrame:
    return rules.suppressed(rules.date_hits(dated(s, d), ["o_orderkey"]), ["o_orderkey"])


@query("rule_level_skips", f"WITH {LEVELED}, x AS (SELECT *, lag(level) OVER (PARTITION BY doc_id ORDER BY line_no) AS b FROM leveled WHERE level IS NOT NULL) SELECT doc_id, line_no, 'STR-01' AS rule, 'must_fix' AS severity, b || '>' || level AS detail FROM x WHERE level - b > 1")
def rule_level_skips(s: SparkSession, d: str) -> DataFrame:
    return rules.skipped_levels(leveled(doc_lines(s, d)), ["doc_id"], "line_no")


@query("rule_long_sentences", "WITH s AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS x FROM documents) SELECT doc_id, 'STR-05' AS rule, 'advisory' AS severity, length(x)::VARCHAR AS detail FROM s WHERE length(x) > 110")
def rule_long_sentences(s: SparkSession, d: str) -> DataFrame:
    return rules.long_sentences(docs(s, d), ["doc_id"])


@query("rule_totals", "SELECT l_orderkey, 'CON-01' AS rule, 'must_fix' AS severity, max(l_quantity) FILTER (l_linenumber = 1)::BIGINT || '<>' || sum(l_quantity) FILTER (l_linenumber <> 1)::BIGINT AS detail FROM lineitem GROUP BY l_orderkey HAVING max(l_quantity) FILTER (l_linenumber = 1) <> sum(l_quantity) FILTER (l_linenumber <> 1)")
def rule_totals(s: SparkSession, d: str) -> DataFrame:
    cells = table(s, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("value"), (F.col("l_linenumber") == 1).alias("is_total"))
    return rules.total_mismatches(cells, ["l_orderkey"])


@query("rule_references", "WITH a AS (SELECT DISTINCT o_orderkey AS k, o_orderkey % 3 AS number FROM orders), b AS (SELECT DISTINCT l_orderkey AS k, l_linenumber % 3 AS number FROM lineitem) SELECT coalesce(a.k, b.k) AS k, coalesce(a.number, b.number)::BIGINT AS number, 'CON-03' AS rule, 'verify' AS severity, CASE WHEN a.k IS NULL THEN 'unreferenced' ELSE 'unlisted' END AS detail FROM a FULL JOIN b ON a.k = b.k AND a.number = b.number WHERE a.k IS NULL OR b.k IS NULL")
def rule_references(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 3).cast("long").alias("number"))
    return rules.reference_faults(r, table(s, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") % 3).cast("long").alias("number")), ["k"])


@query("rule_mixed_values", "SELECT l_orderkey, 'FMT-09' AS rule, 'must_fix' AS severity, count(DISTINCT l_returnflag)::VARCHAR AS detail FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1")
def rule_mixed_values(s: SparkSession, d: str) -> DataFrame:
    return rules.mixed_values(table(s, d, "lineitem"), ["l_orderkey"], "l_returnflag", "FMT-09")


@query("quality_grade", "WITH w AS (SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN 'blank_page' ELSE 'scanned_page' END AS code FROM documents WHERE doc_id % 2 = 0) SELECT DISTINCT d.doc_id, CASE WHEN EXISTS (SELECT 1 FROM w WHERE w.doc_id = d.doc_id AND code <> 'blank_page') THEN 'PARTIAL' ELSE 'COMPLETE' END AS quality FROM documents d")
def quality_grade(s: SparkSession, d: str) -> DataFrame:
    warnings = docs(s, d).where("doc_id % 2 = 0").select("doc_id", F.when(F.col("n_chars") % 3 == 0, "blank_page").otherwise("scanned_page").alias("code"))
    return validate.quality_grade(warnings, docs(s, d), "doc_id")


@query("luminance", "SELECT p_partkey, round((((p_partkey * 7919 % 16777216) >> 16 & 255) * 0.299 + ((p_partkey * 7919 % 16777216) >> 8 & 255) * 0.587 + (p_partkey * 7919 % 16777216 & 255) * 0.114) / 255, 6)::DOUBLE AS lum FROM part")
def luminance(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", F.round(T.luminance((F.col("p_partkey") * 7919 % 16777216).cast("int")), 6).alias("lum"))


def page_boxes(s: SparkSession, d: str) -> DataFrame:
    """Lines in two columns, some a little off their row, with sizes and starts of blocks."""
    i, n = F.col("doc_id"), F.col("line_no")
    right = (n % 2) * 300.0
    y0 = F.floor(n / 2) * 12.0 + (i + n) % 3
    rows = boxed(doc_lines(s, d)).drop("x0", "x1", "y0", "y1")
    return rows.select("doc_id", "page", "line_no", "text", (50 + right).alias("x0"), y0.alias("y0"), (50 + right + F.least(5 * F.length("text"), F.lit(280))).cast("double").alias("x1"), (y0 + 10).alias("y1"), (10 + (n % 5 == 0).cast("int") * 4).cast("double").alias("size"), (n % 4 == 0).alias("starts_block"))


# Steps that are sequential on a page have no SQL; tests/test_layout.py holds them against plain loops.
def page_lines(s: SparkSession, d: str) -> DataFrame:
    """page_boxes as lines of a page of 482 points."""
    return page_boxes(s, d).drop("starts_block").withColumn("is_bold", F.lit(False)).withColumn("height", F.lit(482.0))


@query("reading_order")
def reading_order(s: SparkSession, d: str) -> DataFrame:
    rows = page_boxes(s, d).withColumn("kind", F.lit("para"))
    return page.reading_position(rows, ["doc_id", "page"], "line_no").select("doc_id", "page", "line_no", "position")


PLACED = f"{BOXED}, p AS (SELECT doc_id, line_no, page, text, x0, x1, y0 - (page - 1) * 480 AS y0, y1 - (page - 1) * 480 AS y1, 482.0::DOUBLE AS height FROM boxed)"
EDGED = f"{PLACED}, e AS (SELECT *, CASE WHEN y1 <= height * 0.1 THEN 'header' WHEN y0 >= height * 0.9 THEN 'footer' END AS edge, regexp_replace(text, '\\d+', '#', 'g') AS template FROM p), t AS (SELECT doc_id, edge, template, page, line_no, x0, y0 / height AS y FROM e WHERE edge IS NOT NULL), seen AS (SELECT a.doc_id, a.page, a.line_no, count(DISTINCT b.page) AS seen FROM t a JOIN t b ON a.doc_id = b.doc_id AND a.edge = b.edge AND a.template = b.template AND abs(a.x0 - b.x0) <= 6 AND abs(a.y - b.y) <= 0.01 GROUP BY ALL), n AS (SELECT doc_id, count(DISTINCT page) AS n FROM p GROUP BY doc_id)"


@query("page_running_elements", f"WITH {EDGED} SELECT e.doc_id, e.page, e.line_no, CASE WHEN regexp_matches(text, '^[-–—]\\s*\\d{{1,4}}\\s*[-–—]$') AND (y1 <= height * 0.12 OR y0 >= height * 0.88) THEN 'page_number' WHEN edge IS NULL THEN NULL WHEN regexp_matches(text, '^[\\s\\-–—]*\\d{{1,4}}\\s*(?:/\\s*\\d{{1,4}})?[\\s\\-–—]*$') THEN 'page_number' WHEN seen >= greatest(2, ceil(n * 0.6)) THEN edge END AS running FROM e LEFT JOIN seen s ON s.doc_id = e.doc_id AND s.page = e.page AND s.line_no = e.line_no LEFT JOIN n ON n.doc_id = e.doc_id")
def page_running_elements(s: SparkSession, d: str) -> DataFrame:
    """Lines one below the other: none stands beside another."""
    rows = boxed(doc_lines(s, d)).withColumn("y0", F.col("y0") - (F.col("page") - 1) * 480).withColumn("y1", F.col("y1") - (F.col("page") - 1) * 480)
    return page.running_elements(rows.withColumn("height", F.lit(482.0)), ["doc_id"]).select("doc_id", "page", "line_no", "running")


@query("page_blocks")
def page_blocks(s: SparkSession, d: str) -> DataFrame:
    return page.assemble(page_lines(s, d), ["doc_id"]).select("doc_id", "page", "position", "kind", "level", "type", "marker", F.sha2("text", 256).alias("sha"))


MARKDOWN_KINDS = "CASE level WHEN 1 THEN 'heading' WHEN 2 THEN 'heading' WHEN 3 THEN 'item' WHEN 4 THEN 'item' WHEN 5 THEN 'note' WHEN 6 THEN 'attachment' ELSE 'para' END"


@query(
    "document_markdown",
    f"WITH {LEVELED}, b AS (SELECT doc_id, line_no, line_no // 40 + 1 AS page, level, {MARKDOWN_KINDS} AS kind, text FROM leveled WHERE trim(text, ' ') <> ''), m AS (SELECT *, CASE kind WHEN 'heading' THEN repeat('#', (level + 1)::INT) || ' * ' || text || chr(10) WHEN 'attachment' THEN rtrim(chr(10) || '***** ' || text, ' ') || chr(10) WHEN 'para' THEN text ELSE repeat('  ', greatest(level - 3, 0)::INT) || '* ' || text END AS drawn, lag(page) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM b), w AS (SELECT doc_id, string_agg(CASE WHEN before IS DISTINCT FROM page THEN chr(10) || '<!-- page ' || page || ' -->' || chr(10) || chr(10) ELSE '' END || drawn, chr(10) ORDER BY line_no) AS body FROM m GROUP BY doc_id) SELECT w.doc_id, sha256('# ' || source || chr(10) || chr(10) || regexp_replace(body, '\\s+$', '') || chr(10)) AS sha FROM w JOIN documents d ON d.doc_id = w.doc_id",
)
def document_markdown(s: SparkSession, d: str) -> DataFrame:
    kind = F.expr(MARKDOWN_KINDS)
    rows = leveled(doc_lines(s, d)).where("trim(text) <> ''").withColumn("page", F.floor(F.col("line_no") / 40) + 1).withColumn("kind", kind).withColumnRenamed("line_no", "position")
    rows = rows.withColumn("marker", F.when(kind == "attachment", "*").when(kind != "para", "*")).join(docs(s, d).select("doc_id", "source"), "doc_id")
    return page.markdown(rows, ["doc_id"], F.col("source")).select("doc_id", F.sha2("markdown", 256).alias("sha"))


@query("row_fragments")
def row_fragments(s: SparkSession, d: str) -> DataFrame:
    return page.flow(page_lines(s, d), ["doc_id", "page"], wrapping=False).select("doc_id", "page", "line_no", "text", F.size("steps").alias("n_steps"))


@query("wrapped_paragraphs")
def wrapped_paragraphs(s: SparkSession, d: str) -> DataFrame:
    return page.flow(page_lines(s, d), ["doc_id", "page"]).select("doc_id", "page", "line_no", "text", "n_lines")


@query("touching_components")
def touching_components(s: SparkSession, d: str) -> DataFrame:
    boxes = page_boxes(s, d).select("doc_id", "page", F.col("line_no").alias("box"), "x0", "y0", "x1", "y1")
    return layout.touching_components(boxes, ["doc_id", "page"], 0.5).select("doc_id", "page", "box", "component")


@query("shadow_lines")
def shadow_lines(s: SparkSession, d: str) -> DataFrame:
    rows = boxed(doc_lines(s, d)).withColumn("is_light", (F.col("doc_id") + F.col("line_no")) % 4 == 0)
    twin = rows.where("is_light and length(text) > 4").withColumn("is_light", F.lit(False)).withColumn("text", F.concat("text", F.lit("!")))
    return L.drop_shadows(rows.unionByName(twin), ["doc_id", "page"]).groupBy("doc_id").agg(F.count_if("is_light").alias("light"), F.count("*").alias("n"))


MARKS = ("Ⅰ. ", "1. ", "□ ", "ㅇ ", "- ", "· ", "※ ", "① ", "1) ", "가. ", "(a) ", "◆ ", "붙임 1. ", "")
# SQL has no lookahead: what a pattern forbids after itself is a condition on the rest of the line.
AFTER = {
    "number": "(regexp_matches(text, '^\\d{1,2}\\.\\s{2,}') OR NOT regexp_matches(text, '^\\d{1,2}\\.\\s+\\d{1,2}\\s*[.(（~∼〜]'))",
    "dash": "(NOT regexp_matches(text, '^.\\d')) AND NOT regexp_matches(regexp_replace(text, '^.\\s*', ''), '^.+[-‐‑–—]\\s*$')",
}


def marker_sql() -> str:
    """The first pattern that fits, as a CASE chain over the same fixed values."""
    cases: dict[str, list[str]] = {c: [] for c in ("kind", "level", "type", "marker", "content")}
    for level, kind, pattern in T.MARKERS:
        bare = pattern.split("(?!")[0].replace("(?=\\S)", "").replace("(?:\\s+|(?=\\D))", "\\s*").replace("'", "''")
        content = f"trim(regexp_replace(text, '{bare}', ''), ' ')"
        when = f"WHEN regexp_matches(text, '{bare}') AND {content} <> '' AND {AFTER.get(kind, 'true')} THEN "
        shown = "note" if kind == "note" else "heading" if level in (1, 2) else "item"
        parts = f"list_filter(regexp_split_to_array({content}, '\\s+'), lambda x: x <> '')"
        body = f"CASE WHEN len({parts}) > 1 AND len(list_filter({parts}, lambda x: length(x) <> 1)) = 0 THEN array_to_string({parts}, '') ELSE {content} END" if shown == "heading" else content
        for name, value in (("kind", f"'{shown}'"), ("level", str(level or "NULL")), ("type", f"'{kind}'"), ("marker", f"regexp_extract(text, '{bare}', 1)"), ("content", body)):
            cases[name].append(when + value)
    attached = r"^(붙\s*임|참\s*고|첨\s*부|별\s*첨)\s*(\d{1,2})?\s*[.:]?\s*"
    last = {"kind": "'attachment'", "level": "1", "type": "'attachment'", "marker": f"trim(regexp_extract(text, '{attached}'), ' ')", "content": f"trim(regexp_replace(text, '{attached}', ''), ' ')"}
    other = {"kind": "'para'", "level": "NULL", "type": "NULL", "marker": "NULL", "content": "text"}
    shown = ", ".join(f"(CASE {' '.join(cases[c])} WHEN regexp_matches(text, '{attached}') THEN {last[c]} ELSE {other[c]} END){'::BIGINT' if c == 'level' else ''} AS {c}" for c in cases)
    marks = ", ".join(f"'{m}'" for m in MARKS)
    return f"WITH {LINES}, marked AS (SELECT doc_id, line_no, trim([{marks}][line_no % {len(MARKS)} + 1] || text, ' ') AS text FROM lines) SELECT doc_id, line_no, {shown} FROM marked"


@query("line_markers", marker_sql())
def line_markers(s: SparkSession, d: str) -> DataFrame:
    marks = F.element_at(F.array(*[F.lit(x) for x in MARKS]), (F.col("line_no") % len(MARKS) + 1).cast("int"))
    return doc_lines(s, d).select("doc_id", "line_no", T.marker(F.concat(marks, F.col("text"))).alias("m")).select("doc_id", "line_no", "m.*")


@query("response_issues")
def response_issues(s: SparkSession, d: str) -> DataFrame:
    """Answers made from annotated lines, judged by every code that answers alone can break."""
    rows = annotated(s, d).join(doc_lines(s, d), ["doc_id", "line_no"])
    key = F.concat_ws(":", "doc_id", "line_no")
    odd = (F.col("doc_id") + F.col("line_no")) % 11
    made = rows.select(
        F.col("doc_id").alias("request_id"), key.alias("block_id"), F.when(odd == 1, "b1").otherwise("a1").alias("annotation_id"), F.when(odd == 2, "NONE").otherwise(F.col("move")).alias("move"), "steps",
        F.col("status").alias("step_status"), F.col("reason").alias("step_reason"), F.when((F.col("move") == "UNDETERMINED") & (odd != 3), "AMBIGUOUS").alias("undetermined_reason"), F.when(odd == 4, 1).otherwise(0).alias("spec_items"),
        F.when(odd == 5, F.substring("text", 1, 1)).otherwise(F.col("text")).alias("quote"), F.lit(None).cast("int").alias("occurrence"), "text", odd.alias("odd"),
    )
    asked = made.select("request_id", "block_id")
    answered = made.where("odd <> 6").select("request_id", "block_id", F.when(F.col("odd") == 7, "a9").alias("primary_id"))
    known = made.select("block_id", "text", F.lit(False).alias("title_like"))
    return validate.block_issues(asked, answered, made.where("odd <> 8").drop("text", "odd"), known).groupBy("code", "message").agg(F.count("*").alias("n"))


@query("rule_section_order")
def rule_section_order(s: SparkSession, d: str) -> DataFrame:
    tags = tree.tag_headings(headings(s, d), s.createDataFrame(LEXICON, "word string, tag string, seq int"))
    ranks = s.createDataFrame([("SEC_OVERVIEW", 1), ("SEC_STATUS", 2), ("SEC_PLAN", 3), ("SEC_RESULT", 4), ("SEC_EFFECT", 5)], "tag string, rank int")
    return rules.order_faults(tags, ranks, ["doc_id"], "line_no")


@query("rule_missing_sections")
def rule_missing_sections(s: SparkSession, d: str) -> DataFrame:
    tags = tree.tag_headings(headings(s, d), s.createDataFrame(LEXICON, "word string, tag string, seq int")).select("doc_id", "tag")
    required = s.createDataFrame([("plan", "what", "SEC_OVERVIEW"), ("plan", "how", "SEC_PLAN"), ("plan", "how", "SEC_STATUS"), ("report", "end", "SEC_RESULT"), ("report", "end", "SEC_EFFECT")], "outline_id string, slot string, tag string")
    documents = docs(s, d).select("doc_id", F.when(F.col("doc_id") % 3 == 0, "plan").when(F.col("doc_id") % 3 == 1, "report").alias("outline_id"))
    return rules.missing_sections(documents, tags, required, "doc_id")


@query("block_requests")
def block_requests(s: SparkSession, d: str) -> DataFrame:
    blocks = turns(s, d).select(F.col("conv_id").cast("string").alias("document_id"), F.concat(F.lit("b"), F.col("turn").cast("string")).alias("block_id"), F.col("turn").alias("seq"), F.col("section").alias("section_id"), "text", "units", F.when(F.col("role") == "system", "context").otherwise("target").alias("class"))
    out = requests.block_requests(blocks, full=3000)
    return out.select("document_id", "chunk", F.size("targets").alias("n_targets"), "context_kind", F.length("context").alias("context_chars"), "request_id")


def cell_boxes(s: SparkSession, d: str) -> DataFrame:
    cells = grid.pipe_cells(doc_lines(s, d), ["doc_id", "line_no"])
    x0 = F.col("col") * 30.0 + (F.col("doc_id") + F.col("col")) % 3 * 0.75
    return cells.select("doc_id", (F.col("line_no") * 1000 + F.col("col")).alias("cell"), x0.alias("x0"), (F.col("line_no") * 12.0).alias("y0"), (x0 + 29.0).alias("x1"), (F.col("line_no") * 12.0 + 11).alias("y1"))


@query("neighbour_cells", f"WITH {PIPES}, b AS (SELECT doc_id, line_no * 1000 + col AS cell, col * 30.0::DOUBLE + (doc_id + col) % 3 * 0.75::DOUBLE AS x0, line_no * 12.0::DOUBLE AS y0, line_no * 12.0::DOUBLE + 11 AS y1 FROM cells), x AS (SELECT *, x0 + 29.0 AS x1 FROM b) SELECT l.doc_id, l.cell, r.cell AS neighbour FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.cell <> r.cell AND l.y0 = r.y0 AND abs(l.x1 - r.x0) <= 1.0")
def neighbour_cells(s: SparkSession, d: str) -> DataFrame:
    return drawings.neighbours(cell_boxes(s, d), ["doc_id"])


@query("rule_bare_tables", f"WITH {LINES}, k AS (SELECT doc_id, line_no, CASE WHEN (doc_id + line_no) % 3 = 0 THEN 'table' WHEN (doc_id * 5 + line_no) % 4 < 2 THEN 'para' ELSE 'figure' END AS kind FROM lines), n AS (SELECT *, lag(kind) OVER w AS b, lead(kind) OVER w AS a FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)) SELECT doc_id, line_no, 'EXP-05' AS rule, 'advisory' AS severity, 'no prose' AS detail FROM n WHERE kind = 'table' AND coalesce(b, '') <> 'para' AND coalesce(a, '') <> 'para'")
def rule_bare_tables(s: SparkSession, d: str) -> DataFrame:
    i, n = F.col("doc_id"), F.col("line_no")
    kind = F.when((i + n) % 3 == 0, "table").when((i * 5 + n) % 4 < 2, "para").otherwise("figure")
    return rules.bare_tables(doc_lines(s, d).select("doc_id", "line_no", kind.alias("kind")), ["doc_id"], "line_no")


@query("rule_vague_words", f"WITH {LINES}, w AS (SELECT DISTINCT doc_id, line_no, unnest(string_split_regex(text, '[\\s,.]+')) AS word FROM lines WHERE NOT regexp_matches(text, '[0-9]')) SELECT doc_id, line_no, 'EXP-01' AS rule, 'advisory' AS severity, word AS detail FROM w WHERE word IN ('that', 'dass', 'pour', 'los')")
def rule_vague_words(s: SparkSession, d: str) -> DataFrame:
    return rules.vague_words(doc_lines(s, d), s.createDataFrame([("that",), ("dass",), ("pour",), ("los",)], "word string"), ["doc_id", "line_no"])


@query("rule_long_bodies", f"WITH {BOXED}, p AS (SELECT doc_id, count(DISTINCT page) FILTER (line_no % 90 <> 89) AS pages, bool_or(line_no % 90 = 89) AS annex FROM boxed GROUP BY doc_id) SELECT doc_id, 'STR-08' AS rule, 'advisory' AS severity, pages::VARCHAR AS detail FROM p WHERE pages > 1 AND NOT annex")
def rule_long_bodies(s: SparkSession, d: str) -> DataFrame:
    rows = boxed(doc_lines(s, d)).withColumn("tag", F.when(F.col("line_no") % 90 == 89, "SEC_ANNEX").otherwise("SEC_CONTENT"))
    return rules.long_bodies(rows, ["doc_id"], 1)


@query("horizontal_rules", f"WITH {LINES} SELECT doc_id, count(*) AS n_rules, round(sum(len), 3) AS total FROM (SELECT doc_id, line_no, least(greatest(length(text), 20), 60)::DOUBLE AS len FROM lines) WHERE len > 40 GROUP BY doc_id")
def horizontal_rules(s: SparkSession, d: str) -> DataFrame:
    """Each line of text is underlined by two segments that meet; short ones go."""
    n = F.least(F.greatest(F.length("text"), F.lit(20)), F.lit(60)).cast("double")
    rows = doc_lines(s, d).withColumn("n", n).withColumn("y", F.col("line_no") * 5.0)
    first = rows.select("doc_id", "y", F.lit(0.0).alias("x0"), F.lit(15.0).alias("x1"))
    second = rows.select("doc_id", "y", F.lit(14.0).alias("x0"), F.col("n").alias("x1"))
    found = drawings.horizontal_rules(first.unionByName(second), ["doc_id"])
    return found.groupBy("doc_id").agg(F.count("*").alias("n_rules"), F.round(F.sum(F.col("x1") - F.col("x0")), 3).alias("total"))
