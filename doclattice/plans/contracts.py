"""Registered queries of the contract checks and of the rules that need side tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.operators import contract, rules, summary
from doclattice.plans.queries import BOXED, LINES, doc_lines, query
from doclattice.sources.readers import boxed, table

# Blocks made from lines: one in so many has a fault of each kind.
BLOCKS = f"""{BOXED}, blocks AS (SELECT doc_id AS document_id, line_no::VARCHAR AS id, line_no AS seq, page, text,
    CASE WHEN line_no % 23 = 5 THEN 'header' WHEN line_no % 29 = 7 THEN 'other' ELSE 'para' END AS kind, x0, y0, CASE WHEN line_no % 31 = 3 THEN 0 ELSE x1 END AS x1, y1,
    CASE WHEN line_no = 0 THEN NULL WHEN (doc_id + line_no) % 17 = 0 THEN line_no WHEN (doc_id + line_no) % 19 = 0 THEN line_no + 100000 ELSE line_no - 1 END::VARCHAR AS parent_id FROM boxed)"""


def blocks(s: SparkSession, d: str) -> DataFrame:
    n, both = F.col("line_no"), F.col("doc_id") + F.col("line_no")
    parent = F.when(n > 0, F.when(both % 17 == 0, n).when(both % 19 == 0, n + 100000).otherwise(n - 1))
    return boxed(doc_lines(s, d)).select(
        F.col("doc_id").alias("document_id"), n.cast("string").alias("id"), n.alias("seq"), "page", "text",
        F.when(n % 23 == 5, "header").when(n % 29 == 7, "other").otherwise("para").alias("kind"),
        F.array("x0", "y0", F.when(n % 31 == 3, 0.0).otherwise(F.col("x1")), "y1").alias("bbox"),
        parent.cast("string").alias("parent_id"), F.lit(False).alias("excluded"),
    )


@query("block_contract", f"""WITH {BLOCKS}, walked AS (SELECT document_id, id, last_value(CASE WHEN parent_id = id THEN 1 WHEN parent_id::BIGINT > seq THEN 0 END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY seq) AS loops FROM blocks)
SELECT document_id, 'C05' AS code, id AS path, 'own parent' AS message FROM blocks WHERE parent_id = id
UNION ALL SELECT document_id, 'C05', id, 'parent unknown' FROM blocks b WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM blocks o WHERE o.document_id = b.document_id AND o.id = b.parent_id)
UNION ALL SELECT document_id, 'C05', id, 'parents loop' FROM walked WHERE loops = 1
UNION ALL SELECT document_id, 'C10', id, 'not excluded' FROM blocks WHERE kind = 'header'
UNION ALL SELECT document_id, 'C11', id, 'box' FROM blocks WHERE x0 > x1
UNION ALL SELECT document_id, 'C12', id, 'page out of range' FROM blocks WHERE page > 2
UNION ALL SELECT document_id, 'C13', id, 'unknown kind' FROM blocks WHERE kind = 'other'
UNION ALL SELECT document_id, 'C16', id, 'empty text' FROM blocks WHERE kind = 'para' AND NOT regexp_matches(text, '\\S')""")
def block_contract(s: SparkSession, d: str) -> DataFrame:
    return contract.block_contract(table(s, d, "documents").select(F.col("doc_id").alias("document_id"), F.lit(2).alias("page_count")), blocks(s, d))


@query("section_contract", f"""WITH {BOXED}, blocks AS (SELECT *, (line_no + 3) // 10 AS owner, line_no // 10 AS section FROM boxed),
sections AS (SELECT doc_id, section, min(page) AS lo, max(page) AS hi FROM blocks GROUP BY doc_id, section)
SELECT doc_id AS document_id, 'C06' AS code, line_no::VARCHAR AS path, 'section unknown' AS message FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM sections x WHERE x.doc_id = b.doc_id AND x.section = b.owner)
UNION ALL SELECT doc_id, 'C07', section::VARCHAR, 'head is no member' FROM sections WHERE section % 5 = 2
UNION ALL SELECT doc_id, 'C09', section::VARCHAR, 'page range' FROM sections WHERE section % 4 = 1 AND (lo <> 1 OR hi <> 9)""")
def section_contract(s: SparkSession, d: str) -> DataFrame:
    n = F.col("line_no")
    rows = boxed(doc_lines(s, d)).select(F.col("doc_id").alias("document_id"), n.cast("string").alias("id"), n, "page", F.floor((n + 3) / 10).cast("string").alias("section_id"), F.floor(n / 10).alias("section"))
    made = rows.groupBy("document_id", "section").agg(F.collect_list("id").alias("block_ids"), F.min(n).cast("string").alias("first"), F.array(F.min("page"), F.max("page")).alias("pages"))
    sections = made.select(
        "document_id", F.col("section").cast("string").alias("section_id"), "block_ids", F.when(F.col("section") % 5 == 2, "none").otherwise(F.col("first")).alias("head_block_id"),
        F.when(F.col("section") % 4 == 1, F.array(F.lit(1), F.lit(9))).otherwise(F.col("pages")).alias("page_range"),
    )
    return contract.section_contract(rows, sections)


@query("text_contract", f"""WITH {LINES}
SELECT doc_id AS document_id, 'P02' AS code, line_no::VARCHAR AS path, 'letters not in the source' AS message FROM lines WHERE line_no % 11 = 2 AND regexp_matches(text, '^\\S')
UNION ALL SELECT doc_id, 'P03', line_no::VARCHAR, 'line break' FROM lines WHERE line_no % 7 = 1
UNION ALL SELECT doc_id, 'P05', line_no::VARCHAR, 'marker not in the source' FROM lines WHERE line_no % 13 = 4
UNION ALL SELECT doc_id, 'P08', line_no::VARCHAR, 'bullet within a block' FROM lines WHERE line_no % 5 = 3""")
def text_contract(s: SparkSession, d: str) -> DataFrame:
    n = F.col("line_no")
    source = F.when(n % 11 == 2, F.substring("text", 2, 1 << 30)).otherwise(F.col("text"))
    return contract.text_contract(doc_lines(s, d).select(
        F.col("doc_id").alias("document_id"), n.cast("string").alias("id"), F.lit("para").alias("kind"), F.when(n % 13 == 4, "￿").alias("marker"),
        F.when(n % 7 == 1, F.concat("text", F.lit("\n"))).otherwise(F.col("text")).alias("text"), F.when(n % 5 == 3, F.concat(source, F.lit("\n ■ next"))).otherwise(source).alias("source_text"),
    ))


@query("order_contract", f"""WITH {LINES}, b AS (SELECT doc_id, line_no, CASE WHEN (doc_id + line_no) % 3 = 0 THEN 300 ELSE 0 END AS x, line_no // 2 AS y FROM lines),
n AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
SELECT doc_id AS document_id, 'P06' AS code, line_no::VARCHAR AS path, 'right block first' AS message FROM n WHERE y = ny AND nx + 200 <= x + 1""")
def order_contract(s: SparkSession, d: str) -> DataFrame:
    x = F.when((F.col("doc_id") + F.col("line_no")) % 3 == 0, 300.0).otherwise(0.0)
    y = F.floor(F.col("line_no") / 2) * 12.0
    return contract.order_contract(doc_lines(s, d).select(F.col("doc_id").alias("document_id"), F.col("line_no").alias("seq"), F.col("line_no").cast("string").alias("id"), F.lit(1).alias("page"), F.lit("para").alias("kind"), F.array(x, y, x + 200, y + 10).alias("bbox")))


@query("reference_contract", "SELECT 'part' AS name, l_partkey::VARCHAR AS value, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY l_partkey")
def reference_contract(s: SparkSession, d: str) -> DataFrame:
    return contract.reference_contract({"part": (table(s, d, "lineitem"), "l_partkey")}, table(s, d, "part").where("p_size > 5"), "p_partkey")


REGISTER = "register AS (SELECT p_partkey AS law, unnest(range(1, 6)) AS article, TIMESTAMP '1994-01-01' AS since, CASE WHEN p_size % 2 = 0 THEN TIMESTAMP '1996-01-01' END AS until FROM part WHERE p_size > 5), cited AS (SELECT l_orderkey, l_linenumber, l_partkey AS law, l_linenumber AS article, l_shipdate AS written FROM lineitem)"


@query("rule_citations", f"""WITH {REGISTER}, known AS (SELECT * FROM cited WHERE law IN (SELECT law FROM register))
SELECT DISTINCT l_orderkey, l_linenumber, 'LAW-01' AS rule, 'must_fix' AS severity, law::VARCHAR AS detail FROM cited WHERE law NOT IN (SELECT law FROM register)
UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, 'LAW-02', 'must_fix', law || ' ' || article FROM known k WHERE NOT EXISTS (SELECT 1 FROM register r WHERE r.law = k.law AND r.article = k.article)
UNION ALL SELECT l_orderkey, l_linenumber, 'LAW-03', 'verify', k.law || ' ' || k.article FROM known k JOIN register r ON r.law = k.law AND r.article = k.article
GROUP BY l_orderkey, l_linenumber, k.law, k.article HAVING NOT bool_or(since <= written AND (until IS NULL OR written < until))""")
def rule_citations(s: SparkSession, d: str) -> DataFrame:
    until = F.when(F.col("p_size") % 2 == 0, F.lit("1996-01-01").cast("timestamp_ntz"))
    register = table(s, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("law"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("article"), F.lit("1994-01-01").cast("timestamp_ntz").alias("since"), until.alias("until"))
    cited = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("law"), F.col("l_linenumber").alias("article"), F.col("l_shipdate").cast("timestamp_ntz").alias("written"))
    return rules.citation_faults(cited, register, ["l_orderkey", "l_linenumber"])


@query("awaiting_judgement", """WITH t AS (SELECT *, (conv_id + turn) % 3 AS m FROM conversations)
SELECT DISTINCT conv_id, NULL::VARCHAR AS section_id, 'LAW-05' AS rule FROM t WHERE conv_id NOT IN (SELECT conv_id FROM t WHERE m = 1 AND conv_id % 2 = 0)
UNION ALL SELECT conv_id, turn::VARCHAR, 'EXP-04' FROM t x WHERE role = 'assistant' AND NOT EXISTS (SELECT 1 FROM t y WHERE y.conv_id = x.conv_id AND y.turn = x.turn AND m = 0 AND turn % 2 = 0)""")
def awaiting_judgement(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "conversations").select("conv_id", "turn", F.col("turn").cast("string").alias("section_id"), "role", ((F.col("conv_id") + F.col("turn")) % 3).alias("m"))
    sections = t.select("conv_id", "section_id", F.when(F.col("role") == "assistant", "SEC_EFFECT").otherwise("SEC_PLAN").alias("tag"))
    steps = F.when(F.col("turn") % 2 == 0, F.array(F.lit("QUANTITATIVE"))).otherwise(F.array().cast("array<string>"))
    move = F.when(F.col("m") == 0, "EFFECT").when((F.col("m") == 1) & (F.col("conv_id") % 2 == 0), "GROUNDS").otherwise("PLAN")
    return rules.awaiting_judgement(sections, t.select("conv_id", "section_id", move.alias("move"), steps.alias("steps")), ["conv_id"])


@query("page_id_gaps", f"WITH {BOXED}, p AS (SELECT doc_id, list(DISTINCT page) FILTER (length(text) >= 60) AS have, max(page) AS n FROM boxed GROUP BY doc_id), m AS (SELECT doc_id, list_filter(range(1, n + 1), lambda i: have IS NULL OR NOT list_contains(have, i)) AS gaps FROM p) SELECT doc_id, len(gaps)::BIGINT AS n_missing FROM m WHERE len(gaps) > 0")
def page_id_gaps(s: SparkSession, d: str) -> DataFrame:
    """Pages without a line of 60 characters or more count as missing."""
    page = F.when(F.length("text") >= 60, F.col("page"))
    return summary.missing_pages(boxed(doc_lines(s, d)), ["doc_id"], page, F.col("page")).select("doc_id", F.size("missing").alias("n_missing"))
