"""Validation: each check is a DataFrame of issues (code, path, message); nothing is thrown for bad data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclattice.functions.text import locate

# The vocabulary of moves and their steps, reasons and roles.
MOVES: dict[str, tuple[str, ...]] = {
    "BACKGROUND": (), "GROUNDS": ("LAW", "ORDINANCE", "DIRECTIVE", "PLAN", "ORDER"), "PURPOSE": (), "STATUS": (), "PROBLEM": ("GAP", "DEFECT", "CONSTRAINT", "CAUSE"),
    "ACTION": (), "EXECUTION": (), "OUTCOME": (), "ASSESSMENT": ("ACHIEVEMENT", "LIMITATION", "IMPLICATION"), "EFFECT": ("QUANTITATIVE", "QUALITATIVE"),
    "FOLLOWUP": (), "SPEC": (), "ANNEX_REF": (), "OTHER": (), "UNDETERMINED": (),
}
UNDETERMINED_REASONS = ("INPUT_BROKEN", "CONTEXT_MISSING", "AMBIGUOUS")
ROW_ROLES = ("header", "body", "empty")
INFORMATIONAL = ("blank_page",)


def issues(code: str, found: DataFrame, path: Column, message: str, key: list[str]) -> DataFrame:
    return found.select(*key, F.lit(code).alias("code"), path.alias("path"), F.lit(message).alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose non-null foreign key has no parent."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: (key, side)."""
    l, r = left.select(key).distinct(), right.select(key).distinct()
    return l.join(r, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(r.join(l, key, "left_anti").withColumn("side", F.lit("extra")))


def step_status_fault(move: Column, steps: Column, status: Column, reason: Column) -> Column:
    """Null where the status fits the steps and the reason; else what is wrong (V06)."""
    domain = F.create_map(*[x for m, s in MOVES.items() for x in (F.lit(m), F.array(*[F.lit(v) for v in s]).cast("array<string>"))])
    allowed, n, said = F.element_at(domain, move), F.size(steps), F.trim(F.coalesce(reason, F.lit(""))) != ""
    fits = (
        F.when(F.size(allowed) == 0, (status == "not_applicable") & (n == 0) & ~said)
        .when(status == "determined", (n > 0) & ~said).when(status == "partial", (n > 0) & said).when(status == "undetermined", (n == 0) & said).otherwise(False)
    )
    return (
        F.when(F.size(F.array_except(steps, allowed)) > 0, "unknown_step").when(F.size(F.array_distinct(steps)) < n, "repeated_step")
        .when(move == "UNDETERMINED", F.lit(None)).when(~F.coalesce(fits, F.lit(False)), "status")
    )


def block_issues(requests: DataFrame, responses: DataFrame, annotations: DataFrame, blocks: DataFrame) -> DataFrame:
    """Issues of answers to requests.

    requests: request_id, block_id. responses: request_id, block_id, primary_id. annotations: request_id, block_id,
    annotation_id, move, steps, step_status, step_reason, undetermined_reason, spec_items (n), quote, occurrence.
    blocks: block_id, text, title_like.
    """
    key = ["request_id", "block_id"]
    where = F.concat(F.lit("blocks["), F.col("block_id").cast("string"), F.lit("]"))
    at = F.concat(where, F.lit("."), F.coalesce("annotation_id", F.lit("?")))
    known = annotations.where(F.col("move").isin(*MOVES))
    fault = step_status_fault(F.col("move"), F.col("steps"), F.col("step_status"), F.col("step_reason"))
    undetermined = F.when(F.col("move") == "UNDETERMINED", F.coalesce(F.col("undetermined_reason").isin(*UNDETERMINED_REASONS), F.lit(False)) & (F.size("steps") == 0) & (F.col("spec_items") == 0)).otherwise(F.col("undetermined_reason").isNull())
    spec = F.when(F.col("move") == "SPEC", F.col("spec_items") > 0).otherwise(F.col("spec_items") == 0)
    spans = known.join(blocks.select("block_id", "text"), "block_id", "left").withColumn("found", locate(F.coalesce("text", F.lit("")), F.col("quote"), F.col("occurrence")))
    primary = responses.where(F.col("primary_id").isNotNull()).join(annotations.select(*key, F.col("annotation_id").alias("primary_id")), [*key, "primary_id"], "left_anti")
    bare = responses.join(annotations.select(*key), key, "left_anti").join(blocks.where(~F.col("title_like")).select("block_id"), "block_id", "left_semi")
    return union([
        issues("V02", requests.select(*key).join(responses.select(*key), key, "left_anti"), where, "missing block", key),
        issues("V02", responses.select(*key).join(requests.select(*key), key, "left_anti"), where, "block not asked for", key),
        issues("V02", duplicate_keys(responses, key), where, "block answered twice", key),
        issues("V03", annotations.where(~F.coalesce(F.rlike("annotation_id", F.lit(r"^(r\d+\.)?a\d+$")), F.lit(False))), at, "annotation id", key),
        issues("V03", duplicate_keys(annotations, [*key, "annotation_id"]), at, "annotation id repeated", key),
        issues("V04", primary, where, "primary annotation unknown", key),
        issues("V05", annotations.where(~F.coalesce(F.col("move").isin(*MOVES), F.lit(False))), at, "unknown move", key),
        issues("V06", known.where(fault.isNotNull()), at, "steps", key),
        issues("V07", known.where(~undetermined), at, "undetermined reason", key),
        issues("V08", known.where(~spec), at, "spec items", key),
        issues("V09", spans.where("found.reason is not null"), at, "quote", key),
        issues("V12", bare, where, "no annotation", key),
    ])


def quality_grade(warnings: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """COMPLETE unless a document has a warning that is more than informational."""
    partial = warnings.groupBy(key).agg(F.bool_or(~F.col("code").isin(*INFORMATIONAL)).alias("partial"))
    return documents.select(key).distinct().join(partial, key, "left").select(key, F.when(F.coalesce("partial", F.lit(False)), "PARTIAL").otherwise("COMPLETE").alias("quality"))


# Domains of a document's own labels.
DOCUMENT_VERSION = "1.2.0"


def response_gate(responses: DataFrame, version: str = DOCUMENT_VERSION) -> DataFrame:
    """V00 for what isn't JSON, V01 for another version or request. responses: request_id, response (string)."""
    key = ["request_id"]
    parsed = responses.withColumn("v", F.try_parse_json("response"))
    get = lambda name: F.try_variant_get(F.col("v"), f"$.{name}", "string")
    known = parsed.where("v is not null")
    return union([
        issues("V00", parsed.where("v is null"), F.lit("$"), "not JSON", key),
        issues("V01", known.where(~get("schema_version").eqNullSafe(F.lit(version))), F.lit("schema_version"), "version", key),
        issues("V01", known.where(get("schema_version").eqNullSafe(F.lit(version)) & ~get("request_id").eqNullSafe(F.col("request_id"))), F.lit("request_id"), "another request", key),
    ])


def cell_issues(spans: DataFrame, cells: DataFrame, headers: DataFrame, key: list[str]) -> DataFrame:
    """V10: a span's cell is out of range, inherited, or neither of its row nor of a header row.

    spans: key, unit_row, row, col. cells: key, row, col, from_row (null unless inherited). headers: key, row.
    """
    at = F.concat_ws(",", F.col("row").cast("string"), F.col("col").cast("string"))
    there = spans.join(cells.select(*key, "row", "col", "from_row", F.lit(True).alias("there")), [*key, "row", "col"], "left")
    head = headers.select(*key, "row", F.lit(True).alias("head"))
    judged = there.join(head, [*key, "row"], "left")
    return union([
        issues("V10", judged.where("there is null"), at, "cell out of range", key),
        issues("V10", judged.where("from_row is not null"), at, "cell inherited", key),
        issues("V10", judged.where((F.col("row") != F.col("unit_row")) & F.col("head").isNull() & F.col("there").isNotNull()), at, "cell of another row", key),
    ])


def table_issues(rows: DataFrame, tables: DataFrame, key: list[str]) -> DataFrame:
    """V11: every row exactly once, known roles, body rows labelled. rows: key, row, role, n_annotations; tables: key, n_rows."""
    listed = rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.col("row").cast("int"))).alias("listed"))
    wanted = F.when(F.col("n_rows") > 0, F.sequence(F.lit(0), F.col("n_rows").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    compared = tables.join(listed, key, "left")
    return union([
        issues("V11", compared.where(~F.col("listed").eqNullSafe(wanted)), F.lit("rows"), "rows", key),
        issues("V11", rows.where(~F.coalesce(F.col("role").isin(*ROW_ROLES), F.lit(False))), F.col("row").cast("string"), "role", key),
        issues("V11", rows.where((F.col("role") == "body") & (F.col("n_annotations") == 0)), F.col("row").cast("string"), "body row without annotation", key),
    ])


def context_issues(contexts: DataFrame, blocks: DataFrame, key: list[str]) -> DataFrame:
    """V13: context ids that the document doesn't have. contexts: key, document_id, context_id; blocks: document_id, block_id."""
    known = blocks.select("document_id", F.col("block_id").alias("context_id")).distinct()
    return issues("V13", contexts.join(known, ["document_id", "context_id"], "left_anti"), F.col("context_id"), "context", key)


def document_issues(labels: DataFrame, texts: DataFrame, types: tuple[str, ...], topics: tuple[str, ...]) -> DataFrame:
    """D01: type, topics, reason and evidence. labels: document_id, type, topics, outline_reason, block_id, quote, occurrence."""
    key = ["document_id"]
    right = texts.select("document_id", "block_id", F.col("text").alias("t_text"))
    spans = labels.join(right, ["document_id", "block_id"], "left").withColumn("found", locate(F.coalesce("t_text", F.lit("")), F.col("quote"), F.col("occurrence")))
    return union([
        issues("D01", labels.where(~F.coalesce(F.col("type").isin(*types), F.lit(False))), F.lit("type"), "type", key),
        issues("D01", labels.where(F.size(F.array_except("topics", F.array(*[F.lit(t) for t in topics]))) > 0), F.lit("topics"), "topics", key),
        issues("D01", labels.where(F.trim(F.coalesce("outline_reason", F.lit(""))) == ""), F.lit("outline_reason"), "reason", key),
        issues("D01", spans.where("t_text is null or found.reason is not null"), F.lit("evidence"), "evidence", key),
    ])
