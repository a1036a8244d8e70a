"""Requests to a labeler, and the documents assembled from its answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclattice.functions.text import canonical_sha256, locate, starts
from doclattice.operators import targets


def with_request_id(requests: DataFrame, *columns: str) -> DataFrame:
    """request_id: hash of the canonical JSON of the columns, so an equal request has an equal id wherever it is made."""
    return requests.withColumn("request_id", canonical_sha256(F.to_json(F.struct(*columns))))


def document_requests(blocks: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """One request a document, over the text of its blocks that aren't excluded. blocks: document_id, block_id, seq, text, class."""
    text = targets.document_text(blocks.where("class <> 'excluded'"), ["document_id"], "block_id", "seq")
    if titles is not None:
        text = text.join(titles.select("document_id", "title"), "document_id", "left")
    return with_request_id(text, *text.columns)


def block_requests(blocks: DataFrame, limit: int = targets.CHUNK_UNITS, full: int = targets.FULL_TEXT) -> DataFrame:
    """One request a chunk of targets, with the whole document as context if it is short, or else the chunk's surroundings.

    blocks: document_id, block_id, seq, section_id, text, units, class.
    """
    key = ["document_id"]
    wanted = blocks.where(F.col("class").isin("target", "table"))
    chunk = targets.pack(wanted, key, "seq", "section_id", "units", limit)
    asked = chunk.join(blocks, [*key, "seq"]).groupBy(*key, "chunk").agg(F.array_sort(F.collect_list(F.struct("seq", "block_id", "text"))).alias("targets"))
    text = targets.document_text(blocks.where("class <> 'excluded'"), key, "block_id", "seq")
    shown = blocks.where("class <> 'excluded'").join(chunk, [*key, "seq"], "left").withColumn("chunk", F.coalesce("chunk", F.lit(-1)))
    near = targets.neighbours(shown, key, "seq").where("chunk >= 0").join(blocks.select(*key, "seq", "block_id", "text"), [*key, "seq"])
    near = near.groupBy(*key, "chunk").agg(F.array_sort(F.collect_list(F.struct("seq", "block_id", "text"))).alias("around"))
    joined = asked.join(text, key).join(near, [*key, "chunk"], "left")
    local = F.array_join(F.transform("around", lambda x: F.concat(F.lit("["), x["block_id"], F.lit("] "), F.coalesce(x["text"], F.lit("")))), "\n")
    whole = F.length("document_text") <= full
    out = joined.select(*key, "chunk", "targets", F.when(whole, F.col("document_text")).otherwise(F.coalesce(local, F.lit(""))).alias("context"), F.when(whole, "document").otherwise("local").alias("context_kind"))
    return with_request_id(out, *out.columns)


def widened(requests: DataFrame, texts: DataFrame) -> DataFrame:
    """The same targets with the whole document as context. texts: document_id, document_text."""
    out = requests.drop("request_id", "context", "context_kind").join(texts.select("document_id", F.col("document_text").alias("context")), "document_id").withColumn("context_kind", F.lit("document"))
    return with_request_id(out, *out.columns)


def resolved_spans(annotations: DataFrame, texts: DataFrame) -> DataFrame:
    """Annotations with start and end of their quote in the block's (or cell's) text; those that can't be found have a reason."""
    key = [c for c in ("document_id", "block_id", "row", "col") if c in annotations.columns and c in texts.columns]
    right = texts.select(*[F.col(c).alias(f"t_{c}") for c in key], F.col("text").alias("t_text"))
    joined = annotations.join(right, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in key], "left")
    found = locate(F.coalesce("t_text", F.lit("")), F.col("quote"), F.col("occurrence"))
    return joined.withColumn("found", found).select(*annotations.columns, "found.start", "found.end", "found.reason")


def occurrence_number(text: Column, quote: Column, start: Column) -> Column:
    """Which occurrence (from 1) begins at start; null where none does. It undoes locate()."""
    at = F.array_position(starts(text, quote), start.cast("int"))
    return F.when(at > 0, at).cast("int")


def assembled(documents: DataFrame, labels: DataFrame, failed: DataFrame, prefilled: DataFrame) -> DataFrame:
    """One row a document: its labelled blocks in order (answers, and tables that weren't asked about), and failed units.

    labels and prefilled: document_id, block_id, seq, label (string); failed: document_id, block_id, codes.
    """
    key = ["document_id"]
    blocks = labels.select(*key, "block_id", "seq", "label").unionByName(prefilled.select(*key, "block_id", "seq", "label"))
    blocks = blocks.join(failed.select(*key, "block_id"), [*key, "block_id"], "left_anti")
    listed = blocks.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("seq", "block_id", "label"))).alias("blocks"))
    lost = failed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("block_id", "codes"))).alias("failed_units"))
    empty_b, empty_f = F.array().cast("array<struct<seq:bigint,block_id:string,label:string>>"), F.array().cast("array<struct<block_id:string,codes:array<string>>>")
    return documents.select(*key).distinct().join(listed, key, "left").join(lost, key, "left").select(*key, F.coalesce("blocks", empty_b).alias("blocks"), F.coalesce("failed_units", empty_f).alias("failed_units"))


def replace_contained(blocks: DataFrame, regions: DataFrame, page: list[str], kind: str = "approval") -> DataFrame:
    """Blocks whose centre lies in a region become one block of the region, if all that touch it lie in it."""
    names = ("x0", "y0", "x1", "y1")
    area = regions.select(*page, "region", *(F.col(c).alias(f"r_{c}") for c in names))
    touches = (F.col("x0") < F.col("r_x1")) & (F.col("r_x0") < F.col("x1")) & (F.col("y0") < F.col("r_y1")) & (F.col("r_y0") < F.col("y1"))
    middle = ((F.col("x0") + F.col("x1")) / 2).between(F.col("r_x0"), F.col("r_x1")) & ((F.col("y0") + F.col("y1")) / 2).between(F.col("r_y0"), F.col("r_y1"))
    met = blocks.join(area, page).where(touches)
    whole = met.groupBy(*page, "region").agg(F.bool_and(middle).alias("all"), F.min("seq").alias("seq")).where("all")
    gone = met.join(whole.select(*page, "region"), [*page, "region"], "left_semi").select(*page, "block_id").distinct()
    made = whole.join(area, [*page, "region"]).select(*page, F.concat(F.lit("region-"), F.col("region").cast("string")).alias("block_id"), "seq", F.lit(kind).alias("kind"), *(F.col(f"r_{c}").alias(c) for c in names))
    return blocks.join(gone, [*page, "block_id"], "left_anti").select(*page, "block_id", "seq", "kind", *names).unionByName(made)


def structure_warnings(tables: DataFrame, warnings: DataFrame, page: list[str], codes: tuple[str, ...] = ("table_grid_sparse", "table_geometry_ambiguous", "table_background_grid_split")) -> DataFrame:
    """Sorted codes of the warnings about a table's structure: those of its page whose box is the table's, within a point."""
    names = ("x0", "y0", "x1", "y1")
    told = warnings.where(F.col("code").isin(*codes)).select(*page, "code", *(F.col(c).alias(f"w_{c}") for c in names))
    same = (F.abs(F.col("x0") - F.col("w_x0")) <= 1) & (F.abs(F.col("y0") - F.col("w_y0")) <= 1) & (F.abs(F.col("x1") - F.col("w_x1")) <= 1) & (F.abs(F.col("y1") - F.col("w_y1")) <= 1)
    return tables.join(told, page).where(same).groupBy(*page, "block_id").agg(F.sort_array(F.collect_set("code")).alias("codes"))


def source_scope(url: Column, host: str, prefix: str, key: Column) -> Column:
    """Null for an https URL of exactly this host whose decoded path is the object key below prefix; else what is wrong."""
    path = F.try_url_decode(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    return (
        F.when(~F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")) == "https", F.lit(False)), "scheme").when(~F.coalesce(F.try_parse_url(url, F.lit("HOST")) == host, F.lit(False)), "host")
        .when(F.try_parse_url(url, F.lit("USERINFO")).isNotNull(), "userinfo").when(F.try_parse_url(url, F.lit("REF")).isNotNull(), "fragment")
        .when(F.rlike(path, F.lit(r"(^|/)\.\.?(/|$)")), "traversal").when(~F.coalesce((path == F.concat(F.lit("/"), key)) & F.startswith(key, F.lit(prefix)), F.lit(False)), "path")
    )
