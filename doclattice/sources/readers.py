"""Sources and sinks: files, parsed documents, manifests, catalogues; and the line view of a documents table."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = "1.2.0"
BLOCK = "id string, page int, kind string, text string, source_text string, bbox array<double>, section_id string, parent_id string, rows array<array<string>>, cells array<struct<row:int,col:int,rowspan:int,colspan:int>>, excluded_from_retrieval boolean, requires_vision boolean"
PARSED = (
    "schema_version string, document struct<document_id:string,filename:string,sha256:string,page_count:int>, sections array<struct<section_id:string,head_block_id:string,head_text:string>>, "
    f"blocks array<struct<{', '.join(':'.join(c.split(' ', 1)) for c in BLOCK.split(', '))}>>, warnings array<struct<code:string,page:int,bbox:array<double>,detail:string>>, _corrupt string"
)
GLYPHS = "doc string, page int, block_no int, line_no int, span_no int, ch string, x0 double, y0 double, x1 double, y1 double, size double, color int, flags int"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(documents: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), text."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text")).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "text")


def leveled(rows: DataFrame) -> DataFrame:
    """lines with a level 1..6 or none."""
    x = (F.col("doc_id") * 7 + F.col("line_no") * 13) % 9
    return rows.withColumn("level", F.when(x < 6, x + 1).cast("int"))


def boxed(rows: DataFrame) -> DataFrame:
    """lines with a page and a box."""
    y0 = (F.col("line_no") * 12).cast("double")
    return rows.select("*", F.lit(50.0).alias("x0"), y0.alias("y0"), (F.lit(50.0) + 5 * F.length("text")).alias("x1"), (y0 + 10).alias("y1"), (F.floor(F.col("line_no") / 40) + 1).cast("int").alias("page"))


def pdf_files(spark: SparkSession, path: str, pattern: str = "*.pdf", most_bytes: int = 20_000_000) -> DataFrame:
    """document_id, path, length, sha256, error_code of every file; content stays in the reader's row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    sha = F.sha2("content", 256)
    fault = F.when(F.col("length") > most_bytes, "FILE_TOO_LARGE").when(F.substring("content", 1, 5) != F.lit(b"%PDF-"), "UNSUPPORTED_MEDIA_TYPE")
    return files.select(F.concat(F.lit("doc_"), F.substring(sha, 1, 16)).alias("document_id"), "path", "length", sha.alias("sha256"), fault.alias("error_code"))


def parsed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Parsed documents as written by stage A, sparse arrays read as empty; other versions and broken files are marked."""
    raw = spark.read.schema(PARSED).option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    bad = F.when(F.col("_corrupt").isNotNull(), "MALFORMED_JSON").when(~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION)), "SCHEMA_VERSION")
    return raw.select("document", F.coalesce("sections", F.array()).alias("sections"), F.coalesce("blocks", F.array()).alias("blocks"), F.coalesce("warnings", F.array()).alias("warnings"), bad.alias("error_code"))


def blocks(parsed: DataFrame) -> DataFrame:
    """Blocks in document order, defaults applied."""
    each = parsed.select(F.col("document.document_id").alias("document_id"), F.posexplode("blocks").alias("seq", "b")).select("document_id", "seq", "b.*")
    no = F.lit(False)
    return each.withColumn("excluded_from_retrieval", F.coalesce("excluded_from_retrieval", no)).withColumn("requires_vision", F.coalesce("requires_vision", no)).withColumn("rows", F.coalesce("rows", F.array()))


def split_files(spark: SparkSession, manifest: str, split: str, root: str) -> DataFrame:
    """Parsed paths of a split's files. manifest: {"groups": [{"group_id", "split", "files": [...]}]}."""
    schema = "groups array<struct<group_id:string,split:string,files:array<string>>>"
    each = spark.read.schema(schema).option("multiLine", "true").json(manifest).select(F.explode("groups").alias("g")).where(F.col("g.split") == split)
    files = each.select("g.group_id", F.explode("g.files").alias("file"))
    return files.select("group_id", F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace("file", r"\.pdf$", ".json")).alias("path"))


def catalogue(spark: SparkSession, path: str, names: tuple[str, ...] = ("moves", "sections", "rules")) -> DataFrame:
    """A YAML catalogue's entries as (name, body JSON); a file of another name is refused."""
    import json

    if Path(path).stem not in names:
        raise ValueError(f"unknown catalogue {Path(path).stem!r}; known: {', '.join(names)}")
    content = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    entries = content.items() if isinstance(content, dict) else enumerate(content)
    return spark.createDataFrame([(str(k), json.dumps(v, ensure_ascii=False, sort_keys=True, default=str)) for k, v in entries], "name string, body string")


def write_documents(rows: DataFrame, path: str, partition: str | None = None, replace: bool = False) -> None:
    """One commit for all rows; what is there is refused, or with replace overwritten by partition."""
    writer = rows.write.mode("overwrite" if replace else "errorifexists").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
