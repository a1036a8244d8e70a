"""A review workspace as tables: frozen requests and labels are used only while they still fit the documents they were made from."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclattice.operators.snapshots import unbound

# Names that a path may be made of.
NAME = re.compile(r"^[A-Za-z0-9_.-]{1,40}$")


def safe_path(root: str, *names: str) -> str:
    """A path below root, of restricted names only."""
    bad = [n for n in names if not NAME.match(n) or set(n) == {"."}]
    if bad:
        raise ValueError(f"not a name: {bad[0]!r}")
    return "/".join([root.rstrip("/"), *names])


def stale_requests(requests: DataFrame, identity: DataFrame) -> DataFrame:
    """Requests (document_id, request_id, parsed_sha256) whose document is unknown or has another content hash now."""
    now = identity.select("document_id", F.col("parsed_content_sha256").alias("now"))
    both = requests.join(now, "document_id", "left")
    return both.where(~F.col("parsed_sha256").eqNullSafe(F.col("now"))).select(*requests.columns)


def moved_targets(requests: DataFrame, blocks: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """document_id, block_id, side: targets that only the frozen requests (targets: array of block ids) or only the current classes have.
    sections: those that were chosen (document_id, section_id); of documents that aren't listed there, all are."""
    frozen = requests.select("document_id", F.explode("targets").alias("block_id")).distinct()
    now = blocks.where(F.col("class").isin("target", "table")).join(requests.select("document_id").distinct(), "document_id", "left_semi")
    if sections is not None:
        listed = sections.select("document_id").distinct()
        chosen = now.join(sections.select("document_id", "section_id"), ["document_id", "section_id"], "left_semi")
        now = chosen.unionByName(now.join(listed, "document_id", "left_anti"))
    on = ["document_id", "block_id"]
    now = now.select(*on).distinct()
    gone = frozen.join(now, on, "left_anti").withColumn("side", F.lit("frozen"))
    return gone.unionByName(now.join(frozen, on, "left_anti").withColumn("side", F.lit("current")))


def save_labels(labels: DataFrame, sources: DataFrame, root: str, annotator: str) -> None:
    """Write an annotator's labels under a restricted name; refused if any label's references don't fit the frozen documents."""
    path = safe_path(root, "labels", annotator)
    wrong = unbound(labels.select(*sources.columns), sources).limit(1).collect()
    if wrong:
        raise ValueError(f"label of {wrong[0].document_id}/{wrong[0].block_id} doesn't fit its document")
    labels.write.mode("errorifexists").parquet(path)
