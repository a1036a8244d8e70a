"""Table grids: cells, merged cells, pruning, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclattice.functions.text import bound


def pipe_cells(lines: DataFrame, key: list[str]) -> DataFrame:
    """Cells of lines that have pipes: (key, col, cell), trimmed."""
    cut = lines.where(F.contains("text", F.lit("|"))).select(*key, F.posexplode(F.split("text", r"\|")).alias("col", "cell"))
    return cut.select(*key, "col", F.trim("cell").alias("cell"))


def padded(rows: Column) -> Column:
    """Ragged rows with empty cells at their ends."""
    return bound(F.array_max(F.transform(rows, lambda r: F.size(r))), lambda width: F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))


def _full(cell: Column) -> Column:
    return F.coalesce(cell, F.lit("")) != ""


def prune(rows: Column) -> Column:
    """Without rows and columns that are empty all through."""
    columns = lambda full: F.filter(F.sequence(F.lit(1), F.greatest(F.size(F.get(full, F.lit(0))), F.lit(1))), lambda j: F.exists(full, lambda r: _full(F.get(r, j - 1))))
    kept = lambda full, cols: F.transform(F.filter(full, lambda r: F.exists(r, _full)), lambda r: F.transform(cols, lambda j: F.get(r, j - 1)))
    return bound(padded(rows), lambda full: bound(columns(full), lambda cols: kept(full, cols)))


def is_ghost(rows: Column) -> Column:
    """Over three quarters empty and over eight columns wide."""
    return bound(padded(rows), lambda full: (F.size(F.filter(F.flatten(full), lambda c: ~_full(c))) > 0.75 * F.size(F.flatten(full))) & (F.size(F.get(full, F.lit(0))) > 8))


def slots(cells: DataFrame, key: list[str]) -> DataFrame:
    """The grid slots that each cell covers."""
    down = cells.withColumn("r", F.explode(F.sequence(F.col("row"), F.col("row") + F.col("rowspan") - 1)))
    return down.withColumn("c", F.explode(F.sequence(F.col("col"), F.col("col") + F.col("colspan") - 1)))


def filled(cells: DataFrame, texts: DataFrame, key: list[str]) -> DataFrame:
    """Texts by slot; an empty slot that a merged cell covers takes the text of the cell's origin. Later cells win."""
    origin = slots(cells, key).groupBy(*key, "r", "c").agg(F.max_by(F.struct("row", "col"), "seq").alias("from"))
    source = texts.select(*key, F.col("row").alias("o_row"), F.col("col").alias("o_col"), F.col("text").alias("o_text"))
    joined = (
        texts.join(origin.withColumnsRenamed({"r": "row", "c": "col"}), [*key, "row", "col"], "left")
        .withColumn("o_row", F.col("from.row")).withColumn("o_col", F.col("from.col")).join(source, [*key, "o_row", "o_col"], "left")
    )
    inherits = (F.coalesce("text", F.lit("")) == "") & F.col("from").isNotNull() & ~((F.col("o_row") == F.col("row")) & (F.col("o_col") == F.col("col")))
    return joined.select(*key, "row", "col", F.when(inherits, F.coalesce("o_text", F.lit(""))).otherwise(F.coalesce("text", F.lit(""))).alias("text"), F.when(inherits, F.col("o_row")).alias("from_row"), F.when(inherits, F.col("o_col")).alias("from_col"))


def cell_faults(cells: DataFrame, key: list[str], n_rows: str = "n_rows", n_cols: str = "n_cols") -> DataFrame:
    """Cells out of bounds, without extent, or sharing a slot: (key, row, col, fault)."""
    bad = (F.col("row") < 0) | (F.col("col") < 0) | (F.col("rowspan") < 1) | (F.col("colspan") < 1)
    outside = bad | (F.col("row") + F.col("rowspan") > F.col(n_rows)) | (F.col("col") + F.col("colspan") > F.col(n_cols))
    bounds = cells.where(outside).select(*key, "row", "col", F.lit("bounds").alias("fault"))
    shared = slots(cells.where(~bad), key).groupBy(*key, "r", "c").agg(F.count("*").alias("n")).where("n > 1").select(*key, F.col("r").alias("row"), F.col("c").alias("col"), F.lit("overlap").alias("fault"))
    return bounds.unionByName(shared)
