"""Which blocks are labelled, and how they are packed into requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclattice.operators.lines import islands

CHUNK_UNITS, NEIGHBOURS, FULL_TEXT = 40, 3, 15_000
# Kinds of blocks that hold text to label.
TEXT_KINDS = ("item", "para", "note", "attachment", "heading")


def block_class(kind: Column, excluded: Column, annex: Column, vision: Column, n_rows: Column, warnings: Column, blank: Column) -> Column:
    """(class, reason); the order of the tests counts. warnings: sorted codes of the table's structure, or null."""
    said = lambda c, r=None: F.struct(F.lit(c).alias("class"), (r if isinstance(r, Column) else F.lit(r).cast("string")).alias("reason"))
    table = (
        F.when(annex, said("not_targeted", "annex_table")).when(vision, said("unreadable", "requires_vision")).when(n_rows == 0, said("unreadable", "no_rows"))
        .when(F.size(warnings) > 0, said("unreadable", F.concat(F.lit("table_structure_warning:"), F.array_join(warnings, ",")))).otherwise(said("table"))
    )
    text = F.when(blank, said("context", "empty_text")).otherwise(said("target"))
    return F.when(excluded, said("excluded")).when(kind == "table", table).when(kind.isin(*TEXT_KINDS), text).when(kind == "document_title", said("context")).otherwise(said("excluded"))


def title_like(kind: Column, text: Column, has_children: Column, in_lexicon: Column, sentence: str = r"(?:\.|다)$") -> Column:
    """A heading, or a short parent item: at most 15 characters, no colon, no sentence, and at most 6 or a lexicon word."""
    short = (F.length(text) <= 15) & ~F.contains(text, F.lit(":")) & ~F.rlike(text, F.lit(sentence)) & ((F.length(text) <= 6) | in_lexicon)
    return F.when(kind == "heading", True).otherwise((kind == "item") & has_children & short)


def unit_count(kind: Column, n_rows: Column) -> Column:
    return F.when(kind == "table", n_rows).otherwise(1)


def pack(rows: DataFrame, key: list[str], order: str, section: str, units: str, limit: int = CHUNK_UNITS) -> DataFrame:
    """chunk (from 0) of each row, in order: whole runs of a section while the sum is within limit; a run that is too
    large alone is cut between rows; a row is never cut.

    Runs come from one window; packing is a fold over a document's rows, in its own array, without Python.
    """
    run = F.col(section).eqNullSafe(F.lag(section).over(Window.partitionBy(*key).orderBy(order))) & (F.row_number().over(Window.partitionBy(*key).orderBy(order)) > 1)
    numbered = islands(rows, key, order, run)
    whole = numbered.groupBy(*key, "island").agg(F.sum(units).cast("long").alias("total"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("seq"), F.col(units).cast("long").alias("u")))).alias("rows"))
    doc = whole.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("island", "total", "rows"))).alias("runs"))
    # chunk: the last one opened; load: its units; open: whether more may join it. A run that was cut closes its last chunk.
    state = lambda chunk, load, is_open, out: F.struct(chunk.cast("long").alias("chunk"), load.cast("long").alias("load"), is_open.alias("open"), out.alias("out"))
    zero = state(F.lit(-1), F.lit(0), F.lit(False), F.array().cast("array<struct<seq:bigint,chunk:bigint>>"))
    row = lambda seq, chunk: F.struct(seq.cast("long").alias("seq"), chunk.cast("long").alias("chunk"))

    def one(acc: Column, r: Column) -> Column:
        fits = acc["open"] & (acc["load"] + r["u"] <= limit)
        chunk = F.when(fits, acc["chunk"]).otherwise(acc["chunk"] + 1)
        return state(chunk, F.when(fits, acc["load"] + r["u"]).otherwise(r["u"]), F.lit(True), F.concat(acc["out"], F.array(row(r["seq"], chunk))))

    def many(acc: Column, run: Column) -> Column:
        fits = acc["open"] & (acc["load"] + run["total"] <= limit)
        chunk = F.when(fits, acc["chunk"]).otherwise(acc["chunk"] + 1)
        whole = state(chunk, F.when(fits, acc["load"] + run["total"]).otherwise(run["total"]), F.lit(True), F.concat(acc["out"], F.transform(run["rows"], lambda r: row(r["seq"], chunk))))
        cut = F.aggregate(run["rows"], state(acc["chunk"], F.lit(0), F.lit(False), acc["out"]), one, lambda end: state(end["chunk"], F.lit(0), F.lit(False), end["out"]))
        return F.when(run["total"] > limit, cut).otherwise(whole)

    return doc.select(*key, F.explode(F.aggregate("runs", zero, many, lambda acc: acc["out"])).alias("x")).select(*key, F.col("x.seq").alias(order), "x.chunk")


def neighbours(rows: DataFrame, key: list[str], order: str, chunk: str = "chunk", reach: int = NEIGHBOURS) -> DataFrame:
    """(key, chunk, order): rows within reach of a chunk's rows that aren't in it. Rows are matched by their place, in an equi-join."""
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    near = placed.select(*key, F.col(chunk).alias("for"), F.explode(F.sequence(F.col("place") - reach, F.col("place") + reach)).alias("place")).distinct()
    return near.join(placed, [*key, "place"]).where(F.col("for") != F.col(chunk)).select(*key, F.col("for").alias("chunk"), order)


def document_text(blocks: DataFrame, key: list[str], ident: str, order: str, text: str = "text") -> DataFrame:
    """'[id] text' lines of a document, in order."""
    shown = F.concat(F.lit("["), F.col(ident).cast("string"), F.lit("] "), F.coalesce(text, F.lit("")))
    return blocks.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), shown.alias("t")))), lambda s: s["t"]), "\n").alias("document_text"))


def greedy_take(rows: DataFrame, key: list[str], order: list[Column], units: str, limit: int) -> DataFrame:
    """Of each group, in order, every row that still fits: taken (boolean). A fold over the group's own array."""
    listed = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(units).cast("long").alias("u")))).alias("rows"))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("n"))
    take = lambda acc, r: F.when(acc["sum"] + r["u"] <= limit, F.struct((acc["sum"] + r["u"]).alias("sum"), (acc["n"] + 1).cast("long").alias("n"))).otherwise(acc)
    return listed.select(*key, F.aggregate("rows", zero, take).alias("t")).select(*key, F.col("t.sum").alias("taken_units"), F.col("t.n").alias("taken"))
