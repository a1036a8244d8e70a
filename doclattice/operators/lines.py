"""Operators over lines: running heads, shadows, body size, title, boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclattice.functions.text import digit_template

RUNNING_SHARE, BAND = 0.6, 0.10
DX, DY = 6.0, 0.01


def running_templates(lines: DataFrame, group: list[str], page: str, least: Column, text: str = "text") -> DataFrame:
    """Texts (digits as #) that at least `least` different pages of a group have."""
    template = lines.where(F.trim(F.col(text)) != "").select(*group, page, digit_template(F.col(text)).alias("template"))
    return template.groupBy(*group, "template").agg(F.countDistinct(page).alias("n_pages"), F.count("*").alias("n_lines")).where(F.col("n_pages") >= least)


def running_share(pages: Column) -> Column:
    """How many pages make a text a running one."""
    return F.greatest(F.lit(2), F.ceil(pages * RUNNING_SHARE))


def edge_position(y0: Column, y1: Column, height: Column, band: float = BAND) -> Column:
    """header, footer or null by the vertical band that the box is in."""
    return F.when(y1 <= height * band, "header").when(y0 >= height * (1 - band), "footer")


def drop_shadows(lines: DataFrame, page: list[str]) -> DataFrame:
    """Light lines go where a darker, longer line of the page contains their text and covers over half of them."""
    dark = lines.where("not is_light").select(*page, F.col("text").alias("d_text"), *(F.col(c).alias(f"d_{c}") for c in ("x0", "y0", "x1", "y1")))
    light = lines.where("is_light")
    cover = overlap_ratio([F.col(c) for c in ("x0", "y0", "x1", "y1")], [F.col(f"d_{c}") for c in ("x0", "y0", "x1", "y1")])
    shadow = F.contains("d_text", "text") & (F.length("d_text") > F.length("text")) & (cover > 0.5)
    on = [light[c] == dark[c] for c in page]
    kept = light.join(dark, [*on, shadow], "left_anti")
    return lines.where("not is_light").unionByName(kept)


def overlap_ratio(a: list[Column], b: list[Column]) -> Column:
    """Intersection over the smaller area; 0 for an empty box."""
    area = lambda box: (box[2] - box[0]) * (box[3] - box[1])
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    smaller = F.least(area(a), area(b))
    return F.when(smaller > 0, w * h / smaller).otherwise(0.0)


def y_overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    height = F.least(a1 - a0, b1 - b0)
    return F.when(height > 0, F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0.0)) / height).otherwise(0.0)


def body_size(lines: DataFrame, key: list[str], size: str = "size", text: str = "text", seq: str = "line_no") -> DataFrame:
    """The size (to 0.1) that most non-space characters have; on ties the one met first."""
    weight = F.length(F.regexp_replace(text, r"(?U)\s", ""))
    by_size = lines.select(*key, F.bround(F.col(size), 1).alias("size"), weight.alias("w"), F.col(seq).alias("seq")).groupBy(*key, "size").agg(F.sum("w").alias("w"), F.min("seq").alias("seq"))
    return by_size.groupBy(*key).agg(F.max_by("size", F.struct("w", -F.col("seq"))).alias("body_size"))


def title_line(lines: DataFrame, key: list[str], seq: str = "line_no") -> DataFrame:
    """Of each group the largest line of 5 to 100 characters that is at least 1.2 times the median size; then the longest, the first."""
    median = lines.groupBy(*key).agg(F.median("size").alias("median"))
    fit = lines.join(median, key).where((F.col("size") >= 1.2 * F.col("median")) & F.length("text").between(5, 100))
    return fit.groupBy(*key).agg(F.max_by(F.struct(F.col(seq).alias("seq"), F.col("text").alias("title")), F.struct(F.bround(F.col("size"), 1), F.length("text"), -F.col(seq))).alias("t")).select(*key, "t.seq", "t.title")


def assign_to_cells(words: DataFrame, cells: DataFrame, page: list[str], bin_height: float = 50.0) -> DataFrame:
    """Each word goes to the cell that holds its centre; of several to the one it overlaps most, then the first.

    Cells are cut into horizontal bins and words looked up in their own bin: an equi-join instead of all pairs of a page.
    """
    binned = cells.select(*page, F.col("cell"), *(F.col(c).alias(f"c_{c}") for c in ("x0", "y0", "x1", "y1"))).withColumn("bin", F.explode(F.sequence(F.floor(F.col("c_y0") / bin_height), F.floor(F.col("c_y1") / bin_height))))
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    placed = words.withColumn("bin", F.floor(cy / bin_height)).join(binned, [*page, "bin"]).where(cx.between(F.col("c_x0"), F.col("c_x1")) & cy.between(F.col("c_y0"), F.col("c_y1")))
    share = overlap_ratio([F.col(c) for c in ("x0", "y0", "x1", "y1")], [F.col(f"c_{c}") for c in ("x0", "y0", "x1", "y1")])
    return placed.groupBy(*page, "word").agg(F.max_by("cell", F.struct(F.round(share, 9), -F.col("cell"))).alias("cell"))


def nearest_in_order(rows: DataFrame, is_node: Column, page: list[str], at: str, ident: str) -> DataFrame:
    """node: the nearest node of the page along one axis (the earlier on ties), from one sort: the last before and the first after."""
    node = F.when(is_node, F.struct(F.col(at).alias("at"), F.col(ident).alias("id")))
    w = Window.partitionBy(*page).orderBy(at, ident)
    before = F.last(node, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(node, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    out = rows.withColumn("__b", before).withColumn("__a", after)
    closer = F.col("__b").isNull() | ((F.col("__a.at") - F.col(at)) < (F.col(at) - F.col("__b.at")))
    return out.withColumn("node", F.when(F.col("__a").isNotNull() & closer, F.col("__a.id")).otherwise(F.col("__b.id"))).where(~is_node).drop("__a", "__b")


def islands(rows: DataFrame, key: list[str], order: str, same: Column) -> DataFrame:
    """island: number of the run a row is in; a run ends where `same` (against the row before) is not true."""
    w = Window.partitionBy(*key).orderBy(order)
    return rows.withColumn("__new", F.when(same, 0).otherwise(1)).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def merge_intervals(rows: DataFrame, key: list[str], start: str, end: str, gap: float) -> DataFrame:
    """Intervals that lie within gap of what came before them become one."""
    w = Window.partitionBy(*key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    numbered = rows.withColumn("__reach", reach).withColumn("__new", F.when(F.col(start) - F.col("__reach") <= gap, 0).otherwise(1))
    numbered = numbered.withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"))
