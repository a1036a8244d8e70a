"""Operators over drawings: rules, dashes, strips, ruled cells, approval forms, diagrams, underlines, figures.

Segments are rows; sorted windows find what lies side by side, and equi-joins on a binned coordinate replace
all-pairs tests within a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclattice.operators.lines import overlap_ratio

RULE_GAP, RULE_LENGTH, SAME_Y = 2.0, 40.0, 1.0
DASH_GAP, DASHES, DASH_LENGTH, DASH_COVER = (0.05, 2.0), 8, 12.0, (0.15, 0.85)
STRIP_RUN, STRIP_COLORS, STRIP_WIDTH = 10, 3, 15.0
BAR = 1.5
NEIGHBOUR = 1.0
FIGURE, FIGURE_VISION = 8.0, 0.02
SCAN_COVER, OUTLINE_DRAWINGS = 0.7, 50


def thin_bar(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """v or h for a filled box thin enough to be a rule."""
    w, h = x1 - x0, y1 - y0
    return F.when((w <= BAR) & (h > 4 * w), "v").when((h <= BAR) & (w > 4 * h), "h")


def _anchored(rows: DataFrame, key: list[str], value: str, width: float, name: str) -> DataFrame:
    """Groups of sorted values that lie within width of their group's first, by a fold over the page's own array."""
    zero = F.struct(F.lit(None).cast("double").alias("first"), F.lit(-1).alias("n"), F.array().cast("array<struct<v:double,g:int>>").alias("out"))

    def step(acc: Column, v: Column) -> Column:
        new = acc["first"].isNull() | (v - acc["first"] > width)
        n = F.when(new, acc["n"] + 1).otherwise(acc["n"])
        return F.struct(F.when(new, v).otherwise(acc["first"]).alias("first"), n.alias("n"), F.concat(acc["out"], F.array(F.struct(v.alias("v"), n.alias("g")))).alias("out"))

    values = rows.groupBy(*key).agg(F.sort_array(F.collect_set(F.col(value).cast("double"))).alias("vs"))
    return values.select(*key, F.explode(F.aggregate("vs", zero, step, lambda a: a["out"])).alias("x")).select(*key, F.col("x.v").alias(value), F.col("x.g").alias(name))


def snapped(rows: DataFrame, key: list[str], value: str, width: float = 1.0) -> DataFrame:
    """snapped: the mean of each group of positions that lie within width of the group's first."""
    groups = _anchored(rows, key, value, width, "g")
    mean = groups.groupBy(*key, "g").agg(F.avg(value).alias("snapped"))
    return rows.join(groups.join(mean, [*key, "g"]).select(*key, value, "snapped"), [*key, value])


def horizontal_rules(segments: DataFrame, page: list[str]) -> DataFrame:
    """Segments on one line (within a point) that touch or nearly touch become one rule; short ones go."""
    rows = segments.join(_anchored(segments, page, "y", SAME_Y, "line"), [*page, "y"])
    w = Window.partitionBy(*page, "line").orderBy("x0", "x1")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = rows.withColumn("reach", reach).withColumn("new", F.when(F.col("x0") - F.col("reach") <= RULE_GAP, 0).otherwise(1)).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*page, "line", "run").agg(F.min("y").alias("y"), F.min("x0").alias("x0"), F.max("x1").alias("x1")).where(F.col("x1") - F.col("x0") > RULE_LENGTH).select(*page, "y", "x0", "x1")


def dashed_lines(segments: DataFrame, page: list[str]) -> DataFrame:
    """Chains of many small, evenly placed dashes of one line: (y, x0, x1, dashes)."""
    w = Window.partitionBy(*page, "y").orderBy("x0")
    gap = F.col("x0") - F.lag("x1").over(w)
    chain = segments.withColumn("new", F.when(gap.between(*DASH_GAP), 0).otherwise(1)).withColumn("chain", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = chain.groupBy(*page, "y", "chain").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.count("*").alias("dashes"), F.sum(F.col("x1") - F.col("x0")).alias("ink"))
    length = F.col("x1") - F.col("x0")
    return out.where((F.col("dashes") >= DASHES) & (length >= DASH_LENGTH) & (F.col("ink") / length).between(*DASH_COVER)).select(*page, "y", "x0", "x1", "dashes")


def gradient_strips(fills: DataFrame, page: list[str]) -> DataFrame:
    """Ids of narrow fills that touch in a run of many with several colours."""
    w = Window.partitionBy(*page, "y0").orderBy("x0")
    run = fills.where(F.col("x1") - F.col("x0") <= STRIP_WIDTH).withColumn("new", F.when(F.abs(F.col("x0") - F.lag("x1").over(w)) <= 0.5, 0).otherwise(1))
    run = run.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    long = run.groupBy(*page, "y0", "run").agg(F.count("*").alias("n"), F.countDistinct("fill").alias("colors")).where((F.col("n") >= STRIP_RUN) & (F.col("colors") >= STRIP_COLORS))
    return run.join(long.select(*page, "y0", "run"), [*page, "y0", "run"], "left_semi").select(*page, "id")


def covered(boxes: DataFrame, containers: DataFrame, page: list[str], share: float = 0.9, bin_height: float = 100.0) -> DataFrame:
    """Boxes of which more than share lies in a container (of the smaller area)."""
    names = ("x0", "y0", "x1", "y1")
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / bin_height), F.floor(F.col(hi) / bin_height)))
    outer = containers.select(*page, *(F.col(c).alias(f"o_{c}") for c in names)).withColumn("bin", bins("o_y0", "o_y1"))
    pairs = boxes.withColumn("bin", bins("y0", "y1")).join(outer, [*page, "bin"])
    return pairs.where(overlap_ratio([F.col(c) for c in names], [F.col(f"o_{c}") for c in names]) > share).select(*boxes.columns).distinct()


def vector_shapes(drawings: DataFrame, tables: DataFrame, page: list[str], least: float = 8.0) -> DataFrame:
    """How many shapes of at least 8 points a page has outside its tables."""
    big = drawings.where(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) >= least)
    return big.join(covered(big, tables, page).select(*page, "id"), [*page, "id"], "left_anti").groupBy(*page).agg(F.count("*").alias("shapes"))


def neighbours(cells: DataFrame, page: list[str], direction: str = "right", tolerance: float = NEIGHBOUR) -> DataFrame:
    """(cell, neighbour): cells whose edges meet within a point and that share some of the edge."""
    near, far, lo, hi = ("x0", "x1", "y0", "y1") if direction == "right" else ("y0", "y1", "x0", "x1")
    slot = lambda c: F.floor(F.col(c) / (2 * tolerance))
    left = cells.select(*page, "cell", F.col(far).alias("edge"), F.col(lo).alias("lo"), F.col(hi).alias("hi")).withColumn("slot", F.explode(F.array(*[slot("edge") + k for k in (-1, 0, 1)])))
    right = cells.select(*page, F.col("cell").alias("neighbour"), F.col(near).alias("edge2"), F.col(lo).alias("lo2"), F.col(hi).alias("hi2")).withColumn("slot", slot("edge2"))
    meets = (F.abs(F.col("edge") - F.col("edge2")) <= tolerance) & (F.least("hi", "hi2") - F.greatest("lo", "lo2") > 0) & (F.col("cell") != F.col("neighbour"))
    return left.join(right, [*page, "slot"]).where(meets).select(*page, "cell", "neighbour").distinct()


def underlined(segments: DataFrame, glyphs: DataFrame, page: list[str], below: float = 3.0, share: float = 0.7) -> DataFrame:
    """Glyphs that a horizontal segment just below them covers by at least 70 percent."""
    slot = lambda c: F.floor(c / below)
    lines = segments.select(*page, F.col("y"), F.col("x0").alias("s0"), F.col("x1").alias("s1")).withColumn("slot", slot(F.col("y")))
    under = glyphs.withColumn("slot", F.explode(F.array(slot(F.col("y1")), slot(F.col("y1")) + 1))).join(lines, [*page, "slot"])
    cover = F.least("x1", "s1") - F.greatest("x0", "s0")
    fits = (F.col("y") - F.col("y1")).between(0, below) & (cover >= share * (F.col("x1") - F.col("x0")))
    return under.where(fits).select(*glyphs.columns).distinct()


def figures(images: DataFrame, page: list[str], area: str = "page_area") -> DataFrame:
    """Images of at least 8 points, copies at one place once, and whether they need to be seen."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    names = ("x0", "y0", "x1", "y1")
    placed = images.where((w >= FIGURE) & (h >= FIGURE)).groupBy(*page, *[F.bround(F.col(c), 1).alias(c) for c in names]).agg(F.min("id").alias("id"), F.first(area).alias(area))
    return placed.withColumn("requires_vision", w * h >= FIGURE_VISION * F.col(area))


def empty_page(image_cover: Column, n_fonts: Column, n_drawings: Column, n_chars: Column) -> Column:
    """Why a page has no text: scanned_page, outlined_text or blank_page; null if it has some."""
    return F.when(n_chars == 0, F.when(image_cover > SCAN_COVER, "scanned_page").when((n_drawings >= OUTLINE_DRAWINGS) & (n_fonts == 0), "outlined_text").otherwise("blank_page"))


def diagram_edges(nodes: DataFrame, region: list[str], order: str, arrows: DataFrame | None = None) -> DataFrame:
    """Edges between consecutive nodes of a diagram; directed only where exactly one arrow is between the two."""
    w = Window.partitionBy(*region).orderBy(order)
    edges = nodes.select(*region, F.col("node").alias("source"), F.lead("node").over(w).alias("target")).where("target is not null")
    if arrows is None:
        return edges.withColumn("type", F.lit("reading_order"))
    single = arrows.groupBy(*region, "source", "target").agg(F.count("*").alias("n"))
    return edges.join(single, [*region, "source", "target"], "left").withColumn("type", F.when(F.col("n") == 1, "directed").otherwise("reading_order")).drop("n")


def ruled_cells(h_rules: DataFrame, v_rules: DataFrame, page: list[str], tolerance: float = 1.0) -> DataFrame:
    """Rectangles between consecutive vertical rules that neighbouring horizontal rules close above and below.

    h_rules: y, x0, x1; v_rules: x, y0, y1, all snapped. For each pair of consecutive verticals that reach the same
    band of a page, the horizontal rules that span them are sorted, and each neighbouring pair that both verticals
    accompany closes a cell.
    """
    v = v_rules.select(*page, "x", "y0", "y1").distinct()
    lanes = v.select(*page, "x").distinct().withColumn("right", F.lead("x").over(Window.partitionBy(*page).orderBy("x"))).where("right is not null")
    spanning = lanes.join(h_rules, page).where((F.col("x0") <= F.col("x") + tolerance) & (F.col("x1") >= F.col("right") - tolerance)).select(*page, "x", "right", "y").distinct()
    bands = spanning.withColumn("below", F.lead("y").over(Window.partitionBy(*page, "x").orderBy("y"))).where("below is not null")
    beside = lambda side, name: v.select(*page, F.col("x").alias(side), F.col("y0").alias(f"{name}0"), F.col("y1").alias(f"{name}1"))
    holds = lambda name: (F.col(f"{name}0") <= F.col("y") + tolerance) & (F.col(f"{name}1") >= F.col("below") - tolerance)
    left = bands.join(beside("x", "l"), [*page, "x"]).where(holds("l")).select(*page, "x", "right", "y", "below").distinct()
    both = left.join(beside("right", "r"), [*page, "right"]).where(holds("r"))
    return both.select(*page, F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("right").alias("x1"), F.col("below").alias("y1")).distinct()


def nearest_vertical_node(blocks: DataFrame, nodes: DataFrame, page: list[str], reach: float = 36.0) -> DataFrame:
    """blocks beside a vertical node with `node`: the one to which it is nearest, then the leftmost, topmost, first by id.

    A block is beside a node if its centre's height is within the node's, and the gap between them at most reach points. Both are cut into
    bands of heights, so only those of one band meet."""
    band = 50.0
    cut = lambda df, y0, y1: df.withColumn("__band", F.explode(F.sequence(F.floor(F.col(y0) / band), F.floor(F.col(y1) / band))))
    node = cut(nodes.select(*page, "node", *[F.col(c).alias(f"n_{c}") for c in ("x0", "y0", "x1", "y1")]), "n_y0", "n_y1")
    middle = (F.col("y0") + F.col("y1")) / 2
    met = blocks.withColumn("__band", F.floor(middle / band)).join(node, [*page, "__band"])
    gap = F.greatest(F.col("x0") - F.col("n_x1"), F.col("n_x0") - F.col("x1"))
    near = met.withColumn("__gap", gap).where(middle.between(F.col("n_y0"), F.col("n_y1")) & F.col("__gap").between(F.lit(0.0), F.lit(reach)))
    first = F.min_by("node", F.struct("__gap", "n_x0", "n_y0", "node")).alias("node")
    return near.groupBy(*page, "block_id").agg(first)


def glyph_text(glyphs: DataFrame, key: list[str], apart: float = 2.0) -> DataFrame:
    """Text of glyphs (ch, x0, y0, x1, y1) in rows: a glyph opens a row if its centre lies apart points or more below the row's first."""
    centre = (F.col("y0") + F.col("y1")) / 2
    ordered = F.array_sort(F.collect_list(F.struct(centre.alias("y"), F.col("x0").alias("x"), F.col("ch").alias("ch"))))
    zero = F.array().cast("array<struct<y:double,glyphs:array<struct<x:double,ch:string>>>>")

    def step(rows, g):
        last = F.try_element_at(rows, F.lit(-1))
        one = F.struct(g["x"].alias("x"), g["ch"].alias("ch"))
        joined = F.struct(last["y"].alias("y"), F.concat(last["glyphs"], F.array(one)).alias("glyphs"))
        fresh = F.struct(g["y"].alias("y"), F.array(one).alias("glyphs"))
        return F.when((F.size(rows) > 0) & (g["y"] - last["y"] < apart), F.concat(F.slice(rows, 1, F.size(rows) - 1), F.array(joined))).otherwise(F.concat(rows, F.array(fresh)))

    line = lambda r: F.trim(F.array_join(F.transform(F.array_sort(r["glyphs"]), lambda g: g["ch"]), ""))
    return glyphs.groupBy(*key).agg(F.trim(F.array_join(F.transform(F.aggregate(ordered, zero, step), line), "\n")).alias("text"))
