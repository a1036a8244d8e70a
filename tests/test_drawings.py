from pyspark.sql import functions as F

from doclattice.operators import drawings as D


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_rules(spark):
    rows = [(1, 10.0, 0.0, 30.0), (1, 10.4, 31.0, 60.0), (1, 10.8, 100.0, 120.0), (1, 11.5, 0.0, 50.0), (2, 10.0, 0.0, 10.0)]
    got = sorted(tuple(r) for r in D.horizontal_rules(frame(spark, rows, "page int, y double, x0 double, x1 double"), ["page"]).collect())
    assert got == [(1, 10.0, 0.0, 60.0), (1, 11.5, 0.0, 50.0)]


def test_snapping_is_anchored(spark):
    rows = [(1, 0.0), (1, 0.8), (1, 1.6), (1, 5.0)]
    got = {r.x: r.snapped for r in D.snapped(frame(spark, rows, "page int, x double"), ["page"], "x").collect()}
    assert got == {0.0: 0.4, 0.8: 0.4, 1.6: 1.6, 5.0: 5.0}


def test_dashes(spark):
    dashes = [(1, 5.0, 3.0 * i, 3.0 * i + 1.5) for i in range(10)] + [(1, 9.0, 30.0 * i, 30.0 * i + 1) for i in range(10)] + [(1, 12.0, 3.0 * i, 3.0 * i + 1.5) for i in range(5)]
    got = [tuple(r) for r in D.dashed_lines(frame(spark, dashes, "page int, y double, x0 double, x1 double"), ["page"]).collect()]
    assert got == [(1, 5.0, 0.0, 28.5, 10)]


def test_strips(spark):
    fills = [(1, i, 5.0 * i, 0.0, 5.0 * i + 5, i % 3) for i in range(12)] + [(1, 50 + i, 5.0 * i, 40.0, 5.0 * i + 5, 1) for i in range(12)]
    got = {r.id for r in D.gradient_strips(frame(spark, fills, "page int, id int, x0 double, y0 double, x1 double, fill int"), ["page"]).collect()}
    assert got == set(range(12))


def test_shapes_outside_tables(spark):
    ddl = "page int, id int, x0 double, y0 double, x1 double, y1 double"
    shapes = frame(spark, [(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 200.0, 250.0, 220.0, 260.0), (1, 3, 300.0, 300.0, 302.0, 302.0)], ddl)
    tables = frame(spark, [(1, 9, 0.0, 0.0, 100.0, 150.0)], ddl)
    assert [tuple(r) for r in D.vector_shapes(shapes, tables, ["page"]).collect()] == [(1, 1)]


def test_neighbours(spark):
    cells = frame(spark, [(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 10.5, 2.0, 20.0, 8.0), (1, 3, 12.5, 0.0, 20.0, 10.0), (1, 4, 0.0, 10.9, 10.0, 20.0)], "page int, cell int, x0 double, y0 double, x1 double, y1 double")
    assert [(r.cell, r.neighbour) for r in D.neighbours(cells, ["page"]).collect()] == [(1, 2)]
    assert [(r.cell, r.neighbour) for r in D.neighbours(cells, ["page"], "below").collect()] == [(1, 4)]


def test_underlines(spark):
    glyphs = frame(spark, [(1, "a", 0.0, 0.0, 10.0, 10.0), (1, "b", 10.0, 0.0, 20.0, 10.0), (1, "c", 0.0, 30.0, 10.0, 40.0)], "page int, ch string, x0 double, y0 double, x1 double, y1 double")
    segments = frame(spark, [(1, 11.0, 0.0, 16.0)], "page int, y double, x0 double, x1 double")
    assert [r.ch for r in D.underlined(segments, glyphs, ["page"]).collect()] == ["a"]


def test_figures_and_pages(spark):
    images = frame(spark, [(1, 1, 0.0, 0.0, 100.0, 100.0, 1e5), (1, 2, 0.02, 0.0, 100.0, 100.0, 1e5), (1, 3, 0.0, 0.0, 5.0, 5.0, 1e5), (1, 4, 0.0, 0.0, 20.0, 20.0, 1e5)], "page int, id int, x0 double, y0 double, x1 double, y1 double, page_area double")
    assert sorted((r.id, r.requires_vision) for r in D.figures(images, ["page"]).collect()) == [(1, True), (4, False)]
    pages = frame(spark, [(0.9, 0, 0, 0), (0.1, 0, 60, 0), (0.1, 0, 3, 0), (0.9, 1, 0, 5)], "cover double, fonts int, drawings int, chars int")
    assert [r[0] for r in pages.select(D.empty_page(F.col("cover"), F.col("fonts"), F.col("drawings"), F.col("chars"))).collect()] == ["scanned_page", "outlined_text", "blank_page", None]


def test_bars(spark):
    bars = frame(spark, [(0.0, 0.0, 1.0, 50.0), (0.0, 0.0, 50.0, 1.0), (0.0, 0.0, 50.0, 50.0)], "x0 double, y0 double, x1 double, y1 double")
    assert [r[0] for r in bars.select(D.thin_bar(*(F.col(c) for c in ("x0", "y0", "x1", "y1")))).collect()] == ["v", "h", None]


def test_diagram_edges(spark):
    nodes = frame(spark, [(1, "a", 1), (1, "b", 2), (1, "c", 3)], "region int, node string, y int")
    arrows = frame(spark, [(1, "a", "b"), (1, "b", "c"), (1, "b", "c")], "region int, source string, target string")
    assert sorted(tuple(r)[1:] for r in D.diagram_edges(nodes, ["region"], "y", arrows).collect()) == [("a", "b", "directed"), ("b", "c", "reading_order")]


def test_ruled_cells(spark):
    h = frame(spark, [(1, 0.0, 0.0, 20.0), (1, 10.0, 0.0, 10.0), (1, 20.0, 0.0, 20.0)], "page int, y double, x0 double, x1 double")
    v = frame(spark, [(1, 0.0, 0.0, 20.0), (1, 10.0, 0.0, 20.0), (1, 20.0, 0.0, 20.0)], "page int, x double, y0 double, y1 double")
    got = sorted(tuple(r)[1:] for r in D.ruled_cells(h, v, ["page"]).collect())
    assert got == [(0.0, 0.0, 10.0, 10.0), (0.0, 10.0, 10.0, 20.0), (10.0, 0.0, 20.0, 20.0)]
