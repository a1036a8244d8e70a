import random

from pyspark.sql import functions as F

from doclattice.operators import tables as T


def test_plain_and_merged_cells(spark):
    cells = [(0, 0, 0.0, 0.0, 20.0, 10.0), (0, 2, 20.0, 0.0, 30.0, 10.0), (1, 0, 0.0, 10.0, 10.0, 20.0), (1, 1, 10.0, 10.0, 20.0, 20.0), (1, 2, 20.0, 10.0, 30.0, 20.0)]
    got = T.slots_of(cells, 2, 3)
    assert [s[:4] for s in got] == [(0, 0, 1, 2), (0, 2, 1, 1), (1, 0, 1, 1), (1, 1, 1, 1), (1, 2, 1, 1)]
    df = spark.createDataFrame([([dict(zip(("row", "col", "x0", "y0", "x1", "y1"), c)) for c in cells], {"0:0": "wide", "1:1": "b"})], "cells array<struct<row:int,col:int,x0:double,y0:double,x1:double,y1:double>>, texts map<string,string>")
    df = df.withColumn("s", T.slots(F.col("cells"), F.lit(2), F.lit(3)))
    assert [tuple(x) for x in df.first().s] == [tuple(x) for x in got]
    assert df.select(T.grid_of(F.col("s"), F.col("texts"), F.lit(2), F.lit(3))).first()[0] == [["wide", "", ""], ["", "b", ""]]
    assert T.slots_of([], 0, 0) == []


def test_nested_cells():
    # A large cell over 2 x 2 slots, and a small one in its lower right.
    cells = [(0, 0, 0.0, 0.0, 20.0, 20.0), (0, 1, 10.0, 0.0, 20.0, 10.0), (1, 1, 10.0, 10.0, 20.0, 20.0), (1, 0, 0.0, 10.0, 10.0, 20.0)]
    assert [s[:4] for s in T.slots_of(cells[:3], 2, 2)] == [(0, 0, 2, 1), (0, 1, 1, 1), (1, 1, 1, 1)]
    assert [s[:4] for s in T.slots_of(cells, 2, 2, large_first=True)] == [(0, 0, 2, 2)]


def test_slots_never_overlap():
    rng = random.Random(2)
    for _ in range(50):
        n, m = rng.randint(1, 5), rng.randint(1, 5)
        cells = []
        for r in range(n):
            for c in range(m):
                if rng.random() < 0.7:
                    cells.append((r, c, c * 10.0, r * 10.0, (c + rng.randint(1, 3)) * 10.0, (r + rng.randint(1, 3)) * 10.0))
        for large in (False, True):
            seen = set()
            for r, c, h, w, *_ in T.slots_of(cells, n, m, large):
                part = {(i, j) for i in range(r, r + h) for j in range(c, c + w)}
                assert not part & seen and all(i < n and j < m for i, j in part)
                seen |= part
            assert {(r, c) for r, c, *_ in cells} <= seen


def test_unbordered_regions(spark):
    rules = [(0.0, 100.0, y) for y in (10.0, 30.0, 33.0, 50.0, 200.0, 220.0, 300.0)] + [(300.0, 400.0, 10.0)]
    verticals = [(50.0, 9.0, 51.0), (50.0, 199.0, 221.0), (2.0, 0.0, 400.0)]
    assert T.unbordered_regions(rules, verticals) == [(0.0, 10.0, 100.0, 50.0)]
    assert T.unbordered_regions(rules, verticals, [(0.0, 0.0, 100.0, 40.0)]) == []
    assert T.unbordered_regions(rules, []) == [] and T.unbordered_regions([], verticals) == []
    frame = lambda rows, ddl: spark.createDataFrame([(1, *r) for r in rows], f"page int, {ddl}")
    got = T.unbordered_tables(frame(rules, "x0 double, x1 double, y double"), frame(verticals, "x double, y0 double, y1 double"), frame([], "x0 double, y0 double, x1 double, y1 double"), ["page"])
    assert [tuple(r) for r in got.collect()] == [(1, 0.0, 10.0, 100.0, 50.0)]


def test_columns_and_captions(spark):
    df = spark.createDataFrame([([30.0, 10.0, 11.5, 12.5, 31.0], [["(단위 : 원)", ""], ["a", "b"]], [10.2, 29.9])], "xs array<double>, rows array<array<string>>, ys array<double>")
    got = df.select(T.column_positions(F.col("xs")), T.without_unit_caption(F.col("rows")), T.without_unit_caption(F.array(F.array(F.lit("a"), F.lit("b")))), T.shared_edges(F.col("xs"), F.col("ys"))).first()
    assert tuple(got) == ([10.0, 12.5, 30.0], [["a", "b"]], [["a", "b"]], [10, 30])
