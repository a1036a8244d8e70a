"""Table geometry: slots of cells, regions without outer borders, columns, captions. A table's cells are one row; pages bound the rest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values, in points: how far rules of one table may differ, a rule's reach over a gap, a double rule's gap, rules of a table.
SAME_RULE, REACH, INSET, DOUBLE, LEAST_RULES, SAME_X = 4.0, 2.0, 5.0, 6.0, 3, 2.0
CELL = "row int, col int, rowspan int, colspan int, x0 double, y0 double, x1 double, y1 double"
SLOTS = f"array<struct<{', '.join(c.replace(' ', ':') for c in CELL.split(', '))}>>"


def slots_of(cells: list[tuple[int, int, float, float, float, float]], n_rows: int, n_cols: int, large_first: bool = False) -> list[tuple]:
    """(row, col, rowspan, colspan, box) of cells (row, col, box). A cell spans the slots whose start lies a point or more before its end. Of cells that
    overlap, the smaller one has its slots (the larger with large_first); what the other keeps is cut into rectangles, longest downward first."""
    if not cells:
        return []
    frame = pd.DataFrame(cells, columns=["r", "c", "x0", "y0", "x1", "y1"])
    top, left = frame.groupby("r")["y0"].min(), frame.groupby("c")["x0"].min()
    reach = lambda start, end, starts, n: min(n - 1, int(max([i for i in starts.index[starts < end - 1] if i >= start], default=start)))
    frame["r1"] = [reach(r, y, top, n_rows) for r, y in zip(frame.r, frame.y1, strict=True)]
    frame["c1"] = [reach(c, x, left, n_cols) for c, x in zip(frame.c, frame.x1, strict=True)]
    frame["slots"] = (frame.r1 - frame.r + 1) * (frame.c1 - frame.c + 1)
    free = np.ones((n_rows, n_cols), bool)
    out = []
    for cell in frame.sort_values("slots", ascending=not large_first, kind="stable").itertuples():
        window = free[cell.r : cell.r1 + 1, cell.c : cell.c1 + 1]
        while window.any():
            i, j = divmod(int(window.argmax()), window.shape[1])
            down = window[i:, j]
            height = len(down) if down.all() else int(down.argmin())
            across = window[i : i + height, j:].all(axis=0)
            width = len(across) if across.all() else int(across.argmin())
            window[i : i + height, j : j + width] = False
            r, c = cell.r + i, cell.c + j
            r1, c1 = r + height - 1, c + width - 1
            # A part that ends within the cell ends where the next row or column begins.
            out.append((r, c, height, width, left.get(c, cell.x0) if j else cell.x0, top.get(r, cell.y0) if i else cell.y0, left.get(c1 + 1, cell.x1) if c1 < cell.c1 else cell.x1, top.get(r1 + 1, cell.y1) if r1 < cell.r1 else cell.y1))
    return sorted(out)


def slots(cells: Column, n_rows: Column, n_cols: Column, large_first: bool = False) -> Column:
    """Array of (row, col, rowspan, colspan, x0, y0, x1, y1) of an array of (row, col, x0, y0, x1, y1)."""
    names = [c.split(" ")[0] for c in CELL.split(", ")]

    def of(cells: pd.Series, rows: pd.Series, cols: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, map(float, s), strict=True)) | {k: int(v) for k, v in zip(names[:4], s, strict=False)} for s in slots_of([(int(c["row"]), int(c["col"]), c["x0"], c["y0"], c["x1"], c["y1"]) for c in each], int(n), int(m), large_first)] for each, n, m in zip(cells, rows, cols, strict=True)])

    return F.pandas_udf(of, SLOTS)(cells, n_rows, n_cols)


def grid_of(placed: Column, texts: Column, n_rows: Column, n_cols: Column) -> Column:
    """Dense rows of texts: texts is a map from 'row:col' of a cell's first slot to its text; other slots are empty."""
    key = lambda r, c: F.concat_ws(":", r.cast("string"), c.cast("string"))
    known = F.map_from_entries(F.transform(placed, lambda s: F.struct(key(s["row"], s["col"]).alias("key"), F.coalesce(F.element_at(texts, key(s["row"], s["col"])), F.lit("")).alias("value"))))
    row = lambda r: F.transform(F.sequence(F.lit(0), n_cols - 1), lambda c: F.coalesce(F.element_at(known, key(r, c)), F.lit("")))
    return F.transform(F.sequence(F.lit(0), n_rows - 1), row)


def unbordered_regions(rules: list[tuple[float, float, float]], verticals: list[tuple[float, float, float]], tables: list[tuple[float, float, float, float]] = ()) -> list[tuple[float, float, float, float]]:
    """Regions (x0, y0, x1, y1) of tables that are drawn with horizontal rules (x0, x1, y) of one width and inner verticals (x, y0, y1) only.

    Between two rules lies a row of the table if a vertical bridges them; narrow gaps of double rules go with the row above. Three rules are the
    least, and a region that a known table covers by over half is left out."""
    groups: list[list[tuple[float, float, float]]] = []
    for rule in rules:
        home = next((g for g in groups if abs(g[0][0] - rule[0]) <= SAME_RULE and abs(g[0][1] - rule[1]) <= SAME_RULE), None)
        if home is None:
            groups.append(home := [])
        home.append(rule)
    out = []
    for group in groups:
        x0, x1 = min(r[0] for r in group), max(r[1] for r in group)
        ys = np.unique(np.round([r[2] for r in group], 1))
        tops, bottoms = ys[:-1], ys[1:]
        inner = np.array([v for v in verticals if x0 + INSET < v[0] < x1 - INSET]).reshape(-1, 3)
        bridged = ((inner[:, 1] <= tops[:, None] + REACH) & (inner[:, 2] >= bottoms[:, None] - REACH)).any(axis=1)
        run = 0
        member = np.zeros(len(tops), int)  # number of the run that a gap is in, 0 outside
        for i in range(len(tops)):
            after = i > 0 and member[i - 1] > 0
            if bridged[i] or (after and bottoms[i] - tops[i] < DOUBLE):
                run += not after
                member[i] = run
        for n in range(1, run + 1):
            top, bottom = tops[member == n].min(), bottoms[member == n].max()
            area = (x1 - x0) * (bottom - top)
            covered = any(max(0.0, min(x1, b[2]) - max(x0, b[0])) * max(0.0, min(bottom, b[3]) - max(top, b[1])) > 0.5 * area for b in tables)
            if ((ys >= top) & (ys <= bottom)).sum() >= LEAST_RULES and not covered:
                out.append((float(x0), float(top), float(x1), float(bottom)))
    return out


def unbordered_tables(rules: DataFrame, verticals: DataFrame, tables: DataFrame, key: list[str]) -> DataFrame:
    """key and box of each such region; rules (x0, x1, y), verticals (x, y0, y1) and tables (box) meet as arrays of a page."""
    pack = lambda df, cols, name: df.groupBy(*key).agg(F.collect_list(F.array(*[F.col(c).cast("double") for c in cols])).alias(name))
    held = pack(rules, ("x0", "x1", "y"), "r").join(pack(verticals, ("x", "y0", "y1"), "v"), key, "left").join(pack(tables, ("x0", "y0", "x1", "y1"), "t"), key, "left")

    def find(r: pd.Series, v: pd.Series, t: pd.Series) -> pd.Series:
        listed = lambda x: [] if x is None else [tuple(y) for y in x]
        return pd.Series([[list(b) for b in unbordered_regions(sorted(listed(a), key=lambda y: (y[2], y[0])), listed(b), listed(c))] for a, b, c in zip(r, v, t, strict=True)])

    found = held.select(*key, F.explode(F.pandas_udf(find, "array<array<double>>")("r", "v", "t")).alias("b"))
    return found.select(*key, *[F.col("b")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])


def column_positions(xs: Column, least: float = SAME_X) -> Column:
    """Sorted positions, those within two points of the one that was kept before left out."""
    zero = F.array().cast("array<double>")
    return F.aggregate(F.array_sort(xs), zero, lambda kept, x: F.when((F.size(kept) == 0) | (x - F.element_at(kept, -1) > least), F.concat(kept, F.array(x))).otherwise(kept))


def without_unit_caption(rows: Column) -> Column:
    """rows without a first one that holds nothing but a caption of the unit."""
    from doclattice.functions.text import UNIT_CAPTION, unicode

    filled = F.filter(F.get(rows, F.lit(0)), lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")
    only = (F.size(filled) == 1) & F.rlike(F.trim(F.get(filled, F.lit(0))), unicode(UNIT_CAPTION))
    return F.when(F.coalesce(only, F.lit(False)), F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))).otherwise(rows)


def shared_edges(a: Column, b: Column) -> Column:
    """Positions, to a point, that two tables' column edges have in common."""
    rounded = lambda xs: F.transform(xs, lambda x: F.round(x).cast("int"))
    return F.array_sort(F.array_intersect(rounded(a), rounded(b)))
