"""Layout steps that are sequential on a page: one pandas group for each page, whose size a page bounds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def _overlap(a0: float, a1: float, b0: float, b1: float) -> float:
    height = min(a1 - a0, b1 - b0)
    return max(0.0, min(a1, b1) - max(a0, b0)) / height if height > 0 else 0.0


def touching_components(boxes: DataFrame, key: list[str], tolerance: float = 1.0) -> DataFrame:
    """component: the smallest `box` of those that boxes reach by touching."""

    def group(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values("y0").reset_index(drop=True)
        parent = list(range(len(page)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        rows = page[["x0", "y0", "x1", "y1"]].to_numpy()
        live: list[int] = []
        for i, (x0, y0, x1, _) in enumerate(rows):  # boxes above that have ended can't touch any more
            live = [j for j in live if rows[j][3] + tolerance >= y0]
            for j in live:
                if rows[j][0] <= x1 + tolerance and x0 <= rows[j][2] + tolerance:
                    parent[find(i)] = find(j)
            live.append(i)
        least: dict[int, int] = {}
        for i in range(len(page)):
            least[find(i)] = min(least.get(find(i), page["box"][i]), page["box"][i])
        return page.assign(component=pd.Series([least[find(i)] for i in range(len(page))], dtype="int64"))

    return boxes.groupBy(*key).applyInPandas(group, f"{_ddl(boxes)}, component long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
