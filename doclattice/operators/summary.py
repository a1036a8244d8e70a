"""Counts and gaps that describe a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def html_blocks(html: Column, kinds: dict[str, str]) -> Column:
    """Array of (kind, n): how many tags of each kind open; kinds maps tag to kind."""
    return F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_count(html, F.lit(f"<{t}[ >]")).alias("n")) for t, k in kinds.items()])


def one_line(counts: Column) -> Column:
    """'kind=n kind=n' by kind, of an array of (kind, n)."""
    return F.array_join(F.transform(F.array_sort(counts), lambda x: F.concat(x["kind"], F.lit("="), x["n"].cast("string"))), " ")


def missing_pages(rows: DataFrame, key: list[str], page: Column, last: Column) -> DataFrame:
    """missing: the numbers from 1 to last that no row of the key has as its page; a null page counts as none. Only keys that lack any."""
    have = rows.groupBy(*key).agg(F.collect_set(page).alias("have"), F.max(last).alias("n"))
    gaps = F.when(F.col("n") > 0, F.array_except(F.sequence(F.lit(1), F.col("n")), "have")).otherwise(F.array().cast("array<int>"))
    return have.select(*key, gaps.alias("missing")).where(F.size("missing") > 0)


def unseen(rows: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of rows that known doesn't have: what a write-once folder has still to take."""
    return rows.select(column).distinct().join(known.select(column), column, "left_anti")
