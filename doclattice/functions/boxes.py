"""Boxes as column expressions. A box is an array of x0, y0, x1, y1; words are structs with a box's fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How near cells, arrows and images of a line's bullet may stand, in points or multiples of the type size.
TOUCH, BULLET, AHEAD, LINE_HIGH = 1.0, 1.3, 1.5, 2.0


def union(a: Column, b: Column) -> Column:
    """The smallest box around two."""
    return F.array(F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[2], b[2]), F.greatest(a[3], b[3]))


def bounds(x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1") -> Column:
    """The smallest box around the boxes of a group."""
    return F.array(F.min(x0), F.min(y0), F.max(x1), F.max(y1))


def center(box: Column) -> Column:
    return F.array((box[0] + box[2]) / 2, (box[1] + box[3]) / 2)


def contains(box: Column, x: Column, y: Column, tolerance: float = 0.0) -> Column:
    return x.between(box[0] - tolerance, box[2] + tolerance) & y.between(box[1] - tolerance, box[3] + tolerance)


def inside(inner: Column, outer: Column, tolerance: float = TOUCH) -> Column:
    """Both corners of a box lie in another."""
    return contains(outer, inner[0], inner[1], tolerance) & contains(outer, inner[2], inner[3], tolerance)


def text_left(words: Column, box: Column) -> Column:
    """Where the first word begins; without words, the box."""
    return F.coalesce(F.get(words, F.lit(0))["x0"], box[0])


def text_right(words: Column, box: Column) -> Column:
    return F.coalesce(F.try_element_at(words, F.lit(-1))["x1"], box[2])


def shift_words(words: Column, offset: Column) -> Column:
    """Words whose source spans lie offset further on; those without a span stay."""
    return F.transform(words, lambda w: w.withField("source_start", w["source_start"] + offset).withField("source_end", w["source_end"] + offset))


def line_high(box: Column, size: Column) -> Column:
    """A block of one line's height."""
    return (F.coalesce(size, F.lit(0.0)) > 0) & (box[3] - box[1] <= LINE_HIGH * size)


def image_bullet(box: Column, line: Column, left: Column, size: Column) -> Column:
    """An image of a letter's size stands just before the line's first letter."""
    height = F.least(box[3] - box[1], line[3] - line[1])
    beside = (height > 0) & ((F.least(box[3], line[3]) - F.greatest(box[1], line[1])) / height > 0.5)
    return (box[3] - box[1] <= BULLET * size) & (box[2] - box[0] <= BULLET * size) & beside & box[2].between(left - AHEAD * size, left + 1)
