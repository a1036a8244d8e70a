"""From lines to blocks: running elements by joins, then steps that walk the lines of a page, in partitions sorted by page.

A line has key columns, page, line_no, text, x0, y0, x1, y1, size, is_bold, height (of its page) and, where glyphs are known, left and
right (where the first word begins and the last one ends) and value_left (where what follows a colon begins); without them the box counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from doclattice.functions import text as T
from doclattice.operators.layout import _overlap
from doclattice.operators.lines import RUNNING_SHARE, edge_position

# Tolerances, in points, shares of a page's height, or multiples of the type size.
BAND, WIDE_BAND, SAME_X, SAME_Y = 0.10, 0.12, 6.0, 0.01
ROW, SPACE, NEAR, LABEL_GAP, EM_GAP, SPACED_GAP, SHORT, LINE_GAP, ALIKE, ONE_LINE = 0.5, 0.15, 1.5, 4.0, 1.0, 3.0, 1.0, 1.2, 0.15, 2.0
LETTER = r"[가-힣A-Za-z]"
SPACED_HEAD, SPACED_TAIL = r"(?:^|[^가-힣])[가-힣]$", r"^[가-힣]{1,3}\s*[:：]|^[가-힣]{1,2}$"
LABEL_LINE = r"^[가-힣]{1,6}\s?[:：]"
SENTENCE_END = r"(함|음|임|됨|짐|옴|바람|할것|하였음|이다|한다|합니다)$"
CLOSING = (")", "]", "」", "』")

MARKERS = [(level, re.compile(pattern)) for level, _, pattern in T.MARKERS]
ATTACHMENT, DASHED, CHAPTER = re.compile(T.ATTACHMENT), re.compile(T.DASHED_LABEL), re.compile(T.CHAPTER_NUMBER)


def begins_block(text: str) -> bool:
    return bool(ATTACHMENT.match(text) or DASHED.match(text.strip()) or any(p.match(text) for _, p in MARKERS))


def ends_sentence(text: str) -> bool:
    text = text.rstrip()
    return text.endswith((".", "다")) or re.search(SENTENCE_END, text) is not None


def running_elements(lines: DataFrame, doc: list[str]) -> DataFrame:
    """lines with `running`: header, footer or page_number for lines outside the body, else null.

    A line at an edge runs if lines of the same text, digits aside, stand in the same band and at the same place on 60 percent of the pages,
    two at least; so do print stamps. A number alone is a page number unless something stands beside it, a dashed one in a wider band too.
    Lines meet by band, text and a grid of places, so only lines of the same place are compared.
    """
    lines = lines.withColumn("edge", edge_position(F.col("y0"), F.col("y1"), F.col("height"), BAND)).withColumn("template", T.digit_template(F.col("text")))
    edges = lines.where("edge is not null").withColumn("gx", F.floor(F.col("x0") / SAME_X)).withColumn("gy", F.floor(F.col("y0") / F.col("height") / SAME_Y))
    around = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)).alias(c)
    other = edges.select(*doc, "edge", "template", F.col("page").alias("p"), F.col("x0").alias("x"), (F.col("y0") / F.col("height")).alias("y"), around("gx"), "gy").select("*", F.col("gy").alias("g")).drop("gy")
    other = other.select("*", F.explode(F.array(F.col("g") - 1, F.col("g"), F.col("g") + 1)).alias("gy")).drop("g")
    met = edges.join(other, [*doc, "edge", "template", "gx", "gy"]).where((F.abs(F.col("x") - F.col("x0")) <= SAME_X) & (F.abs(F.col("y") - F.col("y0") / F.col("height")) <= SAME_Y))
    pages = lines.groupBy(*doc).agg(F.countDistinct("page").alias("n_pages"))
    seen = met.groupBy(*doc, "page", "line_no").agg(F.countDistinct("p").alias("seen")).join(pages, doc)
    often = seen.where(F.col("seen") >= F.greatest(F.lit(2), F.ceil(F.col("n_pages") * RUNNING_SHARE))).select(*doc, "page", "line_no", F.lit(True).alias("often"))

    number = T.page_number_like(F.col("text"))
    alone = edges.where(number).select(*doc, "page", "line_no", "y0", "y1")
    beside = lines.select(*doc, "page", F.col("line_no").alias("other"), F.col("y0").alias("o0"), F.col("y1").alias("o1"))
    least = F.least(F.col("y1") - F.col("y0"), F.col("o1") - F.col("o0"))
    shared = F.least("y1", "o1") - F.greatest("y0", "o0")
    crowded = alone.join(beside, [*doc, "page"]).where((F.col("line_no") != F.col("other")) & (least > 0) & (shared > ROW * least)).select(*doc, "page", "line_no").distinct().withColumn("crowded", F.lit(True))

    wide = edge_position(F.col("y0"), F.col("y1"), F.col("height"), WIDE_BAND).isNotNull()
    told = (
        F.when(F.rlike("text", T.unicode(T.PAGE_NUMBER_DASHED)) & wide, "page_number").when(F.col("edge").isNull(), None).when(F.rlike("text", T.unicode(T.PRINT_STAMP)), F.col("edge"))
        .when(number, F.when(F.col("crowded").isNull(), "page_number")).when(F.col("often"), F.col("edge"))
    )
    on = [*doc, "page", "line_no"]
    return lines.join(often, on, "left").join(crowded, on, "left").withColumn("running", told).drop("edge", "template", "often", "crowded")


@dataclass
class Piece:
    """A line, or lines that have been joined. steps: what was done to it."""

    line_no: int
    text: str
    x0: float
    y0: float
    x1: float
    y1: float
    size: float
    bold: bool
    left: float
    right: float
    value: float | None = None
    n_lines: int = 1
    steps: frozenset[str] = frozenset()

    def gap(self, other: Piece) -> float:
        return other.x0 - self.x1

    def join(self, other: Piece, glue: str, step: str) -> Piece:
        text = re.sub(r"\s{2,}", " ", self.text + glue + other.text).strip()
        return replace(
            self, text=text, x0=min(self.x0, other.x0), y0=min(self.y0, other.y0), x1=max(self.x1, other.x1), y1=max(self.y1, other.y1), size=max(self.size, other.size), bold=self.bold and other.bold,
            left=min(self.left, other.left), right=max(self.right, other.right), value=self.value, steps=self.steps | other.steps | {step},
        )


def pieces(page: list[dict]) -> list[Piece]:
    known = lambda row, name, other: other if row.get(name) is None else row[name]
    return [
        Piece(int(r["line_no"]), r["text"], r["x0"], r["y0"], r["x1"], r["y1"], r["size"], bool(known(r, "is_bold", False)), known(r, "left", r["x0"]), known(r, "right", r["x1"]), r.get("value_left"))
        for r in page
    ]


def by_page(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[list[dict]]:
    """The rows of one page after the other, of batches that are sorted by the key. One page is held at a time, and one batch."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[c] != held[-1][c] for c in key):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def visual_rows(found: list[Piece]) -> list[list[Piece]]:
    """Rows from top to bottom: a piece joins the first row whose first piece it overlaps by over half of the smaller height."""
    rows: list[list[Piece]] = []
    for piece in sorted(found, key=lambda p: (p.y0, p.x0)):
        home = next((row for row in rows if _overlap(row[0].y0, row[0].y1, piece.y0, piece.y1) > ROW), None)
        if home is None:
            rows.append([piece])
        else:
            home.append(piece)
    rows = [sorted(row, key=lambda p: p.x0) for row in rows]
    return sorted(rows, key=lambda row: (min(p.y0 for p in row), row[0].x0))


def _one_word(row: list[Piece]) -> bool:
    """Single letters that stand close together."""
    return len(row) > 1 and all(len(p.text) == 1 for p in row) and all(a.gap(b) <= NEAR * max(a.size, b.size) for a, b in zip(row, row[1:], strict=False))


def _label_and_title(row: list[Piece]) -> Piece | None:
    """A chapter's number or an attachment's label, joined with the title to its right."""
    label, title = row[0], row[1]
    if label.gap(title) > LABEL_GAP * max(label.size, title.size):
        return None
    number = CHAPTER.match(label.text)
    if number and len(title.text) > 1 and re.search(LETTER, title.text):
        # A number in digits gets the full stop that its marker has.
        named = replace(label, text=f"{number[1]}.") if number[1].isdigit() else label
        return named.join(title, " ", "section_number_joined")
    said = ATTACHMENT.fullmatch(label.text.strip())
    return label.join(title, " ", "attachment_label_joined") if said and re.search(r"[가-힣A-Za-z\d]", title.text) else None


def _same_line(a: Piece, b: Piece, rules: list[tuple[float, float, float]]) -> str | None:
    """What goes between two neighbours of a row that are fragments of one line; None if they aren't."""
    size, gap = max(a.size, b.size), b.left - a.right
    label = bool(re.search(SPACED_HEAD, a.text) and re.match(SPACED_TAIL, b.text))
    if not -1.0 <= gap <= size * (SPACED_GAP if label else EM_GAP) or abs(a.size - b.size) > ALIKE * size or abs(a.y1 - b.y1) > 1.0 or not re.search(LETTER, b.text):
        return None
    bullet = a.text.strip()
    if not (re.search(LETTER, a.text) or gap <= 0.5 or (len(bullet) == 1 and begins_block(f"{bullet} {b.text}"))):
        return None
    if any(a.right - 0.5 <= x <= b.left + 0.5 and top <= max(a.y0, b.y0) + 1 and bottom >= min(a.y1, b.y1) - 1 for x, top, bottom in rules):
        return None
    return " " if gap > SPACE * b.size and not label else ""


def join_rows(found: list[Piece], rules: list[tuple[float, float, float]] = ()) -> list[Piece]:
    """Rows with letters, labels and fragments joined; in reading order."""
    out: list[Piece] = []
    for row in visual_rows(found):
        if _one_word(row):
            word = row[0]
            for p in row[1:]:
                word = word.join(p, "", "visual_row_joined")
            out.append(word)
            continue
        if len(row) > 1 and (titled := _label_and_title(row)):
            row = [titled, *row[2:]]
        line = row[0]
        for p in row[1:]:
            glue = _same_line(line, p, rules)
            if glue is None:
                out.append(line)
                line = p
            else:
                line = line.join(p, glue, "row_fragments_joined")
        out.append(line)
    return out


def join_columns(found: list[Piece]) -> list[Piece]:
    """Single letters that stand below each other become one word, at the place of the first."""
    frame = pd.DataFrame([(i, round(p.x0 / 3), p.y0) for i, p in enumerate(found) if len(p.text) == 1], columns=["i", "column", "y"])
    words: dict[int, Piece] = {}
    gone: set[int] = set()
    for _, column in frame.sort_values("y", kind="stable").groupby("column", sort=False):
        head = last = None
        for i in column["i"].tolist():
            if last is not None and 0 <= found[i].y0 - found[last].y1 < LINE_GAP * found[last].size:
                words[head] = words.get(head, found[head]).join(found[i], "", "vertical_run_joined")
                gone.add(i)
            else:
                head = i
            last = i
    return [words.get(i, p) for i, p in enumerate(found) if i not in gone]


@dataclass
class Paragraph:
    """Lines that wrap: what has been joined, its first line's start and value, and its last line."""

    whole: Piece
    head: float
    value: float | None
    tail: Piece


class Wrapping:
    """Whether a line goes on the paragraph before it, on one page."""

    def __init__(self, found: list[Piece], barriers: list[tuple[float, float, float, float]], rules: list[tuple[float, float, float]]):
        self.barriers, self.rules = barriers, rules
        self.edge = max((p.x1 for p in found), default=0.0)
        self.half = (self.edge - min((p.x0 for p in found), default=0.0)) / 2
        self.wide = [p.x1 for p in found if p.x1 - p.x0 >= self.half]
        beside = lambda a, b: a is not b and _overlap(a.y0, a.y1, b.y0, b.y1) > ROW and (a.x1 <= b.x0 or b.x1 <= a.x0)
        self.shared = {id(a) for a in found if any(beside(a, b) for b in found)}

    def fills(self, para: Paragraph) -> bool:
        """The last line reaches the right edge, a rule around it, or where at least three wide lines end."""
        tail = para.tail
        broad = tail.x1 - tail.x0 >= self.half
        around = [x for x, top, bottom in self.rules if x >= tail.x1 - 1 and top <= tail.y0 and bottom >= tail.y1] if broad else []
        if min([self.edge, *around]) - tail.x1 < SHORT * para.whole.size:
            return True
        return broad and sum(abs(x - tail.x1) <= 1 for x in self.wide) >= 3 and not ends_sentence(tail.text) and not tail.text.rstrip().endswith(CLOSING)

    def aligned(self, para: Paragraph, line: Piece) -> bool:
        size = para.whole.size
        if abs(line.x0 - para.whole.x0) <= 2 * size:
            return True
        start = max(line.left, line.x0)
        return not ends_sentence(para.tail.text) and (abs(start - para.head) <= 2 * size or (para.value is not None and abs(start - para.value) <= size))

    def blocked(self, para: Paragraph, line: Piece) -> bool:
        """Something stands between the two, or an image the size of a letter is the line's bullet."""
        whole = para.whole
        for x0, y0, x1, y1 in self.barriers:
            between = y0 < line.y0 - 1 and y1 > whole.y1 + 1 and whole.y1 - 1 <= (y0 + y1) / 2 <= line.y0 + 1
            if between and x0 < max(whole.x1, line.x1) and x1 > min(whole.x0, line.x0):
                return True
            small = y1 - y0 <= 1.3 * line.size and x1 - x0 <= 1.3 * line.size
            if small and _overlap(y0, y1, line.y0, line.y1) > 0.5 and line.left - 1.5 * line.size <= x1 <= line.left + 1:
                return True
        return False

    def smaller_list_text(self, para: Paragraph, line: Piece) -> bool:
        """A list item that ends with a comma goes on in smaller type."""
        whole = para.whole
        listed = any(level is not None and level >= 3 and p.match(whole.text) for level, p in MARKERS)
        return whole.text.endswith(",") and listed and 0.5 * whole.size <= line.size < 0.85 * whole.size

    def goes_on(self, para: Paragraph, line: Piece) -> str | None:
        """The glue, or None."""
        whole, tail = para.whole, para.tail
        smaller = self.smaller_list_text(para, line)
        if not 0 <= line.y0 - whole.y1 < LINE_GAP * whole.size or not (smaller or abs(line.size - whole.size) <= ALIKE * whole.size) or tail.bold != line.bold:
            return None
        if id(line) in self.shared or id(tail) in self.shared or begins_block(line.text) or DASHED.match(tail.text.strip()):
            return None
        if para.value is not None and re.match(LABEL_LINE, line.text):
            return None
        if not self.fills(para) or not self.aligned(para, line) or self.blocked(para, line):
            return None
        return " " if smaller or tail.text.endswith(" ") else ""


def wrap(found: list[Piece], barriers: list[tuple[float, float, float, float]] = (), rules: list[tuple[float, float, float]] = ()) -> list[Piece]:
    """Paragraphs of lines in reading order."""
    page, out = Wrapping(found, list(barriers), list(rules)), []
    for line in found:
        glue = page.goes_on(out[-1], line) if out else None
        if glue is None:
            out.append(Paragraph(line, line.left, line.value, line))
        else:
            para = out[-1]
            joined = para.whole.join(line, glue, "wrapped_lines_merged")
            para.whole, para.tail = replace(joined, size=para.whole.size, n_lines=para.whole.n_lines + line.n_lines), line
    return [p.whole for p in out]


def flow(lines: DataFrame, key: list[str], barriers: DataFrame | None = None, rules: DataFrame | None = None, wrapping: bool = True) -> DataFrame:
    """Paragraphs of each page (without wrapping: its lines, fragments joined): key, line_no (of the first line), text, box, size, n_lines, steps, left.

    barriers: key and x0, y0, x1, y1 of tables, figures and running lines; rules: key and x, top, bottom of vertical rules. They come
    to their page as arrays.
    """
    held = lines
    for name, side, fields in (("barriers", barriers, ("x0", "y0", "x1", "y1")), ("rules", rules, ("x", "top", "bottom"))):
        if side is None:
            held = held.withColumn(f"__{name}", F.array().cast("array<array<double>>"))
        else:
            held = held.join(side.groupBy(*key).agg(F.collect_list(F.array(*[F.col(f).cast("double") for f in fields])).alias(f"__{name}")), key, "left")
    own = [f for f in lines.schema if f.name in key]

    schema = StructType([*own, *_parse_datatype_string("line_no long, text string, x0 double, y0 double, x1 double, y1 double, size double, n_lines long, steps array<string>, left double")])
    arrow = to_arrow_schema(schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for page in by_page(batches, key):
            sides = [[tuple(x) for x in page[0][c] or []] for c in ("__barriers", "__rules")]
            joined = join_columns(join_rows(pieces(page), sides[1]))
            for p in wrap(joined, *sides) if wrapping else joined:
                out.append({**{c: page[0][c] for c in key}, "line_no": p.line_no, "text": p.text, "x0": p.x0, "y0": p.y0, "x1": p.x1, "y1": p.y1, "size": p.size, "n_lines": p.n_lines, "steps": sorted(p.steps), "left": p.left})
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        yield pa.RecordBatch.from_pylist(out, arrow)

    return held.repartition(*key).sortWithinPartitions(*key, "line_no").mapInArrow(build, schema)


def reading_position(blocks: DataFrame, key: list[str], ident: str) -> DataFrame:
    """position (from 0) of each block on its page: by top, left and kind; blocks of one line's height that overlap the first of their row go
    from left to right. Rows are found in one walk over sorted blocks; texts pass through as they are."""
    own = blocks.columns
    inner = StructType([*blocks.schema, *_parse_datatype_string("__row long")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = None, 0  # the first block of the row (its page, top, bottom), and the row
        for batch in batches:
            found = []
            page = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
            for k, y0, y1, size in zip(page, *(batch.column(c).to_pylist() for c in ("y0", "y1", "size")), strict=True):
                flat = bool(size) and y1 - y0 <= ONE_LINE * size
                if not (first and flat and first[0] == k and _overlap(first[1], first[2], y0, y1) > ROW):
                    number += 1
                    first = (k, y0, y1) if flat else None
                found.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*own, "__row"])

    ordered = blocks.repartition(*key).sortWithinPartitions(*key, F.round("y0", 1), "x0", "kind", ident)
    position = F.row_number().over(Window.partitionBy(*key).orderBy("__row", "x0", "kind", ident)) - 1
    return ordered.mapInArrow(rows, inner).withColumn("position", position.cast("long")).drop("__row")


def assemble(lines: DataFrame, doc: list[str], others: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """Blocks of each page in reading order: doc, page, position, kind, level, type, marker, text, box, size, indent, steps.

    others: tables and figures as blocks (doc, page, kind, text, box); they also keep the lines on either side of them apart.
    """
    key = [*doc, "page"]
    tagged = running_elements(lines, doc)
    outside = tagged.where("running is not null")
    body = tagged.where("running is null").drop("running")
    walls = outside.select(*key, "x0", "y0", "x1", "y1")
    if others is not None:
        walls = walls.unionByName(others.select(*key, "x0", "y0", "x1", "y1"))
    done = flow(body, key, walls, rules)
    start = F.min("left").over(Window.partitionBy(*key))
    done = done.withColumn("indent", F.when(F.col("size") > 0, F.round((F.col("left") - start) / (F.col("size") / 2), 1)))
    none = lambda t: F.lit(None).cast(t)
    shape = [*key, "kind", "level", "type", "marker", "text", "x0", "y0", "x1", "y1", "size", "indent", "steps"]
    made = done.withColumn("m", T.marker(F.col("text"))).select(*key, "m.kind", "m.level", "m.type", "m.marker", F.col("m.content").alias("text"), "x0", "y0", "x1", "y1", "size", "indent", "steps")
    why = F.when(F.col("running") == "page_number", "page_number_at_edge").when(F.rlike("text", T.unicode(T.PRINT_STAMP)), "print_stamp_at_edge").otherwise("repeated_text_at_same_edge_position")
    run = outside.select(*key, F.col("running").alias("kind"), none("int").alias("level"), none("string").alias("type"), none("string").alias("marker"), "text", "x0", "y0", "x1", "y1", "size", none("double").alias("indent"), F.array(why).alias("steps"))
    blocks = made.unionByName(run)
    if others is not None:
        missing = {"level": "int", "type": "string", "marker": "string", "size": "double", "indent": "double", "steps": "array<string>"}
        blocks = blocks.unionByName(others.select(*[F.col(c) if c in others.columns else none(missing[c]).alias(c) for c in shape]))
    ident = F.row_number().over(Window.partitionBy(*key).orderBy("y0", "x0", "kind", "text"))
    return reading_position(blocks.withColumn("block", ident), key, "block").drop("block")


def title_blocks(blocks: DataFrame, doc: list[str], height: Column) -> DataFrame:
    """blocks with kind document_title for each document's title: of the paragraphs in the upper 60 percent of page 1, 5 to 100 characters long and at
    least 1.2 times the median size, neither an organisation's name nor a label between dashes, the largest; then the longest; then the first."""
    typed = F.when((F.col("size") > 0) & (F.col("text") != ""), F.col("size"))
    whole = blocks.withColumn("__floor", F.median(typed).over(Window.partitionBy(*doc)) * 1.2)
    organisation = F.rlike(F.regexp_replace("text", r"(?U)\s+", ""), T.unicode(T.ORGANISATION))
    fit = (F.col("page") == 1) & (F.col("kind") == "para") & (F.col("y0") < height * 0.6) & F.length("text").between(5, 100) & (F.col("size") >= F.col("__floor")) & ~organisation & ~F.rlike(T.strip(F.col("text")), T.unicode(T.DASHED_LABEL))
    ranked = whole.withColumn("__fit", fit).withColumn("__n", F.row_number().over(Window.partitionBy(*doc, "__fit").orderBy(F.desc(F.bround("size", 1)), F.desc(F.length("text")), "page", "position")))
    return ranked.withColumn("kind", F.when(F.col("__fit") & (F.col("__n") == 1), "document_title").otherwise(F.col("kind"))).drop("__floor", "__fit", "__n")


def _markdown_line(kind: Column, level: Column, mark: Column, text: Column, rows: Column | None) -> Column:
    named = F.concat_ws(" ", mark, text)
    head = F.concat(F.repeat(F.lit("#"), F.coalesce(level, F.lit(1)) + 1), F.lit(" "), F.coalesce(mark, F.lit("")), F.lit(" "), text)
    item = F.concat(F.repeat(F.lit("  "), F.greatest(F.coalesce(level, F.lit(5)) - 3, F.lit(0))), named)
    attached = F.concat(F.rtrim(F.concat(F.lit("\n**"), F.coalesce(mark, F.lit("")), F.lit("** "), text)), F.lit("\n"))
    out = (
        F.when(kind == "document_title", F.concat(F.lit("**"), text, F.lit("**\n"))).when(kind == "attachment", attached)
        .when(kind == "heading", F.concat(head, F.lit("\n"))).when(kind.isin("item", "note"), item)
    )
    if rows is not None:
        out = F.when(kind == "table", F.concat(T.markdown_table(rows), F.lit("\n"))).otherwise(out)
    return F.coalesce(out, text)


def markdown(blocks: DataFrame, doc: list[str], title: Column, excluded: tuple[str, ...] = ("header", "footer", "page_number", "figure", "approval", "title_fragment")) -> DataFrame:
    """markdown of each document: title, a comment where a page begins, headings by level, items indented, tables as pipe tables. A document's blocks
    are one row of the result; position orders them within a page."""
    shown = blocks.where(~F.col("kind").isin(*excluded))
    before = F.lag("page").over(Window.partitionBy(*doc).orderBy("page", "position"))
    turned = before.isNull() | (before != F.col("page"))
    comment = F.when(turned, F.concat(F.lit("\n<!-- page "), F.col("page").cast("string"), F.lit(" -->\n\n"))).otherwise("")
    line = _markdown_line(F.col("kind"), F.col("level"), F.col("marker"), F.col("text"), F.col("rows") if "rows" in blocks.columns else None)
    each = shown.select(*doc, "page", "position", F.concat(comment, line).alias("line"), title.alias("title"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page", "position", "line"))), lambda x: x["line"])
    body = F.regexp_replace(F.array_join(ordered, "\n"), r"(?U)\s+$", "")
    return each.groupBy(*doc, "title").agg(body.alias("body")).select(*doc, F.concat(F.lit("# "), "title", F.lit("\n\n"), "body", F.lit("\n")).alias("markdown"))


def glyph_lines(glyphs: DataFrame, key: list[str]) -> DataFrame:
    """Lines of a page from its glyphs (line, seq, ch, x0, y0, x1, y1, size, bold): key, line, text, box, size, is_bold, left, right, and words with offsets.

    A space is put where the gap to the glyph before is over 0.15 of the size and neither is a space; control characters count as spaces; runs of
    four or more leader dots go. Words are islands between spaces, numbered by a running sum.
    """
    w = Window.partitionBy(*key, "line").orderBy("seq")
    space = F.rlike("ch", F.lit(r"(?U)^[\s\x00-\x1f\x7f]$"))
    g = glyphs.withColumn("ch", F.when(space, F.lit(" ")).otherwise(F.col("ch"))).withColumn("__space", F.col("ch") == " ")
    gap = F.col("x0") - F.lag("x1").over(w)
    opens = (gap > SPACE * F.col("size")) & ~F.col("__space") & ~F.lag("__space").over(w)
    g = g.withColumn("__piece", F.concat(F.when(opens, " ").otherwise(""), "ch")).withColumn("__new", (opens | F.lag("__space").over(w)).cast("int"))
    g = g.withColumn("__word", F.sum(F.coalesce("__new", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inked = lambda c: F.when(~F.col("__space"), F.col(c))
    chars = F.transform(F.array_sort(F.collect_list(F.struct("seq", "__piece"))), lambda x: x["__piece"])
    whole = g.groupBy(*key, "line").agg(
        F.array_join(chars, "").alias("raw"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max("size").alias("size"),
        F.bool_and("bold").alias("is_bold"), F.min(inked("x0")).alias("left"), F.max(inked("x1")).alias("right"),
    )
    text = T.normalize_space(F.regexp_replace("raw", r"[·․‧∙⋅.…]{4,}", " "))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("seq", "ch"))), lambda x: x["ch"])
    each = g.where(~F.col("__space")).groupBy(*key, "line", "__word").agg(F.array_join(letters, "").alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    words = each.groupBy(*key, "line").agg(F.transform(F.array_sort(F.collect_list(F.struct("__word", "text", "x0", "y0", "x1", "y1"))), lambda x: F.struct(x["text"].alias("text"), x["x0"].alias("x0"), x["y0"].alias("y0"), x["x1"].alias("x1"), x["y1"].alias("y1"))).alias("words"))
    return whole.withColumn("text", text).where("text <> ''").drop("raw").join(words, [*key, "line"], "left")


def value_left(words: Column) -> Column:
    """Where the word after a colon begins, the colon being within the first five words; else null."""
    first = F.slice(words, 1, 5)
    pairs = F.filter(F.transform(first, lambda w, i: F.struct(F.rlike(w["text"], F.lit("[:：]$")).alias("ends"), F.get(words, i + 1)["x0"].alias("x0"))), lambda p: p["ends"] & p["x0"].isNotNull())
    return F.get(pairs, F.lit(0))["x0"]
