"""Quality rules as hits (rule, severity, key, detail). Missing labels make a rule not executable, never violated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Severity of each rule, and what a reported rule suppresses on the same anchor.
SEVERITY = {
    "FMT-01": "advisory", "FMT-02": "advisory", "FMT-03": "advisory", "FMT-07": "must_fix", "FMT-08": "must_fix", "FMT-09": "must_fix", "STR-01": "must_fix", "STR-03": "must_fix",
    "STR-04": "advisory", "STR-05": "advisory", "STR-06": "advisory", "STR-07": "advisory", "STR-08": "advisory", "CON-01": "must_fix", "CON-02": "must_fix", "CON-03": "verify", "CON-04": "must_fix",
    "EXP-01": "advisory", "EXP-05": "advisory", "LAW-01": "must_fix", "LAW-02": "must_fix", "LAW-03": "verify",
    "FMT-04": "advisory", "FMT-05": "advisory", "FMT-06": "advisory", "EXP-02": "advisory",
}
SUPPRESSES = [("FMT-01", "FMT-02"), ("FMT-07", "FMT-01"), ("FMT-07", "FMT-08"), ("FMT-08", "FMT-01"), ("LAW-01", "LAW-02"), ("LAW-01", "LAW-03")]
SENTENCE, TITLE, OVERVIEW_ITEMS, BODY_PAGES = 110, 20, 5, 2


def hit(rows: DataFrame, rule: str, key: list[str], detail: Column) -> DataFrame:
    return rows.select(*key, F.lit(rule).alias("rule"), F.lit(SEVERITY[rule]).alias("severity"), detail.cast("string").alias("detail"))


def suppressed(hits: DataFrame, key: list[str]) -> DataFrame:
    """Hits less those that another reported hit of the same anchor suppresses; one pass, not transitive."""
    pairs = hits.sparkSession.createDataFrame(SUPPRESSES, "rule string, gone string")
    gone = hits.join(F.broadcast(pairs), "rule").select(*key, F.col("gone").alias("rule")).distinct()
    return hits.join(gone, [*key, "rule"], "left_anti")


def dates(text: Column) -> Column:
    """Dates as written: year, month, day with dots, dashes or slashes."""
    return F.regexp_extract_all(text, F.lit(r"\d{4}[.\-/]\s?\d{1,2}[.\-/]\s?\d{1,2}\.?"), F.lit(0))


def date_hits(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """FMT-01: not 'YYYY. M. D.'. FMT-07: no such day."""
    found = rows.select(*key, F.explode(dates(F.col(text))).alias("date"))
    shape = hit(found.where(~F.rlike("date", F.lit(r"^\d{4}\. [1-9]\d?\. [1-9]\d?\.$"))), "FMT-01", key, F.col("date"))
    plain = F.regexp_replace(F.regexp_replace("date", r"[.\-/]\s?", "-"), r"-$", "")
    impossible = hit(found.where(F.try_to_timestamp(plain, F.lit("yyyy-M-d")).isNull()), "FMT-07", key, F.col("date"))
    return shape.unionByName(impossible)


def skipped_levels(blocks: DataFrame, key: list[str], order: str) -> DataFrame:
    """STR-01: a level more than one below the one before it."""
    levelled = blocks.where("level is not null")
    before = F.lag("level").over(Window.partitionBy(*key).orderBy(order))
    return hit(levelled.withColumn("before", before).where(F.col("level") - F.col("before") > 1), "STR-01", [*key, order], F.concat_ws(">", "before", "level"))


def order_faults(sections: DataFrame, ranks: DataFrame, key: list[str], order: str) -> DataFrame:
    """STR-04: a tag whose rank is below that of the tag before it; tags without a rank are exempt."""
    ranked = sections.join(F.broadcast(ranks), "tag")
    before = F.lag("rank").over(Window.partitionBy(*key).orderBy(order))
    return hit(ranked.withColumn("before", before).where("before > rank"), "STR-04", [*key, order], F.col("tag"))


def missing_sections(documents: DataFrame, sections: DataFrame, required: DataFrame, key: str) -> DataFrame:
    """STR-03: slots of the document's outline that none of its tags fills (a slot may list several tags); no outline, no check."""
    slots = documents.where("outline_id is not null").join(F.broadcast(required), "outline_id")
    have = sections.select(key, "tag").distinct().withColumn("have", F.lit(True))
    filled = slots.join(have, [key, "tag"], "left").groupBy(key, "outline_id", "slot").agg(F.bool_or(F.coalesce("have", F.lit(False))).alias("ok"))
    return hit(filled.where("not ok"), "STR-03", [key], F.col("slot"))


def long_sentences(rows: DataFrame, key: list[str], text: str = "text", most: int = SENTENCE) -> DataFrame:
    """STR-05."""
    cut = rows.select(*key, F.explode(F.split(text, r"(?<=[.!?])\s+")).alias("sentence"))
    return hit(cut.where(F.length("sentence") > most), "STR-05", key, F.length("sentence"))


def total_mismatches(cells: DataFrame, key: list[str]) -> DataFrame:
    """CON-01: a column's total row against the sum of its details. cells: value, is_total."""
    sums = cells.groupBy(*key).agg(F.sum(F.when(~F.col("is_total"), F.col("value"))).alias("sum"), F.max(F.when(F.col("is_total"), F.col("value"))).alias("total"))
    return hit(sums.where("total is not null and sum is not null and total <> sum"), "CON-01", key, F.concat_ws("<>", F.col("total").cast("string"), F.col("sum").cast("string")))


def reference_faults(references: DataFrame, listed: DataFrame, key: list[str]) -> DataFrame:
    """CON-03: numbers referred to but not listed, or the other way round."""
    r = references.select(*key, "number").distinct().withColumn("r", F.lit(1))
    both = r.join(listed.select(*key, "number").distinct().withColumn("l", F.lit(1)), [*key, "number"], "full_outer")
    return hit(both.where("r is null or l is null"), "CON-03", [*key, "number"], F.when(F.col("r").isNull(), "unreferenced").otherwise("unlisted"))


def mixed_values(rows: DataFrame, key: list[str], value: str, rule: str) -> DataFrame:
    """FMT-09, CON-04: more than one value where one is expected."""
    many = rows.groupBy(*key).agg(F.countDistinct(value).alias("n")).where("n > 1")
    return hit(many, rule, key, F.col("n"))


def period_hits(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """FMT-02: a period between two dates not written with a tight tilde."""
    loose = F.regexp_extract_all(text, F.lit(r"\d{1,2}\.?(?:\s+[~∼〜-]\s*|\s*[∼〜-]\s*|\s*~\s+)\d{4}\."), F.lit(0))
    return hit(rows.select(*key, F.explode(loose).alias("period")), "FMT-02", key, F.col("period"))


def clock_hits(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """FMT-03: a time of day not on the 24-hour clock with a colon."""
    times = F.regexp_extract_all(text, F.lit(r"(?:오전|오후)\s*\d{1,2}(?::\d{2}|시)|\d{1,2}시\s*\d{1,2}분"), F.lit(0))
    return hit(rows.select(*key, F.explode(times).alias("time")), "FMT-03", key, F.col("time"))


# Weekdays as written after a date, Monday first.
WEEKDAYS = "월화수목금토일"


def weekday_hits(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """FMT-08: a date whose weekday in brackets is another."""
    written = F.regexp_extract_all(text, F.lit(r"\d{4}\.\s?\d{1,2}\.\s?\d{1,2}\.\s?\([" + WEEKDAYS + r"]\)"), F.lit(0))
    found = rows.select(*key, F.explode(written).alias("d"))
    day = F.try_to_timestamp(F.regexp_replace(F.regexp_extract("d", r"^(\d{4}\.\s?\d{1,2}\.\s?\d{1,2})", 1), r"\.\s?", "-"), F.lit("yyyy-M-d"))
    real = F.substring(F.lit(WEEKDAYS), F.weekday(day) + 1, F.lit(1))
    return hit(found.where(day.isNotNull() & (real != F.regexp_extract("d", r"\((.)\)$", 1))), "FMT-08", key, F.col("d"))


def long_titles(titles: DataFrame, key: list[str], most: int = TITLE) -> DataFrame:
    """STR-06."""
    return hit(titles.where(F.length("title") > most), "STR-06", key, F.length("title"))


def long_overviews(blocks: DataFrame, key: list[str], most: int = OVERVIEW_ITEMS) -> DataFrame:
    """STR-07: an overview section of more than five items or lines."""
    sums = blocks.where("tag = 'SEC_OVERVIEW'").groupBy(*key, "section").agg(F.count("*").alias("items"), F.sum("line_count").alias("lines"))
    return hit(sums.where((F.col("items") > most) | (F.col("lines") > most)), "STR-07", [*key, "section"], F.concat_ws("/", F.col("items").cast("string"), F.col("lines").cast("string")))


def long_bodies(blocks: DataFrame, key: list[str], most: int = BODY_PAGES) -> DataFrame:
    """STR-08: a body of more than two pages and no annex."""
    pages = blocks.groupBy(*key).agg(F.countDistinct(F.when(F.col("tag") != "SEC_ANNEX", F.col("page"))).alias("pages"), F.bool_or(F.col("tag") == "SEC_ANNEX").alias("annex"))
    return hit(pages.where((F.col("pages") > most) & ~F.col("annex")), "STR-08", key, F.col("pages"))


def count_mismatches(stated: DataFrame, children: DataFrame, key: list[str]) -> DataFrame:
    """CON-02: a stated number of items against the children listed; blocks that state none are left out."""
    number = F.try_to_number(F.regexp_extract("text", r"(\d{1,3})\s*(?:개|건|종|명)", 1), F.lit("999")).cast("long")
    said = stated.withColumn("said", number).where("said is not null")
    n = children.groupBy(*key).agg(F.count("*").alias("n"))
    return hit(said.join(n, key).where("said <> n"), "CON-02", key, F.concat_ws("<>", F.col("said").cast("string"), F.col("n").cast("string")))


def vague_words(rows: DataFrame, lexicon: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """EXP-01: a vague word in a text without a number. Words of a text meet the lexicon in an equi-join."""
    words = rows.where(~F.rlike(text, F.lit(r"\d"))).select(*key, F.explode(F.array_distinct(F.split(text, r"(?U)[\s,.]+"))).alias("word"))
    return hit(words.join(lexicon.select("word").distinct(), "word"), "EXP-01", key, F.col("word"))


def bare_tables(blocks: DataFrame, key: list[str], order: str) -> DataFrame:
    """EXP-05: a table with prose neither before nor after it."""
    w = Window.partitionBy(*key).orderBy(order)
    prose = lambda c: F.coalesce(c.isin("para", "item"), F.lit(False))
    beside = blocks.withColumn("ok", prose(F.lag("kind").over(w)) | prose(F.lead("kind").over(w)))
    return hit(beside.where((F.col("kind") == "table") & ~F.col("ok")), "EXP-05", [*key, order], F.lit("no prose"))


# Endings of full sentences, which items in note form don't take.
FULL_ENDINGS = ("습니다", "입니다", "됩니다", "합니다", "았습니다", "었습니다", "해요", "예요", "네요", "세요", "지요", "이다", "한다", "했다", "였다", "된다", "겠다", "있다", "없다")


def amount_hits(blocks: DataFrame, key: list[str], text: str = "text", kind: str = "kind") -> DataFrame:
    """FMT-04: an amount in won outside tables that its reading in brackets doesn't follow."""
    bare = F.regexp_extract_all(text, F.lit(r"금?\s?(?:\d{1,3}(?:,\d{3})+|\d+)\s?원(?![가-힣]*\s*\(금)"), F.lit(0))
    return hit(blocks.where(F.col(kind) != "table").select(*key, F.explode(bare).alias("amount")), "FMT-04", key, F.trim("amount"))


def law_name_hits(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """FMT-05: the name of a law before an article number without corner brackets or single quotes."""
    loose = F.regexp_extract_all(text, F.lit(r"(?:[가-힣]+(?:법|법률|시행령|시행규칙|조례)|[『“\"][^』”\"]+[』”\"])\s*제\d+조"), F.lit(0))
    return hit(rows.select(*key, F.explode(loose).alias("law")), "FMT-05", key, F.col("law"))


def enumeration_hits(rows: DataFrame, key: list[str], text: str = "text", longest: int = 5) -> DataFrame:
    """FMT-06: three or more short nouns joined by commas or slashes."""
    word = rf"[가-힣A-Za-z]{{1,{longest}}}"
    listed = F.regexp_extract_all(text, F.lit(rf"(?<![가-힣A-Za-z]){word}(?:\s?,\s?{word}){{2,}}|(?<![가-힣A-Za-z]){word}(?:\s?/\s?{word}){{2,}}"), F.lit(0))
    return hit(rows.select(*key, F.explode(listed).alias("listed")), "FMT-06", key, F.col("listed"))


def ending_hits(items: DataFrame, exempt: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """EXP-02: an item's sentence with a full ending that no exempt span covers. exempt: key, start, end (code points)."""
    full = rf"({'|'.join(FULL_ENDINGS)})(?=[.!?]?\s*(?:\n|$)|[.!?]\s)"
    ends = F.regexp_extract_all(text, F.lit(full), F.lit(0))
    # A match ends after the pieces and matches up to it; pieces and matches alternate.
    lengths = F.zip_with(F.slice(F.split(F.col(text), full, -1), F.lit(1), F.size(ends)), ends, lambda piece, m: F.length(piece) + F.length(m))
    at = F.transform(ends, lambda m, i: F.struct(m.alias("ending"), F.aggregate(F.slice(lengths, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x).cast("long").alias("at")))
    found = items.select(*key, F.inline(at))
    spans = exempt.select(*key, F.col("start").cast("long").alias("x_start"), F.col("end").cast("long").alias("x_end"))
    covered = found.join(spans, key).where("at > x_start and at <= x_end").select(*key, "at").distinct()
    return hit(found.join(covered, [*key, "at"], "left_anti"), "EXP-02", [*key, "at"], F.col("ending"))


def citations(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key, law, article of each law in corner brackets; the article is null where none follows."""
    cited = F.regexp_extract_all(text, F.lit(r"「[^」]+」(?:\s*제\d+조)?"), F.lit(0))
    each = rows.select(*key, F.explode(cited).alias("c"))
    article = F.regexp_extract("c", r"제(\d+)조$", 1)
    return each.select(*key, F.regexp_extract("c", "「([^」]+)」", 1).alias("law"), F.when(article != "", article.cast("long")).alias("article"))


def citation_faults(cited: DataFrame, register: DataFrame, key: list[str], written: str = "written") -> DataFrame:
    """LAW-01 unknown law, LAW-02 unknown article of a known one, LAW-03 not in force when the document was written.

    cited: key, law, article, and the date of writing. register: law, article, since, until (null: in force). The dates
    of all versions of an article are compared after one equi-join on law and article. A citation that a key repeats counts once.
    All joins are by merging: a register made by explode looks far smaller to Spark than it is, and would be broadcast.
    """
    laws = register.select("law").distinct().hint("merge")
    unknown = hit(cited.join(laws, "law", "left_anti"), "LAW-01", key, F.col("law"))
    known = cited.where("article is not null").join(laws, "law", "left_semi")
    articles = register.select("law", "article").distinct().hint("merge")
    name = F.concat_ws(" ", F.col("law"), F.col("article").cast("string"))
    absent = hit(known.join(articles, ["law", "article"], "left_anti"), "LAW-02", key, name)
    in_force = (F.col("since") <= F.col(written)) & (F.col("until").isNull() | (F.col(written) < F.col("until")))
    judged = known.join(register.hint("merge"), ["law", "article"]).groupBy(*key, "law", "article").agg(F.bool_or(F.coalesce(in_force, F.lit(False))).alias("ok"))
    return unknown.unionByName(absent).unionByName(hit(judged.where("not ok"), "LAW-03", key, name)).distinct()


def awaiting_judgement(sections: DataFrame, annotations: DataFrame, key: list[str]) -> DataFrame:
    """What LAW-05 and EXP-04 would have a model judge: documents without grounds, effect sections without a metric.

    sections: key, section_id, tag. annotations: key, section_id, move, steps.
    """
    grounds = annotations.where("move = 'GROUNDS'").select(*key).distinct()
    bare = sections.select(*key).distinct().join(grounds, key, "left_anti").select(*key, F.lit(None).cast("string").alias("section_id"), F.lit("LAW-05").alias("rule"))
    metric = annotations.where((F.col("move") == "EFFECT") & F.array_contains("steps", "QUANTITATIVE")).select(*key, "section_id").distinct()
    vague = sections.where("tag = 'SEC_EFFECT'").join(metric, [*key, "section_id"], "left_anti").select(*key, "section_id", F.lit("EXP-04").alias("rule"))
    return bare.unionByName(vague)
