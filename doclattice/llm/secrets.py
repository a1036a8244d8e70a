"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

A document's candidates are the base matches (assign, access, hex) and, as the method's own kind, `opaque`:
runs of 20 or more key-like characters that mix digits with both letter cases. Each candidate's value is hashed, and only the
hash is written or shuffled. Grouped counts of the distinct repositories and owners that hold a hash decide its class:

- copied: COPIED_OWNERS owners or more, or COPIED_REPOS repositories or more, hold it: a widely copied example;
- owned: it isn't copied, and looks live: DISTINCT different characters at least, and none of the words of placeholders;
- weak: neither.

Base matches are always reported, whatever their class; an opaque run is reported only if it is owned.

Positions come from the pieces between matches: split() and regexp_extract_all() walk the same matches, so
a match starts after all pieces and matches before it. Counts are distinct before they are shuffled, and only
candidates travel, never texts; a value that a third of all rows hold is one row for each of its owners.

Result: one row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied, n_weak (reported spans
of each class). A null text is empty. A null source is an owner of its own.
Repeated rows have the same result each. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclattice.session import materialize

# The patterns of the base kinds and of the method's own, in the order of report.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "opaque")
CLASSES = ("owned", "copied", "weak")
ASSIGN_VALUE = 6
#: A value is an example if at least so many owners, or so many repositories, hold it.
COPIED_OWNERS, COPIED_REPOS = 2, 4
#: A live-looking value has so many different characters, and none of these words.
DISTINCT = 6
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|change_me|your[_-]?|xxxx|redacted|test[_-]?key|foobar|qwerty|123456"
#: Matches of a text that one fold adds up; a text has any number of such runs.
RUN = 256


#: What is kept of a match. hash stands for its value, live tells whether the value looks so.
SPAN = "array<struct<at:int,rank:int,end:int,kind:string,hash:binary,live:boolean>>"


def _looks_live(value: Column) -> Column:
    return (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT) & ~F.rlike(value, F.lit(PLACEHOLDER))


def _matches(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of SPAN of the leftmost non-overlapping matches whose value (a group of the pattern) has the least length, offsets in code points."""
    order = KINDS.index(kind)
    empty = F.array().cast(SPAN)
    pieces = F.split(text, pattern, -1)
    triples = F.arrays_zip(pieces.alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["pos"] + F.length(x["before"])
        end = at + F.coalesce(F.length(x["match"]), F.lit(0))
        value = F.regexp_extract(x["match"], pattern, group) if group else x["match"]
        one = _bound(value, lambda v: F.struct(at.cast("int").alias("at"), F.lit(order).alias("rank"), end.cast("int").alias("end"), F.lit(kind).alias("kind"), F.unhex(F.sha2(v, 256)).alias("hash"), _looks_live(v).alias("live")))
        kept = x["match"].isNotNull() if not least else x["match"].isNotNull() & (F.length(value) >= least)
        return F.struct(end.cast("int").alias("pos"), F.when(kept, F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"))

    # Runs of RUN matches: where each run starts, then the matches within it. One fold over all would copy what it has found with each match.
    def runs(all_triples: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_triples) - 1) / RUN).cast("int")), lambda g: F.slice(all_triples, g * RUN + 1, F.lit(RUN)))

    def start_of_runs(parts: Column) -> Column:
        width = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda n, x: n + F.length(x["before"]) + F.coalesce(F.length(x["match"]), F.lit(0))))
        return F.aggregate(width, F.array(F.lit(0)), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))

    def placed(parts: Column) -> Column:
        first = F.slice(start_of_runs(parts), F.lit(1), F.size(parts))
        return F.flatten(F.zip_with(parts, first, lambda p, at: F.aggregate(p, F.struct(at.alias("pos"), empty.alias("found")), step, lambda acc: acc["found"])))

    return F.when(F.rlike(text, F.lit(pattern)), _bound(triples, lambda t: _bound(runs(t), placed))).otherwise(empty)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, though body's own lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """key, doc_id, owner, repo, base (array) and opaque (array) of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(_matches(text, ASSIGN, "assign", 2, ASSIGN_VALUE), _matches(text, ACCESS, "access"), _matches(text, HEX, "hex"))
    repo = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in repo_cols])
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        # Rows that are the same in what matters here have the same key, and the same result.
        F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.xxhash64(text_col).cast("string"), F.xxhash64(F.lit(7), F.col(text_col)).cast("string")).alias("key"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("\0")).alias("owner"),
        repo.alias("repo"),
        base.alias("base"),
        _matches(text, OPAQUE, "opaque").alias("opaque"),
    )
    # A run that a base match already covers, or touches, is no candidate of its own.
    apart = F.filter("opaque", lambda o: ~F.exists(F.col("base"), lambda b: (b["at"] < o["end"]) & (o["at"] < b["end"])))
    return rows.withColumn("opaque", apart)


def classified(found: DataFrame) -> DataFrame:
    """Reported candidates one a row: key, span, class."""
    each = found.select("key", "owner", "repo", F.explode(F.concat("base", "opaque")).alias("span"))
    held = each.select("span.hash", "owner", "repo").distinct().groupBy("hash").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repo").alias("repos"))
    kind = F.when((F.col("owners") >= COPIED_OWNERS) | (F.col("repos") >= COPIED_REPOS), "copied").when(F.col("span.live"), "owned").otherwise("weak")
    named = each.withColumn("hash", F.col("span.hash")).join(held, "hash").select("key", "span", kind.alias("class")).distinct()
    return named.where((F.col("span.kind") != "opaque") | (F.col("class") == "owned"))


def secret_report(docs: DataFrame, **columns) -> DataFrame:
    found = materialize(candidates(docs, **columns), "secrets")
    spans = classified(found).groupBy("key").agg(F.collect_set("span").alias("reported"), *(F.count_if(F.col("class") == c).alias(f"n_{c}") for c in CLASSES))
    count = lambda kind: F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.join(spans, "key", "left").select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("reported")), F.lit("")).alias("spans"),
        *(F.coalesce(f"n_{c}", F.lit(0)).alias(f"n_{c}") for c in CLASSES),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every reported span replaced by [EXAMPLE] (copied) or [SECRET]; all columns and rows stay. Spans that overlap become one mark.

    Marks are taken in runs of RUN: a run's part of the text is cut out once, its pieces from that part, so a long text with many
    spans is copied a few times and not once for each."""
    found = materialize(candidates(docs), "secrets")
    at = Window.partitionBy("key").orderBy("at", "end", "own")
    # A window holds one text's spans.
    shown = classified(found).select("key", F.col("span.at").alias("at"), F.col("span.end").alias("end"), (F.col("class") != "copied").alias("own")).distinct()
    shown = shown.withColumn("upto", F.max("end").over(at)).withColumn("prev", F.coalesce(F.lag("upto").over(at), F.lit(0)))
    marks = shown.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "end", "own", "prev", "upto"))).alias("marks"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"), F.xxhash64(F.lit(7), F.col("text")).cast("string"))
    keyed = docs.withColumn("__key", key).join(marks.select(F.col("key").alias("__key"), F.col("marks").alias("__marks")), "__key", "left")
    text, all_marks = F.col("text"), F.col("__marks")

    def piece(part: Column, start: Column, m: Column) -> Column:
        label = F.when(m["at"] < m["prev"], F.lit("")).otherwise(F.when(m["own"], F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE]")))
        return F.concat(F.substring(part, m["prev"] - start + 1, F.greatest(m["at"] - m["prev"], F.lit(0))), label)

    def run(marks: Column) -> Column:
        start, stop = F.get(marks, F.lit(0))["prev"], F.element_at(marks, -1)["upto"]
        return _bound(F.substring(text, start + 1, stop - start), lambda part: F.array_join(F.transform(marks, lambda m: piece(part, start, m)), ""))

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_marks) - 1) / RUN).cast("int")), lambda g: F.slice(all_marks, g * RUN + 1, F.lit(RUN)))
    rest = F.substring(text, F.element_at(all_marks, -1)["upto"] + 1, F.length(text))
    clean = F.concat(F.array_join(F.transform(runs, run), ""), rest)
    return keyed.withColumn("text", F.when(all_marks.isNull(), text).otherwise(clean)).select(*docs.columns)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
