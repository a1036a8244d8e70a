"""Hierarchy of blocks: parents, section paths, sections, ancestors. One sort by (document, order) serves them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclattice.session import materialize

LEVELS = range(1, 7)
#: Steps of an ancestor walk.
HOPS = 16


def _before(key: str, seq: str) -> Window:
    return Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)


def _last_of(level: Column, which: int, ident: str, seq: str, w: Window) -> Column:
    return F.last(F.when(level == which, F.struct(F.col(seq).alias("seq"), F.col(ident).alias("id"), level.alias("level"))), ignorenulls=True).over(w)


def with_parent(blocks: DataFrame, key: str = "doc_id", seq: str = "line_no", ident: str = "line_no", level: str = "level") -> DataFrame:
    """parent: the latest earlier block of a smaller level; of a block without level, the latest earlier one that has one.

    A stack of open blocks keeps levels rising, so its top of level k is the last block of level k unless a smaller
    level came after it; the latest of all smaller levels is then the parent.
    """
    w = _before(key, seq)
    lasts = [_last_of(F.col(level), k, ident, seq, w) for k in LEVELS]
    return blocks.withColumn("__last", F.array(*lasts)).withColumn(
        "parent", F.array_max(F.filter("__last", lambda s: s.isNotNull() & (F.col(level).isNull() | (s["level"] < F.col(level)))))["id"]
    ).drop("__last")


def with_section_path(blocks: DataFrame, key: str = "doc_id", seq: str = "line_no", ident: str = "line_no", level: str = "level") -> DataFrame:
    """path: the last earlier level-1 block, then the last level-2 block if it came later."""
    w = _before(key, seq)
    one, two = (_last_of(F.col(level), k, ident, seq, w) for k in (1, 2))
    later = F.when(F.col("__two").isNotNull() & (F.col("__one").isNull() | (F.col("__two.seq") > F.col("__one.seq"))), F.col("__two.id"))
    return blocks.withColumn("__one", one).withColumn("__two", two).withColumn("path", F.array_compact(F.array(F.col("__one.id"), later))).drop("__one", "__two")


def ancestors(blocks: DataFrame, key: str = "doc_id", ident: str = "line_no", parent: str = "parent", hops: int = HOPS) -> DataFrame:
    """(key, node, ancestor, depth) up to hops steps, by doubling: joins grow with the logarithm of the depth. What a round has found is
    written, so the next one doesn't compute it again; rounds end when none finds more."""
    found = blocks.where(F.col(parent).isNotNull()).select(F.col(key).alias("k"), F.col(ident).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth"))
    found, reach = materialize(found, "ancestors"), 1
    while reach < hops:
        # Chains of exactly reach steps, made longer by all that is known of where they end.
        whole = found.where(F.col("depth") == reach)
        right = found.select("k", F.col("node").alias("ancestor"), F.col("ancestor").alias("far"), F.col("depth").alias("more"))
        longer = whole.join(right, ["k", "ancestor"]).select("k", "node", F.col("far").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
        longer = materialize(longer, "ancestors")
        if not longer.limit(1).count():
            break
        found, reach = found.unionByName(longer), reach * 2
    return found.where(F.col("depth") <= hops).select(F.col("k").alias(key), "node", "ancestor", "depth")


def roots(blocks: DataFrame, head: Column, key: str = "doc_id", seq: str = "line_no", ident: str = "line_no") -> DataFrame:
    """section: the last head at or before each block; blocks before the first head have none."""
    w = Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("section", F.last(F.when(head, F.col(ident)), ignorenulls=True).over(w))


def section_table(blocks: DataFrame, key: str = "doc_id", page: str = "page") -> DataFrame:
    """One row for each section: blocks, and its first and last page."""
    return blocks.where("section is not null").groupBy(key, "section").agg(F.count("*").alias("n_blocks"), F.min(page).alias("first_page"), F.max(page).alias("last_page"))


def tag_headings(headings: DataFrame, lexicon: DataFrame, text: str = "heading", least: int = 3) -> DataFrame:
    """tag: of the equal lexicon word, or else of the longest word of at least `least` characters that begins the
    heading (the earlier on ties), or else SEC_UNKNOWN.

    Prefixes of the headings, of the lengths that words have, meet the words in an equi-join, so the lexicon may have any number of words.
    """
    words = lexicon.where("word <> ''").groupBy("word").agg(F.min_by("tag", "seq").alias("tag"), F.min("seq").alias("seq"))
    longest = F.length(text)
    # No more numbers than the longest word has characters.
    lengths = sorted(r.n for r in words.select(F.length("word").alias("n")).distinct().collect())
    fit = F.filter(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"), lambda n: n <= longest)
    prefixes = headings.select(text).distinct().select(text, F.explode(fit).alias("n"))
    prefixes = prefixes.where((F.col("n") >= least) | (F.col("n") == longest)).select(text, "n", F.expr(f"substring({text}, 1, n)").alias("word"))
    best = prefixes.join(words, "word").groupBy(text).agg(F.max_by("tag", F.struct("n", -F.col("seq"))).alias("tag"))
    return headings.join(best, text, "left").withColumn("tag", F.coalesce("tag", F.lit("SEC_UNKNOWN")))
