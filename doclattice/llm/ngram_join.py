"""N-gram Jaccard join: grouped prefix join over word shingles.

1. Every whole text becomes its set of distinct k-word shingles, in one order that all documents share: by hash first, then
   those that too many prefixes would post (demoted), then those that are frequent in the corpus (heavy.py), by count. What is
   demoted is a bitmap of DEMOTED_BITS that counts over all prefixes fill, so it is broadcast at any size of the corpus. Any bitmap
   gives an order, so results don't depend on it; posting lists of more than HOT groups remain only of texts that consist
   of demoted shingles for the most part, as a passage that many texts quote is behind the prefix of all others.
2. Documents of equal sets collapse into one class. Classes of equal size and equal prefix collapse into
   one group, which posts the prefix's shingles once.
3. Group pairs that share a posting are filtered by size and by the shingles' positions. First each
   shingle's pivot group (the one that has it earliest) is compared with the other groups there: a star,
   linear in the postings. Links that verification confirms merge documents into components. Only then
   are the pairs between different components made, so a family of near copies costs a star and not its
   square; such pairs meet by shingle and class of size, so that sizes which can't link don't meet, and only where
   the shingle may be their first shared one. Then whole prefixes are counted.
4. Surviving group pairs expand to members, and the members' whole texts are compared exactly.

Result: one row per document: doc_id, n_shingles, component_id. A null text has no words; a document
without words has an empty set and links with nothing. With fewer than k words the whole sequence is the
one shingle. Rows that repeat a doc_id count as one document and so as linked; rows whose doc_id is null
are returned as their own component (null). Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.llm.components import connected_components
from doclattice.llm.heavy import heavy_hitters
from doclattice.llm.textkit import U64, Alphabet, Words, mix, words
from doclattice.session import drop_materialized, materialize, short_batches

WORDS = Alphabet(lower=True)
TOP = U64(1 << 63)
#: Bits of the table of demoted shingles (8 MB), and where they begin in the order.
DEMOTED_BITS = 1 << 26
BACK = U64(1 << 62)
#: A shingle of more postings is demoted; more, where that many shingles would fill over half of the bits.
HOT = 256


@dataclass(frozen=True)
class Threshold:
    """Similarity of at least num/den."""

    num: int = 85
    den: int = 100

    def overlap(self, a, b):
        """The least intersection of sets of a and b members that link. Works on numbers and columns."""
        total = (a + b) * self.num
        return -((-total) // (self.num + self.den)) if not isinstance(total, Column) else F.ceil(total / (self.num + self.den)).cast("long")

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -((-n * self.num) // self.den) + 1


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and the row of each, repeats included; short rows have their whole sequence."""
    grams, at = w.ngrams(k)
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    return np.concatenate([grams, w.whole()[short]]), np.concatenate([w.doc[at], short])


def distinct_sorted(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return keys[new], doc[new]


def _ordered(keys: np.ndarray, heavy: np.ndarray, rank: np.ndarray, demoted: np.ndarray | None) -> np.ndarray:
    """Keys in the shared order as numbers: light ones below 2**62 by hash, demoted ones from there, heavy ones from 2**63 by rank."""
    out = keys >> U64(2)
    if demoted is not None:
        place = out & U64(DEMOTED_BITS - 1)
        out = out | (demoted[place >> U64(6)] >> (place & U64(63)) & U64(1)) * BACK
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, keys), len(heavy) - 1)
        hit = heavy[at] == keys
        out[hit] = TOP + rank[at[hit]]
    return out


def demoted_shingles(prefixes: DataFrame, hot: int = HOT) -> np.ndarray | None:
    """The bitmap, as 64-bit words, of the light shingles that more than hot prefixes hold; none if there is no such shingle."""
    light = prefixes.select(F.explode("prefix").alias("shingle")).where("shingle >= 0").groupBy("shingle").agg(F.count("*").alias("n"))
    total = prefixes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    word, bit = F.expr(f"shiftright(shingle & {DEMOTED_BITS - 1}L, 6)"), F.expr("shiftleft(1L, cast(shingle & 63L as int))")
    # DEMOTED_BITS / 64 rows at most.
    words64 = light.where(F.col("n") > max(hot, 2 * total // DEMOTED_BITS)).select(word.alias("word"), bit.alias("bit"))
    rows = words64.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    if not len(rows):
        return None
    out = np.zeros(DEMOTED_BITS // 64, U64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(U64)
    return out


def _profiles(k: int, limit: Threshold, heavy: np.ndarray, rank: np.ndarray, shared=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        demoted = None if shared is None else shared.value
        for batch in batches:
            for w in words(batch.column("text"), WORDS):
                keys, doc = shingles(w, k)
                keys, doc = distinct_sorted(_ordered(keys, heavy, rank, demoted), doc)
                n = np.bincount(doc, minlength=w.rows)
                ends = np.cumsum(n)
                starts = ends - n
                sums = []
                for salt in (3, 4):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(keys, salt))])
                    sums.append((total[ends] - total[starts]).view(np.int64))
                length = np.where(n > 0, limit.prefix(n), 0)
                keep = np.arange(len(keys)) - starts[doc] < length[doc]
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[keep].view(np.int64)))
                ids = batch.column("doc_id").slice(w.first, w.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), prefix], ["doc_id", "n", "s1", "s2", "prefix"])

    return run


def _verify(k: int, limit: Threshold):
    """Pairs (a, b, ta, tb) whose texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            found = np.zeros(len(a), bool)
            first = 0
            # Texts of a and b alternate, so both sets of a pair are in one chunk or in two that follow each other.
            ta, tb = batch.column("ta"), batch.column("tb")
            step = 64
            for first in range(0, len(a), step):
                m = min(step, len(a) - first)
                both = pa.concat_arrays([ta.slice(first, m), tb.slice(first, m)])
                keys, docs = [np.empty(0, U64)], [np.empty(0, np.int64)]
                for w in words(both, WORDS):
                    x, d = shingles(w, k)
                    keys.append(x)
                    docs.append(d + w.first)
                x, d = distinct_sorted(np.concatenate(keys), np.concatenate(docs))
                n = np.bincount(d, minlength=2 * m)
                x, pair = distinct_runs(x, d % m)
                same = np.bincount(pair, minlength=m)
                found[first : first + m] = (same > 0) & (same * (limit.num + limit.den) >= (n[:m] + n[m:]) * limit.num)
            yield pa.RecordBatch.from_arrays([pa.array(a[found]), pa.array(b[found])], ["a", "b"])

    return run


def distinct_runs(keys: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of members of two sets each: those that both sets of a pair have."""
    order = np.lexsort((keys, pair))
    keys, pair = keys[order], pair[order]
    twice = np.zeros(len(keys), bool)
    twice[1:] = (keys[1:] == keys[:-1]) & (pair[1:] == pair[:-1])
    return keys[twice], pair[twice]


def links(pairs: DataFrame, texts: DataFrame, k: int, limit: Threshold) -> DataFrame:
    """Those of the distinct pairs (a, b) whose whole texts link."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(_verify(k, limit), "a long, b long")


def _sizes(limit: Threshold, n1: str, n2: str) -> Column:
    """Size filter."""
    a, b = F.col(n1), F.col(n2)
    return F.least(a, b) * limit.den >= F.greatest(a, b) * limit.num


def _could_link(limit: Threshold, n1: str, p1: str, n2: str, p2: str) -> Column:
    """Size filter, and the filter by the positions of the first shared shingle (from 0): it and what follows must suffice."""
    a, b = F.col(n1), F.col(n2)
    least = limit.overlap(a, b)
    return _sizes(limit, n1, n2) & (F.col(p1) <= a - least) & (F.col(p2) <= b - least)


def _seeds(mixed: DataFrame, limit: Threshold) -> DataFrame:
    """Group pairs (a, b), repeats included, by the postings (shingle, gid, n, pos, lo, hi) that may be their first shared one."""
    # Sizes that can link are of one class or of neighbouring ones; the smaller class looks for its own and the next.
    mixed = mixed.withColumn("class", F.floor(F.log("n") / (1.001 * math.log(limit.den / limit.num))).cast("int") if limit.num < limit.den else F.col("n"))
    right = mixed.select(
        "shingle", F.col("gid").alias("other"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
        F.col("class").alias("own"), F.explode(F.array("class", F.col("class") - 1)).alias("class"),
    )
    apart = F.least("lo", "lo2") < F.greatest("hi", "hi2")
    once = (F.col("own") > F.col("class")) | (F.col("gid") < F.col("other"))
    pairs = mixed.join(right, ["shingle", "class"]).where(once & apart & _could_link(limit, "n", "pos", "m", "at"))
    return pairs.select(F.least("gid", "other").alias("a"), F.greatest("gid", "other").alias("b"))


PROFILE = "doc_id long, n long, s1 long, s2 long, prefix array<long>"


def ngram_components(docs: DataFrame, k: int = 4, limit: Threshold = Threshold(), id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    short_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def occurrences(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for w in words(batch.column("text"), WORDS):
            yield shingles(w, k)[0]

    heavy, count, _ = heavy_hitters(docs, ["text"], occurrences)
    rank = np.empty(len(heavy), np.uint64)
    rank[np.lexsort((heavy, count))] = np.arange(len(heavy), dtype=np.uint64)
    profiles = materialize(docs.mapInArrow(_profiles(k, limit, heavy, rank), PROFILE), "profiles")
    demoted = demoted_shingles(profiles, hot)
    if demoted is not None:
        drop_materialized(profiles)
        profiles = materialize(docs.mapInArrow(_profiles(k, limit, heavy, rank, docs.sparkSession.sparkContext.broadcast(demoted)), PROFILE), "profiles")

    # Classes: documents of equal sets. rep is the smallest doc_id among them.
    ids = profiles.where("n > 0 and doc_id is not null").select("doc_id", "n", "s1", "s2")
    classes = materialize(ids.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = profiles.join(classes.select(F.col("rep").alias("doc_id"), "n", "s1", "s2"), ["doc_id", "n", "s1", "s2"], "left_semi")

    # Groups: classes of equal size and prefix. Members of a group share every prefix shingle.
    signed = reps.select("doc_id", "n", F.xxhash64("prefix").alias("sign"), "prefix")
    member = signed.select("doc_id", "n", "sign").withColumnRenamed("doc_id", "member")
    grouped = member.groupBy("n", "sign").agg(F.min("member").alias("gid"), F.count("*").alias("members"))
    members = materialize(member.join(grouped.where("members > 1").drop("members"), ["n", "sign"]).select("gid", "member"), "members", small=True)
    postings = (
        signed.join(members.where("gid <> member").select(F.col("member").alias("doc_id")), "doc_id", "left_anti")
        .select(F.col("doc_id").alias("gid"), "n", F.posexplode("prefix").alias("pos", "shingle"))
    )
    # A shingle of one group only makes no pair. The pivot has the shingle earliest: it has fewest rare ones.
    shared = materialize(
        postings.groupBy("shingle").agg(F.count("*").alias("df"), F.min(F.struct("pos", "gid", "n")).alias("pivot")).where("df > 1").select("shingle", "pivot"), "shared"
    )
    live = materialize(postings.join(shared, "shingle").select("shingle", "gid", "n", "pos", "pivot"), "live")

    # Stars: each group with the pivots of its shingles, and members of a group with its first.
    star = (
        live.where("gid <> pivot.gid").select("gid", "n", "pos", F.col("pivot.gid").alias("other"), F.col("pivot.n").alias("m"), F.col("pivot.pos").alias("at"))
        .where(_could_link(limit, "n", "pos", "m", "at")).select(F.least("gid", "other").alias("a"), F.greatest("gid", "other").alias("b")).distinct()
    )
    star = materialize(star, "star", small=True)
    inside = members.where("gid <> member").select(F.col("gid").alias("a"), F.col("member").alias("b"))
    # Only documents of live groups and of groups with several members are ever compared.
    wanted = live.select(F.col("gid").alias("doc_id")).unionAll(members.select(F.col("member").alias("doc_id"))).distinct()
    texts = materialize(docs.join(wanted, "doc_id", "left_semi"), "texts")
    first = materialize(links(_expand(star, members).unionAll(inside).distinct(), texts, k, limit), "links")
    labels = connected_components(first)

    # Between components: what the stars did not settle. Members of a group may be in several components, lo to hi.
    label = labels.select(F.col("node").alias("member"), "component")
    parted = members.join(label, "member", "left").withColumn("component", F.coalesce("component", "member"))
    parted = materialize(parted, "parted", small=True)
    several = parted.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    single = label.select(F.col("member").alias("gid"), "component")
    labelled = live.select("shingle", "gid", "n", "pos").join(single, "gid", "left").join(several, "gid", "left")
    labelled = labelled.select("shingle", "gid", "n", "pos", F.coalesce("lo", "component", "gid").alias("lo"), F.coalesce("hi", "component", "gid").alias("hi"))
    labelled = materialize(labelled, "labelled")
    spread = labelled.groupBy("shingle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("shingle")
    mixed = materialize(labelled.join(spread, "shingle", "left_semi"), "mixed")
    # A pair comes from shared shingles that may be its first one, so a family's common shingles bring no pair of members whose
    # own ones come before them. Tables that only served to find pairs go before texts are dealt.
    seeds = materialize(_seeds(mixed, limit).distinct().join(star, ["a", "b"], "left_anti"), "seeds", small=True)
    for done in (live, labelled, mixed):
        drop_materialized(done)
    # Count filter: what whole prefixes don't share must be made up for by what comes after them.
    one, two = (profiles.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("prefix").alias(f"p{x}")) for x in "ab")
    cross = seeds.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("pa", "pb")))
    longest = F.ceil(F.greatest("na", "nb") * limit.num / limit.den) - 1
    cross = cross.where(F.col("common") + longest >= limit.overlap(F.col("na"), F.col("nb"))).select("a", "b").distinct()
    # Stars have compared all members of their pairs; of the other pairs, members of one component need no comparison.
    rest = _expand(materialize(cross, "cross", small=True), members)
    one, two = (label.select(F.col("member").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    rest = rest.join(one, "a", "left").join(two, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    # Groups of several members whose members did not all link with the first: their other pairs.
    loose = parted.join(several.select("gid"), "gid", "left_semi")
    other = loose.select("gid", F.col("member").alias("b"), F.col("component").alias("component2"))
    within = loose.withColumnRenamed("member", "a").join(other, "gid").where("a < b and component <> component2").select("a", "b")
    second = links(rest.unionAll(within).distinct(), texts, k, limit)
    labels = connected_components(materialize(first.unionAll(second), "links"))

    named = classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    rows = profiles.select("doc_id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Group pairs to pairs of members; a group that isn't in members stands for itself."""
    one = members.select(F.col("gid").alias("a"), F.col("member").alias("x"))
    two = members.select(F.col("gid").alias("b"), F.col("member").alias("y"))
    wide = pairs.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    return wide.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
