"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (labelled rows of good quality) and one of
raw text (all documents), give each document a log weight: the log ratio of its whole text's probabilities.
Gumbel noise is added and the top k are taken, which samples without replacement in proportion to the
weights. k is fixed before any document is scored: it may be given; otherwise it is the number of documents times the
share of good ones among the labelled, plus MARGIN standard errors of that share, so that good documents aren't cut off.

The k-th score is found without sorting: scores are written as whole numbers in the same order, and counts by their
highest 16 bits, then by the next 16 among those that share the k-th's, and so on, lead to it in four grouped counts of at
most 65,536 rows. Ties at the k-th score go to the smaller id in the same way; null ids come last.

Features: words, word pairs, triples of character classes and patterns of recent repetition, hashed into
BUCKETS each. Counts cover all documents. Labelled rows are a bounded sample (at most MAX_LABELS, the smallest
by hash of their id), half of which train the target model; the rest serve to measure it.

Result: one row per document: doc_id, log_weight, score (with noise), keep. A null or empty text holds no
evidence, so its weight is 0. Rows that repeat an id have the same noise; those that share both the k-th score and its id are
kept together. A null id's label is unknown. Labels of unknown documents, and null qualities, are ignored; an id labelled
twice has its lowest quality. Without labels of both kinds nothing is rejected. Extra columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.llm.textkit import U64, Alphabet, _buffers, mix, words
from doclattice.session import materialize, short_batches

#: Labelled rows used at most.
MAX_LABELS = 100_000
#: Hash buckets of each family of features; three families and 16 repetition patterns.
BUCKETS = 1 << 15
FEATURES = 3 * BUCKETS + 16
#: Added to both counts of a ratio, so that rare features say little.
SMOOTHING = 2.0
#: Standard errors that are added to the share of good documents among the labelled.
MARGIN = 3.0
SEED = 77


def _classes() -> np.ndarray:
    """Character classes: ASCII lower case, upper case, digit, white space, non-ASCII; every other byte is its own."""
    c = np.arange(256, dtype=np.int64)
    c[97:123], c[65:91], c[48:58], c[128:] = 97, 65, 48, 128
    c[[9, 10, 11, 12, 13, 32]] = 32
    return c


CLASS = _classes()


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, feature, row of each) for chunks of a text column."""
    offsets, data = _buffers(column)
    for w in words(column, Alphabet(seed=SEED)):
        lo, hi = int(offsets[w.first]), int(offsets[w.first + w.rows])
        kind = CLASS[data[lo:hi]]
        row = np.repeat(np.arange(w.rows), np.diff(offsets[w.first : w.first + w.rows + 1]))
        one = kind[:-2] * 65536 + kind[1:-1] * 256 + kind[2:] if hi - lo > 2 else np.empty(0, np.int64)
        inside = row[:-2] == row[2:] if hi - lo > 2 else np.empty(0, bool)
        shape = (mix(one[inside].astype(U64), 1) % U64(BUCKETS)).astype(np.int64)
        single = (w.hashes % U64(BUCKETS)).astype(np.int64) + BUCKETS
        pair, at = w.ngrams(2)
        pair = (pair % U64(BUCKETS)).astype(np.int64) + 2 * BUCKETS
        again = np.zeros(len(w.hashes), np.int64)
        for lag in range(1, 5):
            same = np.zeros(len(again), bool)
            same[lag:] = (w.hashes[lag:] == w.hashes[:-lag]) & (w.doc[lag:] == w.doc[:-lag])
            again |= same.astype(np.int64) << lag - 1
        yield w.first, w.rows, np.concatenate([shape, single, pair, again + 3 * BUCKETS]), np.concatenate([row[:-2][inside] if hi - lo > 2 else row[:0], w.doc, w.doc[at], w.doc])


@dataclass(frozen=True)
class Labels:
    """A bounded sample: ids in order, whether each is good, and whether it trains (or else sets the cut)."""

    ids: np.ndarray
    good: np.ndarray
    trains: np.ndarray

    def of(self, ids: pa.Array) -> np.ndarray:
        """Place of each id, -1 where it has no label."""
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(self.ids):
            return np.full(len(number), -1)
        at = np.minimum(np.searchsorted(self.ids, number), len(self.ids) - 1)
        return np.where(known & (self.ids[at] == number), at, -1)


def sample_labels(labels: DataFrame, most: int = MAX_LABELS) -> Labels:
    rows = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    rows = rows.withColumn("h", F.xxhash64("doc_id")).orderBy("h").limit(most).toPandas().sort_values("doc_id")
    return Labels(rows["doc_id"].to_numpy(np.int64), rows["quality"].to_numpy() > 0, rows["h"].to_numpy(np.int64) >> 7 & 1 == 0)


def _count(labels: Labels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
        for batch in batches:
            at = labels.of(batch.column("doc_id"))
            wanted = (at >= 0) & labels.good[at] & labels.trains[at] if len(labels.ids) else np.zeros(len(at), bool)
            for first, _, feature, row in features(batch.column("text")):
                raw += np.bincount(feature, minlength=FEATURES)
                target += np.bincount(feature[wanted[first + row]], minlength=FEATURES)
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(raw[met]), pa.array(target[met])], ["feature", "raw", "target"])

    return run


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each feature, within its family: the target's count against the one that raw text lets expect."""
    out = np.zeros(FEATURES)
    for lo, hi in [(0, BUCKETS), (BUCKETS, 2 * BUCKETS), (2 * BUCKETS, 3 * BUCKETS), (3 * BUCKETS, FEATURES)]:
        expected = raw[lo:hi] / max(raw[lo:hi].sum(), 1) * target[lo:hi].sum()
        out[lo:hi] = np.log(target[lo:hi] + SMOOTHING) - np.log(expected + SMOOTHING)
    return out


def gumbel(ids: pa.Array, seed: int = SEED) -> np.ndarray:
    number = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
    u = ((mix(number, seed) >> U64(11)).astype(np.float64) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def weigh(column: pa.Array, ratios: np.ndarray) -> np.ndarray:
    out = np.zeros(len(column))
    for first, rows, feature, row in features(column):
        out[first : first + rows] = np.bincount(row, ratios[feature], minlength=rows)
    return out


@dataclass(frozen=True)
class Model:
    """Log ratios by feature, and the share of all documents that is kept."""

    ratios: np.ndarray
    share: float


def good_share(good: np.ndarray, margin: float = MARGIN) -> float:
    """Share of good ones, with a margin for the size of the sample; all, unless both kinds are there."""
    if not good.any() or good.all():
        return 1.0
    share = float(good.mean())
    return min(1.0, share + margin * math.sqrt(share * (1 - share) / len(good)))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELS) -> Model:
    short_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = sample_labels(labels, most)
    counted = docs.mapInArrow(_count(sample), "feature long, raw long, target long").groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(FEATURES), np.zeros(FEATURES)
    at = counted["feature"].to_numpy(np.int64)
    raw[at], target[at] = counted["raw"].to_numpy(np.float64), counted["target"].to_numpy(np.float64)
    if not target.sum():
        return Model(np.zeros(FEATURES), 1.0)
    return Model(log_ratios(raw, target), good_share(sample.good))


def in_order(score: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the scores."""
    bits = score.astype(np.float64).view(np.int64)
    return bits ^ (bits >> np.int64(63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _weighed(batch: pa.RecordBatch, ratios: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    ids = batch.column("doc_id").cast(pa.int64())
    weight = weigh(batch.column("text"), ratios)
    return ids, weight, weight + gumbel(ids)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, weight, score = _weighed(batch, shared.value)
            yield pa.RecordBatch.from_arrays([ids, pa.array(weight), pa.array(score), pa.array(in_order(score))], ["doc_id", "log_weight", "score", "place"])

    return run


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _largest(rows: DataFrame, column: Column, k: int) -> tuple[int, int]:
    """The k-th largest (from 1) of a column of longs, and how many of its equals are among the first k. Grouped counts by 16 bits each."""
    known = 0  # what has been found: the bits above shift, of the value less LEAST
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(column.bitwiseXOR(F.lit(LEAST)), shift)
        inside = rows if shift == 48 else rows.where(F.shiftrightunsigned(column.bitwiseXOR(F.lit(LEAST)), shift + 16) == known)
        counts = inside.groupBy(digit.bitwiseAND(F.lit(0xFFFF)).alias("digit")).agg(F.count("*").alias("n")).collect()
        for r in sorted(counts, key=lambda r: -r.digit):
            if k <= r.n:
                known = known << 16 | r.digit
                break
            k -= r.n
    return known + LEAST, k


@dataclass(frozen=True)
class Cut:
    """Rows of a larger place are kept, and of an equal place those of an id up to last_id."""

    place: int
    last_id: int

    def column(self) -> Column:
        return (F.col("place") > self.place) | (F.col("place") == self.place) & (F.coalesce("doc_id", F.lit(MOST)) <= self.last_id)

    def mask(self, ids: pa.Array, score: np.ndarray) -> np.ndarray:
        place = in_order(score)
        return (place > self.place) | (place == self.place) & (ids.fill_null(MOST).to_numpy(zero_copy_only=False) <= self.last_id)


def top_cut(scored: DataFrame, k: int, total: int) -> Cut:
    """What the k highest scores have in common."""
    if k >= total:
        return Cut(LEAST, MOST)
    if k <= 0:
        return Cut(MOST, LEAST)
    place, equals = _largest(scored, F.col("place"), k)
    # Smallest ids first: the largest of the complements.
    ties = scored.where(F.col("place") == place).select(F.bitwise_not(F.coalesce("doc_id", F.lit(MOST))).alias("turned"))
    return Cut(place, ~_largest(ties, F.col("turned"), equals)[0])


def _resampled(docs: DataFrame, labels: DataFrame, k: int | None) -> tuple[DataFrame, Cut, object]:
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model.ratios)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(shared), "doc_id long, log_weight double, score double, place long")
    scored = materialize(scored, "scored")
    total = scored.count()
    return scored, top_cut(scored, math.ceil(total * model.share) if k is None else k, total), shared


def score_quality(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """doc_id, log_weight, score, keep for each row of docs: keep holds for the k highest scores, ties to the smaller id."""
    scored, cut, _ = _resampled(docs, labels, k)
    return scored.select("doc_id", "log_weight", "score", cut.column().alias("keep"))


def kept_documents(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """docs without those that the classifier rejects, all columns kept. Whole texts aren't shuffled: a second narrow pass weighs them again."""
    _, cut, shared = _resampled(docs, labels, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, _, score = _weighed(batch, shared.value)
            yield batch.filter(pa.array(cut.mask(ids, score)))

    return docs.mapInArrow(run, docs.schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
