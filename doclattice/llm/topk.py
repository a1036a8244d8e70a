"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to floor(256 * x). The index keeps, for each block of rows and each attribute, the
bits of the value above its DROPPED lowest ones as slices: one bitmap over the block's rows for each bit,
offset so that all are positive. A query's coarse score of all rows at once is the sum of the attributes'
slices, each added once for every set bit of the query's component, shifted by it, by ripple-carry bitmap
arithmetic. The k-th largest coarse score is found from the most significant slice downward; the dropped
bits can change a score by a known amount, so rows whose coarse score is that much lower cannot be among
the first k. The few boundary rows that remain are resolved with whole integers, ties going to the smaller id.

Queries are broadcast in blocks of a fixed number; each block of queries passes over all rows, every task
keeps k rows a query, and a grouped top-k merges them. With several blocks of queries, each is a job of its own that
appends its answers to one written table. Nothing is left out, and no pair of rows becomes a record.

Components of any size go through the index: a larger one has more slices. Whole numbers are 64-bit where they fit and
Python's own where they don't, so nothing overflows on the way. A score beyond a long counts as the nearest long, in the
ranking too.

Result: query_id, rank (from 1), vec_id, score. Vectors that are null or hold a null or non-finite component
take no part, nor do rows whose id is null. Vectors of other lengths count as padded with zeros. Rows that
share a query's id are its own and not its candidates; a query id that repeats is answered for its smallest
vector (compared as arrays), and a candidate id that repeats is listed as often. Extra columns are ignored. Empty tables
give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclattice.session import shared_dir

SCALE, TOP, EVERY = 256.0, 5, 50
#: Bits left out of the index.
DROPPED = 2
#: Rows of an index block, queries added at once, and queries of a broadcast.
BLOCK, LOT, QUERIES = 8192, 128, 16384
U64 = np.uint64
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(column: pa.Array) -> np.ndarray:
    """Whole numbers by row, Python's own if one doesn't fit in 62 bits; the column has no nulls and only finite components."""
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(column) else np.empty(0, np.int64)
    width = int(n.max(initial=0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = np.abs(flat).max(initial=0) >= 2.0**54
    # Numbers of 2**53 or more are whole before they are scaled.
    whole = np.array([int(x) * int(SCALE) if abs(x) >= 2.0**53 else int(np.floor(SCALE * x)) for x in flat.tolist()], object) if wide else np.floor(SCALE * flat).astype(np.int64)
    out = np.zeros((len(n), width), whole.dtype)
    out[np.arange(width) < n[:, None]] = whole
    return out


def narrow(numbers: np.ndarray) -> np.ndarray:
    """64-bit whole numbers where all fit."""
    fits = numbers.dtype != object or max((abs(x) for x in numbers.ravel().tolist()), default=0) < 1 << 62
    return numbers.astype(np.int64) if fits else numbers


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return np.pad(a, ((0, 0), (0, d - a.shape[1]))), np.pad(b, ((0, 0), (0, d - b.shape[1])))


def bitmaps(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans to 64-bit words, the last padded."""
    pad = -bits.shape[-1] % 64
    packed = np.packbits(np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, pad)]), axis=-1, bitorder="little")
    return np.ascontiguousarray(packed).view(U64)


class Slices:
    """Index of one block: slices[j] holds the bitmaps of attribute j, lowest bit first."""

    def __init__(self, values: np.ndarray, dropped: int = DROPPED):
        self.dropped, self.rows = dropped, len(values)
        self.low = [int(x) for x in values.min(axis=0) >> dropped]
        self.slices = []
        for j, low in enumerate(self.low):
            coarse = narrow((values[:, j] >> dropped) - low)
            bits = np.arange(int(coarse.max()).bit_length())[:, None]
            self.slices.append(bitmaps((coarse >> bits & 1 != 0).astype(bool)) if len(bits) else [])
        self.high = [(1 << len(s)) - 1 for s in self.slices]
        self.exists = bitmaps(np.ones(self.rows, bool))

    def coarse_scores(self, queries: np.ndarray) -> list[np.ndarray]:
        """Slices of each query's coarse scores, of shape (queries, words); negative components count the complement's distance."""
        total: list[np.ndarray] = []
        size, ones = np.abs(queries), ~U64(0)
        for j, slices in enumerate(self.slices):
            if not len(slices):
                continue
            turned = np.where(queries[:, j] < 0, ones, U64(0))[:, None]
            values = [s[None, :] ^ turned & self.exists for s in slices]
            for b in range(int(size[:, j].max()).bit_length()):
                mask = np.where(size[:, j] >> b & 1 != 0, ones, U64(0))[:, None]
                carry = None
                for i in range(b, max(len(total), b + len(values)) + 1):
                    while len(total) <= i:
                        total.append(np.zeros((len(queries), len(self.exists)), U64))
                    add = values[i - b] & mask if i - b < len(values) else None
                    if add is None and carry is None:
                        break
                    if add is None or carry is None:
                        x = carry if add is None else add
                        total[i], carry = total[i] ^ x, total[i] & x
                    else:
                        both = total[i] ^ add
                        total[i], carry = both ^ carry, total[i] & add | both & carry
                    if i - b >= len(values) - 1 and not carry.any():
                        break
        return total

    def error(self, queries: np.ndarray) -> np.ndarray:
        """What the dropped bits may add to or take from a score, in units of the coarse scores, rounded up."""
        return np.abs(queries).astype(object).sum(axis=1) + 1

    def base(self, queries: np.ndarray) -> np.ndarray:
        """What a coarse score lacks to the score, in its units: the offsets that make all slices positive."""
        up, down = np.array(self.low, object), np.array(self.low, object) + np.array(self.high, object)
        whole = queries.astype(object)
        return (whole * np.where(queries < 0, down, up)).sum(axis=1)

    def candidates(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Bitmaps (queries, words) of the rows that can be among the first k of each query."""
        total = self.coarse_scores(queries)
        n = len(queries)
        if self.rows <= k or not total:
            return np.repeat(self.exists[None, :], n, 0)
        # The k-th largest coarse score, from the most significant slice downward.
        sure, maybe = np.zeros_like(total[0]), np.repeat(self.exists[None, :], n, 0)
        kth = np.zeros(n, object)
        for i in range(len(total) - 1, -1, -1):
            with_bit = maybe & total[i]
            enough = np.bitwise_count(sure | with_bit).sum(axis=1, dtype=np.int64) >= k
            kth[enough] += 1 << i
            maybe, sure = np.where(enough[:, None], with_bit, maybe & ~total[i]), np.where(enough[:, None], sure, sure | with_bit)
        # Rows of at least that less the error. Scores beyond a long are equal, so all of them are among the rows.
        base, error = self.base(queries), self.error(queries)
        least = np.minimum(kth, (MOST >> self.dropped) - base) - error
        least = np.where((kth + base + error) << self.dropped <= LEAST, 0, np.maximum(least, 0))
        above, equal = np.zeros_like(total[0]), np.repeat(self.exists[None, :], n, 0)
        for i in range(len(total) - 1, -1, -1):
            bit = np.where((least >> i & 1).astype(bool), ~U64(0), U64(0))[:, None]
            above |= equal & total[i] & ~bit
            equal &= ~(total[i] ^ bit)
        # A bound above all coarse scores would have bits that no slice has; min and max keep it below.
        return above | equal


def scores(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products, as the nearest long."""
    size = [max((abs(int(x)) for x in (a.max(initial=0), a.min(initial=0)))) for a in (values, query)]
    if size[0] * size[1] * max(len(query), 1) <= MOST:
        return values.astype(np.int64) @ query.astype(np.int64)
    return np.array([min(max(int(x), LEAST), MOST) for x in values.astype(object) @ query.astype(object)], np.int64)


def block_top(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the first k rows of a block for each query, the query's own rows left out."""
    values, queries = _same_width(values, queries)
    own = int(np.unique(ids, return_counts=True)[1].max(initial=0))
    index = Slices(values)
    out: list[tuple] = []
    for i in range(0, len(queries), LOT):
        marks = index.candidates(queries[i : i + LOT], k + own)
        found = np.unpackbits(marks.view(np.uint8), axis=-1, bitorder="little")[:, : len(ids)].astype(bool)
        found &= query_ids[i : i + LOT, None] != ids[None, :]
        for q, row in enumerate(found, i):
            at = np.flatnonzero(row)
            score = scores(values[at], queries[q])
            order = np.lexsort((ids[at], -1 - score))[:k]
            out.append((np.full(len(order), query_ids[q]), ids[at][order], score[order]))
    return tuple(np.concatenate([o[i] for o in out]).astype(np.int64) for i in range(3))


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best = tuple(np.empty(0, np.int64) for _ in range(3))
        for batch in batches:
            ids, values = batch.column("vec_id").to_numpy(), quantised(batch.column("embedding"))
            for i in range(0, len(ids), BLOCK):
                new = block_top(ids[i : i + BLOCK], values[i : i + BLOCK], query_ids, queries, k)
                q, v, s = (np.concatenate(x) for x in zip(best, new, strict=True))
                order = np.lexsort((v, -1 - s, q))
                q, v, s = q[order], v[order], s[order]
                first = np.searchsorted(q, q)
                keep = np.arange(len(q)) - first < k
                best = q[keep], v[keep], s[keep]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["query_id", "vec_id", "score"])

    return run


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def top_k(vectors: DataFrame, every: int = EVERY, k: int = TOP, size: int = QUERIES) -> DataFrame:
    """The k highest-scoring other rows of each row whose id is divisible by every. size: queries of a broadcast."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    def answered(lot: list) -> DataFrame:
        ids = np.array([r.vec_id for r in lot], np.int64)
        values = quantised(pa.array([r.embedding for r in lot], pa.list_(pa.float64())))
        partial = rows.mapInArrow(_search(spark.sparkContext.broadcast((ids, values)), k), "query_id long, vec_id long, score long")
        return partial.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    lots = _lots(asked, size)
    lot, after = next(lots, []), next(lots, None)
    if after is None:
        return answered(lot) if lot else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    where = f"{shared_dir(spark)}/doclattice/answers-{uuid.uuid4().hex}"
    while lot:
        answered(lot).write.mode("append").parquet(where)
        lot, after = after, next(lots, None)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(where)


def _lots(asked: DataFrame, size: int) -> Iterator[list]:
    """Lists of size rows; the driver holds two at a time."""
    lot: list = []
    for row in asked.toLocalIterator():
        lot.append(row)
        if len(lot) == size:
            yield lot
            lot = []
    if lot:
        yield lot


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
