"""Best-fit packing with Martello-Toth dominance reduction.

Documents become token ids and a closing id; a longer one than a sequence is cut into whole sequences, its
first piece being what is left over. Only the number of pieces of each length matters for the plan, so the
driver solves the packing on a histogram of at most `capacity` counts, whatever the number of documents:

1. Reduction (Martello-Toth): where a piece j, from the longest down, has a set of companions that dominates
   every other choice, that sequence is fixed for good, many at a time. Dominating sets: none, if nothing fits beside j;
   the longest k that fits, if it fills the sequence exactly or if no two pieces fit beside j together.
2. Best fit decreasing packs the rest: each length, longest first, goes to the open sequences whose free
   space is least and suffices.

Sequences of equal make are a range of numbers, so the plan is a table of (length, first rank, ranks, first
sequence, offset). Ranks of pieces within their length come from slices of it (the length and a hash
of the document), one for each SLICE_ROWS pieces and for each 1/PARTS of all pieces, so a frequent length is numbered
by as many tasks as its count asks for, and what is broadcast is a row for each slice: capacity + PARTS + pieces /
SLICE_ROWS of them at most.

Result: one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null text is
empty: one piece of the closing id. Repeated rows and null ids are packed as they come. Extra columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclattice.session import materialize, short_batches

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces of one length that a task numbers on average.
SLICE_ROWS = 1_000_000
#: A slice is at most this part of all pieces, on average.
PARTS = 1024
VOCABULARY = "byte_bpe_50k"


def encoder(name: str = VOCABULARY):
    """Token ids of a text, as an array: those of the vocabulary's .json file without added special tokens. Its rank file is the
    faster form for ordinary text; strings of the .json file's special tokens that a text holds become their ids, as there."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    made = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.asarray(made.encode_to_numpy(text, allowed_special="all"), np.uint32)


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Whole sequences, after a first piece of what is left over."""
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


def _pieces(capacity: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name)
        seen = 0
        for batch in batches:
            rows: list[list] = [[] for _ in range(5)]
            for number, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.uint32(CLOSING_ID)).astype("<u4")
                at = 0
                for piece, n in enumerate(piece_lengths(len(ids), capacity)):
                    for column, x in zip(rows, (number, piece, at, n, zlib.crc32(ids[at : at + n].tobytes())), strict=False):
                        column.append(x)
                    at += n
            salt = pa.array([seen + r for r in rows[0]], pa.int64())
            seen += len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5]), salt], ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
            )

    return run


@dataclass
class Open:
    """Sequences first..first+count-1, of equal make: free tokens are left in each."""

    first: int
    count: int
    free: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, offset): rank r of a length is in sequence first + r - first rank."""
    left = {s: n for s, n in histogram.items() if n > 0}
    ranks: dict[int, int] = dict.fromkeys(left, 0)
    table: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, count: int, first: int, offset: int) -> None:
        table.append((length, ranks[length], count, first, offset))
        ranks[length] += count
        left[length] -= count
        if not left[length]:
            del left[length]

    # Dominance: a piece and its companion, fixed for all copies at once; again until nothing is fixed.
    while True:
        before = sequences
        for j in sorted(left, reverse=True):
            while j in left:
                room = capacity - j
                k = max((s for s in left if s <= room and (s != j or left[j] > 1)), default=0)
                if not k:
                    n = left[j]
                    place(j, n, sequences, 0)
                    sequences += n
                    break
                least = sorted(s for s in left if s <= room)[:2]
                spare = left[least[0]] - (least[0] == j)
                two = 2 * least[0] if spare > 1 else sum(least) if len(least) > 1 else capacity + 1
                if k != room and two <= room:
                    break
                n = left[j] // 2 if j == k else min(left[j], left[k])
                place(j, n, sequences, 0)
                place(k, n, sequences, j)
                sequences += n
        if sequences == before:
            break

    # Best fit decreasing over what is left.
    open_by_free: dict[int, list[Open]] = {}
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            free = min((f for f, o in open_by_free.items() if f >= s and o), default=None)
            if free is None:
                # Nothing open fits: new sequences. As many of the length as fit go to each before the next is opened.
                each = capacity // s
                full, rest = divmod(n, each)
                for made, count in ((full, each), (1, rest)):
                    if made and count:
                        for i in range(count):
                            place(s, made, sequences, i * s)
                        if capacity - count * s:
                            open_by_free.setdefault(capacity - count * s, []).append(Open(sequences, made, capacity - count * s))
                        sequences += made
                break
            group = open_by_free[free].pop()
            m = min(n, group.count)
            place(s, m, group.first, capacity - free)
            if free - s:
                open_by_free.setdefault(free - s, []).append(Open(group.first, m, free - s))
            if m < group.count:
                open_by_free[free].append(Open(group.first + m, group.count - m, free))
            n -= m
    return table


def _assign(table: np.ndarray):
    """table rows are sorted by (length, first rank)."""
    keys = table[:, 0] << 44 | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, length << 44 | rank, "right") - 1] if len(rank) else table[:0]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, capacity: int = CAPACITY, name: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    spark = docs.sparkSession
    short_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(docs.mapInArrow(_pieces(capacity, name), "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"), "pieces")
    # capacity counts at most.
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    made = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 5)
    each = max(1, min(slice_rows, sum(histogram.values()) // PARTS))
    slices = spark.createDataFrame([(length, -(-n // each)) for length, n in histogram.items()], "length long, slices long")
    sliced = pieces.join(F.broadcast(slices), "length").withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.col("slices")))
    counts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n")).toPandas().sort_values(["length", "slice"])
    counts["before"] = counts.groupby("length")["n"].cumsum() - counts["n"]
    before = spark.createDataFrame([(int(r.length), int(r.slice), int(r.before)) for r in counts.itertuples()], "length long, slice long, before long")
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    ranked = sliced.withColumn("rank", F.row_number().over(within)).join(F.broadcast(before), ["length", "slice"]).withColumn("rank", F.col("before") + F.col("rank") - 1)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_assign(made), OUT)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
