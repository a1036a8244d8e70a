"""Benchmark decontamination by Wu-Manber multi-pattern search.

Items become windows of 13 consecutive words (an item of fewer words is one window), written as
" word word ... ". Windows are the patterns. For each class of patterns a shift table over blocks of bytes
tells how far the search may advance; where it says 0, the block's suffix bucket lists the patterns that
may end there, and a direct comparison of bytes confirms or refutes each. Many positions advance at once:
the normalised text of a chunk is cut into lanes that step together.

Benchmark texts are broadcast in blocks of at most block_bytes, whatever the size of the table: each
block is one narrow pass over the documents that adds to what the passes before it found, so there is no
shuffle and no bound on the benchmark. At most CHAIN passes run in one stage, each a Python worker with the tables of one block;
then the rows and what was found are written, the blocks are unpersisted, and the next passes read them.

Result: one row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A null or
word-less text has 0 words and isn't contaminated; null and word-less items have no windows; an item_id
that repeats counts once, a null item_id not at all (its words are still hit). Repeated rows are returned
each. Extra columns are ignored. Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from doclattice.session import drop_materialized, materialize, short_batches

#: Words of a window.
WINDOW = 13
#: Bytes of benchmark text that a broadcast block holds; one larger item makes a block of its own.
BLOCK_BYTES = 8 << 20
#: Blocks that one stage takes.
CHAIN = 4
#: Bytes of normalised text that are searched at once, and of a lane.
CHUNK, LANE = 1 << 20, 2048
#: Words of up to this many bytes a pattern go to classes of their own, so that a short one doesn't shorten all shifts.
CLASSES = (8, 24, 48)

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split() if text else []


def item_windows(text: str | None, k: int = WINDOW) -> set[bytes]:
    w = normal_words(text)
    if not w:
        return set()
    return {b" " + b" ".join(w[i : i + k]) + b" " for i in range(max(1, len(w) - k + 1))}


@dataclass
class WuManber:
    """Search tables for patterns of at least m bytes. Blocks are of width bytes."""

    patterns: list[bytes]
    m: int = 0
    width: int = 0
    shift: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    buckets: dict[int, list[tuple[bytes, int]]] = field(default_factory=dict)

    BITS = 20

    def __post_init__(self) -> None:
        self.m = min(map(len, self.patterns))
        self.width = min(8, self.m)
        self.shift = np.full(1 << self.BITS, self.m - self.width + 1, np.int32)
        heads = np.frombuffer(b"".join(p[: self.m] + bytes(8) for p in self.patterns), np.uint8).reshape(len(self.patterns), self.m + 8)
        for end in range(self.width, self.m + 1):
            keys = self._key(np.ascontiguousarray(heads[:, end - self.width : end - self.width + 8]).view("<u8")[:, 0])
            np.minimum.at(self.shift, keys, self.m - end)
        for number, (p, key) in enumerate(zip(self.patterns, keys.tolist(), strict=True)):
            self.buckets.setdefault(key, []).append((p, number))

    def _key(self, blocks: np.ndarray) -> np.ndarray:
        """Table places of blocks, given as eight bytes of which the first width count."""
        return ((blocks & np.uint64((1 << 8 * self.width) - 1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern number) of every occurrence."""
        n = len(text)
        if n < self.m:
            return
        blocks = np.ndarray((n + 1,), "<u8", text + bytes(8), strides=(1,))
        at = np.arange(self.m, n + 1, LANE)
        stop = np.minimum(at + LANE, n + 1)
        while len(at):
            key = self._key(blocks[at - self.width])
            step = self.shift[key]
            for end, k in zip(at[step == 0].tolist(), key[step == 0].tolist(), strict=True):
                start = end - self.m
                for pattern, number in self.buckets.get(k, ()):
                    if text.startswith(pattern, start):
                        yield start, number
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]


@dataclass
class Benchmark:
    """One block of items: patterns by class of length, and the items that have each."""

    machines: list[WuManber]
    items: list[list[list[str]]]
    words: list[list[int]]

    @staticmethod
    def of(rows: list[tuple[object, str | None]], k: int = WINDOW) -> Benchmark:
        owners: dict[bytes, set[str]] = {}
        for item, text in rows:
            for p in item_windows(text, k):
                owners.setdefault(p, set()).update([] if item is None else [str(item)])
        classes: dict[int, list[bytes]] = {}
        for p in sorted(owners):
            classes.setdefault(sum(len(p) > c for c in CLASSES), []).append(p)
        machines = [WuManber(c) for _, c in sorted(classes.items())]
        return Benchmark(machines, [[sorted(owners[p]) for p in m.patterns] for m in machines], [[p.count(b" ") - 1 for p in m.patterns] for m in machines])

    def find(self, texts: list[bytes]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """For each normalised text: word ranges that are hit (start, end), and items."""
        out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) < CHUNK):
                size += len(texts[last]) + 1
                last += 1
            offsets = np.cumsum([0, *(len(t) + 1 for t in texts[first:last])])
            joined = b"\0".join(texts[first:last])
            found = [(start, kind, number) for kind, machine in enumerate(self.machines) for start, number in machine.search(joined)]
            if found:
                spaces = np.cumsum(np.frombuffer(joined, np.uint8) == 32)
                starts = np.array([x[0] for x in found])
                row = np.searchsorted(offsets, starts, "right") - 1
                before = np.concatenate([[0], spaces])[offsets[row]]
                word = spaces[starts] - before - 1
                for r, w, (_, kind, number) in zip(row.tolist(), word.tolist(), found, strict=True):
                    ranges, items = out[first + r]
                    ranges.append((w, w + self.words[kind][number]))
                    items.update(self.items[kind][number])
            first = last
        return out


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [(lo, hi) for lo, hi in merged]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str | None]]]:
    """All items, in lists of at most block_bytes. The driver holds one list at a time."""
    rows: list[tuple[object, str | None]] = []
    size = 0
    for item, text in benchmark.where("text is not null").toLocalIterator():
        grow = 4 * len(text.encode("utf-8", "surrogatepass"))
        if rows and size + grow > block_bytes:
            yield rows
            rows, size = [], 0
        rows.append((item, text))
        size += grow
    yield rows


#: What one block's pass hands to the next, beside the rows' own columns.
STATE = "__n_words long, __ranges array<struct<lo:int,hi:int>>, __items array<string>"
REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def is_contaminated(hit: int, words: int) -> bool:
    return hit > 0 and 20 * hit >= words


#: The search tables of the block that this worker had last; tasks that follow each other in a worker share them.
_LAST: dict[str, Benchmark] = {}


def _tables(shared, name: str, k: int) -> Benchmark:
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Benchmark.of(shared.value, k)
    return _LAST[name]


def _pass(shared, name: str, own: list[str], first: bool, last: bool, report: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _tables(shared, name, k)
        for batch in batches:
            words = [normal_words(t) for t in batch.column("text").to_pylist()]
            found = machine.find([b" " + b" ".join(w) + b" " if w else b"" for w in words]) if machine.machines else [([], set())] * len(words)
            if not first:
                known = zip(batch.column("__ranges").to_pylist(), batch.column("__items").to_pylist(), strict=True)
                found = [(r + [(x["lo"], x["hi"]) for x in old], items | set(more)) for (r, items), (old, more) in zip(found, known, strict=True)]
            found = [(merge_ranges(r), sorted(items)) for r, items in found]
            n = [len(w) for w in words]
            hit = [sum(hi - lo for lo, hi in r) for r, _ in found]
            bad = pa.array([is_contaminated(h, w) for h, w in zip(hit, n, strict=True)], pa.bool_())
            if not last:
                ranges = pa.array([[{"lo": lo, "hi": hi} for lo, hi in r] for r, _ in found], pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))
                state = [pa.array(n, pa.int64()), ranges, pa.array([i for _, i in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *state], [*own, "__n_words", "__ranges", "__items"])
            elif report:
                digest = [hashlib.sha256(",".join(i).encode()).hexdigest() for _, i in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(i) for _, i in found], pa.int64()), pa.array(digest, pa.string()), bad],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )
            else:
                yield batch.select(own).filter(pa.compute.invert(bad))

    return run


def _passes(rows: DataFrame, benchmark: DataFrame, report: bool, k: int, block_bytes: int) -> DataFrame:
    spark, schema = rows.sparkSession, rows.schema
    short_batches(spark)
    between, end = StructType([*schema, *_parse_datatype_string(STATE)]), REPORT if report else schema
    blocks = benchmark_blocks(benchmark.select("item_id", "text"), block_bytes)
    block, first, held, written = next(blocks), True, [], None
    while block is not None:
        after = next(blocks, None)
        held.append(spark.sparkContext.broadcast(block))
        rows = rows.mapInArrow(_pass(held[-1], uuid.uuid4().hex, schema.names, first, after is None, report, k), end if after is None else between)
        if after is not None and len(held) == CHAIN:
            rows = materialize(rows, "searched")
            if written is not None:
                drop_materialized(written)
            for x in held:
                x.destroy()
            held, written = [], rows
        block, first = after, False
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs."""
    return _passes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, True, k, block_bytes)


def clean_documents(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the contaminated ones, all columns kept."""
    return _passes(docs, benchmark, False, k, block_bytes)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
