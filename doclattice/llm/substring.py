"""Substring dedup on a token De Bruijn graph.

Runs of k-1 consecutive words are nodes; a window of k words of a document is an edge from its first k-1 words to
its last k-1, and two edges are the same if both of their nodes are. Only edges that several documents walk matter.

1. Edges meet by minimizer: windows that follow each other mostly share the smallest hash of their short
   sub-runs, so a document's walk reaches a bucket in stretches, as the hashes of the nodes it passes and one header.
   There, each edge of two documents gets its source: the smallest doc_id and the first position there. Edges that are frequent in
   the corpus (heavy.py; a bounded table) don't travel: a grouped minimum finds their source, and they join the graph as one
   row each; a document's stretches of them are read off the broadcast table.
2. Nodes: a grouped count gives each its repeated edges in and out. A node with one of each, whose two edges follow each other in one
   source, doesn't branch. All edges that don't leave such a node are heads of compacted paths.
3. Walks: the stretches of repeated edges that a document walks are cut where a path's head is (a join on source and block of
   positions) and glued within paths. What remains are spans: document, start, and the source's coordinates.
4. A join on the document brings the spans to the whole text, where covered words are removed. Source coordinates verify them: the
   words of every span, in the document and at its source, are digested (SHA-256, 128 bits kept) and joined on the coordinates.
   A span that differs (a collision of node hashes) makes the operator run again with other seeds.

A bucket's edges are compacted SPLIT at a time, dealt by hash, so what a task holds of a large bucket is its packed
hashes. No minimizer of a bucket has more than one window in 131,072 of the corpus (heavier ones are dealt by window).
A source that many spans ask for gets them ASKED at a time, its text once for each lot.

Result: one row per document: doc_id, n_words, n_removed, kept_sha256. Words that a window covers are
removed if the same k words start in a document of smaller doc_id; windows are judged on the input. A null
or empty text has no words. Rows that repeat a doc_id are one document's and don't remove each other's
words; they are told apart by a hash of their words. Rows whose doc_id is null neither lose words nor make others lose them.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.llm.heavy import heavy_hitters
from doclattice.llm.textkit import U64, Alphabet, Words, mix, words
from doclattice.session import drop_materialized, materialize, parallelism, short_batches

WINDOW = 13
#: Words of the sub-runs whose smallest hash deals out a window.
MINIMIZER = 4
#: Windows that a bucket holds on average, and that are compacted at once.
BUCKET_WINDOWS, SPLIT = 500_000, 1_000_000
#: Windows that a task gathers before it sends them: then a stretch's header is small beside its hashes.
SEND_AT = 500_000
#: Positions of a block by which walks and heads meet, and spans that one copy of a source's text verifies on average.
POSITIONS, ASKED = 16, 10_000


#: In place of a minimizer.
NONE = U64((1 << 64) - 1)


def _alphabet(seed: int) -> Alphabet:
    return Alphabet(seed=20240701 + seed)


def _minimizers(w: Words, at: np.ndarray, k: int, m: int, heavy: np.ndarray) -> np.ndarray:
    """The smallest hash of the m-word runs, frequent ones aside, inside the window of k words that starts at each of at; NONE if all are frequent."""
    grams, where = w.ngrams(m, seed=5)
    low = np.full(len(w.hashes), NONE, U64)
    low[where] = np.where(_is_heavy(grams, heavy), NONE, grams)
    span, width, best = k - m + 1, 1, low
    while width * 2 <= span:  # minimum over 2, 4, ... positions
        best = np.minimum(best[: len(best) - width], best[width:])
        width *= 2
    return np.minimum(best[at], best[at + span - width])


@dataclass
class Edges:
    """Windows: the nodes they join, and document, row (32 bits of a hash of its words) and position of each."""

    left: np.ndarray
    right: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    pos: np.ndarray

    def take(self, which: np.ndarray) -> Edges:
        return Edges(*(x[which] for x in (self.left, self.right, self.doc, self.row, self.pos)))

    def ids(self) -> np.ndarray:
        return mix(self.left * U64(0x9E3779B97F4A7C15) + self.right, 6)

    @staticmethod
    def concat(parts: list[Edges]) -> Edges:
        return Edges(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("left", "right", "doc", "row", "pos")))


def _pack(edges: Edges, bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """For each bucket: a count, stretch headers (doc, row, first position, windows), then the nodes along each stretch."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    edges, bucket = edges.take(order), bucket[order]
    new = np.ones(len(bucket), bool)
    new[1:] = (edges.doc[1:] != edges.doc[:-1]) | (edges.row[1:] != edges.row[:-1]) | (edges.pos[1:] != edges.pos[:-1] + 1) | (bucket[1:] != bucket[:-1])
    starts = np.flatnonzero(new)
    length = np.diff(np.append(starts, len(bucket)))
    nodes = np.empty(len(bucket) + len(starts), U64)
    at = np.arange(len(bucket)) + np.cumsum(new) - 1
    nodes[at] = edges.left
    nodes[at + 1] = edges.right
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
        a, b = np.searchsorted(starts, [lo, hi])
        first = starts[a:b]
        head = [np.array([b - a], np.int64), edges.doc[first], edges.row[first].astype(np.int32), edges.pos[first].astype(np.int32), length[a:b].astype(np.int32)]
        yield int(bucket[lo]), b"".join(x.tobytes() for x in head) + nodes[lo + a : hi + b].tobytes()


def _unpack(blob) -> Edges:
    data = memoryview(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    doc = np.frombuffer(data, np.int64, n, 8)
    row, pos, length = (np.frombuffer(data, np.int32, n, 8 + (8 + 4 * i) * n) for i in range(3))
    nodes = np.frombuffer(data, U64, -1, 8 + 20 * n)
    ends = np.cumsum(length)
    total = int(ends[-1]) if n else 0
    stretch = np.repeat(np.arange(n), length)
    at = np.arange(total) + stretch
    return Edges(nodes[at], nodes[at + 1], doc[stretch], row[stretch], (pos - (ends - length))[stretch] + np.arange(total))


def _walks(batch: pa.RecordBatch, alphabet: Alphabet, k: int) -> Iterator[tuple[Words, Edges, np.ndarray]]:
    """Words, edges and the index of each edge's first word, for rows with an id."""
    ids = batch.column("doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for w in words(batch.column("text"), alphabet):
        nodes, at = w.ngrams(k - 1)
        first = np.cumsum(w.counts) - w.counts
        of = w.doc[at]
        edge = np.flatnonzero((of[1:] == of[:-1]) & known[w.first + of[:-1]]) if len(at) else np.empty(0, np.int64)
        row = row_hashes(w)
        of, at = of[edge], at[edge]
        yield w, Edges(nodes[edge], nodes[edge + 1], number[w.first + of], row[of], at - first[of]), at


def row_hashes(w: Words) -> np.ndarray:
    return (w.whole() >> U64(32)).astype(np.uint32).view(np.int32)


def _is_heavy(keys: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    if not len(heavy):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(heavy, keys), len(heavy) - 1)
    return heavy[at] == keys


#: A walk along repeated edges: the document's row and position, edges, and the source's row and position.
WALK = ("doc_id", "row", "start", "len", "source", "srow", "at")
#: Rows of the two tables that a bucket makes, told apart by their kind: repeated edges, and walks.
FOUND = "kind int, left long, right long, doc_id long, row int, start int, len int, source long, srow int, at int"


def merge_walks(walks: tuple[np.ndarray, ...], head: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Join walks where document and source both go on side by side, but not onto a head."""
    doc, row, start = walks[:3]
    order = np.lexsort((start, row, doc))
    doc, row, start, length, source, srow, at = (x[order] for x in walks)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (source[1:] != source[:-1]) | (srow[1:] != srow[:-1])
    new[1:] |= (start[1:] != start[:-1] + length[:-1]) | (at[1:] != at[:-1] + length[:-1])
    if head is not None:
        new |= head[order]
    first = np.flatnonzero(new)
    if not len(first):
        return doc, row, start, length, source, srow, at
    return doc[first], row[first], start[first], np.add.reduceat(length, first), source[first], srow[first], at[first]


@dataclass
class Heavy:
    """The frequent hashes in ascending order, and source, its row and position of those that are edges (MISSING: none)."""

    keys: np.ndarray
    source: np.ndarray
    srow: np.ndarray
    at: np.ndarray

    def walks(self, edges: Edges) -> tuple[np.ndarray, ...]:
        """Walks along heavy edges, those at the source itself aside."""
        place = np.searchsorted(self.keys, edges.ids())
        later = self.source[place] != edges.doc
        e, place = edges.take(later), place[later]
        return merge_walks((e.doc, e.row, e.pos, np.ones(len(place), np.int64), self.source[place], self.srow[place], self.at[place]))


MISSING = (1 << 63) - 1


def _heavy_sources(alphabet: Alphabet, k: int, heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(heavy)
        best = [np.full(n, MISSING), np.zeros(n, np.int64), np.zeros(n, np.int64)]
        most, nodes = np.full(n, -MISSING), np.zeros((2, n), U64)
        for batch in batches:
            for _, edges, _ in _walks(batch, alphabet, k):
                edges = edges.take(_is_heavy(edges.ids(), heavy))
                place = np.searchsorted(heavy, edges.ids())
                np.maximum.at(most, place, edges.doc)
                nodes[:, place] = edges.left, edges.right
                order = np.lexsort((edges.pos, edges.row, edges.doc, place))
                place, first = np.unique(place[order], return_index=True)
                new = [x[order][first].astype(np.int64) for x in (edges.doc, edges.row, edges.pos)]
                old = [x[place] for x in best]
                less = (new[0] < old[0]) | (new[0] == old[0]) & ((new[1] < old[1]) | (new[1] == old[1]) & (new[2] < old[2]))
                for x, y in zip(best, new, strict=True):
                    x[place[less]] = y[less]
        met = np.flatnonzero(best[0] < MISSING)
        columns = [met, *(x[met] for x in best), most[met], *(x[met].view(np.int64) for x in nodes)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["edge", "source", "srow", "at", "most", "left", "right"])

    return run


def heavy_edges(docs: DataFrame, alphabet: Alphabet, k: int, keys: np.ndarray) -> tuple[Heavy, DataFrame]:
    """The broadcast table, and its edges of several documents as rows of the graph; fewer than 131,072 both."""
    met = docs.mapInArrow(_heavy_sources(alphabet, k, keys), "edge long, source long, srow long, at long, most long, left long, right long").groupBy("edge")
    first = F.min(F.struct("source", "srow", "at")).alias("first")
    rows = met.agg(first, F.max("most").alias("most"), F.first("left").alias("left"), F.first("right").alias("right")).select("edge", "first.*", "most", "left", "right").toPandas()
    table = Heavy(keys, np.full(len(keys), MISSING), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64))
    place = rows["edge"].to_numpy(np.int64)
    for column in ("source", "srow", "at"):
        getattr(table, column)[place] = rows[column].to_numpy(np.int64)
    several = rows[rows["source"] < rows["most"]]
    return table, docs.sparkSession.createDataFrame(several[["left", "right", "source", "srow", "at"]] if len(several) else [], "left long, right long, source long, srow int, at int")


def _deal(alphabet: Alphabet, k: int, buckets: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy: Heavy = shared.value
        held: list[tuple[Edges, np.ndarray]] = []
        walks: list[tuple[np.ndarray, ...]] = []
        size = 0

        def send() -> pa.RecordBatch:
            sent = [(b, x, None) for b, x in _pack(Edges.concat([e for e, _ in held]), np.concatenate([b for _, b in held]))]
            along = np.stack([np.concatenate(c) for c in zip(*walks, strict=True)]).astype(np.int64)
            for i in range(0, along.shape[1], 4096):
                part = along[:, i : i + 4096]
                sent.append((int(mix(part[0, :1].view(U64), 8)[0] % U64(buckets)), None, part.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in sent], pa.int32()), pa.array([x for _, x, _ in sent], pa.binary()), pa.array([x for _, _, x in sent], pa.binary())], ["bucket", "edges", "walks"])

        for batch in batches:
            for w, edges, at in _walks(batch, alphabet, k):
                frequent = _is_heavy(edges.ids(), heavy.keys)
                walks.append(heavy.walks(edges.take(frequent)))
                edges, at = edges.take(~frequent), at[~frequent]
                low = _minimizers(w, at, k, min(MINIMIZER, k), heavy.keys)
                # A sub-run that is frequent in the corpus would gather too much; windows without another go by their own hash.
                key = mix(np.where(low == NONE, edges.ids(), low), 5) % U64(buckets)
                held.append((edges, key.astype(np.int32)))
                size += len(at) + len(walks[-1][0])
                if size >= SEND_AT:
                    yield send()
                    held, walks, size = [], [], 0
        if size:
            yield send()

    return run


def repeated(edges: Edges) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Edges of several documents (left, right, source, srow, at), and the walks of the others along them."""
    ids = edges.ids()
    order = np.argsort(ids, kind="stable")
    unlike = lambda o: (edges.left[o][1:] != edges.left[o][:-1]) | (edges.right[o][1:] != edges.right[o][:-1])
    other = ids[order][1:] != ids[order][:-1]
    if (unlike(order) & ~other).any():  # two edges of one hash
        order = np.lexsort((edges.right, edges.left))
        other = unlike(order)
    new = np.append(np.ones(min(1, len(ids)), bool), other)
    starts = np.flatnonzero(new)
    if not len(starts):
        none = np.empty(0, np.int64)
        return (none,) * 5, (none,) * 7
    doc = edges.doc[order]
    several = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
    group = np.cumsum(new) - 1
    kept = several[group]
    e = edges.take(order[kept])
    starts = np.flatnonzero(new[kept])
    if not len(starts):
        none = np.empty(0, np.int64)
        return (none,) * 5, (none,) * 7
    group = np.cumsum(new[kept]) - 1
    source = np.minimum.reduceat(e.doc, starts)
    own = e.doc == source[group]
    row = np.minimum.reduceat(np.where(own, e.row, np.iinfo(np.int32).max), starts)
    at = np.minimum.reduceat(np.where(own & (e.row == row[group]), e.pos, MISSING), starts)
    found = e.left[starts].view(np.int64), e.right[starts].view(np.int64), source, row, at
    later = ~own
    g = group[later]
    return found, merge_walks((e.doc[later], e.row[later], e.pos[later], np.ones(len(g), np.int64), source[g], row[g], at[g]))


def _compact(bucket: pa.Table) -> pa.Table:
    blobs = [x.as_buffer() for x in bucket.column("edges") if x.is_valid]
    windows = sum((len(x) - 8 - 20 * n) // 8 - n for x in blobs for n in (int(np.frombuffer(x, np.int64, 1)[0]),))
    parts = max(1, -(-windows // SPLIT))
    found, walks = [], [tuple(np.frombuffer(x.as_buffer(), np.int64).reshape(len(WALK), -1)) for x in bucket.column("walks") if x.is_valid]
    for part in range(parts if blobs else 0):
        # All instances of an edge are in one part.
        taken = [e if parts == 1 else e.take(e.ids() % U64(parts) == U64(part)) for e in map(_unpack, blobs)]
        edges, along = repeated(Edges.concat(taken))
        found.append(edges)
        walks.append(along)
    columns: list[list[pa.Array]] = [[] for _ in range(10)]
    kinds = (0, found, ("left", "right", "source", "srow", "at")), (1, walks, WALK)
    schema = pa.schema([("kind", pa.int32()), ("left", pa.int64()), ("right", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int32()), ("start", pa.int32()), ("len", pa.int32()), ("source", pa.int64()), ("srow", pa.int32()), ("at", pa.int32())])
    tables = []
    for kind, lists, names in kinds:
        held = dict(zip(names, (np.concatenate(c) for c in zip(*lists, strict=True)), strict=True)) if lists else {c: np.empty(0, np.int64) for c in names}
        n = len(held["at"])
        columns = [pa.array(np.full(n, kind), pa.int32()) if f.name == "kind" else pa.array(held[f.name].astype(np.int64), pa.int64()).cast(f.type) if f.name in held else pa.nulls(n, f.type) for f in schema]
        tables.append(pa.table(columns, schema=schema))
    return pa.concat_tables(tables)


def path_heads(edges: DataFrame) -> DataFrame:
    """Heads of compacted paths, a row for each source and block of positions: source, srow, block, heads (positions). A head is a
    repeated edge that doesn't leave a node which doesn't branch."""
    into = edges.select(F.col("right").alias("node"), "source", "srow", (F.col("at") + 1).alias("at"), F.lit(1).alias("enters"))
    out = edges.select(F.col("left").alias("node"), "source", "srow", "at", F.lit(0).alias("enters"))
    least = [f(c).alias(f"{n}_{c}") for c in ("source", "srow", "at") for n, f in (("lo", F.min), ("hi", F.max))]
    nodes = into.unionByName(out).groupBy("node").agg(F.count("*").alias("edges"), F.sum("enters").alias("entering"), *least)
    through = nodes.where("edges = 2 and entering = 1 and lo_source = hi_source and lo_srow = hi_srow and lo_at = hi_at")
    through = through.select(F.col("lo_source").alias("source"), F.col("lo_srow").alias("srow"), F.col("lo_at").alias("at"))
    # A bit for each position of a block.
    bit = F.expr(f"shiftleft(1, cast(at % {POSITIONS} as int))")
    marks = edges.select("source", "srow", "at", bit.alias("edge"), F.lit(0).alias("inner")).unionByName(through.select("source", "srow", "at", F.lit(0).alias("edge"), bit.alias("inner")))
    blocks = marks.groupBy("source", "srow", F.expr(f"at div {POSITIONS}").alias("block")).agg(F.bit_or("edge").alias("edge"), F.bit_or("inner").alias("inner"))
    mask = F.col("edge").bitwiseAND(F.bitwise_not("inner"))
    places = F.filter(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda i: F.call_function("getbit", mask, i) == 1)
    return blocks.where(mask != 0).select("source", "srow", "block", F.transform(places, lambda i: (F.col("block") * POSITIONS + i).cast("int")).alias("heads"))


def cut_walks(walks: DataFrame, heads: DataFrame) -> DataFrame:
    """Walks in parts that lie in one block of positions of the source and begin at a head or don't reach one; head tells which.
    heads is a written table, so the join can deal out a source that a large part of all walks have."""
    block = F.explode(F.sequence(F.expr(f"at div {POSITIONS}"), F.expr(f"(at + len - 1) div {POSITIONS}"))).alias("block")
    lo, hi = F.greatest(F.col("at").cast("long"), F.col("block") * POSITIONS), F.least(F.col("at") + F.col("len"), (F.col("block") + 1) * POSITIONS)
    parts = walks.select("*", block).select(*WALK, "block", lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    met = parts.join(heads, ["source", "srow", "block"], "left")
    inside = F.filter(F.coalesce("heads", F.array().cast("array<int>")), lambda h: (h >= F.col("lo")) & (h < F.col("hi")))
    points = met.withColumn("inside", inside).withColumn("points", F.array_sort(F.array_union(F.array("lo"), F.col("inside"))))
    each = points.select("*", F.posexplode("points").alias("i", "point"))
    end = F.coalesce(F.get("points", F.col("i") + 1), F.col("hi"))
    return each.select(
        "doc_id", "row", (F.col("start") + F.col("point") - F.col("at")).alias("start"), (end - F.col("point")).alias("len"), "source", "srow", F.col("point").alias("at"),
        F.array_contains("inside", F.col("point")).alias("head"),
    )


def _glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = merge_walks(tuple(b.column(c).to_numpy().astype(np.int64) for c in WALK), b.column("head").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64), pa.int64()).cast(b.schema.field(c).type) for c, x in zip(WALK, found, strict=True)], list(WALK))


SPAN = "struct<row:int,start:int,len:int,source:long,srow:int,at:int,own:boolean>"
MARKS = "array<struct<source:long,srow:int,at:int,len:int,digest:binary,own:boolean>>"
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remove(alphabet: Alphabet, k: int):
    """Texts with their spans to the contract's columns (in a text's first lot), and the digests that verify the spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.concatenate([row_hashes(w) for w in words(batch.column("text"), alphabet)] or [np.empty(0, np.int32)])
            spans = batch.column("spans")
            offsets = np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            flat = spans.flatten()
            of, start, length, source, srow, at = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("row", "start", "len", "source", "srow", "at"))
            own = flat.field("own").to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for i, (doc_id, text, lot) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("lot").to_pylist(), strict=True)):
                kept = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                mine = np.arange(offsets[i], offsets[i + 1])
                mine = mine[(of[mine] == rows[i]) & (start[mine] >= 0)]
                marks, covered, n = [], np.zeros(len(kept) + 1, np.int64), len(kept)
                for j in mine.tolist():
                    lo, hi = int(start[j]), int(start[j] + length[j]) + k - 1
                    digest = hashlib.sha256(b" ".join(kept[lo:hi])).digest()[:16]
                    marks.append({"source": int(source[j]), "srow": int(srow[j]), "at": int(at[j]), "len": int(length[j]), "digest": digest, "own": bool(own[j])})
                    if own[j]:
                        covered[lo] += 1
                        covered[min(hi, n)] -= 1
                if lot:
                    out.append((doc_id, None, None, None, marks))
                    continue
                dead = np.cumsum(covered)[:n] > 0
                lost = int(dead.sum())
                if lost:
                    kept = [x for x, d in zip(kept, dead.tolist(), strict=True) if not d]
                out.append((doc_id, n, lost, hashlib.sha256(b" ".join(kept)).hexdigest(), marks))
            columns = list(zip(*out, strict=True)) or [()] * 5
            mark = pa.list_(pa.struct([("source", pa.int64()), ("srow", pa.int32()), ("at", pa.int32()), ("len", pa.int32()), ("digest", pa.binary()), ("own", pa.bool_())]))
            types = pa.int64(), pa.int64(), pa.int64(), pa.string(), mark
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "marks"])

    return run


def spans_by_document(walks: DataFrame, asked_at_once: int = ASKED) -> DataFrame:
    """doc_id, lot, spans: a document's own spans and, in lots, those that others ask it for. Every document here has a lot 0."""
    none = F.lit(None)
    asked = walks.select("source", "srow", "at", "len").distinct()
    asked = asked.select(F.col("source").alias("doc_id"), F.col("srow").alias("row"), F.col("at").alias("start"), "len", "source", "srow", "at", F.lit(False).alias("own"))
    lots = asked.groupBy("doc_id").agg(F.ceil(F.count("*") / asked_at_once).alias("lots")).where("lots > 1")
    asked = asked.join(lots, "doc_id", "left").withColumn("lot", F.pmod(F.xxhash64("at", "len", "srow"), F.coalesce("lots", F.lit(1))).cast("int")).drop("lots")
    ever = lots.select("doc_id", none.cast("int").alias("row"), F.lit(-1).alias("start"), F.lit(0).alias("len"), none.cast("long").alias("source"), none.cast("int").alias("srow"), F.lit(0).alias("at"), F.lit(False).alias("own"), F.lit(0).alias("lot"))
    own = walks.select(*WALK, F.lit(True).alias("own"), F.lit(0).alias("lot"))
    filled = own.unionByName(asked).unionByName(ever.fillna({"row": 0, "source": 0, "srow": 0}))
    return filled.groupBy("doc_id", "lot").agg(F.collect_list(F.struct("row", "start", "len", "source", "srow", "at", "own")).alias("spans"))


def _attempt(docs: DataFrame, k: int, seed: int, asked_at_once: int) -> DataFrame | None:
    """The result, or none if a span didn't verify."""
    spark = docs.sparkSession
    alphabet = _alphabet(seed)
    m = min(MINIMIZER, k)

    def occurrences(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for w, edges, _ in _walks(batch, alphabet, k):
            yield edges.ids()
            yield w.ngrams(m, seed=5)[0]

    keys, _, total = heavy_hitters(docs, ["doc_id", "text"], occurrences)
    table, frequent = heavy_edges(docs, alphabet, k, keys)
    buckets = max(parallelism(spark), -(-total // (2 * BUCKET_WINDOWS)))
    dealt = docs.mapInArrow(_deal(alphabet, k, buckets, spark.sparkContext.broadcast(table)), "bucket int, edges binary, walks binary")
    found = materialize(dealt.groupBy("bucket").applyInArrow(_compact, FOUND), "found")
    edges = found.where("kind = 0").select("left", "right", "source", "srow", "at").unionByName(frequent)
    heads = materialize(path_heads(edges), "heads")
    parts = cut_walks(found.where("kind = 1").select(*WALK), heads)
    types = "doc_id long, row int, start int, len int, source long, srow int, at int"
    spans = materialize(parts.repartition("doc_id").sortWithinPartitions("doc_id", "row", "start").mapInArrow(_glue, types), "spans")
    drop_materialized(found)
    both = docs.join(spans_by_document(spans, asked_at_once), "doc_id", "left").select("doc_id", "text", F.coalesce("lot", F.lit(0)).alias("lot"), F.col("spans").cast(f"array<{SPAN}>").alias("spans"))
    removed = materialize(both.mapInArrow(_remove(alphabet, k), f"{OUT}, marks {MARKS}"), "removed")
    seen = removed.select(F.explode("marks").alias("x")).select("x.*").distinct()
    unlike = seen.where("own").join(seen.where("not own"), ["source", "srow", "at", "len", "digest"], "left_anti").limit(1).count()
    return None if unlike else removed.where("kept_sha256 is not null").select("doc_id", "n_words", "n_removed", "kept_sha256")


def substring_dedup(docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", asked_at_once: int = ASKED) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs. k is 2 at least."""
    short_batches(docs.sparkSession, 1000)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    for seed in range(4):
        found = _attempt(docs, k, seed, asked_at_once)
        if found is not None:
            return found
    raise RuntimeError("repeated spans did not verify under four hash families")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
