import heapq
import random
import zlib
from collections import defaultdict

from doclattice.llm.sharding import lpt, op8, shard_rows


def verify(rows, docs, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs if i is not None)
    slots, home = defaultdict(list), defaultdict(set)
    texts = dict(docs)
    for r in rows:
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        slots[r.shard].append(r.slot)
        if r.doc_id is not None:
            home[texts[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in home.values())


def test_small_cases(spark):
    docs = [(i, "x" * (i % 7) * 10) for i in range(60)] + [(100, None), (101, ""), (102, None), (103, "long " * 20_000)]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs] + [(None, "no id", "clash")], "doc_id long, text string, shard string")
    rows = shard_rows(frame, 4).collect()
    assert len(rows) == len(docs) + 1
    verify(rows, docs, 4)
    verify(shard_rows(frame, 4, slice_rows=3).collect(), docs, 4)
    repeated = shard_rows(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "doc_id long, text string"), 2).collect()
    assert sorted((r.doc_id, r.slot) for r in repeated) == [(1, 0), (1, 1), (2, 0)]
    assert shard_rows(spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string"), 2).count() == 2
    assert shard_rows(frame.limit(0), 4).collect() == []


def test_whole_table_is_balanced(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = op8(spark, d).collect()
    verify(rows, docs, 40)
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r.size
    mean = sum(load.values()) / 40
    assert max(load.values()) <= mean * 1.05 and min(load.values()) >= mean * 0.95


def plain_lpt(sizes, shards):
    """One by one through a heap: the shards' loads, and each shard's items by size."""
    heap, got = [(0, s) for s in range(shards)], defaultdict(lambda: defaultdict(int))
    for size in sorted(sizes, reverse=True):
        load, s = heapq.heappop(heap)
        got[s][size] += 1
        heapq.heappush(heap, (load + size, s))
    return sorted(heap), got


def test_fill_and_schedule_against_a_heap():
    rng = random.Random(9)
    for _ in range(60):
        shards = rng.randint(1, 7)
        histogram = {rng.randint(1, 60): rng.choice([1, 2, 5, 40, 300]) for _ in range(rng.randint(1, 12))}
        heap, got = plain_lpt([s for s, n in histogram.items() for _ in range(n)], shards)
        mine = defaultdict(lambda: defaultdict(int))
        for size, firsts, taken in lpt(list(histogram.items()), shards):
            for first, end, s in zip(firsts, [*firsts[1:], histogram[size]], taken, strict=True):
                assert end > first
                mine[s][size] += end - first
        assert mine == got


def test_shards_against_a_plain_schedule(spark):
    rng = random.Random(4)
    texts = ["x" * rng.randint(0, 40) + str(rng.randint(0, 3)) for _ in range(400)] + ["hot"] * 150 + [None] * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_rows(frame, 6).collect()
    verify(rows, list(enumerate(texts)), 6)
    groups = defaultdict(int)
    for t in texts:
        groups[t] += len((t or "").encode()) + 16
    heap, _ = plain_lpt(list(groups.values()), 6)
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r.size
    assert sorted((n, s) for s, n in load.items()) == heap


def test_rows_of_one_id_are_numbered_by_many_tasks(spark):
    frame = spark.createDataFrame([(None, f"t{i % 50}") for i in range(3000)], "doc_id long, text string")
    rows = shard_rows(frame, 4, slice_rows=10).collect()
    assert {(r.shard, r.slot) for r in rows} == {(s, i) for s in range(4) for i in range(sum(r.shard == s for r in rows))} and len(rows) == 3000
