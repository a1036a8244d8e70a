import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from doclattice.llm.packing import OUT, op6, pack, plan


def fill(table, capacity):
    load, spans = defaultdict(int), defaultdict(list)
    for length, _, count, first, offset in table:
        for s in range(first, first + count):
            load[s] += length
            spans[s].append((offset, length))
    for s in spans:
        at = 0
        for offset, length in sorted(spans[s]):
            assert offset == at
            at += length
        assert at <= capacity
    return load


def test_plan_is_tight():
    rng = random.Random(5)
    for case in range(60):
        capacity = rng.choice([10, 50, 200])
        histogram = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 25))}
        table = plan(histogram, capacity)
        load = fill(table, capacity)
        assert {s: sum(t[2] for t in table if t[0] == s) for s in histogram} == histogram
        for s in histogram:
            ranks = sorted((t[1], t[2]) for t in table if t[0] == s)
            assert ranks[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(ranks, ranks[1:]))
        least = max(-(-sum(s * n for s, n in histogram.items()) // capacity), sum(n for s, n in histogram.items() if 2 * s > capacity))
        assert least <= len(load) <= 1.23 * least + 1, case
    assert plan({}, 10) == []


def test_dominance_fixes_perfect_pairs():
    assert len(fill(plan({7: 4, 3: 4, 6: 3, 4: 3}, 10), 10)) == 7


def check_rows(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for piece, n in enumerate(([len(ids) % capacity] if len(ids) % capacity else []) + [capacity] * (len(ids) // capacity)):
            want.append((i, piece, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at += n
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    where = defaultdict(list)
    for r in rows:
        where[r.sequence_id].append((r.offset, r.length))
    for spans in where.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
    return len(where), sum(r.length for r in rows)


def test_small_cases(spark):
    docs = [(1, None), (2, ""), (3, "a few words"), (3, "a few words"), (None, "no id <|endoftext|>"), (4, "long " * 9000), (5, "exact " * 15), (6, "é日本  \x00")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, piece int")
    check_rows(pack(frame, 16).collect(), docs, 16)
    check_rows(pack(frame).collect(), docs, 2048)
    check_rows(pack(frame, 16, slice_rows=3).collect(), docs, 16)
    empty = pack(frame.limit(0))
    assert empty.collect() == [] and [f.name for f in empty.schema] == [c.split()[0] for c in OUT.split(", ")]


def test_equal_rows_spread_over_slices(spark):
    docs = [(None, "same row")] * 300 + [(1, "same row")] * 300
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check_rows(pack(frame, 16, slice_rows=10).collect(), docs, 16)


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    sequences, tokens = check_rows(op6(spark, d).collect(), docs, 2048)
    assert sequences <= -(-tokens // 2048) * 1.02 + 1
