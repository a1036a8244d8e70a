import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from doclattice.llm import heavy, substring
from doclattice.llm.substring import Edges, _compact, _pack, _unpack, op7, path_heads, substring_dedup


def brute(docs, k=13):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in split:
        for a in range(len(w) - k + 1):
            g = tuple(w[a : a + k])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        dead = set()
        for a in range(len(w) - k + 1):
            if i is not None and first[tuple(w[a : a + k])] < i:
                dead |= set(range(a, a + k))
        out.append((i, len(w), len(dead), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in dead)).hexdigest()))
    return sorted(out, key=str)


P = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()
DOCS = [
    (5, "start " + " ".join(P) + " end"),
    (3, " ".join(P[:13])),
    (4, " ".join(P[1:14]) + " tail " + " ".join(P[1:14])),
    (1, None),
    (2, ""),
    (7, " ".join(P[:12])),
    (8, "Start " + "\t".join(P) + "\nEND one two"),
    (9, "same word " * 30),
    (9, "same word " * 30),
    (10, "word same " * 30_000),
    (None, " ".join(P)),
    (11, "x " * 20 + " ".join(P) + " y" * 20),
    (12, "x " * 20 + " ".join(P) + " y" * 20),
    (12, "other text of the same id " + " ".join(P[:14])),
    (6, "été à la plage " * 8),
    (20, "été à la plage " * 8),
]


def test_small_cases(spark):
    docs = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, start long")
    assert sorted(map(tuple, substring_dedup(docs).collect()), key=str) == brute(DOCS)
    assert substring_dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("heavy_max", [1, 40, 1 << 17])
def test_random_corpora(spark, monkeypatch, heavy_max):
    """Passages that texts share in full and in part, branches, repeated ids; all edges light, some or all heavy."""
    monkeypatch.setattr(heavy, "HEAVY_MAX", heavy_max)
    rng = random.Random(heavy_max)
    passages = [[f"p{p}w{rng.randrange(30)}" for _ in range(rng.randint(13, 70))] for p in range(12)]
    docs = []
    for _ in range(150):
        text = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randint(5, 70)] + [f"r{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 15]))]
        docs.append((rng.choice([None, rng.randrange(100), rng.randrange(100)]), " ".join(text)))
    docs += [(500, " ".join(passages[0]))] * 2 + [(501, " ".join(passages[0] + passages[1])), (501, " ".join(passages[1] + passages[0]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, substring_dedup(frame, asked_at_once=3).collect()), key=str) == brute(docs)
    assert sorted(map(tuple, substring_dedup(frame, 5).collect()), key=str) == brute(docs, 5)


def edges_of(texts):
    parts = [(np.array([hash(x) % 2**62 for x in t], np.uint64), i) for i, t in enumerate(texts)]
    return Edges.concat([Edges(n[:-1], n[1:], np.full(len(n) - 1, i), np.full(len(n) - 1, 7, np.int32), np.arange(len(n) - 1)) for n, i in parts])


def test_packed_edges_and_parts_of_a_bucket(monkeypatch):
    edges = edges_of([[1, 2, 3, 4, 5], [9, 2, 3, 4, 8], [3, 4, 5, 2, 3]])
    bucket = np.array([0, 0, 1, 1] * 3, np.int32)
    back = Edges.concat([_unpack(blob) for _, blob in _pack(edges, bucket)])
    assert sorted(zip(*(getattr(back, c).tolist() for c in ("left", "right", "doc", "row", "pos")))) == sorted(zip(*(getattr(edges, c).tolist() for c in ("left", "right", "doc", "row", "pos"))))
    blobs = [blob for _, blob in _pack(edges, np.zeros(12, np.int32))]
    table = pa.table({"bucket": pa.array([0], pa.int32()), "edges": pa.array(blobs, pa.binary()), "walks": pa.array([None], pa.binary())})
    whole = _compact(table).filter(pa.compute.equal(_compact(table)["kind"], 0)).to_pylist()
    monkeypatch.setattr(substring, "SPLIT", 3)
    parts = _compact(table)
    assert sorted(map(str, parts.filter(pa.compute.equal(parts["kind"], 0)).to_pylist())) == sorted(map(str, whole)) and len(whole) == 3
    steps = [(r["doc_id"], r["start"] + i, r["source"], r["at"] + i) for r in parts.to_pylist() if r["kind"] for i in range(r["len"])]
    assert sorted(steps) == [(1, 1, 0, 1), (1, 2, 0, 2), (2, 0, 0, 2), (2, 1, 0, 3), (2, 3, 0, 1)]


def test_paths_end_where_nodes_branch(spark):
    # 1-2-3-4 of source 0, 3-9 of source 5: node 3 has two edges out. 20-21-22 goes on in one source, 30-31-32 changes sources.
    rows = [(1, 2, 0, 1, 0), (2, 3, 0, 1, 1), (3, 4, 0, 1, 2), (3, 9, 5, 1, 7), (20, 21, 0, 1, 50), (21, 22, 0, 1, 51), (30, 31, 0, 1, 70), (31, 32, 2, 1, 71)]
    heads = path_heads(spark.createDataFrame(rows, "left long, right long, source long, srow int, at int")).collect()
    assert all(a // 16 == h.block for h in heads for a in h.heads)
    assert sorted((h.source, a) for h in heads for a in h.heads) == [(0, 0), (0, 2), (0, 50), (0, 70), (2, 71), (5, 7)]


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op7(spark, d).collect()), key=str)
    assert got == brute(docs) and sum(r[2] > 50 for r in got) > 20
