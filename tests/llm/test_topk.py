import math
import time
from fractions import Fraction

import numpy as np

from doclattice.llm.topk import block_top, op10, top_k


def brute(rows, every, k):
    use = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in use:
        if q % every == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(x, y)), -(1 << 63)), (1 << 63) - 1), i) for i, y in use if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_small_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [9.0] * 6), (304, [0.0] * 6), (305, [0.5] * 3), (306, []), (310, [-3.0] * 6)]
    rows += [(400 + i, [0.25] * 6) for i in range(40)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, score int")
    assert sorted(map(tuple, top_k(frame, every=5, k=5).collect())) == brute(rows, 5, 5)
    few = frame.where("vec_id < 3")
    assert sorted(map(tuple, top_k(few, every=1, k=5).collect())) == brute(rows[:3], 1, 5)
    assert top_k(frame.limit(0)).collect() == []
    one = frame.where("vec_id = 0")
    assert top_k(one).collect() == []


def test_components_of_any_size(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    for i, x in enumerate([64.0, 2.0**22, -(2.0**33), 2.0**45, 2.0**53, 2.0**53 + 2, 2.0**54, -(2.0**62), 1e17, 1e30, -1e30, 1e300, 1.7e308, -1.7e308, 0.1, 2.0**31]):
        for j in range(4):
            rows.append((1000 + 4 * i + j, [x if a == j else 0.5 * a - j / 3 for a in range(4)]))
    rows += [(2000 + i, [1e200, 1e200, -1e200, float(i)]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 4, 5)
    assert sorted(map(tuple, top_k(frame, every=4, k=5).collect())) == want
    assert sorted(map(tuple, top_k(frame, every=4, k=5, size=9).collect())) == want


def test_a_large_component_keeps_the_index():
    rng = np.random.default_rng(3)
    values = np.floor(256 * rng.normal(size=(4000, 16))).astype(np.int64)
    values[7, 3] = 1 << 50
    began = time.time()
    block_top(np.arange(4000), values, np.arange(200), values[:200], 5)
    assert time.time() - began < 3


def test_repeated_ids(spark):
    rows = [(0, [1.0, 2.0]), (0, [0.5, 2.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [0.0, -1.0])]
    got = [tuple(r) for r in top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3).orderBy("rank").collect()]
    assert [g[2] for g in got] == [7, 7, 8]


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op10(spark, d).collect())) == brute(rows, 50, 5)
