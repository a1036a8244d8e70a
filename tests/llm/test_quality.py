import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from doclattice.llm.quality import BUCKETS, FEATURES, SEED, SMOOTHING, _largest, features, fit, good_share, gumbel, in_order, kept_documents, op9, sample_labels, score_quality

GOOD = "the quick brown fox jumps over the lazy dog and then rests by the river until evening comes "
BAD = "BUY!! NOW!! ### CHEAP!! ### CLICK!! ### HERE!! ### "


def corpus(spark):
    rows = [(i, (GOOD if i % 4 else BAD) * (1 + i % 5), "keep") for i in range(200)]
    rows += [(500, None, "k"), (501, "", "k"), (None, GOOD, "k"), (502, GOOD * 3000, "k"), (503, BAD * 3000, "k"), (503, BAD * 3000, "k"), (504, "é", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep string")
    labels = [(i, int(i % 4 > 0), 0) for i in range(160)] + [(None, 1, 0), (3, None, 0), (9999, 1, 0), (5, 1, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_small_cases(spark):
    docs, labels = corpus(spark)
    rows = score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.log_weight == 0 for r in rows if r.doc_id in (500, 501))
    assert sum(r.keep for r in rows) >= math.ceil(len(rows) * good_share(sample_labels(labels).good))
    assert all(r.keep for r in rows if r.doc_id is not None and r.doc_id < 200 and r.doc_id % 4)
    assert not any(r.keep for r in rows if r.doc_id == 503)
    kept = kept_documents(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in rows if r.keep)
    for k in (0, 1, 7, 150, len(rows), len(rows) + 5):
        top = score_quality(docs, labels, k=k).collect()
        order = sorted(rows, key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
        first = {(r.score, r.doc_id) for r in order[:k]}
        assert len(top) == len(rows) and all(r.keep == ((r.score, r.doc_id) in first) for r in top)
        kept = kept_documents(docs, labels, k=k).collect()
        assert sorted(r.doc_id or -1 for r in kept) == sorted(r.doc_id or -1 for r in top if r.keep)
    assert score_quality(docs.limit(0), labels).collect() == []
    assert all(r.keep for r in score_quality(docs, labels.limit(0)).collect())
    assert len(sample_labels(labels, 10).ids) == 10


def test_features_match_a_plain_count(spark):
    import pyarrow as pa

    text = ["aB1 aB1  x", "", None, "é!"]
    found = [(f, r + first) for first, _, feature, row in features(pa.array(text)) for f, r in zip(feature.tolist(), row.tolist())]
    sizes = [sum(r == i for _, r in found) for i in range(4)]
    plain = [max(0, len((t or "").encode()) - 2) + 3 * len((t or "").split()) - (1 if t and t.split() else 0) for t in text]
    assert sizes == plain


def test_largest_against_a_sort(spark):
    rng = np.random.default_rng(3)
    score = np.concatenate([rng.normal(size=300) * 10.0 ** rng.integers(-5, 6, 300), [0.0, -0.0, 1.5, 1.5, 1.5]])
    place = in_order(score)
    assert [score[i] for i in np.argsort(place, kind="stable")] == sorted(score)
    frame = spark.createDataFrame([(int(p),) for p in place], "place long")
    order = sorted(place.tolist(), reverse=True)
    for k in (1, 2, 77, 150, 305):
        assert _largest(frame, F.col("place"), k) == (order[k - 1], k - sum(p > order[k - 1] for p in order))


def test_good_share():
    assert good_share(np.array([True, True])) == 1.0 and good_share(np.array([], bool)) == 1.0 and good_share(np.array([False])) == 1.0
    assert 0.5 < good_share(np.array([True, False] * 500)) < 0.56


def test_result_against_a_plain_model(spark):
    """Log weights, noise and the first k from plain counts in Python dictionaries."""
    docs, labels = corpus(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sample = sample_labels(labels)
    target_ids = {i for i, g, t in zip(sample.ids.tolist(), sample.good.tolist(), sample.trains.tolist()) if g and t}
    found = {text: [f for _, _, feature, _ in features(pa.array([text], pa.string())) for f in feature.tolist()] for _, text in rows}
    raw, target = [0] * FEATURES, [0] * FEATURES
    for i, text in rows:
        for f in found[text]:
            raw[f] += 1
            target[f] += i in target_ids
    family = lambda f: min(f // BUCKETS, 3)
    of_raw, of_target = [0] * 4, [0] * 4
    for f in range(FEATURES):
        of_raw[family(f)] += raw[f]
        of_target[family(f)] += target[f]
    ratio = lambda f: math.log(target[f] + SMOOTHING) - math.log(raw[f] / max(of_raw[family(f)], 1) * of_target[family(f)] + SMOOTHING)
    noise = gumbel(pa.array([i for i, _ in rows], pa.int64()), SEED).tolist()
    scores = [sum(map(ratio, found[text])) + g for (_, text), g in zip(rows, noise)]
    k = math.ceil(len(rows) * good_share(sample.good))
    first = sorted(range(len(rows)), key=lambda x: -scores[x])[:k]
    want = sorted((rows[i][0] or -1, round(scores[i], 4)) for i in first)
    got = score_quality(docs, labels).collect()
    assert np.allclose(sorted(r.score for r in got), sorted(scores), rtol=1e-9, atol=1e-6)
    # The repeated row of id 503 may tie with the last.
    assert [w for w in want if w[0] != 503] == [w for w in sorted((r.doc_id or -1, round(r.score, 4)) for r in got if r.keep) if w[0] != 503]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    keep = {r.doc_id: r.keep for r in op9(spark, d).collect()}
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    sample = sample_labels(labels)
    held = [(keep[i], g) for i, g, t in zip(sample.ids.tolist(), sample.good.tolist(), sample.trains.tolist()) if not t]
    assert len(keep) == 1000 and np.mean([k == g for k, g in held]) > 0.95
    assert np.mean([k for k, g in held if g]) > 0.97
    assert 0 < fit(docs, labels).share < 1
