from collections import defaultdict

import corpus_pipeline
from doclattice.llm.decontam import contamination


def test_stages_take_effect(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, before = docs.columns, docs.count()
    benchmark = spark.read.parquet(f"{d}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, d).cache()
        n = after.count()
        assert after.columns == columns and n <= before
        old, new = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(new) <= set(old)
        if name == "n-gram Jaccard join":
            split = {i: r.text.encode().lower().split() for i, r in old.items()}
            shingles = {i: frozenset(zip(*(w[k:] for k in range(5)))) or frozenset([tuple(w)] if w else []) for i, w in split.items()}
            links = defaultdict(set)
            for i in shingles:
                for j in shingles:
                    a, b = shingles[i], shingles[j]
                    if i < j and a and b and 0.8 <= len(a) / len(b) <= 1.25 and len(a & b) * 100 >= 80 * len(a | b):
                        links[i].add(j)
                        links[j].add(i)
            assert all(i in new for i in old if not links[i])
            assert not any(links[i] & set(new) for i in new) and len(new) < len(old)
        if name == "benchmark decontamination":
            bad = {r.doc_id for r in contamination(docs, benchmark).collect() if r.contaminated}
            assert set(new) == set(old) - bad and bad
        if name == "secret scans":
            assert set(new) == set(old) and any(old[i].text != new[i].text for i in old)
            assert not any("password=" in (r.text or "") and "[" not in r.text for r in new.values())
        docs, before = after, n
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_empty_and_odd_rows(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    odd = spark.createDataFrame([(None, "text without id", None, None, None), (-1, None, "en", None, 0), (-2, "", None, "s", None), (-3, "same text here now again", "en", "s", 1), (-3, "same text here now again", "en", "s", 1)], docs.schema)
    for frame in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, d)
            frame.collect()
        assert frame.count() in (0, 4)
