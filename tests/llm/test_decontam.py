import hashlib
import re

import pytest

from doclattice.llm.decontam import clean_documents, contamination

ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "short item here"),
    (10, "Été à la plage, encore UNE fois: dix mots et puis trois autres mots ici même"),
    (3, None),
    (4, "?!"),
    (None, "anonymous thing"),
    (2, "another text with the same id"),
]
DOCS = [
    (1, "say ALPHA, beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron and more", "x"),
    (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu missing", "x"),
    (3, "short-item\nhere short item here", "x"),
    (4, None, "x"),
    (5, "", "x"),
    (6, "word " * 200 + "short item here", "x"),
    (7, "prefixshort item here", "x"),
    (8, "été à la plage encore une fois dix mots et puis trois autres mots ici même " * 3, None),
    (8, "été à la plage encore une fois dix mots et puis trois autres mots ici même " * 3, None),
    (None, "an anonymous thing", "x"),
    (9, "a " * 60_000 + "short item here", "x"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=13):
    wins = [(i, tuple(w[a : a + k])) for i, t in items if (w := words(t)) for a in range(max(1, len(w) - k + 1))]
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(p) for _, p in wins}:
            at = {}
            for i in range(len(w) - n + 1):
                at.setdefault(tuple(w[i : i + n]), []).append(i)
            for item, p in wins:
                if len(p) == n and p in at:
                    hit |= {j for i in at[p] for j in range(i, i + n)}
                    ids |= {str(item)} if item is not None else set()
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_small_cases(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(map(tuple, contamination(docs, items, block_bytes=block_bytes).collect()), key=str)
    assert got == brute([d[:2] for d in DOCS], ITEMS)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_clean_documents(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, items string")
    clean = clean_documents(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), block_bytes=block_bytes)
    want = [r[0] for r in brute([d[:2] for d in DOCS], ITEMS) if not r[5]]
    assert clean.columns == docs.columns and sorted((r.doc_id for r in clean.collect()), key=str) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(docs.limit(0), items).collect() == []
    assert {r.n_hit for r in contamination(docs, items.limit(0)).collect()} == {0}


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    got = sorted(map(tuple, contamination(docs, items).collect()), key=str)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and any(r[5] for r in want)
