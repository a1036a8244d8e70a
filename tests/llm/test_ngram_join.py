import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from doclattice.llm.components import connected_components
from doclattice.llm.heavy import HEAVY_MAX, heavy_hitters
from doclattice.llm.ngram_join import HOT, WORDS, Threshold, ngram_components, shingles
from doclattice.llm.textkit import Alphabet, words


def brute(docs, k=4, num=85, den=100):
    """Rows by position; a doc_id stands for the rows that have it."""
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = [i for i, (d, _) in enumerate(docs) if d is not None and sets[i]]
    for x in order:
        for y in order:
            both = len(sets[x] & sets[y])
            if x < y and both * den >= num * (len(sets[x]) + len(sets[y]) - both):
                parent[find(x)] = find(y)
    least = defaultdict(list)
    for i in order:
        least[find(i)].append(docs[i][0])
    return sorted(((d, len(sets[i]), (min(least[find(i)]) if i in order else d) if d is not None else None) for i, (d, _) in enumerate(docs)), key=str)


def near_copies(rng, n, words=60, edits=2):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_odd_rows(spark):
    docs = [(5, "a b c d e"), (3, "A B c D E"), (9, None), (8, ""), (7, " \t\n"), (6, "one two"), (2, "ONE\ttwo"), (1, "one two three"), (None, "a b c d e"), (None, None), (11, "a b c d e"), (11, "a b c d e"), (12, "z " * 50_000), (13, "z " * 40_000), (14, "a b c d e"), (15, "é É ü x y"), (16, "é É ü x y!")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n long")
    got = sorted(map(tuple, ngram_components(frame).collect()), key=str)
    assert got == brute(docs)
    assert ngram_components(frame.limit(0)).collect() == []


@pytest.mark.parametrize(("k", "num", "hot"), [(4, 85, HOT), (5, 80, HOT), (4, 85, 5), (5, 80, 1)])
def test_families_chains_and_shared_passages(spark, k, num, hot):
    rng = random.Random(17)
    texts = near_copies(rng, 150, 60, 3) + near_copies(rng, 40, 25, 2)
    passage = " ".join(f"p{i}" for i in range(50))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randint(0, 120))) for _ in range(60)]
    chain = [f"c{i}" for i in range(80)]
    texts += [" ".join(chain[i : i + 60]) for i in range(0, 20, 2)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = sorted(map(tuple, ngram_components(spark.createDataFrame(docs, "doc_id long, text string"), k, Threshold(num, 100), hot=hot).collect()), key=str)
    assert got == brute(docs, k, num)


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1001 + i) for i in range(200)] + [(5, 5), (2000, 1999)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 1000 for i in range(1000, 1201)) and got[2000] == 1999
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_heavy_counts(spark):
    docs = spark.createDataFrame([(f"common {i}",) for i in range(400)], "text string").repartition(4)

    def one(batch):
        for w in words(batch.column("text"), Alphabet()):
            yield w.hashes

    keys, counts, total = heavy_hitters(docs, ["text"], one)
    common = next(words(pa.array(["common"]), Alphabet())).hashes[0]
    assert total == 800 and len(keys) < HEAVY_MAX and counts[np.searchsorted(keys, common)] >= 400 - 4


def families_agree(spark, families, k=4, num=85, hot=HOT):
    """Families share no words, so brute force takes each by itself."""
    docs, want, first = [], [], 0
    for texts in families:
        family = list(enumerate(texts, first))
        first += len(texts)
        docs += family
        want += brute(family, k, num)
    got = map(tuple, ngram_components(spark.createDataFrame(docs, "doc_id long, text string"), k, Threshold(num, 100), hot=hot).collect())
    assert sorted(got, key=str) == sorted(want, key=str)


def test_nested_truncations_whose_shingles_have_other_pivots(spark):
    rng, families = random.Random(5), []
    for f in range(30):
        long = [f"f{f}w{i}" for i in range(103)]
        # Windows have the shared shingles earlier than the long texts, so no star joins 80, 90 and 100 shingles.
        family = [long, long[:93], long[:83]] + [long[i : i + 40] for i in range(0, 64, 7)]
        short = [f"f{f}s{i}" for i in range(23)]
        family += [short, short[:-1] + [f"f{f}e"]] + [short[i : i + 10] for i in range(0, 14, 2)]
        rng.shuffle(family)
        families.append([" ".join(words) for words in family])
    families_agree(spark, families)


def test_a_member_that_its_group_does_not_hold_links_with_another_group(spark):
    pool = [f"word{i}" for i in range(60)]
    keys, _ = shingles(next(words(pa.array([" ".join(pool)]), WORDS)), 1)
    pool = [pool[i] for i in np.argsort(keys)]  # in the order that the join takes
    prefix, rest, of_g, of_x, extra = pool[:7], pool[7:36], pool[36:40], pool[40:44], pool[44:45]
    g = prefix + rest + of_g
    x = prefix + rest + of_x  # size and prefix of g, and no link with it
    y = prefix + rest + of_g[:2] + of_x[:2] + extra  # links with both
    z = prefix[1:] + rest + of_g + extra  # joins g and y by stars; decoys are the pivots of all else
    docs = [(i, w) for i, w in enumerate(prefix) if i != 3] + [(10 + i, " ".join(d)) for i, d in enumerate((g, x, y, z))]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(docs, len(docs)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_components(frame, 1).collect()}
    assert [got[i] for i in (10, 11, 12, 13)] == [10] * 4
    assert got == {d: c for d, _, c in brute(docs, 1)}


def test_quoted_single_shingles_undo_no_link(spark):
    """Two texts that link, and short texts that each quote one shared shingle."""
    x, y = ([f"w{i}" for i in range(95)] + [f"{c}{i}" for i in range(8)] for c in "ab")
    docs = [(1, " ".join(x)), (2, " ".join(y))] + [(3 + i, " ".join(x[i : i + 4])) for i in range(92)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in ngram_components(frame).collect()}
    assert got[1] == got[2] == 1 and got == {d: c for d, _, c in brute(docs)}


@pytest.mark.parametrize(("num", "hot"), [(80, HOT), (85, 2)])
def test_random_families_with_quotes(spark, num, hot):
    rng, families = random.Random(num), []
    for f in range(25):
        base = [f"f{f}w{i}" for i in range(rng.randint(20, 110))]
        family = []
        for _ in range(rng.randint(2, 6)):
            cut = rng.randint(0, len(base) // 6)
            text = base[: len(base) - cut]
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = f"f{f}x{rng.randrange(10**6)}"
            family.append(text)
        family += [base[i : i + 4] for i in rng.sample(range(len(base) - 4), min(15, len(base) - 4))]
        rng.shuffle(family)
        families.append([" ".join(words) for words in family])
    families_agree(spark, families, 4, num, hot)


def join_rows(spark, since):
    """Rows out of the largest join, and how many queries the session has run."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs, most = store.executionsList(), 0
    for i in range(since, runs.size()):
        values, nodes = store.executionMetrics(runs.apply(i).executionId()), store.planGraph(runs.apply(i).executionId()).allNodes()
        for node in (nodes.apply(j) for j in range(nodes.size())):
            for m in (node.metrics().apply(j) for j in range(node.metrics().size() if "Join" in node.name() else 0)):
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return most, runs.size()


def test_family_and_strays_make_no_pair_a_shared_shingle(spark):
    """Near copies share their base's shingles, but too late in the order of most strays to link."""
    docs = list(enumerate(near_copies(random.Random(3), 500, 150, 6)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    _, since = join_rows(spark, 1 << 30)
    got = sorted(map(tuple, ngram_components(frame).collect()), key=str)
    most, _ = join_rows(spark, since)
    assert got == brute(docs)
    assert 0 < most < 40 * len(docs), most
