"""The join against all pairs of a small table."""

from collections import Counter
from fractions import Fraction

import numpy as np

from talkgrain.llm import ngram_join as nj
from tests.llm.frames import edge_docs, edge_rows, no_docs


def grams(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def plain(rows, least=Fraction(4, 5)):
    """(id, class, links) of each row, by comparing every row with every other."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= least * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return Counter((i, ids.get(find(k)) if sets[k] else i, links[k]) for k, (i, _) in enumerate(rows))


def test_edge_cases(spark):
    got = Counter(tuple(r) for r in nj.near_duplicates(edge_docs(spark)).collect())
    assert got == plain([r[:2] for r in edge_rows()])


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = Counter(tuple(r) for r in nj.near_duplicates(docs).collect())
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_large_group_in_blocks(spark):
    """One group of near copies over several blocks, every pair of which counts."""
    words = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join([*words[:40], f"x{k % 9}", *words[40:]]) + (f" end{k}" if k % 3 else "")) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in nj.near_duplicates(docs, nj.Settings(block=16)).collect())
    assert got == plain(rows)


def test_empty(spark):
    assert nj.near_duplicates(no_docs(spark)).count() == 0
    assert nj.one_of_each(no_docs(spark)).count() == 0


def test_one_of_each(spark):
    rows = nj.one_of_each(edge_docs(spark)).collect()
    ids = [r["doc_id"] for r in rows if r["text"] and len(r["text"].split()) > 50]
    assert 0 in ids and 2 not in ids and ids.count(0) == 1 and 3 in ids
    assert len([r for r in rows if r["doc_id"] is not None]) == len({(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None})


def test_pruning_keeps_what_may_be_similar():
    settings = nj.Settings()
    fewest = nj.least_matches(settings)
    assert all(fewest[n] < 0.8 * n for n in fewest) and fewest[128] > 60
    rng = np.random.default_rng(1)
    left = rng.integers(0, 2**32, (20, 128), dtype=np.uint32)
    right = left.copy()
    right[:, 100:] += 1  # 100 of 128 agree
    i, j = nj.unpruned(left, right, np.ones((20, 20), bool), settings)
    assert list(zip(i, j)) == [(k, k) for k in range(20)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (12, 11), (20, 20), (7, 6), (6, 8)]
    got = {r["key"]: r["root"] for r in nj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 6: 6, 7: 6, 8: 6}
