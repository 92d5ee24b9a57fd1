"""Packings: whole, within capacity, best-fit, and no dearer than one size alone."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from talkgrain.llm import packing as pk
from tests.llm.frames import edge_docs, no_docs

SMALL = pk.Settings(sizes=(8, 16, 32), shard=50, each=2, square=256)


def plain_best_fit(lengths, floor, settings):
    """Room left in each bin, and the bins, by looking at every bin for every piece."""
    bins = []
    for n in lengths:
        fits = [b for b in bins if b[0] >= n]
        if fits:
            least = min(b[0] for b in fits)
            one = [b for b in fits if b[0] == least][0]
        else:
            allowed = [s for s in sorted(settings.sizes) if s >= max(n, floor)]
            size = min(allowed, key=lambda s: settings.cost(s) / (s if s > n else n))
            one = [size, []]
            bins.append(one)
        one[0] -= n
        one[1].append(n)
    return sorted(sorted(b[1]) for b in bins)


def test_against_plain_best_fit():
    for seed in range(30):
        rng = random.Random(seed)
        lengths = sorted((rng.randrange(1, 33) for _ in range(rng.randrange(0, 60))), reverse=True)
        for floor in SMALL.sizes:
            bins = pk.best_fit(lengths, floor, SMALL)
            assert sorted(sum(bins, [])) == list(range(len(lengths)))
            assert all(sum(lengths[k] for k in b) <= 32 for b in bins)
            assert len(bins) == len(plain_best_fit(lengths, floor, SMALL))
        cost = lambda bins: sum(SMALL.cost(pk.downsized(sum(lengths[k] for k in b), SMALL)) for b in bins)  # noqa: B023, E731
        assert cost(pk.packed_shard(lengths, SMALL)) == min((cost(pk.best_fit(lengths, f, SMALL)) for f in SMALL.sizes), default=0)


def held(rows, settings):
    """Checks pieces, offsets and sizes, and returns the tokens of each document."""
    bins, docs = defaultdict(list), defaultdict(int)
    for r in rows:
        docs[r["doc_id"]] += r["n_tokens"]
        if r["bin"] is None:
            assert r["n_tokens"] == 0
            continue
        assert r["start"] == r["piece"] * max(settings.sizes) and 0 < r["n_tokens"] <= max(settings.sizes)
        bins[r["bin"]].append((r["bin_start"], r["n_tokens"], r["bin_size"]))
    for own in bins.values():
        own.sort()
        assert [a for a, _, _ in own] == [sum(n for _, n, _ in own[:k]) for k in range(len(own))]
        total = sum(n for _, n, _ in own)
        assert {s for *_, s in own} == {pk.downsized(total, settings)}
    return docs


def test_frames(spark):
    docs = edge_docs(spark)
    rows = pk.packed(docs, SMALL).collect()
    want = defaultdict(int)
    for r in docs.select("doc_id", pk.words_and_signs(F.col("text")).alias("n")).collect():
        want[r["doc_id"]] += r["n"]
    assert held(rows, SMALL) == want
    assert pk.packed(no_docs(spark), SMALL).count() == 0


def test_lengths_of_ones_own(spark):
    docs = spark.createDataFrame([(k, k) for k in range(200)] + [(None, 5), (3, None)], "doc_id long, size long")
    rows = pk.packed(docs, SMALL, length=docs["size"]).collect()
    assert held(rows, SMALL)[150] == 150 and sum(r["n_tokens"] for r in rows) == sum(range(200)) + 5
