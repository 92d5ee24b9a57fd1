"""Merkle manifest against trees and proofs worked out by plain lists."""

import hashlib
import random
import zlib

import pytest

from talkgrain.llm import merkle_manifest, queries
from tests.llm.frames import edge_docs, edge_rows, no_docs
from tests.oracle import compare, connect

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = dict(zip(NAMES, row, strict=True))
    if values["n_chars"] is not None:
        values["n_chars"] += more
    shown = ["-" if v is None else str(v) for v in values.values()]
    return h(*("-" if v is None else f"{len(s.encode())}:{s}" for v, s in zip(values.values(), shown, strict=True)))


def climb(nodes, k, value=None):
    """Root, siblings, and the root that a changed leaf folds to."""
    level, own, siblings = list(nodes), nodes[k] if value is None else value, []
    while len(level) > 1:
        run = level[k // 2 * 2 : k // 2 * 2 + 2]
        siblings += run[:k % 2] + run[k % 2 + 1 :]
        run[k % 2] = own
        own, level, k = h(*run), [h(*level[i : i + 2]) for i in range(0, len(level), 2)], k // 2
    return level[0], siblings, own


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    roots = [climb([leaf(r) for r in trees[x]], 0)[0] for x in langs]
    out = []
    for at, x in enumerate(langs):
        nodes = [leaf(r) for r in trees[x]]
        for k, r in enumerate(trees[x]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            _, below, mid = climb(nodes, k, leaf(r, 1) if bad else None)
            root, above, end = climb(roots, at, mid)
            out.append((r[0], nodes[k], roots[at], root, h(*below, *above), end, end == root))
    return sorted(map(repr, out))


def asked(docs, **more):
    return sorted(repr(tuple(r)) for r in merkle_manifest.manifest(docs, **more).collect())


def test_edge_cases(spark):
    rows = [tuple(r[c] for c in NAMES) for r in edge_docs(spark).collect()]
    assert len(rows) == len(edge_rows())
    assert asked(edge_docs(spark)) == plain(rows)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 1, None: 1}, {"en": 17, "de": 16, "": 5, None: 2, "日本": 33}, {"en": 70, "fr": 1, "x": 3, "y": 2, "z": 1}])
def test_shapes(spark, sizes):
    rng = random.Random(5)
    rows = [(rng.randrange(10**6), rng.choice(["a", None, "é"]), lang, rng.choice([None, k, 2**63 - 1]), f"text {k}") for lang, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert asked(docs, span=2) == plain(rows)


def test_hot_row(spark):
    """A third of all rows are the same row."""
    rows = [(7, "s", "en", 3, "abc")] * 40 + [(k, "s", "en", 3, f"t{k}") for k in range(80)]
    assert asked(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == plain(rows)


def test_empty(spark):
    assert asked(no_docs(spark)) == []


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert not compare(spark, connect(folder), folder, queries.op13_merkle_manifest, queries.ORACLES["op13_merkle_manifest"])
