"""Filter audit against filters applied in turn to plain rows."""

import itertools
import re

import numpy as np

from talkgrain.llm import filter_audit
from tests.llm.frames import edge_docs, edge_rows, no_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RATED = [(0, 1, 0), (1, 1, 1), (1, 0, None), (4, 0, 1), (None, 1, 1), (3, None, None)]


def fails(rows):
    for doc_id, text, part in rows:
        text = text or ""
        words = WORD.findall(text)
        yield {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows)}


def plain(rows, rated):
    good = {d for d, q, _ in rated if d is not None and q == 1}
    toxic = {d for d, _, x in rated if d is not None and x == 1}
    told = list(fails(rows))
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [k for k, row in enumerate(rows) if (row[2] or "") == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [k for k in left if told[k][f]]
                left = [k for k in left if not told[k][f]]
                sums[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(told[k][f] for k in own) - len(gone), sum(told[k][f] and sum(told[k].values()) == 1 for k in own),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return out


def asked(spark, docs, rated):
    labels = spark.createDataFrame([(*r, 1) for r in rated], "doc_id long, quality int, toxic int, mask int")
    rows = filter_audit.audited(filter_audit.failures(docs, labels)).collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows}
    assert len(out) == len(rows)
    return out


def test_edge_cases(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert len(rows) == len(edge_rows())
    assert asked(spark, docs, RATED) == plain(rows, RATED)


def test_copies_across_parts(spark):
    long = " ".join(f"word{k}" for k in range(250))
    rows = [(9, long, "a"), (2, long, "b"), (2, long, "a"), (None, long, "a"), (5, long + " #", "a"), (6, long + " #", None), (7, "SHOUT", ""), (8, "SHOUT", "b"), (8, "SHOUT", "b")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, mask string")
    assert asked(spark, docs, [(9, 1, 0), (8, 0, 1)]) == plain(rows, [(9, 1, 0), (8, 0, 1)])


def test_empty(spark):
    assert asked(spark, no_docs(spark), RATED) == {}


def test_walk_stores_every_state():
    cells = np.random.default_rng(1).integers(0, 50, (3, 2, 32))
    left = filter_audit.walked(cells, 5)
    for subset in range(32):
        assert (left[..., subset] == cells[..., [m for m in range(32) if not m & subset]].sum(-1)).all()
