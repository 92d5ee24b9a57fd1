"""Scores against models counted by plain loops, and on documents held out."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from talkgrain.llm import cross_entropy as ce
from tests.llm.frames import edge_docs, no_docs

SETTINGS = ce.Settings()


def loops(rows):
    """(text, target, in the models) to words and mean losses by plain counting of words as strings, each text left out of its models."""
    words, pairs, contexts = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    for text, good, held in rows:
        own = text.lower().split()
        for m in ((0, 1) if good else (1,)) if held else ():
            words[m].update(own)
            pairs[m].update(zip(["", *own], own))
            contexts[m].update(["", *own][:-1] if own else [])
    size, vocabulary = [sum(w.values()) for w in words], len(words[1]) + 1
    out = []
    for text, good, held in rows:
        own = text.lower().split()
        mine = [Counter(own), Counter(zip(["", *own], own)), Counter(["", *own][:-1] if own else [])]
        none = [Counter(), Counter(), Counter()]
        less = [mine if held and good else none, mine if held else none]
        left = [size[m] - less[m][0].total() for m in (0, 1)]
        share, sums = [1.0, left[0] / left[1] if left[1] else 0.0], [0.0, 0.0]
        for m in (0, 1):
            for a, b in zip(["", *own], own):
                single = ((words[m][b] - less[m][0][b]) * share[m] + 1) / (left[m] * share[m] + vocabulary)
                sums[m] -= math.log(((pairs[m][a, b] - less[m][1][a, b]) * share[m] + SETTINGS.prior * single) / ((contexts[m][a] - less[m][2][a]) * share[m] + SETTINGS.prior))
        out.append((len(own), *((x / len(own) for x in sums) if own else (None, None))))
    return out


def auc(low, high):
    """The chance that one of `low` is below one of `high`."""
    return (low[:, None] < high[None, :]).mean() + (low[:, None] == high[None, :]).mean() / 2


def test_scores_do_not_tell_who_was_counted(spark):
    """Half of the good documents are named as targets: the named are not told from the unnamed."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("good", F.expr("quality = 1 and toxic = 0"))
    named = F.col("good") & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = ce.compared(docs, labels.where(named).select("doc_id")).join(labels.where("good").select("doc_id", named.alias("named")), "doc_id").dropna(subset=["loss_difference"]).toPandas()
    assert 0.4 < auc(rows[rows.named].loss_difference.to_numpy(), rows[~rows.named].loss_difference.to_numpy()) < 0.6


def test_held_out(spark):
    """Models of one half of the documents tell the well written ones of the other half from the rest."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").join(labels.select("doc_id"), "doc_id")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    scored = ce.compared(docs, labels.where("quality = 1").select("doc_id"), in_models=F.pmod(F.xxhash64(docs["doc_id"]), F.lit(2)) == 0)
    rows = scored.where(~seen).join(labels, "doc_id").dropna(subset=["loss_difference"]).select("quality", "loss_difference").toPandas()
    assert auc(rows[rows.quality == 1].loss_difference.to_numpy(), rows[rows.quality == 0].loss_difference.to_numpy()) > 0.9


def test_exact_beyond_any_table(spark):
    """A million distinct words and pairs; frequent ones, texts held out of the models, many chunks."""
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{rng.randrange(2_000_000)}" if rng.random() < 0.9 else "The cat" for _ in range(1000)), k % 3 == 0, k % 7 != 0) for k in range(1400)]
    rows += [(2000, "", True, True), (2001, "  \n", False, True), (2002, "alone", False, False), (9007199254740993, "the cat", True, True), (None, "the cat", False, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean, held boolean").repartition(5)
    targets = docs.where("good").select("doc_id")
    got = ce.compared(docs, targets, ce.Settings(chunk=1_500_000), in_models=docs["held"]).collect()
    assert len({w for _, text, *_ in rows for w in text.split()}) > 500_000
    want = {i: x for (i, *_), x in zip(rows, loops([r[1:] for r in rows]))}
    assert len(got) == len(rows) and "text" not in got[0].asDict()
    for r in got:
        n, *losses = want[r["doc_id"]]
        assert r["n_words"] == n
        if not n:
            assert r["target_loss"] is r["background_loss"] is r["loss_difference"] is None
        else:
            assert abs(r["target_loss"] - losses[0]) < 1e-9 and abs(r["background_loss"] - losses[1]) < 1e-9 and abs(r["loss_difference"] - losses[0] + losses[1]) < 1e-9


def test_exact_edge_cases(spark):
    docs = edge_docs(spark)
    assert ce.compared(docs, no_docs(spark)).count() == docs.count()
    assert ce.compared(no_docs(spark), docs).count() == 0


def test_query_counts_exactly(spark):
    """The registered query against plain counting over the smallest tables."""
    from talkgrain.llm.queries import op6_cross_entropy

    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    good = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id").collect()}
    want = dict(zip((i for i, _ in docs), loops([(text, i in good, True) for i, text in docs])))
    for r in op6_cross_entropy(spark, folder).collect():
        n, *losses = want[r["doc_id"]]
        assert r["n_words"] == n and (not n or abs(r["loss_difference"] - losses[0] + losses[1]) < 1e-9)


def test_pair_keys_that_share_64_bits():
    keys, checks = np.array([5, 3, 5, 5], np.uint64), np.array([1, 9, 2, 1], np.uint16)
    one, places = ce._distinct(keys, checks)
    assert len(one) == 3 and places[0] == places[3] != places[2] and list(keys[one]) == [3, 5, 5]
