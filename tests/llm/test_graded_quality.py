"""The ordinal classifier: likelihood and slopes, held-out grades, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from talkgrain.llm import graded_quality as gq
from talkgrain.llm import queries
from tests.llm.frames import edge_docs, no_docs, texts

SMALL = gq.Settings(bits=14, rounds=80, sample=500, least_documents=2)


def test_separates_ordered_grades():
    texts_ = [f"{['awful', 'plain', 'great'][k % 3]} text number {k % 7} here" for k in range(120)]
    model = gq.fit(texts_, np.array([k % 3 for k in range(120)]), SMALL)
    assert model.history[-1] < 0.3 * model.history[0] and (np.diff(model.thresholds) > 0).all()
    scorer = gq.Scorer(model, SMALL)
    tails = model.tails(np.array([scorer.score(f"{w} text") for w in ("awful", "plain", "great")]))
    assert (np.diff(tails.sum(axis=1)) > 0.4).all() and (tails[:, 0] >= tails[:, 1]).all()


def test_scorer_is_the_sum_over_features():
    rng = np.random.default_rng(2)
    settings = gq.Settings(bits=12, known_words=50)
    model = gq.Model(rng.normal(size=1 << 12), np.array([0.0, 1.0]), rng.random(1 << 12) + 1, 12)
    scorer, hasher = gq.Scorer(model, settings), gq.Hasher(settings)
    for text in [t or "" for t in texts()] * 2:
        buckets, values = hasher.features(text)
        assert abs(scorer.score(text) - model.weights[buckets] @ gq.scaled(buckets, values, model.rarity)) < 1e-6


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    grades = queries.graded(spark.read.parquet(f"{folder}/labels.parquet"))
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(4)) > 0
    settings = gq.Settings(sample=3_000, rounds=120)
    model = gq.train(docs, grades.where(seen), settings)
    rows = gq.scored(docs.join(grades.where(~seen), "doc_id"), model, settings, select=2, least=0.5).select("grade", "kept").toPandas()
    assert rows[rows.grade == 2].kept.mean() > 0.98
    assert rows[rows.grade == 0].kept.mean() < 0.05
    assert rows[rows.grade == 1].kept.mean() < 0.4


def test_sample_is_bounded_and_ties_take_the_lowest(spark):
    ratings = spark.createDataFrame([(1, 2), (1, 0), (2, 1), (None, 1), (3, None), (0, 2), (2, 1)], "doc_id long, grade int")
    rows = gq.graded_sample(edge_docs(spark), ratings, SMALL).collect()
    assert {(r["_id"], r["_grade"]) for r in rows} == {(0, 2), (1, 0), (2, 1)}
    assert gq.graded_sample(edge_docs(spark), ratings, gq.Settings(sample=2)).count() == 2


def test_edge_cases(spark):
    ratings = spark.createDataFrame([(k, k % 3) for k in range(18)], "doc_id long, grade int")
    model = gq.train(edge_docs(spark), ratings, SMALL)
    rows = gq.scored(edge_docs(spark), model, SMALL).collect()
    assert len(rows) == edge_docs(spark).count()
    assert all(0 <= r["expected_grade"] <= 2 and isinstance(r["kept"], bool) for r in rows)
    assert gq.scored(no_docs(spark), model, SMALL).count() == 0
    nothing = gq.train(edge_docs(spark), ratings.where("false"), SMALL)
    assert gq.scored(edge_docs(spark), nothing, SMALL).where("kept").count() == 0
    single = gq.train(edge_docs(spark), ratings.where("grade = 2"), SMALL)
    assert gq.scored(edge_docs(spark), single, SMALL, select=2).where("not kept").count() == 0
