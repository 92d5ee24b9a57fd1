"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < ... < K share one weight per hashed text feature; ordered thresholds cut the score of a document into grades:
P(grade <= k) = sigmoid(threshold[k] - weights . features). A document gets its expected grade and the probability of each
tail, and is selected by one of the tails.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import picked, whole

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
LOUD = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}")
SHAPES, SHAPE_WEIGHT, POWER = 4, 3.0, 0.25
FOUR, FIVE = 4, 5  # where the hash of a stem starts, so that it is not that of the same word


@dataclass(frozen=True)
class Settings:
    """bits: of the hashed feature space. sample: labelled documents used for the fit at most, a bound on its memory.
    The sample holds the ids that come first by a hash, so it is the same at each run and not tied to the order of the table.
    penalty: on the absolute weights, which leaves only telling features. Features of fewer than least_documents documents of
    the sample get no weight."""

    bits: int = 18
    sample: int = 6_000
    rounds: int = 200
    rate: float = 0.05
    penalty: float = 1e-4
    least_documents: int = 5
    part: int = 500
    known_words: int = 400_000


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    rarity: np.ndarray
    bits: int
    history: list[float] = field(default_factory=list)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per score."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


class Hasher:
    """Text to hashed features. Remembers where words go, up to a bound; past it words are hashed each time."""

    def __init__(self, settings: Settings) -> None:
        self.mask, self.most, self.place = (1 << settings.bits) - 1, settings.known_words, {}

    def bucket(self, word: str) -> int:
        return crc32(word.encode()) & self.mask

    def buckets(self, word: str) -> tuple[int, int, int]:
        """Of the word, of its first four and of its first five letters: languages that build words share stems."""
        at = self.place.get(word)
        if at is None:
            at = self.hashed(word)
            if len(self.place) < self.most:
                self.place[word] = at
        return at

    def hashed(self, word: str) -> tuple[int, int, int]:
        key, mask = word.encode(), self.mask
        return crc32(key) & mask, crc32(word[:4].encode(), FOUR) & mask, crc32(word[:5].encode(), FIVE) & mask

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and their weights: damped counts of words with their stems, and the shape of the text."""
        counts, shape = counted(text)
        each = np.array([self.buckets(w) for w in counts], np.int64).reshape(-1, 3)
        damped = 1.0 + np.log(np.fromiter(counts.values(), float, len(counts)))
        return np.concatenate([each.T.ravel(), [self.bucket(k) for k in shape]]).astype(np.int64), np.concatenate([np.tile(damped, 3), list(shape.values())])


class Scorer:
    """Scores of texts under a model: the same sums as over their features, gathered word by word."""

    def __init__(self, model: Model, settings: Settings) -> None:
        self.hasher, self.model, self.place, self.most = Hasher(settings), model, {}, settings.known_words
        self.pull, self.square = np.zeros(1024), np.zeros(1024)

    def _learn(self, words: list[str]) -> None:
        at = len(self.place)
        if at + len(words) > len(self.pull):
            self.pull, self.square = (np.concatenate([x, np.zeros(len(x) + len(words))]) for x in (self.pull, self.square))
        buckets = np.array([self.hasher.hashed(w) for w in words], np.int64)
        rarity = self.model.rarity[buckets]
        self.pull[at : at + len(words)] = (self.model.weights[buckets] * rarity).sum(axis=1)
        self.square[at : at + len(words)] = (rarity**2).sum(axis=1)
        self.place.update(zip(words, range(at, at + len(words)), strict=True))

    def score(self, text: str) -> float:
        counts, shape = counted(text)
        if len(self.place) + len(counts) > self.most:
            self.place.clear()
        if unknown := [w for w in counts if w not in self.place]:
            self._learn(unknown)
        at = [self.place[w] for w in counts]
        damped = 1.0 + np.log(np.fromiter(counts.values(), float, len(counts)))
        size = float(damped**2 @ self.square[at]) ** POWER
        own = sum(self.model.weights[self.hasher.bucket(k)] * v for k, v in shape.items()) * SHAPE_WEIGHT
        return (float(damped @ self.pull[at]) / size if size else 0.0) + float(own)


def counted(text: str) -> tuple[Counter, dict[str, float]]:
    """Counts of lower-cased words and runs of signs, and the shares of the text that shout, repeat the token before or repeat a
    line."""
    tokens = TOKEN.findall(text)
    total = max(len(tokens), 1)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    return Counter(map(str.lower, tokens)), {
        "\x00loud": len(LOUD.findall(text)) / total,
        "\x00echo": sum(map(eq, tokens, tokens[1:])) / total,
        "\x00again": (len(lines) - len(set(lines))) / max(len(lines), 1),
        "\x00short": 1.0 / (1 + len(tokens)),
    }


def scaled(buckets: np.ndarray, values: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Words weighted by rarity, over the root of their length as a vector: a few telling words count in a long text as well.
    The shares of the shape features are not divided."""
    out = values.astype(float)
    out[-SHAPES:] *= SHAPE_WEIGHT
    out[:-SHAPES] *= rarity[buckets[:-SHAPES]]
    size = (out[:-SHAPES] ** 2).sum() ** POWER
    out[:-SHAPES] /= size if size else 1.0
    return out


def fit(texts: list[str], grades: np.ndarray, settings: Settings) -> Model:
    """Likelihood of the cumulative links with a penalty on absolute weights, by Adam steps with soft thresholds over the whole
    sample. Without rows, or with one grade only, each document gets that grade (grade 0 if there are no rows at all)."""
    hasher, size = Hasher(settings), 1 << settings.bits
    top = max(int(grades.max()), 1) if len(grades) else 1
    if len(set(grades.tolist())) < 2:
        return Model(np.zeros(size), np.where(np.arange(1, top + 1) <= (grades[0] if len(grades) else 0), -20.0, 20.0), np.ones(size), settings.bits)
    rows = [(b.astype(np.int32), v.astype(np.float32)) for b, v in map(hasher.features, texts)]
    seen = np.zeros(size, np.int64)
    for b, _ in rows:
        seen[np.unique(b[:-SHAPES])] += 1
    rarity = np.log((1 + len(rows)) / (1 + seen)) + 1
    common = seen >= settings.least_documents
    common[rows[0][0][-SHAPES:]] = True
    used = np.nonzero(common)[0]
    place = np.zeros(size, np.int32)
    place[used] = np.arange(len(used))
    parts = []  # some documents at a time, which bounds the working memory
    while rows:
        own, rows = rows[: settings.part], rows[settings.part :]
        told = [common[b] for b, _ in own]
        parts.append((
            np.concatenate([place[b[t]] for (b, _), t in zip(own, told, strict=True)]),
            np.concatenate([scaled(b, v, rarity)[t].astype(np.float32) for (b, v), t in zip(own, told, strict=True)]),
            np.repeat(np.arange(len(own), dtype=np.int32), [int(t.sum()) for t in told]), len(own)))
    n, weights = len(texts), np.zeros(len(used))
    share = np.array([(grades <= k).mean() for k in range(top)]).clip(0.01, 0.99)
    cuts = np.log(share / (1 - share)) + np.arange(top) * 1e-3
    slopes, squares = (np.zeros(len(used)), np.zeros(top)), (np.zeros(len(used)), np.zeros(top))
    history = []
    for step in range(1, settings.rounds + 1):
        score = np.concatenate([np.bincount(row, weights[index] * value, many) for index, value, row, many in parts])
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper = np.where(grades == top, 1.0, _sigmoid(edge[grades + 1] - score))
        lower = np.where(grades == 0, 0.0, _sigmoid(edge[grades] - score))
        chance = np.maximum(upper - lower, 1e-12)
        history.append(float(-np.log(chance).mean()))
        by_upper, by_lower = upper * (1 - upper) / chance / n, lower * (1 - lower) / chance / n
        pull, slope, at = by_upper - by_lower, np.zeros(len(used)), 0
        for index, value, row, many in parts:
            slope += np.bincount(index, pull[at : at + many][row] * value, len(used))
            at += many
        grads = slope, np.array([by_lower[grades == k + 1].sum() - by_upper[grades == k].sum() for k in range(top)])
        slopes = tuple(0.9 * a + 0.1 * g for a, g in zip(slopes, grads, strict=True))
        squares = tuple(0.999 * a + 0.001 * g**2 for a, g in zip(squares, grads, strict=True))
        paces = [settings.rate / (np.sqrt(a / (1 - 0.999**step)) + 1e-8) for a in squares]
        weights = weights - paces[0] * slopes[0] / (1 - 0.9**step)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - paces[0] * settings.penalty, 0)
        cuts = np.maximum.accumulate(cuts - paces[1] * slopes[1] / (1 - 0.9**step)) + np.arange(top) * 1e-6
    everywhere = np.zeros(size)
    everywhere[used] = weights
    return Model(everywhere, cuts, rarity, settings.bits, history)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def graded_sample(docs: DataFrame, ratings: DataFrame, settings: Settings, *, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade") -> DataFrame:
    """The labelled documents of the fit: ids by hash order, `settings.sample` at most; of several ratings the lowest counts."""
    rated = picked(ratings, _id=id_col, _grade=grade_col).dropna().groupBy("_id").agg(F.min("_grade").cast("int").alias("_grade"))
    chosen = rated.orderBy(F.xxhash64("_id"), "_id").limit(settings.sample)
    texts = picked(docs, _id=id_col, _text=text_col)
    # at most settings.sample narrow rows
    return texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_grade").agg(F.max(whole(F.col("_text"))).alias("_text"))


def train(docs: DataFrame, ratings: DataFrame, settings: Settings | None = None, **columns: str) -> Model:
    settings = settings or Settings()
    rows = graded_sample(docs, ratings, settings, **columns).orderBy("_id").toPandas()
    return fit(rows.pop("_text").tolist(), rows["_grade"].to_numpy(np.int64) if len(rows) else np.zeros(0, np.int64), settings)


def scored(docs: DataFrame, model: Model, settings: Settings | None = None, *, text_col: str = "text", select: int | None = None, least: float = 0.5) -> DataFrame:
    """docs with expected_grade, tail probabilities and kept (probability of grade `select` or better is `least` or more).

    A NULL text counts as empty; rows that repeat are scored each by itself. Columns of docs that have these names already are
    replaced.
    """
    settings = settings or Settings(bits=model.bits)
    top = len(model.thresholds)
    wanted = top if select is None else select
    # two tables of 2 ** bits numbers, whatever the input
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.rarity, model.thresholds))

    @F.pandas_udf("expected_grade double, tails array<double>, grade_score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, rarity, thresholds = held.value
        own = Model(weights, thresholds, rarity, settings.bits)
        scorer = Scorer(own, settings)
        for texts in batches:
            score = np.fromiter((scorer.score(x) for x in texts), float, len(texts))
            tails = own.tails(score)
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tails": list(tails), "grade_score": score})

    out = docs.withColumn("_judged", judge(whole(docs[text_col])))
    out = out.withColumns({"expected_grade": F.col("_judged.expected_grade"), "tails": F.col("_judged.tails"), "grade_score": F.col("_judged.grade_score")}).drop("_judged")
    return out.withColumn("kept", F.element_at("tails", wanted) >= F.lit(float(least)))
