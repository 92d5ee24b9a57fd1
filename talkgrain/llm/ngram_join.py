"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of word n-grams. Bands of MinHash values bring likely pairs together; within a bucket every member meets the
bucket's leader, so that members with a common leader are the candidate pairs. A pair's MinHash values are compared a few at a
time, and the pair is dropped when the posterior probability that its similarity reaches the threshold falls below a tolerance.
The rest are verified on the whole sets. Pairs are never rows: blocks of members are compared inside a task, which returns sums
and a spanning forest, both linear in the members.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import picked, stored, stretches, whole


@dataclass(frozen=True)
class Settings:
    """words: of an n-gram. least: similarity of a link. A link of exactly that similarity shares no band with probability
    (1 - least ** rows) ** bands (5e-8), and is pruned at one of the looks with about `tolerance` each.
    block: members compared with each other in one task; larger groups are cut into more blocks."""

    words: int = 5
    least: Fraction = Fraction(4, 5)
    bands: int = 32
    rows: int = 4
    look: int = 16
    tolerance: float = 1e-9
    block: int = 256

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def _constants(settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    steps = rng.integers(0, 2**63, settings.words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(0, 2**32, settings.hashes, dtype=np.uint32)
    factors = rng.integers(0, 2**31, settings.hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return steps, masks, factors


def ngram_sets(texts: list[str], settings: Settings) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's n-grams of lower-cased words. A text of fewer words is one n-gram of them all; one
    without words has none."""
    steps, _, _ = _constants(settings)
    split = [x.lower().split() for x in texts]
    flat = [w for words in split for w in words]
    hashed = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.zeros(0, np.uint64)
    out, at = [], 0
    for words in split:
        own, at = hashed[at : at + len(words)], at + len(words)
        n = settings.words
        if len(own) < n:
            grams = np.array([(own * steps[: len(own)]).sum() + np.uint64(len(own))], np.uint64) if len(own) else own
        else:
            grams = sum(own[j : len(own) - n + 1 + j] * steps[j] for j in range(n))
        grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        out.append(np.unique(grams ^ (grams >> np.uint64(29))))
    return out


def minhashes(sets: list[np.ndarray], settings: Settings) -> np.ndarray:
    """A row of MinHash values for each set (all of them non-empty)."""
    _, masks, factors = _constants(settings)
    out = np.empty((len(sets), settings.hashes), np.uint32)
    first = 0
    while first < len(sets):  # some sets at a time, so that they stay in the cache
        last, size = first + 1, len(sets[first])
        while last < len(sets) and size + len(sets[last]) <= 1 << 16:
            size, last = size + len(sets[last]), last + 1
        values = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in sets[first : last - 1])])
        for k in range(settings.hashes):
            out[first:last, k] = np.minimum.reduceat((values ^ masks[k]) * factors[k], starts)
        first = last
    return out


def least_matches(settings: Settings) -> dict[int, int]:
    """For each number n of compared values, the fewest matches m with P(similarity >= least | m of n) >= tolerance, under a
    uniform prior: that probability is the one of m successes at most in n + 1 trials at `least`."""
    t, out = float(settings.least), {}
    for n in range(settings.look, settings.hashes + 1, settings.look):
        tail, m = 0.0, -1
        while tail < settings.tolerance:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


def unpruned(left: np.ndarray, right: np.ndarray, allowed: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of two MinHash tables, of those allowed, that no look drops."""
    fewest = least_matches(settings)
    look = settings.look
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for first in range(0, len(left), 64):  # bounds the first comparison
        part = left[first : first + 64]
        matches = (part[:, None, :look] == right[None, :, :look]).sum(axis=2)
        i, j = np.nonzero((matches >= fewest[look]) & allowed[first : first + 64])
        held = matches[i, j]
        for n in range(2 * look, settings.hashes + 1, look):
            held = held + (part[i, n - look : n] == right[j, n - look : n]).sum(axis=1)
            stay = held >= fewest[n]
            i, j, held = i[stay], j[stay], held[stay]
        found.append((i + first, j))
    return (np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])) if found else (np.zeros(0, int), np.zeros(0, int))


def _candidates(rows: pd.DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Positions of unpruned pairs of one block pair. A pair with several leaders in common belongs to the least of them."""
    leader, one, two = rows["leader"].iloc[0], rows["one"].iloc[0], rows["two"].iloc[0]
    table = np.frombuffer(b"".join(rows["sketch"]), np.uint32).reshape(len(rows), settings.hashes)
    at = np.arange(len(rows))
    left, right = (at, at) if one == two else (at[(rows["part"] == one).to_numpy()], at[(rows["part"] == two).to_numpy()])
    earlier = [[x for x in own if x < leader] for own in rows["leaders"]]
    names = {x: k for k, x in enumerate(sorted({x for own in earlier for x in own}))}
    allowed = left[:, None] < right[None, :] if one == two else np.ones((len(left), len(right)), bool)
    if names:
        has = np.zeros((len(rows), len(names)), np.float32)
        for i, own in enumerate(earlier):
            has[i, [names[x] for x in own]] = 1
        allowed &= (has[left] @ has[right].T) == 0
    i, j = unpruned(table[left], table[right], allowed, settings)
    return left[i], right[j]


def _verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, settings: Settings) -> np.ndarray:
    """Which of the pairs have the similarity, counted on whole sets."""
    sizes = np.array([len(s) for s in sets])
    need, of = settings.least.numerator, settings.least.denominator
    out = np.zeros(len(i), bool)
    shared = np.minimum(sizes[i], sizes[j])
    possible = np.nonzero(shared * of >= need * np.maximum(sizes[i], sizes[j]))[0]
    order = possible[np.argsort(i[possible], kind="stable")]
    _, ids = np.unique(np.concatenate(sets), return_inverse=True) if sets else (None, np.zeros(0, int))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(int(ids.max()) + 1 if len(ids) else 0, bool)
    cuts = np.nonzero(np.diff(i[order]))[0] + 1
    for group in np.split(order, cuts) if len(order) else []:
        own = ids[starts[i[group[0]]] : starts[i[group[0]] + 1]]
        marked[own] = True
        for part in np.array_split(group, -(-len(group) // 256)):
            partners = np.concatenate([ids[starts[k] : starts[k + 1]] for k in j[part]])
            both = np.add.reduceat(marked[partners].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[j[part]])[:-1]]))
            out[part] = of * both >= need * (sizes[i[part]] + sizes[j[part]] - both)
        marked[own] = False
    return out


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def sketched(docs: DataFrame, settings: Settings) -> DataFrame:
    """(id, text) to (id, key, sketch): the key names the n-gram set, so equal sets have one key; NULL where it is empty."""

    @F.pandas_udf("key binary, sketch binary")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, keys, sketches = batch.tolist(), [None] * len(batch), [None] * len(batch)
            for own in stretches(texts):
                sets = ngram_sets(texts[own], settings)
                full = [k for k, s in enumerate(sets) if len(s)]
                for k, row in zip(full, minhashes([sets[k] for k in full], settings) if full else [], strict=True):
                    keys[own.start + k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                    sketches[own.start + k] = row.tobytes()
            yield pd.DataFrame({"key": keys, "sketch": sketches})

    return docs.select("id", sketch.asNondeterministic()(whole(F.col("text"))).alias("made")).select("id", "made.key", "made.sketch")


def _dealt(homes: DataFrame, settings: Settings) -> DataFrame:
    """Each member of a home, once for each block that its own block meets."""
    sizes = homes.groupBy("leader").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"), F.count("*").alias("members"))
    own = homes.join(sizes.where("members > 1"), "leader").withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), "parts").cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select("leader", "key", "leaders", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))


def components(edges: DataFrame) -> DataFrame:
    """(key, root): the least key of each connected component, for every key on an edge (a, b).

    Large and small stars in turn until nothing changes; each round is a table, so a lost executor costs one round at most.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("key"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, settings: Settings | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row (id, class_id, n_links) for each row of docs.

    class_id: the least id of the connected component of links that the row's text is in. n_links: how many other rows have a
    text of the threshold similarity, equal texts among them. A NULL, empty or blank text has no links and is its own class.
    Rows that repeat count as copies of each other; NULL ids are passed over when the least id is sought.
    """
    settings = settings or Settings()
    source = picked(docs, id=id_col, text=text_col)
    rows = stored(sketched(source, settings), "sketches")
    classes = stored(
        rows.where("key is not null").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("sketch").alias("sketch")), "classes")

    width = 4 * settings.rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(settings.bands - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sketch"), b * width + 1, F.lit(width))))
    buckets = classes.select("key", F.explode(bands).alias("bucket"))
    led = buckets.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    candidates = stored(buckets.join(led, "bucket").groupBy("key").agg(F.sort_array(F.collect_set("leader")).alias("leaders")), "candidates")

    homes = candidates.withColumn("leader", F.explode("leaders"))
    sketches = classes.select("key", "sketch", "copies")

    def survivors(part: pd.DataFrame) -> pd.DataFrame:
        i, j = _candidates(part, settings)
        return part.iloc[np.unique(np.concatenate([i, j]))][["leader", "key"]]

    members = stored(
        _dealt(homes, settings).join(sketches, "key").groupBy("leader", "one", "two").applyInPandas(survivors, "leader binary, key binary").distinct(), "members")

    wanted = members.select("key").distinct().join(classes.select("key", "id"), "key")

    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            texts = part["text"].tolist()
            for own in stretches(texts):
                sets = ngram_sets(texts[own], settings)
                yield pd.DataFrame({"key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "grams": [s.tobytes() for s in sets]})

    texts = _texts(source, wanted)
    sets = texts.mapInPandas(to_sets, "key binary, grams binary").groupBy("key").agg(F.first("grams").alias("grams"))

    def links(part: pd.DataFrame) -> pd.DataFrame:
        i, j = _candidates(part, settings)
        own = [np.frombuffer(x, np.uint64) for x in part["grams"]]
        true = _verified(own, i, j, settings)
        i, j = i[true], j[true]
        copies = part["copies"].to_numpy()
        found = np.bincount(i, copies[j], len(part)) + np.bincount(j, copies[i], len(part))
        keys = part["key"].to_numpy()
        order = sorted(range(len(part)), key=lambda k: keys[k])
        place = np.argsort(order)
        roots = _roots(len(part), place[i], place[j])
        linked = np.nonzero(found)[0]
        return pd.DataFrame({"key": keys[linked], "links": found[linked].astype(np.int64), "root": [keys[order[roots[place[k]]]] for k in linked]})

    again = members.join(candidates, "key")
    verified = stored(
        _dealt(again, settings).join(sketches, "key").join(sets, "key").groupBy("leader", "one", "two").applyInPandas(links, "key binary, links long, root binary"), "links")

    roots = components(verified.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = verified.groupBy("key").agg(F.sum("links").alias("links"))
    own = classes.select("key", "id", "copies").join(counts, "key", "left").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    firsts = own.groupBy("root").agg(F.min("id").alias("class_id"))
    judged = own.join(firsts, "root").select("key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("id", "key").join(judged, "key", "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _texts(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the wanted ids, NULL ids included."""
    ids = wanted.select(F.col("id").alias("_wanted")).distinct()
    return source.join(ids, source["id"].eqNullSafe(ids["_wanted"]), "left_semi").select("id", whole(F.col("text")).alias("text"))


def one_of_each(docs: DataFrame, settings: Settings | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near copies: of each class the row with the least id stays. Repeated rows stay once; rows without an id stay,
    equal texts once."""
    classes = near_duplicates(docs, settings, id_col=id_col, text_col=text_col)
    stay = classes.where(F.col(id_col).isNull() | (F.col(id_col) == F.col("class_id"))).select(F.col(id_col).alias("_stay")).distinct()
    marked = docs.join(stay, docs[id_col].eqNullSafe(stay["_stay"]), "left_semi").withColumn("_print", F.md5(whole(docs[text_col])))
    return marked.dropDuplicates([id_col, "_print"]).drop("_print")
