"""Language-model scoring by cross-entropy difference.

A target and a background model of word pairs are matched: both share one vocabulary, one smoothing, and, by scaling, one size. A
document's score is the mean over its tokens of the loss under the target model less the loss under the background model; the
lower, the more it is like the target. A document that is in the models is scored without its own counts, so that a score does
not tell whether the document was counted.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import stretches, whole


@dataclass(frozen=True)
class Settings:
    """prior: weight of the single-word model in the pair model, in tokens. chunk: bytes of text that a task works on at a time."""

    prior: float = 50.0
    chunk: int = 8_000_000


MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


# The documents are dealt into chunks. A chunk asks for each of its distinct words and pairs once, whatever their
# number, so a frequent pair is in one row of a chunk at most. Words and pairs are dealt by hash into parts; a part adds up what
# all chunks tell and answers each in the order in which it asked.


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; 64-bit hashes of all words, and of the word before each (0 before the first)."""
    sizes, ids = [], [np.zeros(0, np.uint64)]
    for some in stretches(texts):
        words = [t.lower().split() for t in texts[some]]
        sizes += map(len, words)
        flat = list(chain.from_iterable(words))
        if flat:
            ids.append(pd.util.hash_array(np.array(flat, dtype=object)))
    lengths, ids = np.array(sizes, np.int64), np.concatenate(ids)
    before = np.concatenate([np.zeros(1, np.uint64), ids])[:-1]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    return lengths, ids, before


def _pair_keys(before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """80 bits of both hashes: among 10^10 pairs some two fall together with a chance of 4e-5."""
    key = _mixed(_mixed(before ^ MULTIPLY) + ids)
    return key, (_mixed(_mixed(ids + MULTIPLY) ^ before) >> np.uint64(48)).astype(np.uint16)


def _distinct(keys: np.ndarray, checks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each distinct key, by key; for each key its place among them."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    if checks is not None and (checks[order][1:] != checks[order][:-1])[~new[1:]].any():
        order = np.lexsort((checks, keys))
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    places = np.empty(len(keys), np.int64)
    places[order] = np.cumsum(new) - 1
    return order[new], places


def _added(places: np.ndarray, size: int, rows: list[np.ndarray]) -> np.ndarray:
    """Each row of whole numbers summed by place; sums below 2^53 are exact."""
    return np.array([np.bincount(places, row, size) for row in rows]).astype(np.int64).reshape(len(rows), size)


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: bytes that are 0 everywhere lie together."""
    return np.ascontiguousarray(np.ascontiguousarray(numbers).reshape(-1, 1).view(np.uint8).T).tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _squeezed(counts: np.ndarray) -> bytes:
    return zlib.compress(_planes(counts.astype(np.int64)), 1)


def _counts(packed: list[bytes], rows: int) -> np.ndarray:
    return np.concatenate([np.zeros((rows, 0), np.int64), *(_numbers(zlib.decompress(x), np.int64).reshape(rows, -1) for x in packed)], axis=1)


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return _planes(np.concatenate([keys[:1], keys[1:] - keys[:-1]]))


def _keys(steps: bytes) -> np.ndarray:
    return np.cumsum(_numbers(steps, np.uint64), dtype=np.uint64)


@dataclass
class Chunk:
    """Distinct words (0: the start of a text) and pairs of some texts, in the order of their keys, and where each token's are."""

    lengths: np.ndarray
    words: np.ndarray
    word_at: np.ndarray
    before_at: np.ndarray
    keys: np.ndarray
    checks: np.ndarray
    pair_at: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Chunk:
        lengths, ids, before = _tokens(texts)
        both = np.concatenate([ids, before])
        one, at = _distinct(both)
        keys, checks = _pair_keys(before, ids)
        pair_one, pair_at = _distinct(keys, checks)
        return Chunk(lengths, both[one], at[: len(ids)], at[len(ids) :], keys[pair_one], checks[pair_one], pair_at)

    def counts(self, target: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words and contexts, pairs) under target and background, from texts that are in the models."""
        roles = [np.repeat((held & target).astype(float), self.lengths), np.repeat(held.astype(float), self.lengths)]
        words = np.concatenate([_added(self.word_at, len(self.words), roles), _added(self.before_at, len(self.words), roles)])
        return words, _added(self.pair_at, len(self.keys), roles)


def _bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part starts among sorted keys, and the end."""
    edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


ASKED = "part int, chunk int, words binary, word_counts binary, keys binary, checks binary, counts binary"
TOLD = "part int, chunk int, word_counts binary, counts binary, vocabulary long, target_size long, size long"
_INT, _LONG, _BYTES = pa.int32(), pa.int64(), pa.binary()


def _answered(asked: pa.Table) -> pa.Table:
    """The counts of one part over all chunks, to each chunk for what it asked."""
    words = [_keys(x) for x in asked["words"].to_pylist()]
    keys = [_keys(x) for x in asked["keys"].to_pylist()]
    checks = np.concatenate([np.frombuffer(x, np.uint16) for x in asked["checks"].to_pylist()])
    one, at = _distinct(np.concatenate(words))
    sums = _added(at, len(one), list(_counts(asked["word_counts"].to_pylist(), 4)))
    pair_one, pair_at = _distinct(np.concatenate(keys), checks)
    pairs = _added(pair_at, len(pair_one), list(_counts(asked["counts"].to_pylist(), 2)))
    word_ends, ends, n = np.cumsum([0, *map(len, words)]), np.cumsum([0, *map(len, keys)]), len(words)
    return pa.table({
        "part": asked["part"], "chunk": asked["chunk"],
        "word_counts": pa.array([_squeezed(sums[:, at[word_ends[k] : word_ends[k + 1]]]) for k in range(n)], _BYTES),
        "counts": pa.array([_squeezed(pairs[:, pair_at[ends[k] : ends[k + 1]]]) for k in range(n)], _BYTES),
        "vocabulary": pa.array([int((sums[1] > 0).sum())] * n, _LONG), "target_size": pa.array([int(sums[0].sum())] * n, _LONG), "size": pa.array([int(sums[1].sum())] * n, _LONG),
    })


def _own(owner: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """For each token, how often its place occurs in its own text."""
    _, at, counts = np.unique(owner * size + places, return_inverse=True, return_counts=True)
    return counts[at]


def _losses(chunk: Chunk, told: pa.Table, target: np.ndarray, held: np.ndarray, settings: Settings) -> np.ndarray:
    """The mean loss of each text with words under target and background, each without the text's own counts. Every part has answered,
    so its sizes sum up to those of the models. The vocabulary is that of the whole background and one word more for unseen ones."""
    told = told.sort_by("part")
    words, pairs = _counts(told["word_counts"].to_pylist(), 4), _counts(told["counts"].to_pylist(), 2)
    vocabulary, *size = (sum(told[c].to_pylist()) for c in ("vocabulary", "target_size", "size"))
    lengths = chunk.lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    own_words, own_contexts, own_pairs = (_own(owner, at, most) for at, most in ((chunk.word_at, len(chunk.words)), (chunk.before_at, len(chunk.words)), (chunk.pair_at, len(chunk.keys))))
    counted = ((held & target).astype(np.int64), held.astype(np.int64))
    sizes = [size[m] - lengths * counted[m] for m in (0, 1)]
    shares = (np.ones(len(lengths)), sizes[0] / np.maximum(sizes[1], 1))  # the background as large as the target
    some = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[some]
    out = np.zeros((2, len(starts)))
    for m in (0, 1):
        mine, share = counted[m][owner], shares[m][owner]
        single = ((words[m][chunk.word_at] - own_words * mine) * share + 1.0) / (sizes[m] * shares[m] + vocabulary + 1.0)[owner]
        chance = ((pairs[m][chunk.pair_at] - own_pairs * mine) * share + settings.prior * single) / ((words[2 + m][chunk.before_at] - own_contexts * mine) * share + settings.prior)
        if len(starts):
            out[m] = np.add.reduceat(-np.log(chance), starts) / lengths[some]
    return out


def compared(docs: DataFrame, targets: DataFrame, settings: Settings | None = None, *, id_col: str = "doc_id", text_col: str = "text", in_models: Column | None = None) -> DataFrame:
    """docs without their text, with n_words, target_loss, background_loss and loss_difference (per token; NULL for a text without words).

    targets: the ids of target documents, in a column id_col; they count in the background too. Documents that aren't in_models are
    scored only; all others are scored by the models less their own counts. Other copies of a text are documents of their own and stay
    counted. Rows that repeat an id are scored one by one, and are targets if the id is one; a NULL id is never a target. Columns of docs
    with the new names are replaced. Without documents there are no rows; without targets the target model knows no word.
    """
    settings = settings or Settings()
    new = ("n_words", "target_loss", "background_loss", "loss_difference")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = -(-size // settings.chunk) or 1

    def dealt(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    rest = [c for c in docs.columns if c not in (*new, text_col)]
    rows = docs.select(
        *(docs[c].alias(f"c{k}") for k, c in enumerate(rest)), docs[id_col].cast("string").alias("_id"), whole(docs[text_col]).alias("_text"),
        F.coalesce(F.lit(True) if in_models is None else in_models, F.lit(False)).alias("_held"))
    rows = rows.withColumn("_chunk", dealt(F.coalesce("_id", "_text"))).groupBy("_chunk")
    ids = targets.select(targets[id_col].cast("string").alias("_id")).where("_id is not null").withColumn("_chunk", dealt(F.col("_id")))

    def ask(own: pa.Table, good: pa.Table) -> pa.Table:
        n = parts if own.num_rows else 0
        chunk, known = Chunk.of(own["_text"].to_pylist()), set(good["_id"].to_pylist())
        target = np.array([x in known for x in own["_id"].to_pylist()], bool)
        words, pairs = chunk.counts(target, np.array(own["_held"].to_pylist(), bool))
        w, p = _bounds(chunk.words, parts), _bounds(chunk.keys, parts)
        return pa.table({
            "part": pa.array(range(n), _INT), "chunk": pa.array([own["_chunk"][0].as_py()] * n if n else [], _INT),
            "words": pa.array([_steps(chunk.words[w[k] : w[k + 1]]) for k in range(n)], _BYTES), "word_counts": pa.array([_squeezed(words[:, w[k] : w[k + 1]]) for k in range(n)], _BYTES),
            "keys": pa.array([_steps(chunk.keys[p[k] : p[k + 1]]) for k in range(n)], _BYTES), "checks": pa.array([chunk.checks[p[k] : p[k + 1]].tobytes() for k in range(n)], _BYTES),
            "counts": pa.array([_squeezed(pairs[:, p[k] : p[k + 1]]) for k in range(n)], _BYTES),
        })

    def score(own: pa.Table, told: pa.Table) -> pa.Table:
        chunk, known = Chunk.of(own["_text"].to_pylist()), set(told["_id"].to_pylist()) - {None}
        target, held = np.array([x in known for x in own["_id"].to_pylist()], bool), np.array(own["_held"].to_pylist(), bool)
        some = chunk.lengths > 0
        losses = np.full((3, len(some)), np.nan)
        if some.any():
            losses[:2, some] = _losses(chunk, told.filter(told["part"].is_valid()), target, held, settings)
        losses[2] = losses[0] - losses[1]
        columns = {f"c{k}": own[f"c{k}"] for k in range(len(rest))} | {"n_words": pa.array(chunk.lengths, _LONG)}
        return pa.table(columns | {n: pa.array(x, pa.float64(), mask=~some) for n, x in zip(new[1:], losses, strict=True)})

    asked = rows.cogroup(ids.groupBy("_chunk")).applyInArrow(ask, ASKED)
    told = asked.groupBy("part").applyInArrow(_answered, TOLD)
    told = told.unionByName(ids.select(F.col("_chunk").alias("chunk"), "_id"), allowMissingColumns=True).groupBy("chunk")
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"c{k} {kinds[c]}" for k, c in enumerate(rest)), "n_words long", *(f"{n} double" for n in new[1:])])
    return rows.cogroup(told).applyInArrow(score, schema).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(rest)), *new)
