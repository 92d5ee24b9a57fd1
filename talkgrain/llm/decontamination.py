"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed, a run of `least` words, are compared: the longest common runs that do not
overlap are marked, longest first, and the share of the item that the marked tiles cover decides. As tiles may come in any order,
passages whose sentences were moved about are caught too. Items of few words are looked for whole. In scripts without spaces each
sign is a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import picked, whole

OTHER = re.compile(r"[\W_]+")
# Thai, Lao, Khmer, Burmese, kana and ideographs.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """least: words of the shortest tile. coverage: per cent of an item's words that tiles must cover. item_words: an item of fewer
    words leaks only where all its words stand in a row. block_words: benchmark words searched for in one pass, which bounds what is broadcast; a larger
    benchmark takes more blocks. known_words: forms remembered by a task."""

    least: int = 4
    coverage: int = 50
    item_words: int = 8
    block_words: int = 500_000
    known_words: int = 400_000


def forms_of(text: str) -> list[str]:
    """What stands between white space, and each sign of a script without spaces."""
    return (text if text.isascii() else UNSPACED.sub(r" \g<0> ", text)).split()


def words(text: str) -> list[str]:
    """Letters and digits of each form, in lower case."""
    return [x for w in forms_of(text) if (x := OTHER.sub("", w).lower())]


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of `size` ids, from running hashes of the prefixes."""
    out = np.zeros(max(len(ids) - size + 1, 0), np.uint64)
    for k in range(size) if size <= 8 else ():
        out = out * BASE + ids[k : len(ids) - size + 1 + k]
    if size <= 8:
        return out
    half = size // 2
    left, right = window_hashes(ids, half), window_hashes(ids, size - half)
    return left[: len(out)] * _power(size - half) + right[half:]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def tiling(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, length), each the longest common run of words not marked before. Ids of both are from 1;
    0 in the text matches nothing."""
    free_item, free_text = np.ones(len(item), bool), text > 0
    tiles: list[tuple[int, int, int]] = []
    size = max(least, len(item))
    while size >= least:
        runs = _runs(item, text, free_item, free_text, size)
        for length, at, start in sorted(runs, key=lambda x: (-x[0], x[1], x[2])):
            if free_item[at : at + length].all() and free_text[start : start + length].all():
                free_item[at : at + length] = False
                free_text[start : start + length] = False
                tiles.append((at, start, length))
                runs = None
        if runs is None:
            continue  # what was cut off by a tile may still hold a run of this length
        size = size // 2 if size > 2 * least else least if size > least else 0
    return tiles


def _runs(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of free words, of `size` or more: windows of equal hash, checked and extended."""
    own, other = _free_windows(free_item, size), _free_windows(free_text, size)
    if not len(own) or not len(other):
        return []
    item_hashes, text_hashes = window_hashes(item, size)[own], window_hashes(text, size)[other]
    order = np.argsort(item_hashes, kind="stable")
    low = np.searchsorted(item_hashes[order], text_hashes, "left")
    high = np.searchsorted(item_hashes[order], text_hashes, "right")
    runs, ends = [], {}
    for k in np.nonzero(high > low)[0].tolist():
        start = int(other[k])
        for at in own[order[low[k] : high[k]]].tolist():
            if ends.get(start - at, -1) > start:  # inside a run of the same diagonal
                continue
            length = 0
            while at + length < len(item) and start + length < len(text) and item[at + length] == text[start + length] and free_item[at + length] and free_text[start + length]:
                length += 1
            if length >= size:
                runs.append((length, at, start))
                ends[start - at] = start + length
    return runs


def _free_windows(free: np.ndarray, size: int) -> np.ndarray:
    if len(free) < size:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.nonzero(taken[size:] == taken[:-size])[0]


@dataclass
class Block:
    """Items of the benchmark, their words as ids from 1, and their seeds sorted by hash. short: by number of words, the hashes of the
    items that are looked for whole, sorted, and the items."""

    names: list[str]
    items: list[np.ndarray]
    ids: dict[str, int]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple[str, list[str]]], settings: Settings) -> Block:
        least, brief = settings.least, max(settings.item_words, settings.least)
        ids: dict[str, int] = {}
        items = [np.array([ids.setdefault(w, len(ids) + 1) for w in own], np.uint64) for _, own in rows]
        hashes = [window_hashes(x, least) if len(x) >= brief else np.zeros(0, np.uint64) for x in items]
        seeds = np.concatenate(hashes)
        order = np.argsort(seeds, kind="stable")
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        at = np.concatenate([np.arange(len(h)) for h in hashes])
        short = {}
        for n in sorted({len(x) for x in items if len(x) < brief}):
            own = np.array([k for k, x in enumerate(items) if len(x) == n])
            whole_hashes = np.concatenate([window_hashes(items[k], n) for k in own])
            by_hash = np.argsort(whole_hashes, kind="stable")
            short[n] = whole_hashes[by_hash], own[by_hash]
        return Block([n for n, _ in rows], items, ids, seeds[order], item[order], at[order], short)


class Searcher:
    def __init__(self, block: Block, settings: Settings) -> None:
        self.block, self.settings, self.forms = block, settings, {}

    def _id(self, form: str) -> int:
        """Of a piece between white space: 0 is a word that the block lacks, -1 no word at all."""
        if len(self.forms) >= self.settings.known_words:
            self.forms.clear()
        word = OTHER.sub("", form).lower()
        self.forms[form] = out = self.block.ids.get(word, 0) if word else -1
        return out

    def leaks(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(item, its words, words covered, tiles, longest tile) of each item that the text covers enough."""
        forms = self.forms
        ids = np.array([forms[w] if w in forms else self._id(w) for w in forms_of(text)], np.int64)
        ids = ids[ids >= 0].astype(np.uint64)
        return self._short(ids) + self._long(ids)

    def _short(self, ids: np.ndarray) -> list[tuple[str, int, int, int, int]]:
        """Items of few words that stand in the text as a whole."""
        block, out = self.block, []
        for n, (hashes, items) in block.short.items():
            places = _free_windows(ids > 0, n)
            if not len(places):
                continue
            own, first = np.unique(window_hashes(ids, n)[places], return_index=True)
            low, high = np.searchsorted(own, hashes, "left"), np.searchsorted(own, hashes, "right")
            for k in np.nonzero(high > low)[0].tolist():
                at = places[first[low[k]]]
                if np.array_equal(ids[at : at + n], block.items[items[k]]):
                    out.append((block.names[items[k]], n, n, 1, n))
        return out

    def _long(self, ids: np.ndarray) -> list[tuple[str, int, int, int, int]]:
        block, least = self.block, self.settings.least
        places = _free_windows(ids > 0, least)
        if not len(places):
            return []
        hashes = window_hashes(ids, least)[places]
        low, high = np.searchsorted(block.seeds, hashes, "left"), np.searchsorted(block.seeds, hashes, "right")
        hit = np.nonzero(high > low)[0]
        if not len(hit):
            return []
        counts = (high - low)[hit]
        rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[hit], counts)
        found, starts = block.seed_item[rank], np.repeat(places[hit], counts)
        out = []
        for k in np.unique(found).tolist():
            mine, item = found == k, block.items[k]
            seeds = np.unique(block.seed_at[rank[mine]])
            need = -(-self.settings.coverage * len(item) // 100)
            if _covered(seeds, least) < need:  # tiles are made of seeds
                continue
            tiles = tiling(item, _near(ids, np.unique(starts[mine]), least), least)
            covered = sum(length for _, _, length in tiles)
            if covered >= need:
                out.append((block.names[k], len(item), covered, len(tiles), max(length for _, _, length in tiles)))
        return out


def _covered(starts: np.ndarray, size: int) -> int:
    return int(np.minimum(np.diff(starts), size).sum()) + size


def _near(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The words under the windows at `starts`, with a 0 wherever others were left out."""
    places = np.unique((starts[:, None] + np.arange(size)[None, :]).ravel())
    gaps = np.nonzero(np.diff(places) > 1)[0] + 1
    return np.insert(ids[places], gaps, np.uint64(0))


def blocks_of(benchmark: DataFrame, settings: Settings, *, item_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark, a bounded number of words at a time. Items that repeat count once; NULL texts and those without words are left out."""
    rows = picked(benchmark, item=F.coalesce(benchmark[item_col].cast("string"), F.lit("")), text=text_col).where("text is not null").distinct().orderBy("item", "text")
    held: list[tuple[str, list[str]]] = []
    size = 0
    for row in rows.toLocalIterator():
        own = words(row["text"])
        if not own:
            continue
        if held and size + len(own) > settings.block_words:
            yield Block.of(held, settings)
            held, size = [], 0
        held.append((row["item"], own))
        size += len(own)
    if held:
        yield Block.of(held, settings)


LEAKS = "array<struct<item string, words long, covered long, tiles long, longest long>>"


def marked(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", leaks_col: str = "leaks") -> DataFrame:
    """docs with the benchmark items that each whole text leaks; an empty list for NULL and empty texts, or an empty benchmark.

    Rows that repeat are searched one by one, items that repeat are reported once, and a NULL id of an item is reported as empty. Of equally
    long tiles the first in the item, then the first in the text is marked. A column of docs with the new name is replaced.
    """
    settings = settings or Settings()
    context = docs.sparkSession.sparkContext
    found = []
    for block in blocks_of(benchmark, settings, item_col=item_col, text_col=item_text_col):
        held = context.broadcast(block)  # settings.block_words words at most

        def search(batches: Iterator[pd.Series], held=held) -> Iterator[pd.Series]:
            searcher = Searcher(held.value, settings)
            for texts in batches:
                yield pd.Series([[dict(zip(("item", "words", "covered", "tiles", "longest"), x, strict=True)) for x in searcher.leaks(text)] for text in texts])

        # not looked at as deterministic: else a filter on the result would search the text twice
        found.append(F.pandas_udf(search, LEAKS, F.PandasUDFType.SCALAR_ITER).asNondeterministic()(whole(docs[text_col])))
    return docs.withColumn(leaks_col, F.concat(*found) if found else F.array().cast(LEAKS))


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None, **columns: str) -> DataFrame:
    """docs without those that leak an item."""
    return marked(docs, benchmark, settings, leaks_col="_leaks", **columns).where(F.size("_leaks") == 0).drop("_leaks")
