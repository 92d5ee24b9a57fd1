"""Tilings against the plain greedy algorithm, and leaks in documents."""

import random

import numpy as np
import pytest

from talkgrain.llm import decontamination as dc
from tests.llm.frames import edge_docs, no_docs

SETTINGS = dc.Settings()


def plain_tiling(item, text, least):
    """Greedy string tiling by looking at all positions each time."""
    free_item, free_text, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and text[j + k] and item[i + k] == text[j + k] and free_item[i + k] and free_text[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return tiles
        for x in range(k):
            free_item[i + x] = free_text[j + x] = False
        tiles.append((i, j, k))


@pytest.mark.parametrize("seed", range(60))
def test_tiling(seed):
    rng = random.Random(seed)
    item = [rng.randrange(1, rng.choice([4, 30])) for _ in range(rng.randrange(1, 40))]
    text = [rng.randrange(0, 8) for _ in range(rng.randrange(0, 60))]
    for _ in range(3):
        a = rng.randrange(len(item))
        text += item[a : a + rng.randrange(1, 20)] + [0]
    got = dc.tiling(np.array(item, np.uint64), np.array(text, np.uint64), 3)
    want = plain_tiling(item, text, 3)
    assert all(item[a : a + n] == text[b : b + n] for a, b, n in got)
    assert sorted(n for *_, n in got) == sorted(n for *_, n in want)


def test_hashes_of_windows():
    ids = np.arange(1, 50, dtype=np.uint64)
    for size in (1, 3, 8, 9, 20, 33):
        joined = np.concatenate([ids, ids])
        hashes = dc.window_hashes(joined, size)
        assert len(hashes) == len(joined) - size + 1 and hashes[0] == hashes[49] and len(set(hashes[: 49 - size].tolist())) == 49 - size


ITEM = "The quick brown fox jumps over a lazy dog. Meanwhile seven wise owls watch the silver moon rise, and nobody in the old village hears them at all."


def leaks(spark, texts, benchmark=((7, ITEM),), settings=SETTINGS):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(benchmark), "item_id long, text string")
    rows = dc.marked(docs, items, settings).collect()
    return {r["doc_id"]: [(x["item"], x["covered"], x["words"]) for x in r["leaks"]] for r in rows}


def test_reordered_and_edited_passages(spark):
    one, two = ITEM.split(". ")
    found = leaks(spark, [
        f"before {ITEM} after", f"{two} And now something else entirely. {one.upper()}!!", f"noise {one} noise", ITEM.replace("wise", "big").replace("lazy", "sleepy"), "The quick brown fox only", None, "", ITEM[:20] * 500])
    assert found[0] == [("7", 28, 28)] and found[1] == [("7", 28, 28)]
    assert found[2] == [] and len(found[3]) == 1 and found[4] == found[5] == found[6] == found[7] == []


def test_short_items_are_found_whole(spark):
    """On both sides of item_words: up to it as one run, from it on by tiles; signs of scripts without spaces are words."""
    seven, eight = "alpha beta gamma delta omega sigma kappa", "alpha beta gamma delta omega sigma kappa theta"
    items = [(1, seven), (2, eight), (3, "Lisbon"), (4, "two, words"), (5, "量子計算機は暗号を破る"), (6, "...")]
    found = leaks(spark, [
        f"so {seven.upper()}! end", "alpha beta gamma delta omega", "x alpha beta gamma delta y sigma kappa", "in Lisbon, two words", "two other words", "彼は言った量子計算機は暗号を破ると", "量子 暗号", "Lisbon " * 3000 + "Two words"], items)
    names = {k: sorted(x[0] for x in v) for k, v in found.items()}
    assert names == {0: ["1", "2"], 1: ["2"], 2: ["2"], 3: ["3", "4"], 4: [], 5: ["5"], 6: [], 7: ["3", "4"]}
    assert found[0] == [("1", 7, 7), ("2", 7, 8)]


def test_short_items_against_plain_search():
    rng = random.Random(8)
    items = [(str(k), [rng.choice("abcd") for _ in range(rng.randrange(1, 8))]) for k in range(60)]
    searcher = dc.Searcher(dc.Block.of(items, SETTINGS), SETTINGS)
    for _ in range(40):
        text = " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 30)))
        assert sorted(x[0] for x in searcher.leaks(text)) == sorted(n for n, own in items if f" {' '.join(own)} " in f" {text} ")


def test_blocks_agree(spark):
    rng = random.Random(5)
    items = [(k, " ".join(rng.choice("abcdefghij") * 3 for _ in range(20))) for k in range(12)] + [(None, ITEM), (50, None), (51, ""), (52, "too short"), (3, ITEM)]
    texts = [f"x {items[k][1]} y {items[(k + 1) % 12][1]}" for k in range(12)] + [ITEM]
    whole, blocks = leaks(spark, texts, items), leaks(spark, texts, items, dc.Settings(block_words=30))
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in blocks.items()}
    assert all(len(whole[k]) >= 2 for k in range(12)) and sorted(x[0] for x in whole[12]) == ["", "3"]


def test_frames(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = edge_docs(spark)
    assert dc.without_leaks(docs, items).count() == docs.count()
    assert dc.without_leaks(docs, items.where("false")).count() == docs.count()
    assert dc.marked(no_docs(spark), items).count() == 0
