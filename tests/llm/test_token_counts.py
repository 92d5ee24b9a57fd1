"""Edited counts against counting the edited text anew."""

import random

import pytest

from talkgrain.llm import token_counts as tc
from talkgrain.llm.token_counts import Settings
from tests.llm.frames import edge_docs, no_docs, texts

PIECES = [" ", "\n", "  ", "a", "'s", "Zürich", "42", "!", " the", "\t", "日本", "", "don't", "\r\n\r\n", "..."]


@pytest.fixture(scope="module")
def encoder():
    with open(Settings().vocabulary, "rb") as file:
        return tc.Encoder(file.read())


@pytest.mark.parametrize("seed", range(60))
def test_recount_is_exact(encoder, seed):
    rng = random.Random(seed)
    leaf = rng.choice([1, 4, 16, 64])
    text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 200)))
    ends = tc.cut(text, leaf)
    tree = tc.summed(encoder.counts([text[a:b] for a, b in zip([0, *ends], ends)]))
    for _ in range(4):  # edits on edits
        edits = []
        for _ in range(rng.randrange(0, 5)):
            start = rng.randrange(0, len(text) + 1)
            edits.append((start, min(len(text), start + rng.choice([0, 0, 1, 2, 9, 50])), "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 6)))))
        want, shift = text, 0
        for a, b, t in tc.settled(edits, len(text)):
            want = want[: a + shift] + t + want[b + shift :]
            shift += len(t) - (b - a)
        text, ends, tree, _ = tc.recounted(text, ends, tree, edits, encoder, leaf)
        assert text == want
        assert tree[1] == encoder.counts([text])[0] if text else tree[1] == 0
        assert not ends or ends[-1] == len(text)
        width = len(tree) // 2
        assert tree[width : width + len(ends)] == encoder.counts([text[a:b] for a, b in zip([0, *ends], ends)])


def test_only_touched_leaves_are_encoded(encoder):
    text = "some plain words in a row " * 2000
    ends = tc.cut(text, 512)
    tree = tc.summed(encoder.counts([text[a:b] for a, b in zip([0, *ends], ends)]))
    _, _, _, encoded = tc.recounted(text, ends, tree, [(20_000, 20_005, "other")], encoder, 512)
    assert encoded < 2 * 600


def test_overlaps_and_repeats():
    assert tc.settled([(5, 9, "b"), (5, 9, "b"), (0, 6, "a"), (20, 30, "z"), (3, 1, "bad")], 12) == [(0, 6, "a"), (12, 12, "z")]


def test_frames(spark, encoder):
    edits = tc.personal_edits(tc.with_trees(edge_docs(spark)))
    before = {(r["doc_id"], r["text"]): r["n_tokens"] for r in edits.collect()}
    for (_, text), n in before.items():
        assert n == encoder.counts([text or ""])[0] if text else n == 0
    rows = tc.with_edits(edits).collect()
    assert len(rows) == edge_docs(spark).count()
    for row in rows:
        assert row["n_tokens"] == (encoder.counts([row["text"]])[0] if row["text"] else 0)
    assert tc.with_edits(tc.personal_edits(tc.with_trees(no_docs(spark)))).count() == 0
    through = tc.counted_through(edge_docs(spark), tc.personal).collect()
    assert sorted((r["n_tokens"], r["n_edits"], r["n_encoded"]) for r in through) == sorted((r["n_tokens"], r["n_edits"], r["n_encoded"]) for r in rows)
    assert tc.counted_through(no_docs(spark), tc.personal).count() == 0
    assert len(texts()) > 10


@pytest.mark.parametrize("seed", range(8))
def test_long_runs_of_white_space_count_as_the_pattern_has_them(encoder, seed):
    """Short enough for the pattern's own matcher, long enough to be counted apart."""
    rng = random.Random(seed)
    for _ in range(6):
        text = "".join(rng.choice(["a", " b", "9", "!", "", "\x1c"]) + "".join(rng.choice(sign) for _ in range(rng.choice([1, 999, 1000, 1001, 3000]))) for sign in rng.choices([" ", "\n", " \n", "\u00a0\u3000", "\r\n\t"], k=4)) + rng.choice(["", "end", "9", "!"])
        assert encoder.count(text) == len(encoder.encoding.encode_ordinary(text))


@pytest.mark.parametrize("text, n", [
    (" " * 5_000_000, 5_000_000), ("\n" * 5_000_000, 2_500_000), ("a" + " " * 5_000_000 + "b", 5_000_001), ("a" * 5_000_000, 1_250_000), ("!?" * 2_500_000, 2_500_001), ("", 0)], ids=["blanks", "breaks", "between", "letters", "signs", "empty"])
def test_texts_of_millions(encoder, text, n):
    assert encoder.count(text) == n


def test_a_text_of_blanks_ends_no_job(spark):
    docs = spark.createDataFrame([(1, " " * 1_500_000), (2, "a" + "\n" * 1_200_000 + "b c@d.ef"), (3, "plain")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in tc.counted_through(docs, tc.personal).collect()}
    assert rows[1]["n_tokens"] == 1_500_000 and rows[2]["n_edits"] == 1 and rows[3]["n_tokens"] == 1
