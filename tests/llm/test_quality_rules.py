"""Quality rules against loops over plain strings."""

import re

import pytest

from talkgrain.llm import quality_rules, queries
from tests.llm.frames import edge_docs, no_docs
from tests.oracle import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_measures(spark):
    rows = quality_rules.judged(edge_docs(spark)).collect()
    for row in rows:
        got = (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"])
        assert got == plain(row["text"])
        assert not (row["kept"] and row["base_failed"])


def test_empty(spark):
    assert quality_rules.judged(no_docs(spark)).count() == 0


@pytest.mark.parametrize("line, fails", [
    ("A short heading", False), ("This work is licensed under the GNU General Public License, version 3.", True), ("Home | News | Sport | Weather", True),
    ("WE SELL CHEAP PILLS!!", True), ("word### other$$$ more%%% signs&&&", True), ("la la la la la la la la la", True),
    ("one two three four five six seven eight nine ten eleven twelve thirteen", True), ("A first sentence. And then one without an end that is as long as this", False),
])
def test_lines(spark, line, fails):
    good = " ".join(f"Sentence {chr(97 + k)} stands here for its own sake." for k in range(20))
    row = quality_rules.judged(spark.createDataFrame([(1, f"{good}\n{line}")], "doc_id long, text string"), clean_col="clean").first()
    assert (line not in row["clean"]) == fails
    assert row["kept"]


def test_loses_too_much(spark):
    menu = "\n".join(f"item{k} | other{k} | third{k} | fourth{k}" for k in range(30))
    assert not quality_rules.judged(spark.createDataFrame([(1, menu)], "doc_id long, text string")).first()["kept"]


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, queries.op1_quality_rules, queries.ORACLES["op1_quality_rules"]) == ""
