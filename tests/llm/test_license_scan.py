"""Licence scan against rules run one by one in Python, and hits settled by looking at all of them."""

import re

import pytest
from pyspark.sql import functions as F

from talkgrain.llm import license_scan, queries
from talkgrain.llm.license_rules import BASE, RULES, Rule
from tests.llm.frames import edge_docs, no_docs
from tests.oracle import compare, connect

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places(found, rules):
    stream = " " + "  ".join(found) + " "
    out = []
    for k, rule in enumerate(rules):
        if rule.keyword in found:
            for m in re.finditer(license_scan.compiled(rule.pattern), stream):
                start = len(stream[: m.start()].split())
                out.append((start, start + len(m.group().split()), rule.level, k, rule.label))
    return sorted(out, key=lambda h: (h[0], -h[1], h[2], h[3]))


def settled(hits):
    out = []
    for h in hits:
        p = out[-1] if out else None
        if p is None or h[0] >= p[1] or (h[2] == p[2] and h[1] > p[1]):
            out.append(h)
        elif h[2] < p[2]:
            out[-1] = h
    return out


def phrases(found):
    out = []
    for rule in BASE:
        phrase = rule.pattern.split()
        out += [(k, rule.label) for k in range(len(found)) if found[k : k + len(phrase)] == phrase]
    return sorted(out)


def scan(spark, texts, **more):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.scanned(docs, **more).collect()}


def agrees(row, text):
    found = words(text)
    assert row["n_words"] == len(found)
    assert sorted((h["start"], h["label"]) for h in row["base"]) == phrases(found)
    assert [tuple(h) for h in row["detections"]] == settled(places(found, RULES))


def test_every_rule_has_its_keyword():
    assert len(RULES) > 300 and len({(r.label, r.pattern) for r in RULES}) == len(RULES)
    for rule in RULES + BASE:
        for word in re.findall(r"\(([^()]*)\)\?", rule.pattern):
            assert rule.keyword not in word.split(), rule  # the keyword is in no optional part
        assert rule.keyword in re.split(r"[ ()?|]+", rule.pattern), rule


CASES = {
    "Licensed under CC BY-NC 4.0.": ["cc-by-nc-4.0"],
    "This work is licensed under the GNU General Public License, version 3.": ["gpl-3.0"],
    "Released under the MIT License.": ["mit"],
    "Licensed under the Apache License, Version 2.0.": ["apache-2.0"],
    "GNU Lesser General Public\n * License v2.1 or later": ["lgpl-2.1"],
    "SPDX-License-Identifier: GPL-2.0-or-later": ["gpl-2.0"],
    "gplv3 and LGPLv2.1 and AGPL": ["gpl-3.0", "lgpl-2.1", "agpl"],
    "BSD 3-Clause, all rights reserved": ["bsd-3-clause", "all-rights-reserved"],
    "Creative Commons Attribution-ShareAlike 4.0 International": ["cc-by-sa-4.0"],
    "https://www.apache.org/licenses/LICENSE-2.0": ["apache-2.0"],
    "RÉSERVÉS; tous droits réservés": ["all-rights-reserved"],
    "er kam mit einem Beer und der Apache": [],
    "": [],
}


@pytest.fixture(scope="module")
def cases(spark):
    return scan(spark, list(CASES))


@pytest.mark.parametrize("k", range(len(CASES)))
def test_cases(cases, k):
    text = list(CASES)[k]
    assert [h["label"] for h in cases[k]["detections"]] == CASES[text]
    agrees(cases[k], text)


def test_suppression(spark):
    rules = [Rule("low", 3, "a", "a b c d"), Rule("high", 1, "c", "c d e"), Rule("in", 3, "b", "b c"), Rule("same", 3, "d", "d e f"), Rule("twin", 3, "a", "a b c d"), Rule("end", 3, "g", "g")]
    row = scan(spark, ["a b c d e f g", "a b c d", "d e f", "b c d e"], rules=rules)
    labels = {k: [h["label"] for h in r["detections"]] for k, r in row.items()}
    assert labels == {0: ["high", "end"], 1: ["low"], 2: ["same"], 3: ["high"]}


def test_long_texts_and_many_hits(spark):
    texts = ["MIT License, CC BY 4.0; " * 3000, "x" * 1_000_000, "word " * 300_000 + "apache license", "license mit " * 700, " \n" * 500_000, None]
    for k, row in scan(spark, texts).items():
        agrees(row, texts[k])


def test_edge_cases(spark):
    docs = edge_docs(spark)
    rows = license_scan.scanned(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        agrees(row, row["text"])
    clash = docs.select("doc_id", "text", F.lit(1).alias("base"), F.lit("x").alias("detections"), F.lit(2).alias("_found"), F.lit(3).alias("n_words"))
    assert license_scan.scanned(clash).count() == len(rows)
    assert license_scan.scanned(no_docs(spark)).count() == 0


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert not compare(spark, connect(folder), folder, queries.op11_license_scan, queries.ORACLES["op11_license_scan"])


def test_sql_on_the_cases(spark, tmp_path):
    texts = [*CASES, *[" and ".join(list(CASES)[k:]) for k in range(6)], "MIT License CC BY " * 20, None]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert not compare(spark, con, str(tmp_path), queries.op11_license_scan, queries.ORACLES["op11_license_scan"])


def test_no_python_in_the_plan(spark):
    plan = queries.op11_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)
