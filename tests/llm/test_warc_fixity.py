"""Archives written, damaged, read and audited."""

import hashlib

from pyspark.sql import functions as F

from talkgrain.llm import queries
from talkgrain.llm import warc_fixity as wf
from tests.oracle import compare, connect

SMALL = wf.Settings(range_bytes=512, fanout=2)


def pages(spark, n=60):
    rows = [(k, f"https://h.example/{k}", f"<p>päge {k}</p>" + "x" * (37 * k % 400)) for k in range(n)]
    rows += [(None, None, None), (3, "https://h.example/3", "again"), (3, "https://h.example/3", "again"), (4, "a\r\nb", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def records(frame):
    return wf.records(frame, SMALL, id_col="page_id", url_col="url", html_col="html", volume=F.floor(F.col("page_id") / 20))


def test_round_trip(spark):
    rows = records(pages(spark))
    read = wf.read_archive(spark, wf.write_archive(rows))
    want = sorted(hashlib.sha256(r["record"].encode()).hexdigest() for r in rows.collect())
    assert sorted(r["digest"] for r in read.collect()) == want
    assert {tuple(r) for r in read.collect()} == {tuple(r) for r in wf.manifest(rows).collect()}
    assert wf.audit(wf.manifest(rows), read, SMALL).count() == 0


def test_damage_is_located(spark):
    rows = records(pages(spark)).where("id is null or id <> 4")
    bad = rows.where("id is null or id <> 30").withColumn("record", F.when(F.col("id") == 11, F.regexp_replace("record", "p>", "P>")).otherwise(F.col("record")))
    bad = bad.unionByName(spark.createDataFrame([(1, 1000, "WARC/1.1\r\nWARC-Record-ID: <urn:page:1000>\r\nContent-Length: 2\r\n\r\nhi")], "volume long, id long, record string"))
    found = {(r["name"], r["status"]) for r in wf.audit(wf.manifest(rows), wf.read_archive(spark, wf.write_archive(bad)), SMALL).collect()}
    assert {x for x in found if x[1] != "moved"} == {("urn:page:11", "changed"), ("urn:page:30", "missing"), ("urn:page:1000", "extra")}
    assert {x[0] for x in found if x[1] == "moved"} == {f"urn:page:{k}" for k in range(31, 40)}


def test_empty_archive(spark):
    none = records(pages(spark)).where("false")
    assert wf.audit(wf.manifest(none), wf.manifest(none), SMALL).count() == 0
    assert wf.audit(wf.manifest(records(pages(spark, 2))), wf.manifest(none), SMALL).where("status <> 'missing'").count() == 0


def test_unreadable_header():
    good = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    broken = good.replace(b"WARC/1.1", b"XARC/1.1")
    names = [x[2] for x in wf.parsed(good + broken + good.replace(b"<a>", b"<c>"))]
    assert names == ["a", "a", "c"]
    assert [x[0] for x in wf.parsed(good + broken + good)] == [0, len(good), 2 * len(good)]
    assert list(wf.parsed(b"")) == []


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, queries.op4_warc_fixity, queries.ORACLES["op4_warc_fixity"]) == ""
