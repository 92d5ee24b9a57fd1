"""WARC archives and their Merkle fixity audit.

Records are hashed in the order of their offsets; fixed ranges of offsets are hashed over the records that start in them, and so on
up to one root for each volume. Two replicas are compared from the roots down, and only branches that differ are entered, until the
records that differ are found.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkgrain.llm.shared import forget_at_exit, picked, shared_folder, stored, whole

END = "\r\n\r\n"
HEAD = re.compile(rb"WARC/1\.\d\r\n")
LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)\s*$")
NAME = re.compile(rb"(?im)^warc-record-id:\s*<([^>\r\n]*)>")


@dataclass(frozen=True)
class Settings:
    """range_bytes: of an offset range, the lowest level above records. fanout: ranges under a node. date: of the records."""

    range_bytes: int = 1 << 16
    fanout: int = 16
    date: str = "2026-01-01T00:00:00Z"


def record(name: Column, url: Column, payload: Column, settings: Settings) -> Column:
    """A resource record without the blank lines at its end. Line breaks in name and URL are escaped."""
    plain = lambda x: F.replace(F.replace(whole(x), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    body = whole(payload)
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Record-ID: <"), F.replace(plain(name), F.lit(">"), F.lit("%3E")), F.lit(">")),
        F.lit(f"WARC-Date: {settings.date}"), F.concat(F.lit("WARC-Target-URI: "), plain(url)), F.concat(F.lit("WARC-Block-Digest: sha256:"), F.sha2(body, 256)),
        F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    return F.concat(head, F.lit(END), body)


def records(pages: DataFrame, settings: Settings, *, id_col: str, url_col: str, html_col: str, volume: Column) -> DataFrame:
    """(volume, id, record): volume is an integer, NULL counting as -1; the order in a volume is by id and a digest of the record."""
    return picked(
        pages, volume=F.coalesce(volume.cast("long"), F.lit(-1)), id=id_col,
        record=record(F.concat(F.lit("urn:page:"), F.coalesce(pages[id_col].cast("string"), F.lit("none"))), pages[url_col], pages[html_col], settings))


def write_archive(rows: DataFrame, path: str | None = None) -> str:
    """Writes (volume, id, record) as a gzipped WARC file for each volume and returns the folder: `path`, or one in the shared folder
    that is removed when the application ends."""
    spark = rows.sparkSession
    if path is None:
        path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
        forget_at_exit(spark, path)
    dealt = rows.repartition("volume").sortWithinPartitions("volume", "id", F.md5("record")).select("volume", F.col("record").alias("value"))
    dealt.write.partitionBy("volume").option("lineSep", END).option("compression", "gzip").text(path)
    return path


def parsed(content: bytes) -> Iterator[tuple[int, int, str | None, str]]:
    """(offset, length, record id, sha256) of each record, by its declared length; where a header is unreadable or a length doesn't end
    at a record, up to the next header."""
    at, close = 0, END.encode()
    while at < len(content):
        split = content.find(close, at)
        declared = LENGTH.search(content, at, split) if split >= 0 and HEAD.match(content, at) else None
        stop = split + len(close) + int(declared[1]) if declared else -1
        if not declared or content[stop : stop + len(close)] != close:
            again = HEAD.search(content, at + 1)
            while again and content[again.start() - len(close) : again.start()] != close:
                again = HEAD.search(content, again.end())
            stop = (again.start() if again else len(content)) - len(close)
        name = NAME.search(content, at, split if split >= 0 else len(content))
        yield at, stop - at, name[1].decode("utf-8", "replace") if name else None, hashlib.sha256(content[at:stop]).hexdigest()
        at = stop + len(close)


RECORDS = "volume long, offset long, length long, name string, digest string"


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive's volumes, one file after another. A volume that can't be decompressed to its end is read as far as
    it goes."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for where, content in zip(files["path"], files["content"], strict=True):
                inflate, plain = zlib.decompressobj(31), b""
                try:
                    plain = inflate.decompress(content)
                except zlib.error:
                    inflate, step = zlib.decompressobj(31), 512
                    parts = []
                    try:
                        for k in range(0, len(content), step):
                            parts.append(inflate.decompress(content[k : k + step]))
                    except zlib.error:
                        pass
                    plain = b"".join(parts)
                volume = int(re.search(r"volume=(-?\d+)", where)[1])
                yield pd.DataFrame([(volume, *x) for x in parsed(plain)], columns=["volume", "offset", "length", "name", "digest"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInPandas(read, RECORDS)


def manifest(rows: DataFrame) -> DataFrame:
    """What read_archive ought to give for (volume, id, record), from the rows themselves."""
    own = rows.select(
        "volume", "id", F.octet_length("record").cast("long").alias("length"), F.regexp_extract("record", "WARC-Record-ID: <([^>]*)>", 1).alias("name"),
        F.sha2("record", 256).alias("digest"), F.md5("record").alias("print"))
    before = Window.partitionBy("volume").orderBy("id", "print").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("length") + len(END)).over(before), F.lit(0)).cast("long")
    return own.select("volume", offset.alias("offset"), "length", "name", "digest")


def tree(records: DataFrame, settings: Settings, levels: int) -> list[DataFrame]:
    """Levels of (volume, node, digest): ranges of offsets, then groups of `fanout` of the level below, up to the roots."""
    hashed = lambda rows: F.sha2(F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: F.concat_ws(":", x["at"].cast("string"), x["digest"]))), 256)
    rows = records.select("volume", F.col("offset").alias("at"), F.floor(F.col("offset") / settings.range_bytes).alias("node"), "digest")
    out = []
    for level in range(levels):
        made = rows.groupBy("volume", "node").agg(hashed(rows).alias("digest"))
        out.append(made)
        rows = made.select("volume", F.col("node").alias("at"), F.floor(F.col("node") / settings.fanout).alias("node"), "digest")
    return out


def levels_for(last_offset: int, settings: Settings) -> int:
    levels, nodes = 1, last_offset // settings.range_bytes + 1
    while nodes > 1:
        levels, nodes = levels + 1, -(-nodes // settings.fanout)
    return levels


def audit(one: DataFrame, two: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Records in which two replicas (volume, offset, length, name, digest) differ: volume, name, status, offset_one, offset_two,
    digest_one, digest_two.

    status: changed (other bytes under the same name), moved (the same bytes at another offset), missing (in one only), extra (in two
    only). Records of one name in a volume are told apart by their order. Equal replicas and empty ones give no rows.
    """
    settings = settings or Settings()
    ends = one.agg(F.max("offset")).unionByName(two.agg(F.max("offset"))).agg(F.max("max(offset)")).first()[0]
    levels = levels_for(ends or 0, settings)
    trees = tree(one, settings, levels), tree(two, settings, levels)
    branches = None
    for level in reversed(range(levels)):
        left, right = (t[level].select("volume", "node", F.col("digest").alias(side)) for t, side in zip(trees, ("left", "right"), strict=True))
        if branches is not None:
            under = lambda rows: rows.withColumn("parent", F.floor(F.col("node") / settings.fanout)).join(branches, ["volume", "parent"], "left_semi").drop("parent")  # noqa: E731, B023
            left, right = under(left), under(right)
        differing = left.join(right, ["volume", "node"], "full").where(~F.col("left").eqNullSafe(F.col("right")))
        branches = stored(differing.select("volume", F.col("node").alias("parent")), "branches")

    def entered(rows: DataFrame, side: str) -> DataFrame:
        own = rows.withColumn("parent", F.floor(F.col("offset") / settings.range_bytes)).join(branches, ["volume", "parent"], "left_semi")
        nth = F.row_number().over(Window.partitionBy("volume", "name").orderBy("offset"))
        return own.select(*(x.alias(f"{n}_{side}") for n, x in (("volume", F.col("volume")), ("name", F.col("name")), ("nth", nth), ("offset", F.col("offset")), ("digest", F.col("digest")))))

    same = (F.col("volume_one") == F.col("volume_two")) & F.col("name_one").eqNullSafe(F.col("name_two")) & (F.col("nth_one") == F.col("nth_two"))
    met = entered(one, "one").join(entered(two, "two"), same, "full").select(
        F.coalesce("volume_one", "volume_two").alias("volume"), F.coalesce("name_one", "name_two").alias("name"),
        F.when(F.col("offset_two").isNull(), "missing").when(F.col("offset_one").isNull(), "extra").when(F.col("digest_one") != F.col("digest_two"), "changed")
        .when(F.col("offset_one") != F.col("offset_two"), "moved").alias("status"), "offset_one", "offset_two", "digest_one", "digest_two")
    return met.where("status is not null")
