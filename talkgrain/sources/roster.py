"""The agent roster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import schemas
from talkgrain.functions import text

FIELDS = ("extension", "name", "did", "account_id", "tl", "state")


def read_roster_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of one roster document, an object with ``agents`` or a bare list, in file order."""
    raw = spark.read.text(path, wholetext=True)
    boxed = F.when(F.trim("value").startswith("["), F.concat(F.lit('{"agents":'), "value", F.lit("}"))).otherwise(F.col("value"))
    parsed = raw.select(F.from_json(boxed, schemas.ROSTER_FILE).alias("d"))
    return (parsed.select(F.posexplode("d.agents").alias("pos", "e"))
            .select(F.col("pos").cast("bigint").alias("pos"), "e.extension", "e.name", "e.did",
                    F.col("e.accountId").alias("account_id"), "e.tl", "e.state"))


def roster_entries(entries: DataFrame) -> DataFrame:
    """Fields trimmed, entries without an extension dropped; repeated extensions stay."""
    clean = {c: F.coalesce(text.strip(F.col(c)), F.lit("")) for c in FIELDS}
    return entries.withColumns(clean).where(F.col("extension") != "")


def resolve_roster(entries: DataFrame) -> DataFrame:
    """One row per extension; the entry furthest down the file wins."""
    others = [c for c in entries.columns if c != "extension"]
    best = F.max_by(F.struct(*others), F.col("pos")).alias("e")
    return (roster_entries(entries).groupBy("extension").agg(best)
            .select("extension", *[F.col(f"e.{c}").alias(c) for c in others])
            .withColumns({"audited": F.col("tl") != "", "did_key": text.did_key("did")}))


def published_roster(roster: DataFrame) -> DataFrame:
    """The roster as readers of the published copy see it, in extension order."""
    return roster.select(
        "extension", "name", F.col("did_key").alias("did"), "account_id", F.col("state").alias("team"),
        F.col("tl").alias("team_leader_name"), "audited").orderBy("extension")


def write_roster(roster: DataFrame, path: str) -> None:
    published_roster(roster).write.mode("overwrite").json(path)
