"""Joins between calls and the roster.

The roster side is never broadcast by hand: adaptive execution measures it and broadcasts it when
it is small, and splits hot extensions when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import text
from talkgrain.sources.roster import FIELDS, roster_entries


def _agent_struct():
    return F.struct(*[F.col(c) for c in FIELDS])


def account_index(entries: DataFrame) -> DataFrame:
    """Account id → agent; the entry furthest down the file wins."""
    return (roster_entries(entries).where(F.col("account_id") != "")
            .groupBy("account_id").agg(F.max_by(_agent_struct(), F.col("pos")).alias("agent")))


def did_index(entries: DataFrame) -> DataFrame:
    """Direct-dial number → agent, for numbers that just one entry has."""
    keyed = roster_entries(entries).withColumn("did_key", text.did_key("did")).where(F.col("did_key") != "")
    return (keyed.groupBy("did_key").agg(F.count("*").alias("owners"), F.max_by(_agent_struct(), F.col("pos")).alias("agent"))
            .where(F.col("owners") == 1).drop("owners"))


def roster_keys(roster: DataFrame, entries: DataFrame) -> DataFrame:
    """Every extension and account id that counts as being on the roster."""
    accounts = roster_entries(entries).where(F.col("account_id") != "").select(F.col("account_id").alias("key"))
    return roster.select(F.col("extension").alias("key")).union(accounts).distinct()


def on_roster(calls: DataFrame, keys: DataFrame, extension: str = "agent_extension") -> DataFrame:
    """Only the calls of rostered extensions; a shared direct-dial number does not make a call ours."""
    wanted = keys.select(F.col("key").alias("_key"))
    return calls.join(wanted, text.strip(F.col(extension)) == F.col("_key"), "left_semi")


def resolve_agents(calls: DataFrame, roster: DataFrame, entries: DataFrame, extension: str = "agent_extension",
                   did: str = "agent_did") -> DataFrame:
    """Extension, then account id, then direct-dial number, then a placeholder with ``known`` false."""
    by_ext = roster.select(F.col("extension").alias("_x"), _agent_struct().alias("_by_ext"))
    by_acc = account_index(entries).select(F.col("account_id").alias("_a"), F.col("agent").alias("_by_acc"))
    by_did = did_index(entries).select(F.col("did_key").alias("_d"), F.col("agent").alias("_by_did"))
    wanted = calls.withColumn("_ext", text.strip(F.coalesce(F.col(extension), F.lit(""))))
    wanted = wanted.withColumn("_did", text.did_key(did))
    joined = (wanted.join(by_ext, F.col("_ext") == F.col("_x"), "left")
              .join(by_acc, F.col("_ext") == F.col("_a"), "left")
              .join(by_did, F.col("_did") == F.col("_d"), "left"))
    kind = (F.when(F.col("_by_ext").isNotNull(), "extension").when(F.col("_by_acc").isNotNull(), "account")
            .when(F.col("_by_did").isNotNull(), "did").otherwise("none"))
    label = (F.when(F.col("_ext") != "", F.col("_ext"))
             .when(F.coalesce(F.col(did), F.lit("")) != "", F.concat(F.lit("DID "), did)).otherwise("?"))
    agent = F.coalesce("_by_ext", "_by_acc", "_by_did")
    return (joined.withColumn("match_kind", kind).withColumn("_agent", agent).withColumns({
        "known": F.col("match_kind") != "none",
        "roster_extension": F.coalesce("_agent.extension", "_ext"),
        "roster_name": F.coalesce("_agent.name", F.concat(F.lit("Unmapped extension "), label)),
        "roster_tl": F.coalesce("_agent.tl", F.lit("")),
        "roster_team": F.coalesce("_agent.state", F.lit(""))})
        .drop("_ext", "_did", "_x", "_a", "_d", "_by_ext", "_by_acc", "_by_did", "_agent"))


def unmapped_extensions(resolved: DataFrame, extension: str = "agent_extension") -> DataFrame:
    """Extensions that no roster entry explains."""
    shown = F.coalesce(text.blank_to_null(F.col(extension)), F.lit("?"))
    return resolved.where(~F.col("known")).select(shown.alias("extension")).distinct()


def rollup_keys(roster: DataFrame) -> DataFrame:
    """Extension → team and agent key; a name shared on a team gets the extension appended.

    Decided from the whole roster, so that a key does not change from day to day.  Slugs are made
    once per distinct name.
    """
    names = roster.select("name").distinct().withColumn("name_slug", text.slug("name"))
    team = F.coalesce(text.blank_to_null("state"), F.lit(K.UNASSIGNED_TEAM))
    keyed = roster.select("extension", "name", team.alias("team")).join(names, "name")
    shared = (keyed.groupBy("team", "name_slug").agg(F.count("*").alias("owners"))
              .where(F.col("owners") > 1).select("team", "name_slug", F.lit(True).alias("is_shared")))
    return (keyed.join(shared, ["team", "name_slug"], "left")
            .select("extension", "team", F.when(F.col("is_shared"), F.concat_ws("-", "name_slug", "extension"))
                    .otherwise(F.col("name_slug")).alias("agent_key")))


def with_rollup_key(calls: DataFrame, keys: DataFrame) -> DataFrame:
    """Team and agent key of each call; an extension off the roster is UNASSIGNED under its name.

    Names are made keys once each, then joined back: the fold of accents never runs per call.
    """
    name = F.coalesce("agent_name", F.lit(""))
    named = calls.select(name.alias("_name")).distinct().withColumn("_slug", text.slug("_name"))
    wanted = calls.withColumns({"_ext": text.strip(F.coalesce("agent_extension", F.lit(""))), "_name": name})
    joined = wanted.join(keys.withColumnRenamed("extension", "_x"), F.col("_ext") == F.col("_x"), "left").join(named, "_name", "left")
    return joined.withColumns({
        "agent_key": F.coalesce("agent_key", "_slug"),
        "team": F.coalesce("team", F.lit(K.UNASSIGNED_TEAM))}).drop("_ext", "_x", "_name", "_slug")


def audited_agents(roster: DataFrame) -> DataFrame:
    return roster.where(F.col("tl") != "").orderBy("extension")


def teams(roster: DataFrame) -> DataFrame:
    """Leader and agent pairs of the audited floor, in order; nest them only where needed."""
    return roster.where(F.col("tl") != "").select("tl", "extension", "name").orderBy("tl", "extension")
