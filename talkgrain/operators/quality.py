"""Constraints as rules, and one pass that returns the violations."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions.text import either


class Rule(NamedTuple):
    name: str
    field: str
    broken: Column


def enum_rule(field: str, kind: str, column: str | None = None) -> Rule:
    value = F.col(column or field)
    return Rule("enum", field, value.isNotNull() & ~value.isin(list(K.ENUMS[kind])))


def range_rule(field: str, bounds: tuple | None = None, column: str | None = None) -> Rule:
    low, high = bounds or K.NUMBER_BOUNDS[field]
    value = F.col(column or field)
    tests = [value < low] if low is not None else []
    tests += [value > high] if high is not None else []
    return Rule("range", field, value.isNotNull() & either(*tests))


def size_rule(field: str, bounds: tuple[int, int] | None = None, column: str | None = None) -> Rule:
    low, high = bounds or K.LIST_BOUNDS[field]
    return Rule("size", field, ~F.coalesce(F.size(column or field), F.lit(0)).between(low, high))


def length_rule(field: str, cap: int | None = None, column: str | None = None) -> Rule:
    return Rule("length", field, F.coalesce(F.length(column or field) > (cap or K.TEXT_CAPS[field]), F.lit(False)))


def item_length_rule(field: str, cap: int | None = None, column: str | None = None) -> Rule:
    most = cap or K.TEXT_CAPS[field]
    return Rule("item_length", field, F.coalesce(F.exists(column or field, lambda v: F.length(v) > most), F.lit(False)))


def anchor_rule(kind: str = "objection_type", turn: str = "turn_index") -> Rule:
    """Only the placeholder objection may have no turn."""
    return Rule("anchor", turn, (F.col(kind) != K.NO_OBJECTION) & (F.coalesce(F.col(turn), F.lit(-1)) < 0))


def criterion_rule(field: str = "criterion") -> Rule:
    return Rule("criterion", field, ~F.col(field).isin(list(K.CRITERIA)))


def repair_anchor(objections: DataFrame, kind: str = "objection_type", turn: str = "turn_index") -> DataFrame:
    """The placeholder's missing turn becomes -1; a real objection's stays missing."""
    missing = (F.col(kind) == K.NO_OBJECTION) & F.col(turn).isNull()
    return objections.withColumn(turn, F.when(missing, F.lit(-1)).otherwise(F.col(turn)))


def violations(df: DataFrame, rules: Iterable[Rule], key: list[str]) -> DataFrame:
    """One row per row and broken rule.  All rules are read in one pass."""
    found = F.array_compact(F.array(*[
        F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"))) for r in rules]))
    return df.select(*key, F.explode(found).alias("v")).select(*key, "v.rule", "v.field")


def valid(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    return df.where(~F.coalesce(either(*[r.broken for r in rules]), F.lit(False)))


def unknown_keys(documents: DataFrame, declared: Iterable[str], body: str = "body") -> DataFrame:
    """Top-level keys of a JSON object that the schema does not declare, one per row."""
    names = F.map_keys(F.from_json(body, "map<string,string>"))
    extra = F.array_except(names, F.array(*map(F.lit, declared)) if declared else F.array().cast("array<string>"))
    return documents.withColumn("unknown_key", F.explode(extra))


def ledger_warnings(ledgers: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Calls that leave nothing for a follow-up to be marked against."""
    filled = F.exists(F.array(*[F.coalesce(F.size(f), F.lit(0)) for f in fields]), lambda n: n > 0)
    return ledgers.where(~filled).select("call_id", F.lit("empty_ledger").alias("warning"))


def citations(documents: DataFrame, singles: dict[str, str], lists: dict[str, str]) -> DataFrame:
    """Every turn a document cites: (call_id, field, turn).

    ``singles`` and ``lists`` map a field name to the column that holds its turn or its array.
    """
    one = [F.array(F.struct(F.lit(f).alias("field"), F.col(c).cast("bigint").alias("turn"))) for f, c in singles.items()]

    def named(field: str, column: str) -> Column:
        listed = F.coalesce(F.col(column), F.array().cast("array<bigint>"))
        return F.transform(listed, lambda t: F.struct(F.lit(field).alias("field"), t.cast("bigint").alias("turn")))

    many = [named(f, c) for f, c in lists.items()]
    return (documents.select("call_id", F.explode(F.concat(*one, *many)).alias("c"))
            .select("call_id", "c.field", "c.turn").where(F.col("turn").isNotNull()))


def beyond(cited: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cited turns outside the transcript, each once, by (call_id, total_turns); the placeholder's -1 is allowed."""
    distinct = cited.where(F.col("turn") != -1).select("call_id", "turn").distinct()
    return (distinct.join(sizes, "call_id").where((F.col("turn") < 0) | (F.col("turn") >= F.col("total_turns")))
            .select("call_id", "turn", "total_turns"))


def out_of_bounds(cited: DataFrame, turns: DataFrame) -> DataFrame:
    """``beyond`` with the sizes counted from the turns."""
    return beyond(cited, turns.groupBy("call_id").agg(F.count("*").alias("total_turns")))
