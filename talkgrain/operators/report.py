"""Audit reports as documents: what they cite, what is cut or scrubbed, which keys and values the schema does not allow.

A report is one nested value per call; every operator here is a walk compiled from ``schemas.REPORT`` and stays inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.functions import text
from talkgrain.functions.text import either
from talkgrain.plans import places

SUMMARY = "sales_summary"


def read_reports(documents: DataFrame, body: str = "body", out: str = "report") -> DataFrame:
    """JSON documents as typed reports, without their text."""
    return places.held(documents, out, F.from_json(body, schemas.REPORT)).drop(body)


def citations(reports: DataFrame, report: str = "report", kind: T.StructType = schemas.REPORT) -> DataFrame:
    """Every turn a report cites: (call_id, path, field, turn), of the nine fields that hold turns, wherever they stand."""
    def entry(path: Column, name: str, turn: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(places.last(name)).alias("field"), turn.cast("bigint").alias("turn"))

    found = places.gathered(F.col(report), kind, lambda name, _: places.last(name) in K.CITATION_FIELDS, entry)
    return reports.select("call_id", F.explode(found).alias("c")).select("call_id", "c.*").where(F.col("turn").isNotNull())


def cap_of(name: str) -> int | None:
    """The most characters of a text, or of a list's entries."""
    if name in K.UNCAPPED_FIELDS:
        return None
    return K.TEXT_CAPS.get(places.last(name))


def trimmed(reports: DataFrame, report: str = "report", log: str = "trims") -> DataFrame:
    """Texts over their cap made to fit, entries of lists too, and a log: (path, field, characters, cap, the new text)."""
    def change(name: str, leaf: T.DataType):
        cap = cap_of(name) if isinstance(leaf, T.StringType) else None
        return None if cap is None else lambda value: text.shorten(value, cap)

    def entry(path: Column, name: str, value: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(name).alias("field"), F.length(value).cast("bigint").alias("was"), F.lit(cap_of(name)).cast("bigint").alias("cap"), value.alias("text"))

    def cut(e: Column) -> Column:
        return e.withField("text", text.shorten(e["text"], e["cap"].cast("int")))

    capped = places.gathered(F.col(report), schemas.REPORT, lambda name, leaf: change(name, leaf) is not None, entry)
    over = F.transform(F.filter(capped, lambda e: e["was"] > e["cap"]), cut)
    return places.held(reports, log, over).withColumn(report, places.rewritten(F.col(report), schemas.REPORT, change))


def scrubbed(reports: DataFrame, report: str = "report", log: str = "scrubs") -> DataFrame:
    """The sales summary without references to turns, and a log of the paths that had some.

    The rest of the report is evidence and keeps them.
    """
    def change(name: str, _: T.DataType):
        return text.strip_turn_citations if name.startswith(SUMMARY + ".") else None

    def texts(document: str) -> Column:
        return places.gathered(F.col(document), schemas.REPORT, lambda name, leaf: isinstance(leaf, T.StringType) and change(name, leaf) is not None,
                               lambda path, _, value: F.struct(path.alias("path"), value.alias("text")))

    def changed(old: Column, new: Column) -> Column:
        return F.when(old["text"] != new["text"], old["path"])

    new = places.held(reports, "_new", places.rewritten(F.col(report), schemas.REPORT, lambda name, leaf: change(name, leaf) if isinstance(leaf, T.StringType) else None))
    return new.withColumns({log: F.array_compact(F.zip_with(texts(report), texts("_new"), changed)), report: F.col("_new")}).drop("_new")


def unknown_keys(documents: DataFrame, body: str = "body", kind: T.StructType = schemas.REPORT) -> DataFrame:
    """Keys that the schema does not declare, at every level: (call_id, path)."""
    return documents.select("call_id", F.explode(places.extra_keys(F.try_parse_json(body), kind)).alias("path"))


def without_unknown_keys(documents: DataFrame, body: str = "body", kind: T.StructType = schemas.REPORT, log: str = "dropped") -> DataFrame:
    """Documents without such keys, as JSON, and the paths that went.  What is no JSON object stays as it is."""
    parsed = places.held(documents, "_v", F.try_parse_json(body)).withColumn(log, places.extra_keys(F.col("_v"), kind))
    clean = F.to_json(places.declared_only(F.col("_v"), kind))
    return parsed.withColumn(body, F.when(F.size(log) > 0, clean).otherwise(F.col(body))).drop("_v")


def violations(reports: DataFrame, report: str = "report", kind: T.StructType = schemas.REPORT) -> DataFrame:
    """What a typed report holds against the schema: (call_id, path, rule), rule enum, range, length, item_length or size."""
    def broken(name: str, leaf: T.DataType, value: Column) -> Column | None:
        own = places.last(name)
        tests = []
        if name in K.ENUM_FIELDS:
            tests.append(("enum", ~value.isin(list(K.ENUMS[K.ENUM_FIELDS[name]]))))
        if own in K.NUMBER_BOUNDS and not isinstance(leaf, T.StringType):
            low, high = K.NUMBER_BOUNDS[own]
            tests.append(("range", either(*([value < low] if low is not None else []), *([value > high] if high is not None else []))))
        if isinstance(leaf, T.StringType) and cap_of(name):
            tests.append(("item_length" if name in _LISTS else "length", F.length(value) > cap_of(name)))
        if not tests:
            return None
        return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(rule)) for rule, test in tests]))

    def wanted(name: str, leaf: T.DataType) -> bool:
        return broken(name, leaf, F.lit(None).cast(leaf)) is not None

    kinds = dict(places.leaves(kind))
    named = lambda path, rules: F.struct(path.alias("path"), rules.alias("rules"))
    of_leaves = places.gathered(F.col(report), kind, wanted, lambda path, name, value: named(path, broken(name, kinds[name], value)))

    def sized(path: Column, name: str, value: Column) -> Column:
        low, high = K.LIST_BOUNDS[places.last(name)]
        return named(path, F.when(F.coalesce(F.size(value), F.lit(0)).between(low, high), F.array().cast("array<string>")).otherwise(F.array(F.lit("size"))))

    of_lists = places.listed(F.col(report), kind, lambda name: places.last(name) in K.LIST_BOUNDS and name not in K.UNCAPPED_FIELDS, sized)
    found = of_leaves if of_lists is None else F.concat(of_leaves, of_lists)
    rows = reports.select("call_id", F.explode(found).alias("f"))
    return rows.select("call_id", "f.path", F.explode("f.rules").alias("rule"))


def _list_names(kind: T.DataType, name: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return {n for f in kind.fields for n in _list_names(f.dataType, f"{name}.{f.name}" if name else f.name)}
    if isinstance(kind, T.ArrayType):
        return {name} | _list_names(kind.elementType, name)
    return set()


_LISTS = _list_names(schemas.REPORT)
