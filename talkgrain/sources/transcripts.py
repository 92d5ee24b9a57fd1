"""Transcript documents in either layout as one turn table, and the timing they carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain import schemas
from talkgrain.functions import text
from talkgrain.plans import ordered


def _entries(document: Column) -> Column:
    """Every entry of a transcript as (speaker, text, start, end), whatever the layout.

    A document is an object with ``transcript``, or a bare list; an entry is an object with
    ``speaker``, or one with role names as keys.
    """
    body = F.when(F.ltrim(document).startswith("["), document).otherwise(F.get_json_object(document, "$.transcript"))
    raw = F.from_json(body, "array<string>")

    def one(entry: Column) -> Column:
        fields = F.from_json(entry, "map<string,string>")
        spoken = F.struct(
            F.try_element_at(fields, F.lit("speaker")).alias("speaker"),
            F.coalesce(F.try_element_at(fields, F.lit("text")), F.try_element_at(fields, F.lit("statement")),
                       F.lit("")).alias("text"),
            F.expr("cast(null as bigint)").alias("start_ms"), F.expr("cast(null as bigint)").alias("end_ms"))
        timed = spoken.withField("start_ms", F.try_element_at(fields, F.lit("start_ms")).cast("bigint")) \
                      .withField("end_ms", F.try_element_at(fields, F.lit("end_ms")).cast("bigint"))
        roles = F.transform(F.map_entries(fields), lambda e: F.struct(
            e["key"].alias("speaker"), e["value"].alias("text"),
            F.expr("cast(null as bigint)").alias("start_ms"), F.expr("cast(null as bigint)").alias("end_ms")))
        return F.when(F.map_contains_key(fields, "speaker"), F.array(timed)).otherwise(roles)

    objects = F.filter(raw, lambda e: F.ltrim(e).startswith("{"))
    return F.flatten(F.transform(objects, one))


def read_turns(documents: DataFrame, call_id: str = "call_id", body: str = "body",
               speaker_policy: str = "binary") -> DataFrame:
    """Turn table of transcript documents.  Turns left empty are dropped before numbering.

    ``binary`` makes every speaker Employee or Customer and sanitises the text; ``raw`` keeps the
    label and trims.
    """
    turns = documents.select(F.col(call_id).alias("call_id"), F.posexplode(_entries(F.col(body))).alias("pos", "t"))
    turns = turns.select("call_id", F.col("pos").cast("bigint").alias("pos"), "t.*")
    return numbered_turns(apply_speaker_policy(turns, speaker_policy))


def apply_speaker_policy(turns: DataFrame, policy: str = "binary") -> DataFrame:
    if policy == "binary":
        return turns.withColumns({"speaker": text.binary_speaker("speaker"), "text": text.sanitize("text")})
    if policy == "raw":
        return turns.withColumn("text", text.strip("text"))
    raise ValueError(f"unknown speaker policy {policy!r}")


def numbered_turns(turns: DataFrame, pos: str = "pos", width: int | None = ordered.AUTO) -> DataFrame:
    """Drop empty turns, then number what is left from 0 within each call, as ``turn``."""
    return ordered.by_size(turns.where(F.col("text") != ""), ["call_id"],
                           lambda rows, width: ordered.dense_index(rows, ["call_id"], pos, "turn", width), width)


def timing_segments(turns: DataFrame) -> DataFrame:
    """Entries with both times and an end no earlier than the start."""
    kept = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull() & (F.col("end_ms") >= F.col("start_ms"))
    return turns.where(kept)


def call_durations(segments: DataFrame, stated: DataFrame | None = None, pos: str = "pos") -> DataFrame:
    """The stated length of a recording, else the end of the segment that starts last."""
    last = segments.groupBy("call_id").agg(
        F.max_by("end_ms", F.struct("start_ms", F.col(pos))).alias("last_end_ms"), F.count("*").alias("segments"))
    if stated is None:
        return last.withColumn("duration_ms", F.col("last_end_ms"))
    known = stated.select("call_id", F.when(F.col("audio_duration_ms") >= 0, F.col("audio_duration_ms")).alias("_stated"))
    return (last.join(known, "call_id", "full_outer")
            .withColumn("duration_ms", F.coalesce("_stated", "last_end_ms")).drop("_stated"))


def sentiment_fields(documents: DataFrame, body: str = "body") -> DataFrame:
    """The part of an analysis document an audit may see, sanitised; ``analysis`` is unwrapped."""
    parsed = F.from_json(F.col(body), schemas.ANALYSIS_DOCUMENT)
    names = [f.name for f in schemas.SENTIMENT.fields]
    whole = documents.withColumn("_d", parsed)
    source = F.coalesce(F.col("_d.analysis"), F.struct(*[F.col(f"_d.{n}").alias(n) for n in names]))
    return whole.withColumn("hypothesis", sanitize_nested(source, schemas.SENTIMENT)).drop("_d")


def sanitize_nested(value: Column, schema) -> Column:
    """``sanitize`` on every string leaf of a nested value, following its declared schema."""
    return map_strings(value, schema, lambda leaf, _key: text.sanitize(leaf))


def redact_nested(value: Column, schema, exempt: tuple[str, ...]) -> Column:
    """Mask phone numbers in every string leaf whose field name is not exempt."""
    return map_strings(value, schema, lambda leaf, key: leaf if key in exempt else text.redact_phones(leaf))


def map_strings(value: Column, schema, change, key: str | None = None) -> Column:
    """Rebuild a nested value with ``change(leaf, field name)`` applied to each string."""
    kind = schema.typeName()
    if kind == "string":
        return change(value, key)
    if kind == "array":
        return F.transform(value, lambda v: map_strings(v, schema.elementType, change, key))
    if kind == "map":
        return F.transform_values(value, lambda _k, v: map_strings(v, schema.valueType, change, key))
    if kind == "struct":
        fields = [map_strings(value[f.name], f.dataType, change, f.name).alias(f.name) for f in schema.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value
