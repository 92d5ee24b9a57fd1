"""Object keys and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions.timing import date_path


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def object_key(kind: str, call_id: Column | str, started: Column | str, extension: str) -> Column:
    suffix = extension if extension.startswith(".") else "." + extension
    return F.concat(F.lit(kind + "/"), date_path(started), F.lit("/"), _col(call_id), F.lit(suffix))


def audio_key(call_id: Column | str, started: Column | str, extension: str = ".wav") -> Column:
    return object_key(K.AUDIO_PREFIX, call_id, started, extension)


def artifact_key(call_id: Column | str, started: Column | str, kind: str) -> Column:
    if kind not in K.ARTIFACT_KINDS:
        raise ValueError(f"{kind!r} is not one of {K.ARTIFACT_KINDS}")
    return object_key(kind, call_id, started, ".json")


def report_key(call_id: Column | str, started: Column | str) -> Column:
    return object_key(K.REPORT_PREFIX, call_id, started, ".pdf")


def every_key(call_id: Column | str, started: Column | str) -> Column:
    """One (kind, key) struct per object a call can own."""
    kinds = [(K.AUDIO_PREFIX, audio_key(call_id, started))]
    kinds += [(k, artifact_key(call_id, started, k)) for k in K.ARTIFACT_KINDS]
    kinds += [(K.REPORT_PREFIX, report_key(call_id, started))]
    return F.array(*[F.struct(F.lit(k).alias("kind"), key.alias("key")) for k, key in kinds])


def base_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def extension_of(path: Column | str) -> Column:
    """Lower-case extension with its dot; leading dots do not start one."""
    return F.lower(F.regexp_extract(base_name(path), r"^\.*[^.].*?(\.[^.]*)$", 1))


def is_recording(key: Column | str) -> Column:
    return (F.substring_index(_col(key), "/", 1) == K.AUDIO_PREFIX) & extension_of(key).isin(list(K.AUDIO_EXTENSIONS))


def call_id_of_key(key: Column | str) -> Column:
    name = base_name(key)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(\.*[^.].*)\.[^.]*$", 1), F.lit("")), name)


def call_id_of_file(path: Column | str) -> Column:
    """File name without its stage and ``.json`` suffix; any other extension goes as well."""
    name = base_name(path)
    staged = F.regexp_replace(name, r"(\.(clean|analysis|transcript|audit))?\.json$", "")
    return F.when(name.endswith(".json"), staged).otherwise(call_id_of_key(path))


def call_stem(path: Column | str) -> Column:
    return F.regexp_replace(call_id_of_key(path), r"\.(transcript|clean|analysis|audit)$", "")


def is_follow_up(call_id: Column | str) -> Column:
    value = _col(call_id)
    return value.endswith(K.FOLLOW_UP_SUFFIX) & (F.length(value) > len(K.FOLLOW_UP_SUFFIX))


def parent_call_id(call_id: Column | str) -> Column:
    value = _col(call_id)
    keep = F.length(value) - F.lit(len(K.FOLLOW_UP_SUFFIX))
    return F.when(is_follow_up(value), F.left(value, keep))
