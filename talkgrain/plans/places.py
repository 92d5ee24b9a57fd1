"""Walks over nested documents, compiled from their schema.

A schema is known before the data, so a walk is unrolled into one column expression: fields by name, lists by ``transform``.  All of it
runs inside the row that holds the document; nothing is exploded or gathered.  A place is told by its path, ``objections[0].quote.turn_index``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[str, T.DataType], bool]
Change = Callable[[str, T.DataType], Callable[[Column], Column] | None]

VARIANT_MAP, VARIANT_LIST = "map<string,variant>", "array<variant>"


def _joined(path: Column | None, name: str) -> Column:
    return F.lit(name) if path is None else F.concat(path, F.lit("." + name))


def _item(path: Column | None, i: Column) -> Column:
    return F.concat(F.lit("") if path is None else path, F.lit("["), i.cast("string"), F.lit("]"))


def _inner(name: str, field: str) -> str:
    return f"{name}.{field}" if name else field


def last(name: str) -> str:
    """A field's own name."""
    return name.rsplit(".", 1)[-1]


def held(df: DataFrame, out: str, value: Column) -> DataFrame:
    """``withColumn`` for a value that many expressions read: it is worked out once a row.

    A plain column is written into each of its readers where a filter on one of them moves down, and a document would be parsed again for
    every field.  A generator's column is not.
    """
    return df.select(*[c for c in df.columns if c != out], F.explode(F.array(value)).alias(out))


def gathered(value: Column, kind: T.DataType, wanted: Rule, entry: Callable[[Column, str, Column], Column],
             path: Column | None = None, name: str = "") -> Column | None:
    """An array of ``entry(path, field, value)`` over every leaf that ``wanted(field, type)`` takes, in the order of the schema.

    A field goes by its names from the top, leaves of a list by those of the list.  None when the schema has no such leaf.  Leaves that are NULL, or under a NULL struct,
    have entries too; a NULL list has none.
    """
    if isinstance(kind, T.StructType):
        parts = [gathered(value[f.name], f.dataType, wanted, entry, _joined(path, f.name), _inner(name, f.name)) for f in kind.fields]
        parts = [p for p in parts if p is not None]
        return F.concat(*parts) if parts else None
    if isinstance(kind, T.ArrayType):
        if not any(wanted(n, k) for n, k in leaves(kind, name)):
            return None
        listed = F.coalesce(value, F.array().cast(kind))
        return F.flatten(F.transform(listed, lambda x, i: gathered(x, kind.elementType, wanted, entry, _item(path, i), name)))
    return F.array(entry(path, name, value)) if wanted(name, kind) else None


def leaves(kind: T.DataType, name: str = "") -> Iterator[tuple[str, T.DataType]]:
    """(field, type) of every leaf of a schema; a field goes by its names from the top, ``objections.quote.turn_index``."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from leaves(f.dataType, _inner(name, f.name))
    elif isinstance(kind, T.ArrayType):
        yield from leaves(kind.elementType, name)
    else:
        yield name, kind


def listed(value: Column, kind: T.DataType, wanted: Callable[[str], bool], entry: Callable[[Column, str, Column], Column],
           path: Column | None = None, name: str = "") -> Column | None:
    """``gathered`` for whole lists: ``entry(path, field, list)`` of every list field that ``wanted(field)`` takes, NULL lists too."""
    if isinstance(kind, T.StructType):
        parts = [listed(value[f.name], f.dataType, wanted, entry, _joined(path, f.name), _inner(name, f.name)) for f in kind.fields]
        parts = [p for p in parts if p is not None]
        return F.concat(*parts) if parts else None
    if isinstance(kind, T.ArrayType):
        own = [F.array(entry(path, name, value))] if wanted(name) else []
        if listed(value[0], kind.elementType, wanted, entry, F.lit(""), name) is not None:
            inside = F.transform(F.coalesce(value, F.array().cast(kind)), lambda x, i: listed(x, kind.elementType, wanted, entry, _item(path, i), name))
            own.append(F.flatten(inside))
        return F.concat(*own) if own else None
    return None


def _objects(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) or isinstance(kind, T.ArrayType) and _objects(kind.elementType)


def rewritten(value: Column, kind: T.DataType, change: Change, name: str = "") -> Column:
    """The document with ``change(field, type)`` applied to each leaf it returns a function for.  NULLs stay, and so does the schema."""
    new = _rewritten(value, kind, change, name)
    return value if new is None else new


def _rewritten(value: Column, kind: T.DataType, change: Change, name: str) -> Column | None:
    if not any(change(n, k) for n, k in leaves(kind, name)):
        return None
    if isinstance(kind, T.StructType):
        parts = [(f.name, value[f.name], _rewritten(value[f.name], f.dataType, change, _inner(name, f.name))) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*[(old if new is None else new).alias(n) for n, old, new in parts]))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _rewritten(x, kind.elementType, change, name))
    return change(name, kind)(value)


def with_changes(value: Column, kind: T.DataType, change: Change) -> tuple[Column, Column]:
    """``rewritten`` for texts, and its log: (path, field, before, after) of every text that came out different."""
    def of_text(name: str, leaf: T.DataType) -> Callable[[Column], Column] | None:
        return change(name, leaf) if isinstance(leaf, T.StringType) else None

    def entry(path: Column, name: str, leaf: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(name).alias("field"), leaf.alias("before"), of_text(name, T.StringType())(leaf).alias("after"))

    found = gathered(value, kind, lambda name, leaf: of_text(name, leaf) is not None, entry)
    if found is None:
        raise ValueError("the schema has no text that the rule changes")
    return rewritten(value, kind, of_text), F.filter(found, lambda e: e["before"] != e["after"])


def _as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def extra_keys(value: Column, kind: T.DataType, path: Column | None = None) -> Column | None:
    """Paths of the keys of a VARIANT document that the schema does not declare, at every level that it describes."""
    if isinstance(kind, T.StructType):
        def inside(fields: Column) -> Column:
            own = F.transform(F.filter(F.map_keys(fields), lambda k: ~k.isin([f.name for f in kind.fields])), lambda k: k if path is None else F.concat(path, F.lit("."), k))
            below = [extra_keys(F.try_element_at(fields, F.lit(f.name)), f.dataType, _joined(path, f.name)) for f in kind.fields]
            return F.concat(own, *[b for b in below if b is not None])

        return F.coalesce(F.element_at(F.transform(F.array(_as(value, VARIANT_MAP)), inside), 1), F.array().cast("array<string>"))
    if isinstance(kind, T.ArrayType):
        if not _objects(kind):
            return None
        return F.coalesce(F.flatten(F.transform(_as(value, VARIANT_LIST), lambda x, i: extra_keys(x, kind.elementType, _item(path, i)))), F.array().cast("array<string>"))
    return None


def declared_only(value: Column, kind: T.DataType) -> Column | None:
    """A VARIANT document without the keys that ``extra_keys`` reports; values that have another type than declared stay as they are."""
    if isinstance(kind, T.StructType):
        def inside(fields: Column) -> Column:
            kept = F.map_filter(fields, lambda k, _: k.isin([f.name for f in kind.fields]))
            below = [(f.name, f.dataType) for f in kind.fields if _objects(f.dataType)]

            def cleaned(k: Column, v: Column) -> Column:
                chosen = F.when(F.lit(False), v)
                for name, inner in below:
                    chosen = chosen.when(k == name, declared_only(v, inner))
                return chosen.otherwise(v)

            return F.to_variant_object(F.transform_values(kept, cleaned) if below else kept)

        return F.coalesce(F.element_at(F.transform(F.array(_as(value, VARIANT_MAP)), inside), 1), value)
    if isinstance(kind, T.ArrayType) and _objects(kind):
        return F.coalesce(F.to_variant_object(F.transform(_as(value, VARIANT_LIST), lambda x: declared_only(x, kind.elementType))), value)
    return value
