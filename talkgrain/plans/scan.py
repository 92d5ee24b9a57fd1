"""Ordered scans: rows of a key read once, in order, in blocks that many tasks share.

A fold over the rows of a key depends on all rows before.  So the rows of a key are dealt into blocks of consecutive positions, and a scan
goes over them twice.  First each block is summed up by itself: not as one result but as a table of what it makes of every state it may be
entered with.  These summaries, one row a block, are linked in order, which gives the state each block really is entered with, and then each
block is read again with it.  Rows stream through in Arrow batches; a task holds a state, never a group.  Nothing is counted or run while the
plan is built, and there is one plan for all sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Row = tuple
WIDTH = 65_536
_BLOCK, _STATE = "_block", "_state"
OUT_ROWS = 10_000


def streamed(rows: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str], schema: str | T.StructType,
             work: Callable[[Row, Iterator[Row]], Iterable[Row]]) -> DataFrame:
    """``work(key, rows)`` for each group of ``by``, its rows (tuples of ``columns``) in order; what it yields, after the key, is the result.

    Groups are told apart as the sorted partition goes by, so that one of any size is a stream.  The shuffle goes by a hash of the keys: one by
    the keys themselves is left out after a join by them, and when that join turns into a broadcast at run time, the groups are torn apart.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = [*by, *columns]
    laid = rows.select(*names, *[c for c in order if c not in names]).repartition(F.xxhash64(*by)).sortWithinPartitions(*by, *order).select(*names)
    out_kind = T.StructType([laid.schema[c] for c in by] + kind.fields)
    n = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(out_kind)
        every = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        held: list[Row] = []
        for key, group in groupby(every, key=lambda row: row[:n]):
            for made in work(key, (row[n:] for row in group)):
                held.append((*key, *made))
                if len(held) == OUT_ROWS:
                    yield _batch(held, target)
                    held = []
        if held:
            yield _batch(held, target)

    return laid.mapInArrow(run, out_kind)


def _batch(rows: list[Row], target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, type=f.type) for column, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)


def scanned(rows: DataFrame, keys: Sequence[str], position: str, order: Sequence[str], columns: Sequence[str], *, summary: str, state: str, schema: str,
            summarise: Callable[[Iterator[Row]], Row], enter: Callable[[Row | None, Row], Row], apply: Callable[[Row | None, Iterator[Row]], Iterable[Row]],
            width: int = WIDTH) -> DataFrame:
    """The rows that ``apply(state, rows of a block)`` yields, with the keys.

    ``summarise(rows)`` is the summary of a block, ``enter(state, summary)`` the state after it; the state before a key's first block is None.
    ``position`` is the first column of the order; blocks are ``width`` positions wide.
    """
    blocked = rows.withColumn(_BLOCK, F.floor(F.col(position) / width).cast("bigint"))
    by = [*keys, _BLOCK]
    kinds = T.StructType([T.StructField("_s", T.StructType.fromDDL(summary))])
    entered = T.StructType([T.StructField(_BLOCK, T.LongType()), T.StructField(_STATE, T.StructType.fromDDL(state))])
    names = T.StructType.fromDDL(state).fieldNames()
    summed = T.StructType.fromDDL(summary).fieldNames()

    def sum_up(_: Row, group: Iterator[Row]) -> Iterator[Row]:
        yield (dict(zip(summed, summarise(group), strict=True)),)

    def link(_: Row, blocks: Iterator[Row]) -> Iterator[Row]:
        now = None
        for block, found in blocks:
            yield block, None if now is None else dict(zip(names, now, strict=True))
            now = enter(now, tuple(found[c] for c in summed))

    def finish(_: Row, group: Iterator[Row]) -> Iterator[Row]:
        first = next(group)
        before = first[-1]
        rest = _chained(first, group)
        yield from apply(None if before is None else tuple(before[c] for c in names), (row[:-1] for row in rest))

    summaries = streamed(blocked, by, order, columns, kinds, sum_up)
    states = streamed(summaries, keys, [_BLOCK], [_BLOCK, "_s"], entered, link)
    joined = blocked.join(states, by)
    return streamed(joined, by, order, [*columns, _STATE], schema, finish).drop(_BLOCK)


def _chained(first: Row, rest: Iterator[Row]) -> Iterator[Row]:
    yield first
    yield from rest
