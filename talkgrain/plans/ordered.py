"""Ordered work per key, for ordinary keys and for one that owns a large share of the rows.

Ordinary keys use plain windows: all of them share one shuffle by the key.  A window puts a whole
key into one task, so keys above ``LIMIT`` rows go another way.  They are cut into blocks of
consecutive positions, worked on inside ``(key, block)``, and what crosses a block edge is carried
through a summary with one row per block.  ``by_size`` looks at the key sizes and takes the way
that fits; both give the same rows.

Helpers take ``width``: None is the plain way, a number the size of a block in positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain.session import checkpoint, checkpoint_folder

LIMIT = 1_000_000
BLOCK = 65_536
AUTO = -1
_B = "_block"


def by_size(df: DataFrame, keys: list[str], build: Callable[[DataFrame, int | None], DataFrame],
            width: int | None = AUTO, block: int = BLOCK, limit: int = LIMIT) -> DataFrame:
    """``build(rows, width)`` over all rows: plain for ordinary keys, blocked for heavy ones.

    One count per key settles it, on the key columns alone.  A caller that knows its sizes passes a
    ``width`` and saves the count.
    """
    if width != AUTO:
        return build(df, width)
    heavy = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*keys)
    if heavy.isEmpty():
        return build(df, None)
    light = build(df.join(heavy, keys, "left_anti"), None)
    return light.unionByName(build(df.join(heavy, keys, "left_semi"), block))


def with_block(df: DataFrame, pos: str, width: int) -> DataFrame:
    return df.withColumn(_B, F.floor(F.col(pos) / width).cast("bigint"))


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint where the session has a checkpoint folder, else the same frame.

    For steps that read their input more than once: in a row they would double the work each time.
    """
    return checkpoint(df) if checkpoint_folder(df.sparkSession) else df


def _inside(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, _B).orderBy(*order)


def _across(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(_B)


_UP_TO = (Window.unboundedPreceding, 0)
_BEFORE = (Window.unboundedPreceding, -1)


def dense_index(df: DataFrame, keys: list[str], pos: str, out: str, width: int | None = None,
                order: list[str] | None = None) -> DataFrame:
    """Zero-based rank of each row within its key, in order."""
    order = order or [pos]
    if width is None:
        return df.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))
    blocked = with_block(cut(df), pos, width)
    counts = blocked.groupBy(*keys, _B).agg(F.count("*").alias("_n"))
    counts = counts.select(*keys, _B, F.coalesce(F.sum("_n").over(_across(keys).rowsBetween(*_BEFORE)), F.lit(0)).alias("_before"))
    ranked = blocked.withColumn(out, F.row_number().over(_inside(keys, order)) - 1)
    return (ranked.join(counts, [*keys, _B])
            .withColumn(out, (F.col(out) + F.col("_before")).cast("bigint")).drop(_B, "_before"))


def running_sum(df: DataFrame, keys: list[str], pos: str, value: Column, out: str, width: int | None = None,
                order: list[str] | None = None) -> DataFrame:
    """Sum of ``value`` over the key's rows up to and with this one."""
    order = order or [pos]
    zero = F.lit(0).cast("bigint")
    if width is None:
        return df.withColumn(out, F.coalesce(F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*_UP_TO)), zero))
    blocked = with_block(cut(df).withColumn("_v", value), pos, width)
    sums = blocked.groupBy(*keys, _B).agg(F.sum("_v").alias("_s"))
    sums = sums.select(*keys, _B, F.coalesce(F.sum("_s").over(_across(keys).rowsBetween(*_BEFORE)), zero).alias("_before"))
    summed = blocked.withColumn(out, F.coalesce(F.sum("_v").over(_inside(keys, order).rowsBetween(*_UP_TO)), zero))
    return (summed.join(sums, [*keys, _B])
            .withColumn(out, F.col(out) + F.col("_before")).drop(_B, "_before", "_v"))


def running_max(df: DataFrame, keys: list[str], pos: str, value: Column, out: str, width: int | None = None,
                order: list[str] | None = None) -> DataFrame:
    """Largest ``value`` over the key's rows before this one; NULL on the first."""
    order = order or [pos]
    if width is None:
        return df.withColumn(out, F.max(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*_BEFORE)))
    blocked = with_block(cut(df).withColumn("_v", value), pos, width)
    tops = blocked.groupBy(*keys, _B).agg(F.max("_v").alias("_t"))
    tops = tops.select(*keys, _B, F.max("_t").over(_across(keys).rowsBetween(*_BEFORE)).alias("_before"))
    topped = blocked.withColumn(out, F.max("_v").over(_inside(keys, order).rowsBetween(*_BEFORE)))
    return (topped.join(tops, [*keys, _B])
            .withColumn(out, F.greatest(out, "_before")).drop(_B, "_before", "_v"))


def previous(df: DataFrame, keys: list[str], pos: str, columns: list[str], width: int | None = None,
             order: list[str] | None = None, prefix: str = "prev_") -> DataFrame:
    """The values of ``columns`` on the key's row just before; NULL on the first."""
    order = order or [pos]
    if width is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({prefix + c: F.lag(c).over(window) for c in columns})
    blocked = with_block(cut(df), pos, width)
    row = F.struct(*[F.col(c) for c in columns])
    ends = blocked.groupBy(*keys, _B).agg(F.max_by(row, F.struct(*order)).alias("_last"))
    ends = ends.select(*keys, _B, F.lag("_last").over(_across(keys)).alias("_carry"))
    here = blocked.withColumn("_here", F.lag(row).over(_inside(keys, order)))
    joined = here.join(ends, [*keys, _B]).withColumn("_p", F.coalesce("_here", "_carry"))
    return (joined.withColumns({prefix + c: F.col("_p." + c) for c in columns})
            .drop(_B, "_here", "_carry", "_p"))


def islands(df: DataFrame, keys: list[str], pos: str, width: int | None = None, label: str | None = None,
            starts: str | None = None, out: str = "island", order: list[str] | None = None) -> DataFrame:
    """Number the runs of consecutive rows.

    A run ends where column ``label`` changes.  With ``starts`` instead, it begins wherever that
    column is true; the key's first row begins one in any case.
    """
    order = order or [pos]
    if width is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        turns = ((F.row_number().over(window) > 1) & ~F.col(label).eqNullSafe(F.lag(label).over(window))) if label else F.coalesce(starts, F.lit(False))
        marked = df.withColumn("_new", turns.cast("bigint"))
        return marked.withColumn(out, F.sum("_new").over(window.rowsBetween(*_UP_TO))).drop("_new")
    blocked = with_block(cut(df), pos, width)
    inside, across, place = _inside(keys, order), _across(keys), F.struct(*order)
    if label:
        changed = (F.row_number().over(inside) > 1) & ~F.col(label).eqNullSafe(F.lag(label).over(inside))
        edge = [F.min_by(F.struct(label), place).alias("_first"), F.max_by(F.struct(label), place).alias("_last")]
    else:
        changed, edge = F.coalesce(starts, F.lit(False)), []
    marked = blocked.withColumn("_new", changed.cast("bigint"))
    summary = marked.groupBy(*keys, _B).agg(F.sum("_new").alias("_n"), *edge)
    turned = F.lit(0).cast("bigint")
    if label:
        last = F.lag("_last").over(across)
        turned = (last.isNotNull() & ~F.col("_first").eqNullSafe(last)).cast("bigint")
    summary = summary.withColumn("_edge", turned)
    prior = F.coalesce(F.sum(F.col("_n") + F.col("_edge")).over(across.rowsBetween(*_BEFORE)), F.lit(0))
    summary = summary.select(*keys, _B, (prior + F.col("_edge")).alias("_before"))
    local = marked.withColumn(out, F.sum("_new").over(inside.rowsBetween(*_UP_TO)))
    return (local.join(summary, [*keys, _B])
            .withColumn(out, F.col(out) + F.col("_before")).drop(_B, "_before", "_new"))


def neighbours(df: DataFrame, keys: list[str], index: str, item: Column, before: int, after: int,
               width: int | None = None) -> DataFrame:
    """Arrays of ``item`` over the rows just before and just after, as ``earlier`` and ``later``.

    ``index`` is dense.  In the blocked way the rows near a block edge are copied to the next
    block, so that each block sees all it needs.
    """
    if width is None:
        window = Window.partitionBy(*keys).orderBy(index)
        return df.withColumn("_item", item).withColumns({
            "earlier": F.collect_list("_item").over(window.rowsBetween(-before, -1)),
            "later": F.collect_list("_item").over(window.rowsBetween(1, after))}).drop("_item")
    if max(before, after) >= width:
        raise ValueError("a block must be wider than the frame")
    place, none = F.col(index) % width, F.lit(None).cast("int")
    homes = F.array(F.lit(0), F.when(place >= width - before, 1) if before else none, F.when(place < after, -1) if after else none)
    spread = (with_block(df, index, width).withColumn("_item", item)
              .withColumn("_step", F.explode(F.array_compact(homes)))
              .withColumn(_B, F.col(_B) + F.col("_step")))
    inside = _inside(keys, [index])
    return (spread.withColumns({"earlier": F.collect_list("_item").over(inside.rowsBetween(-before, -1)),
                                "later": F.collect_list("_item").over(inside.rowsBetween(1, after))})
            .where(F.col("_step") == 0).drop(_B, "_step", "_item"))


def joined_text(df: DataFrame, keys: list[str], pos: str, text: Column, out: str, aggs: list[Column],
                separator: str = " ", width: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Group by ``keys``, join ``text`` in order and apply ``aggs`` (max/min/sum/min_by/max_by).

    In the blocked way the pieces of a block are joined first, so that a long group is gathered
    block by block.
    """
    order = order or [pos]
    place = [F.col(c) for c in order]
    gathered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*place, F.col("_t").alias("_t")))), lambda s: s["_t"]), separator)
    if width is None:
        return df.withColumn("_t", text).groupBy(*keys).agg(*aggs, gathered.alias(out))
    df = cut(df)
    by_block = with_block(df.withColumn("_t", text), pos, width).groupBy(*keys, _B).agg(gathered.alias("_piece"))
    whole = by_block.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(_B, "_piece"))), lambda s: s["_piece"]), separator).alias(out))
    return df.groupBy(*keys).agg(*aggs).join(whole, keys) if aggs else whole
