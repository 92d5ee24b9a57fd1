"""Filter interaction audit: what each filter removes in every order of the filters, from one pass over the documents.

A document is reduced to the set of filters it fails. Documents of one part that fail the same set are a cell, so a part has at
most 2^k cells, whatever it holds. A Gray-code walk goes through all subsets of filters and toggles one filter at a time: each
cell keeps a counter of active filters that it fails, and only cells whose counter leaves or reaches zero move the running
survivors. The survivors of the 2^k states are stored; each step of each order is the difference of two states.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.quality_rules import bound, words_of
from talkgrain.llm.shared import picked, stored, whole

COUNTS = ("n", "good", "toxic")
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 2, "[#$%&*|]"  # shares in per cent


def measured(text: Column) -> Column:
    """What the filters of a text look at: words, distinct words, capitals, characters, and whether one of the signs occurs."""
    return bound(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("words"), F.size(F.array_distinct(w)).cast("long").alias("own"), F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("capitals"),
        F.length(text).cast("long").alias("chars"), text.rlike(SIGNS).alias("signs")))


def text_failures(m: Column) -> list[Column]:
    """Filters A to D on measures: too few words, too few distinct ones, too many capitals, one of the signs."""
    return [m["words"] < LEAST_WORDS, 100 * m["own"] < LEAST_DISTINCT * m["words"], 100 * m["capitals"] > MOST_CAPITALS * m["chars"], m["signs"]]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups of documents with the same part, good, toxic and mask, with their number n. Bit k of the mask: filter k of ABCDE fails.

    E fails where a smaller id has the identical text, in any part. Texts are told apart by SHA-256. Ids of one text meet under
    (text, id), never under the text alone, so a text that a third of all documents share is no hot key.
    A NULL text is empty, a NULL part is ''. A NULL id has no smaller id, is none, and has no label. Repeated rows count each; a
    repeated row of the smallest id passes E like the first. An id that is rated more than once is good or toxic if any rating says so.
    """
    text = whole(F.col("text"))
    rows = picked(docs, id="doc_id", text="text", part="source").select(
        "id", F.coalesce("part", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), measured(text).alias("measures"))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("measures")))), F.lit(0))
    rows = rows.groupBy("digest", "id", "part", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    rows = stored(rows, "failures")

    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    rated = picked(labels, id="doc_id", quality="quality", toxic="toxic").where("id is not null").groupBy("id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    late = F.col("id").isNotNull() & F.col("first").isNull()
    return (
        rows.join(firsts, ["digest", "id"], "left").join(rated, "id", "left")
        .groupBy("part", (F.col("mask") + F.when(late, 16).otherwise(0)).alias("mask"))
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


def walked(cells: np.ndarray, filters: int) -> np.ndarray:
    """cells[..., mask] are counts of documents by the set of filters they fail. Returns survivors[..., subset] of every subset of filters."""
    masks = np.arange(1 << filters)
    active = np.zeros(1 << filters, dtype=np.int64)  # of each cell: the active filters that it fails
    running = cells.sum(axis=-1)
    survivors = np.empty_like(cells)
    survivors[..., 0] = running
    subset = 0
    for step in range(1, 1 << filters):
        toggled = step & -step  # the bit in which Gray codes of step - 1 and step differ
        failing = (masks & toggled) != 0
        subset ^= toggled
        if subset & toggled:
            running = running - cells[..., failing & (active == 0)].sum(axis=-1)
            active[failing] += 1
        else:
            active[failing] -= 1
            running = running + cells[..., failing & (active == 0)].sum(axis=-1)
        survivors[..., subset] = running
    return survivors


def steps(filters: str) -> pd.DataFrame:
    """One row for each step of each order: the filter, and the subsets of filters before and after it."""
    rows = []
    for order in itertools.permutations(range(len(filters))):
        before = 0
        for k, f in enumerate(order):
            rows.append(("".join(filters[x] for x in order), k + 1, f, before, before | 1 << f))
            before |= 1 << f
    return pd.DataFrame(rows, columns=["filter_order", "step", "filter", "before", "after"])


def differences(cells: np.ndarray, table: pd.DataFrame, filters: int) -> dict[str, np.ndarray]:
    """cells[part, count, mask] to columns[part, row of the table]."""
    left = walked(cells, filters)
    n, good, toxic = left[:, 0], left[:, 1], left[:, 2]
    before, after, f = (table[c].to_numpy() for c in ("before", "after", "filter"))
    everything = (1 << filters) - 1
    removed = n[:, before] - n[:, after]
    fails = n[:, [0]] - n[:, 1 << f]
    shapley = np.zeros((len(cells), filters), dtype=np.int64)
    for k in range(filters):
        shapley[:, k] = removed[:, f == k].sum(axis=1)
    return {
        "kept": n[:, after], "removed": removed, "redundant": fails - removed, "unique_fails": n[:, everything & ~(1 << f)] - n[:, [everything]],
        "good_lost": good[:, before] - good[:, after], "toxic_lost": toxic[:, before] - toxic[:, after], "shapley": shapley[:, f],
    }


def audited(cells: DataFrame, filters: str = "ABCDE", parts_at_once: int = 256) -> DataFrame:
    """Rows of `cells` (part, mask, n, good, toxic; one row a cell) to one row for each part, order of the filters and step.

    A part with no cells has no rows; in any other part every order and step has a row, zeros included.
    """
    width = 1 << len(filters)
    rows = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))  # at most 2^k
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = steps(filters)
        for batch in batches:
            for start in range(0, len(batch), parts_at_once):
                some = batch.iloc[start : start + parts_at_once]
                counts = np.zeros((len(some), len(COUNTS), width), dtype=np.int64)
                for k, held in enumerate(some["cells"]):
                    _fill(counts[k], held)
                columns = differences(counts, table, len(filters))
                yield pd.DataFrame({
                    "part": np.repeat(some["part"].to_numpy(), len(table)), "filter_order": np.tile(table["filter_order"].to_numpy(), len(some)),
                    "step": np.tile(table["step"].to_numpy(), len(some)), **{c: columns[c].reshape(-1) for c in names}})

    return rows.mapInPandas(walk, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))


def _fill(counts: np.ndarray, held: Sequence[Mapping[str, int]]) -> None:
    for cell in held:
        for k, c in enumerate(COUNTS):
            counts[k, cell["mask"]] += cell[c]
