"""Best-fit packing into sequences of several permitted lengths.

Pieces of documents are packed in falling length: each goes where it leaves the least room. If no open bin has room, a bin of the
size that costs least is opened, and in the end each bin shrinks to the smallest permitted size that holds its contents. Which
size to open for short pieces is settled for all sizes jointly: every floor for opened sizes is tried, and the cheapest result
taken. Shards of a bounded number of pieces are packed independently.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import picked, stored, whole


@dataclass(frozen=True)
class Settings:
    """sizes: permitted lengths of a sequence. A sequence of n tokens costs n + n * n / square + each. shard: pieces packed together
    on average, which bounds a task."""

    sizes: tuple[int, ...] = (512, 1024, 2048, 4096)
    square: int = 65_536
    each: int = 8
    shard: int = 20_000

    def cost(self, size: int) -> float:
        return size + size * size / self.square + self.each


def words_and_signs(text: Column) -> Column:
    """A length in pieces as tokenizers split before they merge: runs of letters, of digits and of other signs."""
    return F.regexp_count(whole(text), F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")).cast("long")


def best_fit(lengths: list[int], floor: int, settings: Settings) -> list[list[int]]:
    """Bins of positions in `lengths`, which fall. Opened sizes are `floor` at least; the cheapest per token that holds the piece."""
    sizes = sorted(settings.sizes)
    bins: list[list[int]] = []
    with_room: dict[int, list[int]] = {}
    mask = 0  # bit r is set if a bin has room for exactly r more
    for k, n in enumerate(lengths):
        above = mask >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            at = with_room[room].pop()
            if not with_room[room]:
                mask &= ~(1 << room)
        else:
            room = min((s for s in sizes if s >= max(n, floor)), key=lambda s: settings.cost(s) / s if s > n else settings.cost(s) / n, default=sizes[-1])
            at = len(bins)
            bins.append([])
        bins[at].append(k)
        if room > n:
            with_room.setdefault(room - n, []).append(at)
            mask |= 1 << (room - n)
    return bins


def downsized(total: int, settings: Settings) -> int:
    return next(s for s in sorted(settings.sizes) if s >= total)


def packed_shard(lengths: list[int], settings: Settings) -> list[list[int]]:
    """The cheapest packing over all floors, each after its bins were downsized; the smallest floor wins a tie."""
    best, least = [], float("inf")
    for floor in sorted(settings.sizes):
        bins = best_fit(lengths, floor, settings)
        cost = sum(settings.cost(downsized(sum(lengths[k] for k in own), settings)) for own in bins)
        if cost < least:
            best, least = bins, cost
    return best


def packed(docs: DataFrame, settings: Settings | None = None, *, id_col: str = "doc_id", length: Column | None = None) -> DataFrame:
    """A row for each piece: id, piece, start, n_tokens (in the document), bin, bin_start, bin_size.

    A document longer than the largest size is cut into pieces of that size and a rest. length: its length in tokens. One without
    tokens (NULL, empty, blank) has a single row with piece 0, no tokens and no bin. Rows that repeat are packed each by itself.
    """
    settings = settings or Settings()
    most = max(settings.sizes)
    measured = picked(docs, id=id_col, n=F.coalesce(length if length is not None else words_and_signs(docs["text"]), F.lit(0)).cast("long"))
    # written before it is dealt, so that a row keeps its shard when a task runs again
    rows = stored(measured.withColumn("row", F.monotonically_increasing_id()), "lengths")
    pieces = rows.where("n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))))
    count = rows.agg(F.sum(F.ceil(F.col("n") / most))).first()[0] or 0
    shards = max(1, -(-int(count) // settings.shard))
    dealt = pieces.select(
        "id", "row", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most), F.col("n") - F.col("piece") * most).cast("long").alias("n_tokens"),
        F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).alias("shard"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_tokens", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = part["n_tokens"].tolist()
        names, starts, sizes = [""] * len(part), [0] * len(part), [0] * len(part)
        shard = part["shard"].iloc[0]
        for b, own in enumerate(packed_shard(lengths, settings)):
            size, at = downsized(sum(lengths[k] for k in own), settings), 0
            for k in own:
                names[k], starts[k], sizes[k] = f"{shard}-{b}", at, size
                at += lengths[k]
        return part[["id", "piece", "start", "n_tokens"]].assign(bin=names, bin_start=starts, bin_size=sizes)

    # ids as strings inside the task, where a NULL would turn numbers into floats
    kind = docs.schema[id_col].dataType
    out = dealt.withColumn("id", F.col("id").cast("string")).groupBy("shard").applyInPandas(
        pack, "id string, piece long, start long, n_tokens long, bin string, bin_start long, bin_size long").withColumn("id", F.col("id").cast(kind))
    empty = rows.where("n = 0").select(
        "id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("bin"),
        F.lit(None).cast("long").alias("bin_start"), F.lit(None).cast("long").alias("bin_size"))
    return out.unionByName(empty).withColumnRenamed("id", id_col)
