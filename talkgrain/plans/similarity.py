"""Pairs of a group whose token sets overlap, by prefix filtering instead of all pairs.

Let a pair share at least half the tokens of its smaller set.  Order tokens from rare to common:
the smaller set then has one of its ``size - ceil(size / 2) + 1`` rarest tokens in common with the
other.  So the prefix of one side is matched with the whole of the other, once for each side being
the smaller.  The very common tokens of a large set are seldom in a prefix.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.plans.ordered import cut


# Groups with up to so many pairs are compared pair by pair, which moves each token set once.
FEW_PAIRS = 1_000_000


def _exploded(rows: DataFrame, group: str, id_: str, tokens: str) -> DataFrame:
    return rows.select(group, id_, F.size(tokens).alias("_size"), F.explode(tokens).alias("_token"))


def _prefixes(rows: DataFrame, counts: DataFrame, group: str, id_: str, tokens: str, share: float) -> DataFrame:
    """Each row with its rarest tokens, one per output row."""
    sized = (_exploded(rows, group, id_, tokens).join(counts, [group, "_token"])
             .groupBy(group, id_).agg(F.array_sort(F.collect_list(F.struct("_n", "_token"))).alias("_o")))
    exact = Fraction(str(share))
    keep = F.size("_o") - F.expr(f"(size(_o) * {exact.numerator} + {exact.denominator - 1}) div {exact.denominator}").cast("int") + 1
    return sized.select(group, id_, F.size("_o").alias("_size"), F.explode(F.slice("_o", 1, keep)).alias("_e")).select(
        group, id_, "_size", F.col("_e._token").alias("_token"))


def _candidates(a: DataFrame, b: DataFrame, group: str, left_id: str, right_id: str, share: float) -> DataFrame:
    """(group, left_id, right_id) of the pairs that share a token of the smaller set's prefix; token sets stay where they are."""
    left, right = _exploded(a, group, left_id, "_lt"), _exploded(b, group, right_id, "_rt")
    counts = left.select(group, "_token").union(right.select(group, "_token")).groupBy(group, "_token").agg(F.count("*").alias("_n"))
    named = [group, left_id, right_id]
    small_left = (_prefixes(a, counts, group, left_id, "_lt", share).withColumnRenamed("_size", "_own")
                  .join(right, [group, "_token"]).where(F.col("_own") <= F.col("_size")))
    small_right = (_prefixes(b, counts, group, right_id, "_rt", share).withColumnRenamed("_size", "_own")
                   .join(left, [group, "_token"]).where(F.col("_own") < F.col("_size")))
    return small_left.select(*named).unionByName(small_right.select(*named)).distinct()


def overlapping_pairs(left: DataFrame, right: DataFrame, group: str, left_id: str, right_id: str,
                      tokens: str = "tokens", share: float = 0.5, few: int = FEW_PAIRS) -> DataFrame:
    """(group, left_id, right_id, overlap) of all pairs that share enough tokens.

    ``tokens`` are arrays of distinct words.  Rows with equal token sets should be made one by the
    caller.  Only groups of more than ``few`` pairs need the prefixes.
    """
    a = cut(left.select(group, left_id, F.col(tokens).alias("_lt")).where(F.size("_lt") > 0))
    b = cut(right.select(group, right_id, F.col(tokens).alias("_rt")).where(F.size("_rt") > 0))
    n_left, n_right = a.groupBy(group).agg(F.count("*").alias("_nl")), b.groupBy(group).agg(F.count("*").alias("_nr"))
    large = F.broadcast(n_left.join(n_right, group).where(F.col("_nl") * F.col("_nr") > few).select(group))
    small = lambda rows: rows.join(large, group, "left_anti")
    whole = lambda rows: rows.join(large, group, "left_semi")
    met = _candidates(whole(a), whole(b), group, left_id, right_id, share).join(a, [group, left_id]).join(b, [group, right_id])
    cols = [group, left_id, right_id, "_lt", "_rt"]
    pairs = small(a).join(b, group).select(*cols).unionByName(met.select(*cols))
    exact = Fraction(str(share))
    smaller, shared = F.least(F.size("_lt"), F.size("_rt")), F.size(F.array_intersect("_lt", "_rt"))
    counted = pairs.select(group, left_id, right_id, smaller.alias("_smaller"), shared.alias("_shared"))
    kept = counted.where(F.col("_shared") * exact.denominator >= F.col("_smaller") * exact.numerator)
    return kept.select(group, left_id, right_id, F.round(F.col("_shared") / F.col("_smaller"), 4).alias("overlap"))
