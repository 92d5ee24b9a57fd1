"""Exact order statistics that never gather a key or the whole table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def middle_values(df: DataFrame, keys: list[str], value: str, width: int = 1000) -> DataFrame:
    """The lower and upper middle of an integer column per key, as ``low_mid`` and ``high_mid``.

    Values are counted, then located in two steps: the bucket of ``width`` values that holds the
    middle, then the value inside it.  A task sees bucket counts or one bucket's distinct values.
    """
    counted = (df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
               .withColumn("_bucket", F.floor(F.col(value) / width)))
    buckets = counted.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_bn"))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    buckets = (buckets.withColumn("_btop", F.sum("_bn").over(upto))
               .withColumn("_total", F.sum("_bn").over(whole))
               .withColumn("_low", F.floor((F.col("_total") - 1) / 2) + 1)
               .withColumn("_high", F.floor(F.col("_total") / 2) + 1)
               .withColumn("_base", F.col("_btop") - F.col("_bn"))
               .where((F.col("_base") < F.col("_high")) & (F.col("_btop") >= F.col("_low")))
               .select(*keys, "_bucket", "_low", "_high", "_base"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = (counted.join(buckets, [*keys, "_bucket"])
              .withColumn("_top", F.col("_base") + F.sum("_n").over(inside)))
    return placed.groupBy(*keys).agg(
        F.min(F.when(F.col("_top") >= F.col("_low"), F.col(value))).alias("low_mid"),
        F.min(F.when(F.col("_top") >= F.col("_high"), F.col(value))).alias("high_mid"))


def rank_descending(df: DataFrame, value: str, bins: Column, out: str = "rank") -> DataFrame:
    """``rank()`` over the whole table, highest ``value`` first, without a one-task window.

    ``bins`` maps values to integers in the same order, so that a bin holds few distinct values.
    Only distinct values are ranked; the rows get theirs by a join.
    """
    values = df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"), F.max(bins).alias("_bin"))
    sizes = values.groupBy("_bin").agg(F.sum("_n").alias("_size"))
    above = Window.orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_bin", F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_above"))
    inside = Window.partitionBy("_bin").orderBy(F.desc("_value")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (values.join(sizes, "_bin")
             .select("_value", (F.coalesce(F.sum("_n").over(inside), F.lit(0)) + F.col("_above") + 1).alias(out)))
    return df.join(ranks, df[value].eqNullSafe(ranks["_value"])).drop("_value")
