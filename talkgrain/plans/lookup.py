"""Find the first text of a group that contains a phrase, without trying every pair.

A text that contains a phrase contains each of its inner words whole, or, for a phrase of one or
two words, the first letters of its longest word.  That piece is the phrase's anchor.  Only texts
that hold the anchor are compared, and only anchors that are asked for leave the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def _longest(words: Column) -> Column:
    start = F.lit("")
    return F.aggregate(words, start, lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best))


def anchor(phrase: Column) -> Column:
    """``w`` and the longest inner word, or ``g``, a length and that many first letters."""
    words = F.split(phrase, " ")
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    head = F.left(_longest(words), F.lit(GRAM))
    return (F.when(F.size(words) >= 3, F.concat(F.lit("w"), _longest(inner)))
            .otherwise(F.concat(F.lit("g"), head)))


def _pieces_of(size: int):
    """Every run of ``size`` letters of a word."""
    def pieces(word: Column) -> Column:
        places = F.when(F.length(word) >= size, F.sequence(F.lit(1), F.length(word) - size + 1)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit("g"), F.substring(word, i, F.lit(size))))

    return pieces


def anchors_in(value: Column, words: Column, grams: Column) -> Column:
    """The anchors a text can answer to: its words, and the letter runs of its words."""
    parts = F.filter(F.split(value, " "), lambda w: w != "")
    none = F.array().cast("array<string>")
    whole = F.when(words, F.transform(parts, lambda w: F.concat(F.lit("w"), w))).otherwise(none)
    runs = [F.when(grams, F.flatten(F.transform(parts, _pieces_of(size)))).otherwise(none) for size in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(whole, *runs))


# Up to so many phrases of a group are looked for in a text one by one; more are met with the text's own anchors.
FEW = 64


def _hits(value: Column, asked: Column, words: Column, grams: Column) -> Column:
    """Which of the asked anchors a text holds."""
    spaced = F.concat(F.lit(" "), value, F.lit(" "))
    held = lambda a: F.when(F.startswith(a, F.lit("w")), F.contains(spaced, F.concat(F.lit(" "), F.substring(a, 2, 2**31 - 1), F.lit(" ")))).otherwise(
        F.contains(value, F.substring(a, 2, 2**31 - 1)))
    return F.when(F.size(asked) <= FEW, F.filter(asked, held)).otherwise(F.array_intersect(anchors_in(value, words, grams), asked))


def first_containing(phrases: DataFrame, texts: DataFrame, keys: list[str], phrase: str, value: str, position: str,
                     out: str) -> DataFrame:
    """Per distinct (keys, phrase): the smallest ``position`` of the keys' texts that contain it.

    Phrases that no text contains have no row.  Only texts of groups that ask for something are looked at, equal ones once, and a
    text goes on only with the anchors that are asked for in its group.
    """
    wanted = phrases.where(F.col(phrase) != "").select(*keys, phrase).distinct().withColumn("_anchor", anchor(F.col(phrase)))
    asked = wanted.groupBy(*keys).agg(F.bool_or(F.col("_anchor").startswith("w")).alias("_words"),
                                      F.bool_or(F.col("_anchor").startswith("g")).alias("_grams"), F.collect_set("_anchor").alias("_asked"))
    found = texts.join(asked, keys).select(*keys, value, F.col(position).alias("_at"), _hits(F.col(value), F.col("_asked"), F.col("_words"), F.col("_grams")).alias("_found"))
    places = (found.where(F.size("_found") > 0).groupBy(*keys, value).agg(F.min("_at").alias("_at"), F.first("_found").alias("_found"))
              .select(*keys, value, "_at", F.explode("_found").alias("_anchor")))
    return (wanted.join(places, [*keys, "_anchor"]).where(F.contains(F.col(value), F.col(phrase)))
            .groupBy(*keys, phrase).agg(F.min("_at").alias(out)))
