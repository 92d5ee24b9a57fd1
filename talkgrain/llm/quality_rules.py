"""Quality rules: line-first cleaning, in SQL expressions only.

Each line is judged by rules on punctuation, navigation and boilerplate; lines that fail go; a document that loses too much of
its text with them is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import whole

SPACE, SPACES = r"[\x20\x09-\x0D]", " \t\n\x0b\x0c\r"
SIGNS = "[#*$%&|<>]"

# Fixed values of the line rules, valid as patterns in Java and RE2 alike.
BOILERPLATE = (
    r"(?i)(^|[^a-z])(all rights reserved|licensed under|released under the|is licensed under|terms of (use|service)|privacy policy|"
    r"cookie (policy|settings)|accept (all )?cookies|enable javascript|subscribe to our|sign up for our|click here to|skip to (main )?content)([^a-z]|\z)"
)
NAVIGATION = r"[|\x{00BB}\x{203A}\x{2022}\x{00B7}>]( |\z)"
SENTENCE_END = r"[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}][)\]}\"'\x{201D}\x{2019}\x{00BB}]*( |\z)"
CAPITALS = r"\p{Lu}\p{Lu}+"


@dataclass(frozen=True)
class Rules:
    """Shares are whole per cents. window: words of a repeat. The rest: see line_fails and kept."""

    least_words: int = 20
    window: int = 8
    most_repeated: int = 30
    most_lost: int = 60
    heading_words: int = 12
    most_signs: int = 10
    most_separators: int = 2
    most_capitals: int = 60
    least_variety: int = 4
    echo_words: int = 8


def words_of(text: Column) -> Column:
    """The maximal runs without white space."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def lines_of(text: Column) -> Column:
    """The lines with a word, as they are."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, window: int) -> Column:
    """How many words lie in a window of `window` words that the text has twice or more, the first one included."""

    def of_hashes(hashes: Column) -> Column:
        in_order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(in_order, of_sorted))

    def of_sorted(rows: Column) -> Column:
        twins = F.filter(rows, lambda x, i: F.coalesce(x["h"] == F.get(rows, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(rows, i + 1)["h"], F.lit(False)))
        starts = F.sort_array(F.transform(twins, lambda x: x["i"]))
        none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        cover = lambda done, at: F.struct((done["n"] + at + window - F.greatest(at, done["end"])).alias("n"), (at + window).alias("end"))
        return F.aggregate(starts, none, cover, lambda done: done["n"])

    def of_words(hashed: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(hashed) - window + 1), lambda i: F.xxhash64(F.slice(hashed, i, window)))
        return F.when(F.size(hashed) < window, F.lit(0)).otherwise(bound(windows, of_hashes))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line, trimmed and with a word, is no prose:
    - boilerplate: it holds a phrase of licences, cookie notices and the like;
    - navigation: more than most_separators separators;
    - signs: over most_signs per cent of its characters;
    - shouting: runs of capitals are over most_capitals per cent of its words, in a line of more than one word;
    - echo: the square of its different words is under least_variety times its words, in a line of echo_words or more;
    - punctuation: no mark that ends a sentence, though it is longer than a heading.
    """

    def judged(words: Column) -> Column:
        n, distinct, chars = F.size(words), F.size(F.array_distinct(words)), F.length(line)
        return (
            (F.regexp_count(line, F.lit(NAVIGATION)) > rules.most_separators)
            | (100 * F.regexp_count(line, F.lit(SIGNS)) > rules.most_signs * chars)
            | ((n > 1) & (100 * F.regexp_count(line, F.lit(CAPITALS)) > rules.most_capitals * n))
            | ((n >= rules.echo_words) & (distinct * distinct < rules.least_variety * n))
            | ((n > rules.heading_words) & ~line.rlike(SENTENCE_END))
            | line.rlike(BOILERPLATE)
        )

    return bound(words_of(line), judged)


def judged(docs: DataFrame, rules: Rules | None = None, *, text_col: str = "text", clean_col: str | None = None) -> DataFrame:
    """docs with the measures of each whole text and `kept`.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed: plain measures. n_lines: lines with a word;
    n_bad_lines: those that a rule or an equal earlier line removes; lost_chars of line_chars: what goes with them.
    kept: not base_failed, and at most most_lost per cent of the characters are lost. clean_col: also return the text without
    the removed lines. A NULL text has no words, so it isn't kept. Columns of docs that have these names are replaced.
    """
    rules = rules or Rules()
    text = whole(docs[text_col])

    def by_line(lines: Column) -> Column:
        return bound(F.transform(lines, lambda x: F.btrim(x, F.lit(SPACES))), lambda rows: by_trimmed(lines, rows))

    def by_trimmed(lines: Column, rows: Column) -> Column:
        own = F.array_distinct(rows)
        return bound(F.filter(own, lambda x: ~line_fails(x, rules)), lambda good: F.struct(
            F.size(rows).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup"), F.size(good).alias("good"), total(rows).alias("chars"), total(good).alias("left"), F.array_join(good, "\n").alias("clean")))

    def total(rows: Column) -> Column:
        return F.aggregate(rows, F.lit(0).cast("long"), lambda done, x: done + F.length(x))

    def by_word(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n"), repeated_words(words, rules.window).cast("long").alias("repeated"))

    out = docs.withColumns({
        "_words": bound(words_of(text), by_word),
        "_lines": bound(lines_of(text), by_line),
        "word_chars": (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SIGNS)).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.col("_words.n"), "n_repeat_words": F.col("_words.repeated"), "n_lines": F.col("_lines.n").cast("long"), "n_dup_lines": F.col("_lines.dup").cast("long"),
        "n_bad_lines": (F.col("_lines.n") - F.col("_lines.good")).cast("long"), "line_chars": F.col("_lines.chars"),
        "lost_chars": F.col("_lines.chars") - F.col("_lines.left"), **({clean_col: F.col("_lines.clean")} if clean_col else {}),
    }).drop("_words", "_lines")
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words"))
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= rules.most_lost * F.col("line_chars"))
    return out.withColumn("base_failed", failed).withColumn("kept", kept)
