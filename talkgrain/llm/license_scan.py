"""Licence scan: ordered signature rules over the words of a text, in SQL expressions only.

The words of a text decide which rules are tried: a rule is run only where its keyword is a word of the text. Hits that overlap are
settled in one pass over them in the order of the text, by level first and by containment among equals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.license_rules import BASE, NAME, NOTICE, RULES, STATEMENT, VERSION, Rule
from talkgrain.llm.quality_rules import bound
from talkgrain.llm.shared import whole

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"  # stands in no word
SCORES = {VERSION: 1.0, NOTICE: 0.9, NAME: 0.7, STATEMENT: 0.3}
CHUNK = 256


def words_of(text: Column) -> Column:
    """The words, with A-Z in lower case."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NO_WORD), "")


def compiled(pattern: str) -> str:
    """A rule's pattern for a stream in which each word has a space on either side, so that neighbours share none."""
    return " " + pattern.replace(" ", "  ") + " "


def table(rules: Sequence[Rule]) -> Column:
    return F.array(*(F.struct(F.lit(r.keyword).alias("keyword"), F.lit(compiled(r.pattern)).alias("pattern"), F.lit(r.level).alias("level"), F.lit(k).alias("rule"), F.lit(r.label).alias("label")) for k, r in enumerate(rules)))


def hits(stream: Column, words: Column, rules: Sequence[Rule]) -> Column:
    """All places of the rules: start, end (words from 0, end excluded; `back` is -end), level, rule, label. No two of one rule overlap.

    A mark is put before each match and the marked stream is cut into words, so the work grows with the text, not with text times matches.
    """
    known = sorted({r.keyword for r in rules})

    def found(rule: Column) -> Column:
        matches = F.regexp_extract_all(stream, rule["pattern"], F.lit(0))
        return bound(matches, lambda m: F.when(F.size(m) > 0, placed(rule, m)).otherwise(F.filter(placed(rule, m), lambda _: F.lit(False))))

    def placed(rule: Column, matches: Column) -> Column:
        marked = F.split(F.regexp_replace(stream, F.concat(F.lit("("), rule["pattern"], F.lit(")")), F.lit(f" {MARK} $1")), " +")
        at = F.filter(F.transform(marked, lambda w, k: F.when(w == MARK, k - 1)), lambda k: k.isNotNull())  # the first piece is empty

        def hit(k: Column, j: Column) -> Column:
            end = k - j + F.regexp_count(F.get(matches, j), F.lit("[^ ]+"))
            return F.struct((k - j).alias("start"), (-end).alias("back"), rule["level"].alias("level"), rule["rule"].alias("rule"), end.alias("end"), rule["label"].alias("label"))

        return F.transform(at, hit)

    own = F.array_intersect(words, F.array(*map(F.lit, known)))
    listed = table(rules)
    tried = lambda o: F.when(F.size(o) > 0, F.filter(listed, lambda r: F.array_contains(o, r["keyword"]))).otherwise(F.slice(listed, 1, 0))
    return F.flatten(F.transform(bound(own, tried), found))


def settled(all_hits: Column) -> Column:
    """Hits that stay, in order of the text.

    Hits come by start, longer ones first, then by level and rule. One is pending at a time. A hit apart from it, or of its level and
    reaching beyond it, follows it. Of two others that overlap the one with the lower level number stays; among equals the one
    that contains the other. Kept hits are gathered in chunks, as a list that grows by one copies itself each time.
    """
    kept = lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), h["level"].alias("level"), h["rule"].alias("rule"), h["label"].alias("label"))

    def state(full: Column, last: Column, pending: Column) -> Column:
        return F.struct(full.alias("full"), last.alias("last"), pending.alias("pending"))

    def pushed(done: Column, h: Column) -> Column:
        grown = F.concat(done["last"], F.array(done["pending"]))
        return F.when(F.size(done["last"]) < CHUNK, state(done["full"], grown, h)).otherwise(state(F.concat(done["full"], F.array(done["last"])), F.array(done["pending"]), h))

    def step(done: Column, h: Column) -> Column:
        p = done["pending"]
        follows = (h["start"] >= p["end"]) | ((h["level"] == p["level"]) & (h["end"] > p["end"]))
        return F.when(follows, pushed(done, kept(h))).when(h["level"] >= p["level"], done).otherwise(state(done["full"], done["last"], kept(h)))

    def swept(rows: Column) -> Column:
        first = F.transform(F.slice(rows, 1, 1), kept)
        none = F.filter(first, lambda _: F.lit(False))
        start = state(F.filter(F.array(first), lambda _: F.lit(False)), none, F.get(first, F.lit(0)))
        return F.aggregate(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), start, step, lambda done: F.flatten(F.concat(done["full"], F.array(done["last"], F.array(done["pending"])))))

    return bound(F.sort_array(all_hits), lambda rows: F.when(F.size(rows) > 0, swept(rows)).otherwise(F.transform(rows, kept)))


def scanned(docs: DataFrame, *, text_col: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE) -> DataFrame:
    """docs with `n_words`, `base` (every place of the base phrases) and `detections` (settled hits of the rules): arrays of structs with start, end
    (words from 0), level, rule and label.

    A NULL text is empty and has none. Rows are worked on one by one, so repeated rows give repeated results and NULL ids stay. Columns of docs
    that have these names are replaced.
    """
    def scan(words: Column) -> Column:
        stream = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))
        return bound(stream, lambda s: F.struct(
            F.size(words).cast("long").alias("n"), F.transform(hits(s, words, base), lambda h: F.struct(h["start"], h["end"], h["level"], h["rule"], h["label"])).alias("base"), settled(hits(s, words, rules)).alias("detections")))

    out = docs.withColumn("_found", bound(words_of(whole(docs[text_col])), scan))
    return out.withColumns({"n_words": F.col("_found.n"), "base": F.col("_found.base"), "detections": F.col("_found.detections")}).drop("_found")


def labels_of(*found: Column) -> Column:
    """Labels of hits, each once, in order, with commas between."""
    return F.array_join(F.sort_array(F.array_distinct(F.flatten(F.array(*(F.transform(f, lambda h: h["label"]) for f in found))))), ",")


def score(*found: Column) -> Column:
    """How surely a licence is named: by the best level among the hits, 0 without any."""
    best = F.array_min(F.flatten(F.array(*(F.transform(f, lambda h: h["level"]) for f in found))))
    chosen = F.when(F.lit(False), F.lit(0.0))
    for level, value in SCORES.items():
        chosen = chosen.when(best == level, F.lit(value))
    return chosen.otherwise(F.lit(0.0))
