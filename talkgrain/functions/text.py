"""Text expressions.  All but ``slug`` are built-in Column expressions."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from talkgrain import constants as K

# Java's \s under (?U) is White_Space; Python's also has the four separators 1c-1f.
_SPACE = r"[\s\x1c-\x1f]"
# Every white-space character, for trimming without a regex.
_BLANKS = "".join(chr(code) for code in range(0x10000) if chr(code).isspace())


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def either(*tests: Column) -> Column:
    """OR of several conditions."""
    return functools.reduce(lambda a, b: a | b, tests)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` for a ``use`` that reads the value more than once: it is worked out a single time, in a lambda too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(value: Column | str) -> Column:
    """Drop white space of any kind at both ends."""
    return F.btrim(_col(value), F.lit(_BLANKS))


def collapse_space(value: Column | str) -> Column:
    return strip(F.regexp_replace(_col(value), rf"(?U){_SPACE}+", " "))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def ten_digits(value: Column | str) -> Column:
    """The last ten digits of a phone number, empty when there are fewer."""
    digits = F.regexp_replace(F.coalesce(_col(value), F.lit("")), r"(?U)\D", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10))).otherwise(F.lit(""))


def did_key(value: Column | str) -> Column:
    """The last ten digits of a direct-dial number; a short one stays as it is."""
    return F.right(F.regexp_replace(F.coalesce(_col(value), F.lit("")), r"(?U)\D", ""), F.lit(10))


@F.pandas_udf(StringType())
def _ascii_fold(values: pd.Series) -> pd.Series:
    return values.map(
        lambda v: None if v is None
        else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")
    )


def slug_ascii(value: Column | str, fallback: str = K.SLUG_FALLBACK) -> Column:
    """``slug`` for text already known to be ASCII: stays in the JVM."""
    text = F.regexp_replace(F.coalesce(_col(value), F.lit("")), r"[^a-zA-Z0-9]+", "-")
    return F.coalesce(blank_to_null(F.lower(F.regexp_replace(text, r"^-+|-+$", ""))), F.lit(fallback))


def slug(value: Column | str, fallback: str = K.SLUG_FALLBACK) -> Column:
    """Lower-case ASCII words joined by hyphens.

    Spark has no Unicode decomposition, so the accents come off in an Arrow UDF.  Apply it to
    distinct names, not to every row.
    """
    return slug_ascii(_ascii_fold(_col(value)), fallback)


def clean_text(value: Column | str) -> Column:
    """One space between words, none before a full stop, comma or question mark."""
    return F.regexp_replace(collapse_space(value), rf"(?U){_SPACE}+([।,.?!])", "$1")


USUAL_RANGES = 8


@functools.lru_cache(maxsize=None)
def letters_outside(scripts: tuple[str, ...] = ("LATIN", "DEVANAGARI")) -> str:
    """Regex class of the letters whose Unicode name starts with none of ``scripts``."""
    kept: list[list[int]] = []
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha() and unicodedata.name(char, "").startswith(scripts):
            if kept and kept[-1][1] == code - 1:
                kept[-1][1] = code
            else:
                kept.append([code, code])
    ranges = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in kept)
    # The usual letters are told first: a class of many ranges is slow to leave.
    usual = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in kept[:USUAL_RANGES])
    return rf"[\p{{L}}&&[^{usual}]&&[^{ranges}]]"


def _stripped_of_scripts(value: Column, scripts: tuple[str, ...]) -> Column:
    controls = r"(?U)[\p{C}&&[^\s\x1c-\x1f]]"
    return F.regexp_replace(F.regexp_replace(value, letters_outside(scripts), ""), controls, "")


def sanitize(value: Column | str, scripts: tuple[str, ...] = ("LATIN", "DEVANAGARI")) -> Column:
    """Drop letters of other scripts and control characters, then collapse white space."""
    return collapse_space(_stripped_of_scripts(_col(value), scripts))


def was_sanitized(value: Column | str, scripts: tuple[str, ...] = ("LATIN", "DEVANAGARI")) -> Column:
    """Whether ``sanitize`` would remove a character (white space does not count)."""
    return _stripped_of_scripts(_col(value), scripts) != _col(value)


def redact_phones(value: Column | str) -> Column:
    return F.regexp_replace(_col(value), K.PHONE_PATTERN, K.PHONE_MASK)


def _rfind(text: Column, needle: str) -> Column:
    """Zero-based place of the last ``needle``; negative when there is none."""
    tail = F.substring_index(text, needle, -1)
    return F.length(text) - F.length(tail) - F.lit(len(needle))


def shorten(value: Column | str, cap: int | Column) -> Column:
    """Fit text into ``cap`` characters: at a sentence end, else a word end, else a hard cut."""
    text, most = _col(value), F.lit(cap) if isinstance(cap, int) else cap
    head = F.left(text, most)
    half = F.lit(cap // 2) if isinstance(cap, int) else F.floor(most / 2)
    space = _rfind(head, " ")
    cut = F.when(space >= half, F.left(head, space)).otherwise(F.left(head, most - 1))
    hard = F.left(F.concat(F.regexp_replace(cut, r"[ ,;:\-—–]+$", ""), F.lit("…")), most)
    result = F.when(F.length(text) <= most, text)
    for stop in (". ", "! ", "? ", "। "):
        at = _rfind(head, stop)
        result = result.when(at >= half, strip(F.left(head, at + 1)))
    return result.otherwise(hard)


def strip_turn_citations(value: Column | str) -> Column:
    """Take "at turn 13"-like references out of prose; other text is returned untouched."""
    text = _col(value)

    def tidied(cut: Column) -> Column:
        tidy = F.regexp_replace(cut, r"(?U)\s{2,}", " ")
        return strip(F.regexp_replace(tidy, r"(?U)\s+([,.;:])", "$1"))

    def capital(tidy: Column) -> Column:
        return F.concat(F.upper(F.left(tidy, F.lit(1))), F.substring(tidy, 2, 2**31 - 1))

    cut = F.regexp_replace(text, K.TURN_CITATION_PATTERN, " ")
    return once(cut, lambda c: F.when(c == text, text).otherwise(once(tidied(c), capital)))


def strip_fences(value: Column | str) -> Column:
    return strip(F.regexp_replace(strip(value), K.FENCE_PATTERN, ""))


def word_count(value: Column | str) -> Column:
    words = F.split(_col(value), rf"(?U){_SPACE}+")
    return F.size(F.filter(words, lambda w: w != "")).cast("bigint")


def token_set(value: Column | str, longer_than: int = 2) -> Column:
    """Distinct lower-case words; white space and punctuation separate them."""
    words = F.split(F.lower(_col(value)), K.WORD_SPLIT_PATTERN)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) > longer_than))


def token_estimate(chars: Column | str, per_token: float = K.CHARS_PER_TOKEN) -> Column:
    return F.floor(_col(chars) / F.lit(per_token)).cast("bigint")


def processing_mode(tokens: Column | str, threshold: int = K.MAP_REDUCE_TOKENS) -> Column:
    return F.when(_col(tokens) > threshold, "map_reduce").otherwise("single_pass")


def contains_any(value: Column | str, words: Iterable[str]) -> Column:
    return either(*[F.contains(_col(value), F.lit(word)) for word in words])


def marker_hits(value: Column | str, plus: Iterable[str], minus: Iterable[str]) -> Column:
    """Markers of one side found in the text less those of the other; each counts once."""
    low = F.lower(_col(value))
    score = F.lit(0)
    for word in plus:
        score = score + F.contains(low, F.lit(word)).cast("int")
    for word in minus:
        score = score - F.contains(low, F.lit(word)).cast("int")
    return score.cast("bigint")


def is_backchannel(value: Column | str, words: Iterable[str] = K.BACKCHANNEL_WORDS) -> Column:
    """At most three words, each a pure acknowledgement; nothing at all counts too.

    White space and dandas part words, and punctuation at their ends is no part of them.  One pattern, so that nothing is split or
    gathered: a line that is none fails at its first word.
    """
    space, edge = r"\s\x1c-\x1f।", re.escape(K.BACKCHANNEL_STRIP)
    # A word that punctuation begins or ends, that is in parts or has capitals is never what is left of one.
    bare = re.compile(rf"[^{space}{edge}](?:[^{space}]*[^{space}{edge}])?")
    known = "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)) if bare.fullmatch(w) and w == w.lower()) or "(?!)"
    closing = re.escape("".join(c for c in K.BACKCHANNEL_STRIP if not re.match(f"[{space}]", c)))
    between = rf"[{space}{edge}]*+"  # runs are never given back: what follows one can't stand in it
    pattern = rf"(?U)\A{between}(?:(?:{known})[{closing}]*+(?:[{space}]{between}|\z)){{0,3}}\z"
    return F.rlike(F.lower(F.coalesce(_col(value), F.lit(""))), F.lit(pattern))


def is_filler(value: Column | str, words: Iterable[str] = K.FILLER_WORDS) -> Column:
    bare = F.regexp_replace(_col(value), "^[ ।.?!,]+|[ ।.?!,]+$", "")
    return F.lower(bare).isin(list(words))


def is_employee(speaker: Column | str) -> Column:
    return F.lower(strip(speaker)).isin(list(K.EMPLOYEE_LABELS))


def binary_speaker(speaker: Column | str) -> Column:
    return F.when(F.lower(strip(speaker)) == "employee", "Employee").otherwise("Customer")


def normalise_role(raw: Column | str, swap: bool = False, aliases: dict[str, str] = K.ROLE_ALIASES) -> Column:
    label = strip(raw)
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    role = F.coalesce(F.try_element_at(table, F.lower(label)), label)
    if swap:
        role = (F.when(role == "Employee", "Customer")
                .when(role == "Customer", "Employee").otherwise(role))
    return role


def spoken_duration(ms: Column | str) -> Column:
    """Milliseconds the way they are said: seconds below ninety, minutes above."""
    sec = F.bround(_col(ms) / 1000.0).cast("bigint")
    minutes, rest = F.floor(sec / 60).cast("bigint"), sec % 60
    return (F.when(_col(ms).isNull(), "unknown")
            .when(sec < 90, F.format_string("%d sec", sec))
            .when(rest == 0, F.format_string("%d min", minutes))
            .otherwise(F.format_string("%d min %d sec", minutes, rest)))


def clock(ms: Column | str) -> Column:
    """``HH:MM:SS.mmm``."""
    value = _col(ms).cast("bigint")
    part = lambda size: F.floor(value / size).cast("bigint")
    return F.when(value.isNotNull(), F.format_string(
        "%02d:%02d:%02d.%03d", part(3_600_000), part(60_000) % 60, part(1000) % 60, value % 1000))

