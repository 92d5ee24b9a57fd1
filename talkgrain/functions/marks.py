"""Marking-scheme expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain import constants as K


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _lookup(table: dict, key: Column, kind: str) -> Column:
    literal = F.create_map(*[x for k, v in table.items()
                             for x in (F.lit(k), F.array(*map(F.lit, v)) if kind == "array" else F.lit(v))])
    return F.try_element_at(literal, key)


def full_marks(criterion: Column | str) -> Column:
    return _lookup(K.CRITERION_MAX, _col(criterion), "int").cast("bigint")


def section_of(criterion: Column | str) -> Column:
    return _lookup(K.CRITERION_SECTION, _col(criterion), "text")


def bands_of(criterion: Column | str) -> Column:
    return _lookup(K.CRITERION_BANDS, _col(criterion), "array")


def step_down(criterion: Column | str, marks: Column | str, steps: Column | str) -> Column:
    """Marks moved down the criterion's ladder, snapped down onto it first; never below 0."""
    bands = bands_of(criterion)
    longest = max(map(len, K.CRITERION_BANDS.values()))
    below = [F.coalesce((F.get(bands, F.lit(i)) <= _col(marks)).cast("int"), F.lit(0)) for i in range(longest)]
    rungs = F.greatest(sum(below[1:], below[0]), F.lit(1))
    place = F.greatest(rungs - F.greatest(_col(steps), F.lit(0)), F.lit(1))
    return F.try_element_at(bands, place.cast("int")).cast("bigint")


def score_band(score: Column | str) -> Column:
    value = _col(score)
    result = F.when(value.isNull(), "")
    for floor, name in K.SCORE_BANDS:
        result = result.when(value >= floor, name)
    return result.otherwise(K.LOWEST_BAND)


def two_way_advice(long_stretches: Column | str) -> Column:
    """Advisory mark for the two-way line; never merged into a scorecard."""
    table = F.array(*map(F.lit, K.TWO_WAY_BY_LONG_STRETCHES))
    last = len(K.TWO_WAY_BY_LONG_STRETCHES)
    return F.element_at(table, F.least(_col(long_stretches) + 1, F.lit(last)).cast("int")).cast("bigint")


def severity_rank(severity: Column | str) -> Column:
    """0, 1, 2 for low, medium, high; NULL for anything else."""
    found = F.array_position(F.array(*map(F.lit, K.SEVERITIES)), F.lower(F.trim(_col(severity))))
    return F.nullif(found, F.lit(0).cast("bigint")) - 1


def severity_name(rank: Column | str) -> Column:
    return F.try_element_at(F.array(*map(F.lit, K.SEVERITIES)), (_col(rank) + 1).cast("int"))
