"""Registered queries and the SQL each is checked with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from talkgrain.catalog.tables import VIEWS, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_STEPS: dict[str, str] = {name: view.duck for name, view in VIEWS.items()}


def step(name: str, sql: str) -> None:
    """A named step of the checks: SQL over views and earlier steps."""
    _STEPS[name] = sql.strip()


def again(prefix: str, names: list[str], other: dict[str, str]) -> None:
    """Steps once more, named ``s_<prefix>...``, that read each other and the ``other`` tables in place of their own."""
    swap = {name: f"s_{prefix}{name[2:]}" for name in names} | other
    for name in names:
        _STEPS[swap[name]] = re.sub(r"\b(" + "|".join(swap) + r")\b", lambda m: swap[m.group()], _STEPS[name])


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in _STEPS:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(_STEPS[name], seen)
            seen.append(name)
    return seen


def expand(sql: str) -> str:
    """The statement with every view and step it uses as a common table expression."""
    used = _needed(sql, [])
    if not used:
        return sql.strip()
    return "with " + ",\n".join(f"{name} as (\n{_STEPS[name]}\n)" for name in used) + "\n" + sql.strip()


def query(name: str, check: str | None = None):
    """Register a query over ``Inputs``; ``check`` is its SQL."""
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if check is not None:
            ORACLES[name] = expand(check)
        return build

    return register
