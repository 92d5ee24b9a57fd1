"""Registered queries over the driver tables and their checks."""

from talkgrain.catalog import chain, conversation, flags, ledger, log, report, rollups, scoring, streams  # noqa: F401
from talkgrain.catalog.registry import ORACLES, QUERIES  # noqa: F401
