"""Queries whose ordered steps all go the blocked way: every call counts as heavy, blocks are tiny."""

import pytest

import __spark_entry__ as spark_entry
from talkgrain.operators import flags
from talkgrain.plans import ordered, scan
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = ["win_1_merged_turns", "win_3_employee_stretches", "win_5_longest_monologue", "win_6_context_frames", "str_12_numbered_transcript"]


@pytest.mark.parametrize("name", NAMES)
def test_blocked_way_agrees(spark, monkeypatch, name):
    monkeypatch.setattr(ordered.by_size, "__defaults__", (ordered.AUTO, 8, 3))
    build, sql = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    assert compare(spark, connect(FOLDER), FOLDER, build, sql) == ""


@pytest.mark.parametrize("name", ["win_10_merged_neighbours", "win_11_with_scan_flags", "win_12_deduped_flags", "jn_10_carry_over"])
def test_scans_in_small_blocks_agree(spark, monkeypatch, name):
    for work in (flags.merge_neighbours, flags.dedupe_flags, flags.carry_over):
        monkeypatch.setattr(work, "__defaults__", tuple(5 if d == scan.WIDTH else d for d in work.__defaults__))
    build, sql = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    assert compare(spark, connect(FOLDER), FOLDER, build, sql) == ""
