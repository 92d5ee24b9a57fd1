"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "ag_1_day_rollup", "ag_4_metric_totals", "ag_8_span", "srt_5_leaderboard", "prj_20_disposition", "jn_3_resolve_agent",
    "win_1_merged_turns", "win_6_context_frames", "ag_14_metadata", "ag_15_talk_pattern", "jn_8_locate_phrases",
    "win_10_merged_neighbours", "win_12_deduped_flags", "scr_7_scores", "ag_20_token_cost", "ag_23_call_costs", "str_7_redact_phones",
)


def main() -> None:
    from talkgrain import catalog
    from talkgrain.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["ag_10_outstanding"](spark, folder).collect()
    timings = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):  # the first warms up
            begin = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        timings[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": scale}))


if __name__ == "__main__":
    main()
