"""Command line: compare queries with their checks.  ``run_checks.py FOLDER [name prefix ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    import __spark_entry__ as spark_entry
    from talkgrain.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, build in spark_entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            sql = spark_entry.oracle_sql().get(name)
            if sql is None:
                said = f"no check, {len(build(spark, folder).collect())} rows"
                print(f"{name}: {said} ({time.time() - begin:.1f}s)", flush=True)
                continue
            said = compare(spark, con, folder, build, sql)
        except Exception as problem:  # noqa: BLE001
            said = f"{type(problem).__name__}: {str(problem)[:700]}"
        bad += bool(said)
        print(f"{name}: {'ok' if not said else 'DIFFERS ' + said} ({time.time() - begin:.1f}s)", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
