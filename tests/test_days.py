"""Days replaced one by one, and the state of the stall watch."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from talkgrain.sources import storage
from talkgrain.streaming import jobs


def table(spark, path):
    return sorted((r["date_key"], r["pk"], r["n"]) for r in spark.read.parquet(path).select(F.col("date_key").cast("string").alias("date_key"), "pk", "n").collect())


def told(manifest):
    return {r["date_key"]: (r["rows_written"], r["rows_deleted"], r["failed"]) for r in manifest.collect()}


def test_one_failing_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "days")
    frame = lambda rows: spark.createDataFrame(rows, "date_key string, pk string, n long")
    days = lambda *names: spark.createDataFrame([(n,) for n in names], "date_key string")
    first = [("2026-09-01", "a", 1), ("2026-09-01", "b", 2), ("2026-09-02", "a", 3), ("2026-09-03", "a", 4), ("2026-09-04", "a", 5)]
    assert told(storage.replace_days(frame(first), path, days("2026-09-01", "2026-09-02", "2026-09-03", "2026-09-04"))) == {
        "2026-09-01": (2, 0, False), "2026-09-02": (1, 0, False), "2026-09-03": (1, 0, False), "2026-09-04": (1, 0, False)}
    assert table(spark, path) == first
    # 01 gets fewer rows, 02 a bad one, 03 none; 04 isn't touched though a row of it comes along; 05 is new.
    fresh = frame([("2026-09-01", "a", 10), ("2026-09-02", "a", -1), ("2026-09-02", "c", 7), ("2026-09-04", "a", 99), ("2026-09-05", "z", 6)])
    manifest = storage.replace_days(fresh, path, days("2026-09-01", "2026-09-02", "2026-09-03", "2026-09-05", None), check=lambda rows: F.col("n") >= 0)
    assert told(manifest) == {"2026-09-01": (1, 2, False), "2026-09-02": (0, 0, True), "2026-09-03": (0, 1, False), "2026-09-05": (1, 0, False)}
    assert table(spark, path) == [("2026-09-01", "a", 10), ("2026-09-02", "a", 3), ("2026-09-04", "a", 5), ("2026-09-05", "z", 6)]
    assert spark.read.parquet(path + "/_manifest").count() == 8
    again = storage.replace_days(fresh, path, days("2026-09-05"))
    assert told(again) == {"2026-09-05": (1, 1, False)} and len(table(spark, path)) == 4


def test_a_touched_day_without_a_name_is_emptied(spark, tmp_path):
    path = str(tmp_path / "days")
    frame = lambda rows: spark.createDataFrame(rows, "date_key string, pk string, n long")
    storage.overwrite_days(frame([(None, "a", 1), ("2026-09-01", "a", 2), ("2026-09-02", "a", 3)]), path)
    storage.overwrite_days(frame([("2026-09-01", "b", 4)]), path, touched=frame([(None, "", 0), ("2026-09-01", "", 0), ("2026-09-01", "", 0)]))
    assert table(spark, path) == [("2026-09-01", "b", 4), ("2026-09-02", "a", 3)]


def test_stale_rows_are_of_touched_days(spark):
    frame = lambda rows: spark.createDataFrame(rows, "pk string, date_key string")
    stored, fresh = frame([("a", "d1"), ("b", "d1"), ("a", "d2")]), frame([("a", "d1")])
    assert [tuple(r) for r in storage.stale_rows(stored, fresh, touched=frame([("", "d1"), ("", "d1")])).collect()] == [("b", "d1")]
    assert storage.stale_rows(stored, fresh).count() == 2


def test_finished_calls_leave_the_state(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "call_id string, processing_status string, status_at timestamp"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    begin = datetime(2026, 9, 1)
    batches = [
        [(f"c{k}", "INGESTING", begin) for k in range(20)],
        [(f"c{k}", "PROCESSED", begin + timedelta(minutes=5)) for k in range(19)],  # c19 stalls
        [("z", "PROCESSED", begin + timedelta(days=2))], [("z", "PROCESSED", begin + timedelta(days=4))], [("z", "PROCESSED", begin + timedelta(days=6))],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{source}/b{k}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        query = jobs.stalled_ingests(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert [r["call_id"] for r in spark.read.schema("call_id string, since timestamp, failed_at timestamp").parquet(out).collect()] == ["c19"]
    seen = spark.read.format("statestore").option("stateVarName", "seen").load(str(tmp_path / "state"))
    assert {r["key"]["call_id"] for r in seen.collect()} <= {"z"}


def test_stalls_by_session(spark, tmp_path):
    """Any number of calls stays in the JVM; late, repeated and far apart changes count by their times, however they are dealt into batches."""
    schema = "call_id string, processing_status string, status_at timestamp"
    begin = datetime(2026, 9, 1)
    at = lambda minutes: begin + timedelta(minutes=minutes)
    end = [[("z", "PROCESSED", at(3000 * k))] for k in (1, 2)]
    rows = [("stuck", "INGESTING", at(0)), ("quick", "INGESTING", at(0)), ("quick", "PROCESSED", at(5)), ("again", "INGESTING", at(0)), ("again", "INGESTING", at(30)), ("late", "PROCESSED", at(9)),
            ("late", "INGESTING", at(4)), ("slow", "INGESTING", at(1)), ("slow", "PROCESSED", at(200)), ("tie", "INGESTING", at(2)), ("tie", "FAILED", at(2)), ("odd", None, at(2))]
    found = []
    for name, batches in (("one", [rows, *end]), ("two", [rows[:6], rows[6:], *end])):
        source, out = str(tmp_path / name / "in"), str(tmp_path / name / "out")
        for k, batch in enumerate(batches):
            spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{source}/b{k}")
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
            made = jobs.stalled_by_session(stream, delay="300 minutes")
            made.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / name / "state")).trigger(availableNow=True).start().awaitTermination()
        found.append(sorted((r["call_id"], r["since"], r["failed_at"]) for r in spark.read.schema("call_id string, since timestamp, failed_at timestamp").parquet(out).collect()))
    assert found[0] == found[1] == [("again", at(30), at(90)), ("slow", at(1), at(61)), ("stuck", at(0), at(60))]


def test_spans_read_only_their_days(spark, tmp_path):
    """A range is a filter on partitions, open or closed, and gives the sums of its days."""
    from talkgrain.operators import rollup

    numbers = {c: "double" if c == "score_sum" else "long" for c in rollup.SUMS}
    schema = "pk string, scope string, score_max double, score_min double, " + ", ".join(f"{c} {k}" for c, k in numbers.items()) + ", date_key string"
    rows = [(pk, "TEAM", 5.0 + d, 1.0 + d, *[float(d) if c == "score_sum" else d for c in rollup.SUMS], f"2026-01-0{d}") for pk in ("a", "b") for d in range(1, 8)]
    spark.createDataFrame(rows, schema).write.partitionBy("date_key").parquet(str(tmp_path / "days"))
    stored = spark.read.schema(schema).parquet(str(tmp_path / "days"))
    for start, end, days in (("2026-01-03", "2026-01-05", [3, 4, 5]), ("2026-01-06T10:00:00", None, [6, 7]), (None, "2026-01-02", [1, 2]), (None, None, range(1, 8))):
        out = rollup.span(stored, start, end, pk="b")
        plan = out._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
        assert (start is None or "date_key" in filters and f">= {start[:10]}" in filters) and (end is None or f"<= {end}" in filters)
        row = out.collect()
        assert len(row) == 1 and row[0]["days"] == len(days) and row[0]["total_calls"] == sum(days)
        assert row[0]["score_max"] == 5.0 + max(days) and row[0]["score_min"] == 1.0 + min(days) and row[0]["score_mean"] == 1.0


def test_section_span(spark):
    from talkgrain.operators import rollup

    rows = [("a", "2026-01-01", "bda_and_company_intro", 6.0, 2), ("a", "2026-01-02", "bda_and_company_intro", None, 1), ("a", "2026-01-02", "purpose_of_call", 3.0, 1), ("a", "2026-01-09", "purpose_of_call", 9.0, 1), ("a", "2026-01-01", "no_such", 1.0, 1)]
    metrics = spark.createDataFrame(rows, "pk string, date_key string, criterion string, metric_sum double, metric_count long")
    got = rollup.section_span(metrics, None, "2026-01-05").collect()
    assert [(r["pk"], r["section"], r["section_sum"], r["section_mean"], r["criteria"]) for r in got] == [("a", "introduction", 9.0, 5.0, 2)]


def test_means_of_spans_go_by_the_settled_sum(spark):
    from talkgrain.operators import rollup

    numbers = ", ".join(f"{c} {'double' if c == 'score_sum' else 'long'}" for c in rollup.SUMS)
    rows = [("a", "TEAM", 1.0, 1.0, *[0.1 if c == "score_sum" else 5 if d == 9 else 3 for c in rollup.SUMS], f"2026-01-1{d}") for d in range(10)]
    days = spark.createDataFrame(rows, f"pk string, scope string, score_max double, score_min double, {numbers}, date_key string").coalesce(1)
    row = rollup.span(days).first()
    assert (row["score_sum"], row["scored_calls"], row["score_mean"]) == (1.0, 32, 0.0313)  # 0.1 ten times adds up to a little less than 1
