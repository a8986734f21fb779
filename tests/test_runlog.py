from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.functions import elapsed_seconds
from siltstone.operators.union import union_frames
from siltstone.plans import runlog
from siltstone.session import scratch_dir, settings
from tests.conftest import plan, rows

NOW = datetime(2024, 1, 31)
DAY = timedelta(days=1)


def timeline(spark, *periods, key="pipeline_id", run="update_id"):
    """Periods ``(id, run, state, started, seconds)``, started in days before now."""
    data = [
        ("w", i, r, s, NOW - d * DAY, None if n is None else NOW - d * DAY + timedelta(seconds=n))
        for i, r, s, d, n in periods
    ]
    names = f"workspace_id string, {key} string, {run} string, result_state string"
    return spark.createDataFrame(data, f"{names}, period_start_time timestamp, period_end_time timestamp")


def versions(spark, *named, key="pipeline_id"):
    data = [("w", i, n, NOW - d * DAY) for i, n, d in named]
    return spark.createDataFrame(data, f"workspace_id string, {key} string, name string, change_time timestamp")


def events(spark, *found):
    data = [((p, u), kind, details) for p, u, kind, details in found]
    return spark.createDataFrame(data, "origin struct<pipeline_id:string,update_id:string>, event_type string, details string")


def progress(status, count):
    return f'{{"flow_progress": {{"status": "{status}", "metrics": {{"num_output_rows": {count}}}}}}}'


def test_lookback_excludes_its_edge_and_unfinished_runs(spark):
    t = timeline(
        spark, ("p", "in", "OK", 29.9, 1), ("p", "edge", "OK", 30, 1), ("p", "out", "OK", 31, 1), ("p", "open", None, 1, 1)
    )
    out = runlog.pipeline_runs(t, versions(spark, ("p", "n", 1)), as_of=NOW)
    assert rows(out, "run_id") == [("in",)]
    assert rows(runlog.active_ids(t, "pipeline_id", as_of=NOW)) == [("p",)]


def test_lookback_defaults_to_now(spark):
    t = timeline(spark, ("p", "1", "OK", 0, 1)).withColumn("period_start_time", F.current_timestamp())
    assert runlog.pipeline_runs(t, versions(spark, ("p", "n", 1))).count() == 1


def test_newest_name_wins_and_missing_name_is_null(spark):
    t = timeline(spark, ("p", "1", "OK", 1, 1), ("q", "2", "OK", 1, 1))
    names = versions(spark, ("p", "old", 9), ("p", "new", 1), ("p", "newer", 1))
    out = runlog.pipeline_runs(t, names, as_of=NOW)
    assert rows(out, "id", "name") == [("p", "newer"), ("q", None)]


def test_names_do_not_cross_workspaces(spark):
    t = timeline(spark, ("p", "1", "OK", 1, 1)).withColumn("workspace_id", F.lit("other"))
    assert runlog.pipeline_runs(t, versions(spark, ("p", "n", 1)), as_of=NOW).first().name is None


def test_run_of_several_periods(spark):
    t = timeline(spark, ("p", "1", None, 2, 3600), ("p", "1", "OK", 1, 60))
    names = versions(spark, ("p", "n", 1))
    assert rows(runlog.pipeline_runs(t, names, as_of=NOW), "duration_seconds") == [(60,)]
    whole = runlog.pipeline_runs(t, names, as_of=NOW, whole_runs=True)
    assert rows(whole, "status", "duration_seconds") == [("OK", 86460)]


def test_whole_runs_that_began_before_the_lookback_are_left_out(spark):
    t = timeline(
        spark, ("p", "long", None, 40, 3600), ("p", "long", "OK", 1, 60), ("p", "short", "OK", 2, 60), ("p", None, "OK", 31, 1),
        ("p", None, "OK", 1, 1),
    )
    whole = runlog.pipeline_runs(t, versions(spark, ("p", "n", 1)), as_of=NOW, whole_runs=True)
    assert rows(whole, "run_id") == [("short",)]
    scans = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in scans and "LeftSemi" in scans


def test_durations_are_whole_elapsed_seconds(spark):
    df = spark.sql(
        "select timestamp '2024-01-01 00:00:00.9' a, timestamp '2024-01-01 00:00:02.1' b union all select null, now()"
    )
    assert rows(df.select(elapsed_seconds(F.col("a"), F.col("b")))) == [(None,), (1,)]


def test_row_counts(spark):
    log = events(
        spark,
        ("p", "1", "flow_progress", progress("COMPLETED", 5)),
        ("p", "1", "flow_progress", progress("COMPLETED", '"7"')),
        ("p", "1", "flow_progress", progress("COMPLETED", '"many"')),
        ("p", "1", "flow_progress", progress("RUNNING", 100)),
        ("p", "1", "other", progress("COMPLETED", 100)),
        ("p", "2", "flow_progress", progress("COMPLETED", "null")),
        ("p", "3", "flow_progress", progress("\\u0043OMPLETED", 9)),
        ("p", "4", "flow_progress", "no json"),
        ("p", "4", "flow_progress", None),
        ("q", "1", "flow_progress", progress("COMPLETED", 1)),
    )
    active = spark.createDataFrame([("p",)], "pipeline_id string")
    assert rows(runlog.row_counts(log, active)) == [("p", "1", 12), ("p", "2", None), ("p", "3", 9)]
    assert runlog.row_counts(log).count() == 4


def test_event_documents_are_parsed_once(spark, tmp_path):
    events(spark, ("p", "1", "flow_progress", progress("COMPLETED", 5))).write.parquet(f"{tmp_path}/log")
    steps = plan(runlog.row_counts(spark.read.parquet(f"{tmp_path}/log")))
    assert steps.count("from_json") == 1 and "EqualTo(event_type,flow_progress)" in steps


def test_odd_event_documents_count_nothing(spark):
    odd = ["{", "[]", '"COMPLETED"', '{"flow_progress":"COMPLETED"}', '{"flow_progress":{"status":["COMPLETED"]}}', ""]
    log = events(spark, *(("p", str(i), "flow_progress", text) for i, text in enumerate(odd)))
    assert runlog.row_counts(log).count() == 0


def test_counts_attach_to_pipeline_runs_only_by_both_keys(spark):
    t = timeline(spark, ("p", "1", "OK", 1, 1), ("p", "2", "OK", 1, 1))
    j = timeline(spark, ("j", "1", "OK", 1, 1), key="job_id", run="run_id")
    out = runlog.unified_runs(
        t, versions(spark, ("p", "n", 1)), j, versions(spark, ("j", "m", 1), key="job_id"),
        events(spark, ("p", "1", "flow_progress", progress("COMPLETED", 5))), as_of=NOW,
    )
    assert rows(out, "run_type", "id", "run_id", "total_rows_processed") == [
        ("JOB", "j", "1", None), ("PIPELINE", "p", "1", 5), ("PIPELINE", "p", "2", None)]
    assert out.columns == [f.name for f in runlog.RUN_LOG.fields]


def test_event_type_and_start_time_reach_the_scan(spark, tmp_path):
    events(spark, ("p", "1", "flow_progress", "{}")).write.parquet(f"{tmp_path}/e")
    timeline(spark, ("p", "1", "OK", 1, 1)).write.parquet(f"{tmp_path}/t")
    assert "EqualTo(event_type,flow_progress)" in plan(runlog.row_counts(spark.read.parquet(f"{tmp_path}/e")))
    recent = plan(runlog.active_ids(spark.read.parquet(f"{tmp_path}/t"), "pipeline_id", as_of=NOW))
    assert "GreaterThan(period_start_time" in recent and "ReadSchema: struct<pipeline_id:string" in recent


def test_a_pipeline_with_most_runs_is_split(spark):
    """The join to the names splits the partition of a hot pipeline instead of giving it to one task."""
    hot = F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 500).cast("string"))
    t = spark.range(0, 60000, 1, 8).select(
        F.lit("w").alias("workspace_id"),
        hot.alias("pipeline_id"),
        F.col("id").cast("string").alias("update_id"),
        F.lit("OK").alias("result_state"),
        F.lit(NOW - DAY).alias("period_start_time"),
        F.lit(NOW).alias("period_end_time"),
    )
    names = spark.range(500).select(
        F.lit("w").alias("workspace_id"),
        F.when(F.col("id") == 7, "hot").otherwise(F.col("id").cast("string")).alias("pipeline_id"),
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"),
        F.lit(NOW).alias("change_time"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with settings(spark, small):
        out = runlog.pipeline_runs(t, names, as_of=NOW)
        found = out.collect()
        steps = out._jdf.queryExecution().executedPlan().toString()
    assert len(found) == 60000 and sum(r.name == "name 7" for r in found) == 40000
    assert "SortMergeJoin(skew=true)" in steps


def run(kind, i, r, status, n=1, name="n"):
    return (kind, i, name, r, status, NOW, NOW, n, n)


def log(spark, *runs):
    return spark.createDataFrame(list(runs), runlog.RUN_LOG)


def test_merge_keeps_refreshes_and_adds(spark):
    root = scratch_dir(spark, "log")
    assert runlog.read_run_log(spark, root).count() == 0
    runlog.merge_into_run_log(spark, root, log(spark, run("JOB", "a", "1", "RUN"), run("JOB", "b", "1", "OK")), buckets=2)
    runlog.merge_into_run_log(
        spark, root,
        log(spark, run("JOB", "a", "1", "OK", 2, "x"), run("JOB", "b", "1", "OK", 2, "x"), run("JOB", "c", "1", "OK")),
    )
    table = runlog.read_run_log(spark, root)
    assert rows(table, "id", "status", "name", "duration_seconds") == [
        ("a", "OK", "n", 2), ("b", "OK", "n", 1), ("c", "OK", "n", 1)]
    assert [f.name for f in table.schema.fields if f.name in runlog.RUN_LOG.names] == table.columns


def test_same_numbers_of_a_job_and_a_pipeline(spark):
    both = log(spark, run("JOB", "a", "1", "OK"), run("PIPELINE", "a", "1", "OK"))
    with pytest.raises(PySparkException, match="several source rows"):
        runlog.merge_into_run_log(spark, scratch_dir(spark, "log"), both, buckets=2)
    root = scratch_dir(spark, "log")
    for _ in range(2):
        runlog.merge_into_run_log(spark, root, both, ["run_type"], 2)
    assert runlog.read_run_log(spark, root).count() == 2


def test_newest_runs_is_a_top_k(spark):
    out = runlog.newest_runs(log(spark, *(run("JOB", str(i), "1", "OK") for i in range(30))))
    assert out.count() == 20
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_union_of_frames(spark):
    a, b = spark.range(2), spark.range(2)
    assert union_frames([]) is None
    assert union_frames([a, b, a]).count() == 6
    c = spark.createDataFrame([(1, "x")], "n int, id string")
    assert union_frames([c, c.select("id", "n")], by_name=True).distinct().count() == 1


def test_broken_logs_are_left_out_and_named(spark, tmp_path):
    schema = "origin STRUCT<pipeline_id: STRING, update_id: STRING>, event_type STRING, details STRING"
    document = '{"flow_progress":{"status":"COMPLETED","metrics":{"num_output_rows":"5"}}}'
    for k in range(5):
        spark.createDataFrame([((str(k), "u"), "flow_progress", document)], schema).coalesce(1).write.parquet(f"{tmp_path}/{k}")
    (file,) = (tmp_path / "3").glob("*.parquet")
    file.write_bytes(file.read_bytes()[:-30])
    (tmp_path / "3" / f".{file.name}.crc").unlink(missing_ok=True)
    events, skipped = runlog.read_event_logs(spark, [f"{tmp_path}/{k}" for k in range(6)])
    assert sorted(r.source[-1] for r in skipped.collect()) == ["3", "5"] and all(r.reason for r in skipped.collect())
    assert {r.pipeline_id: r.total_rows_processed for r in runlog.row_counts(events).collect()} == {k: 5 for k in "0124"}
    events, skipped = runlog.read_event_logs(spark, [f"{tmp_path}/3"])
    assert events is None and skipped.count() == 1
    assert runlog.read_event_logs(spark, [])[0] is None
