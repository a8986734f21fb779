"""The run log, step by step and as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries import tables as t
from queries.tables import comparable, read
from siltstone.functions import elapsed_seconds
from siltstone.operators.union import union_frames
from siltstone.plans import runlog
from siltstone.session import scratch_dir

_RECENT = {"lookback_days": t.LOOKBACK_DAYS, "as_of": t.AS_OF}
_RECENT_JOBS = {"lookback_days": t.JOB_LOOKBACK_DAYS, "as_of": t.AS_OF}


def _unified(spark: SparkSession, sf_dir: str, counts: bool = True, **window) -> DataFrame:
    return runlog.unified_runs(
        t.pipeline_timeline(spark, sf_dir),
        t.pipelines(spark, sf_dir),
        t.job_timeline(spark, sf_dir),
        t.jobs(spark, sf_dir),
        t.event_log(spark, sf_dir) if counts else None,
        **(window or _RECENT),
    )


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.active_ids(t.pipeline_timeline(spark, sf_dir), "pipeline_id", **_RECENT)


def latest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dimensions in one result."""
    pipelines = runlog.latest_names(t.pipelines(spark, sf_dir), "pipeline_id")
    jobs = runlog.latest_names(t.jobs(spark, sf_dir), "job_id")
    layout = ["workspace_id", "id", "name"]
    return (
        pipelines.toDF(*layout).withColumn("run_type", F.lit("PIPELINE"))
        .unionByName(jobs.toDF(*layout).withColumn("run_type", F.lit("JOB")))
    )


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.pipeline_runs(t.pipeline_timeline(spark, sf_dir), t.pipelines(spark, sf_dir), **_RECENT)


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.job_runs(t.job_timeline(spark, sf_dir), t.jobs(spark, sf_dir), **_RECENT_JOBS)


def whole_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events of one day as the periods of one run."""
    periods = t.job_timeline(spark, sf_dir).withColumn("run_id", F.date_format("period_start_time", "yyyy-MM-dd"))
    return runlog.job_runs(periods, t.jobs(spark, sf_dir), whole_runs=True, **_RECENT_JOBS)


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds from each event to a fractional time after it; none where the end is missing."""
    end = F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    events = read(spark, sf_dir, "events")
    ended = F.when(F.col("event_type") != "click", end)
    return events.select("event_id", elapsed_seconds(F.col("ts"), ended).alias("duration_seconds"))


def counts_past_broken_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log per eighth of the pipelines, and two that are no logs: they are left out, named, and cost no other count."""
    root = scratch_dir(spark, "runlog_broken")
    log = t.event_log(spark, sf_dir).withColumn("part", F.pmod(F.col("origin.update_id").cast("bigint"), F.lit(8)))
    log.write.partitionBy("part").parquet(f"{root}/log")
    for name in ("part=broken", "part=other"):
        read(spark, sf_dir, "region").select("r_name").coalesce(1).write.text(f"{root}/log/{name}")
    sources = [f"{root}/log/part={k}" for k in (0, 1, 2, "broken", 3, 4, 5, 6, 7, "other", "absent")]
    events, skipped = runlog.read_event_logs(spark, sources)
    named = skipped.agg(F.count_if(F.length("reason") > 0).alias("skipped"))
    active_ids = runlog.active_ids(t.pipeline_timeline(spark, sf_dir), "pipeline_id", **_RECENT)
    return runlog.row_counts(events, active_ids).withColumn("skipped", F.lit(named.first()[0]).cast("bigint"))


def counts_of_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log stored with parsed documents, one of seven malformed."""
    root = scratch_dir(spark, "runlog_variants")
    log = t.event_log(spark, sf_dir)
    malformed = F.pmod(F.col("origin.update_id").cast("bigint"), F.lit(7)) == 0
    details = F.when(malformed, F.concat(F.lit("{"), "details")).otherwise(F.col("details"))
    runlog.with_variants(log.withColumn("details", details)).write.parquet(root)
    stored = spark.read.parquet(root)
    lost = stored.agg(F.count_if(F.col("malformed").isNotNull())).first()[0]
    return runlog.row_counts(stored).withColumn("malformed", F.lit(lost).cast("bigint"))


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    active_ids = runlog.active_ids(t.pipeline_timeline(spark, sf_dir), "pipeline_id", **_RECENT)
    return runlog.row_counts(t.event_log(spark, sf_dir), active_ids)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem in slices, put back together."""
    lines = read(spark, sf_dir, "lineitem")
    return union_frames([lines.filter(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")])


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir)


def without_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir, counts=False)


def _changed_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The log as it was built earlier, and as it is built now.

    In between, the runs that started before the earlier time have had their
    state corrected: what had failed was completed after all.
    """
    now = _unified(spark, sf_dir)
    earlier = _unified(spark, sf_dir, lookback_days=t.LOOKBACK_DAYS, as_of=t.AS_OF_EARLIER)
    # Started less than a lookback before the earlier time, but not after it.
    known = earlier.filter(F.col("start_time") <= F.lit(t.AS_OF_EARLIER).cast("timestamp_ntz"))
    corrected = now.withColumns(
        {
            "status": F.when(F.col("status") == "FAILED", "COMPLETED").otherwise(F.col("status")),
            "name": F.concat(F.lit("renamed "), F.col("name")),
            "duration_seconds": F.col("duration_seconds") + 1,
        }
    )
    return [known, corrected]


_LOG_KEYS = ["run_type"]


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier log, then the later one merged into it.

    Pipeline and job runs may share both numbers here, so the run type joins
    the key.
    """
    root = scratch_dir(spark, "runlog_merge")
    for runs in _changed_runs(spark, sf_dir):
        runlog.merge_into_run_log(spark, root, runs, _LOG_KEYS, t.BUCKETS)
    return comparable(runlog.read_run_log(spark, root))


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.newest_runs(_unified(spark, sf_dir))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).agg(F.count("*").alias("total_rows"))


_SINCE = f"TIMESTAMP '{t.AS_OF}' - INTERVAL {t.LOOKBACK_DAYS} DAY"
_SINCE_JOBS = f"TIMESTAMP '{t.AS_OF}' - INTERVAL {t.JOB_LOOKBACK_DAYS} DAY"
_SINCE_EARLIER = f"TIMESTAMP '{t.AS_OF_EARLIER}' - INTERVAL {t.LOOKBACK_DAYS} DAY"


def _runs_sql(kind: str, since: str) -> str:
    timeline, dim, key, run = {
        "PIPELINE": ("pipeline_timeline", "latest_pipelines", "pipeline_id", "update_id"),
        "JOB": ("job_timeline", "latest_jobs", "job_id", "run_id"),
    }[kind]
    return f"""
      SELECT '{kind}' AS run_type, x.{key} AS id, d.name, x.{run} AS run_id, x.result_state AS status,
             x.period_start_time AS start_time, x.period_end_time AS end_time,
             date_sub('second', x.period_start_time, x.period_end_time) AS duration_seconds
      FROM {timeline} x LEFT JOIN {dim} d ON x.{key} = d.{key} AND x.workspace_id = d.workspace_id
      WHERE x.result_state IS NOT NULL AND x.period_start_time > {since}"""


_ROLES = f"WITH {t.PIPELINE_TIMELINE_SQL}, {t.JOB_TIMELINE_SQL}, {t.VERSIONS_SQL}, {t.EVENT_LOG_SQL}"
_COUNTS = f"""
  SELECT pipeline_id, update_id,
         CAST(sum(TRY_CAST(json_extract_string(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT)) AS BIGINT)
           AS total_rows_processed
  FROM event_log
  WHERE event_type = 'flow_progress' AND json_extract_string(details, '$.flow_progress.status') = 'COMPLETED'
    AND pipeline_id IN (SELECT pipeline_id FROM pipeline_timeline WHERE period_start_time > {_SINCE})
  GROUP BY pipeline_id, update_id"""


def _unified_sql(since: str) -> str:
    return f"""
      SELECT u.*, c.total_rows_processed
      FROM ({_runs_sql("PIPELINE", since)} UNION ALL {_runs_sql("JOB", since)}) u
      LEFT JOIN row_counts c ON u.id = c.pipeline_id AND u.run_id = c.update_id"""


_WITH_COUNTS = f"{_ROLES}, row_counts AS ({_COUNTS})"

QUERIES = {
    "active_pipelines": active,
    "runlog_latest_names": latest_names,
    "runlog_pipeline_runs": pipeline_runs,
    "runlog_job_runs": job_runs,
    "runlog_whole_runs": whole_runs,
    "runlog_durations": durations,
    "runlog_row_counts": row_counts,
    "runlog_broken_logs": counts_past_broken_logs,
    "runlog_variant_counts": counts_of_variants,
    "union_frames": frames,
    "runlog_unified": unified,
    "runlog_no_counts": without_counts,
    "runlog_merge": merged,
    "runlog_recent": recent,
    "runlog_counts": counts,
}

ORACLE = {
    "active_pipelines": f"""
        WITH {t.PIPELINE_TIMELINE_SQL}
        SELECT DISTINCT pipeline_id FROM pipeline_timeline WHERE period_start_time > {_SINCE}""",
    "runlog_latest_names": f"""
        WITH {t.VERSIONS_SQL}
        SELECT workspace_id, pipeline_id AS id, name, 'PIPELINE' AS run_type FROM latest_pipelines
        UNION ALL SELECT workspace_id, job_id, name, 'JOB' FROM latest_jobs""",
    "runlog_pipeline_runs": f"{_ROLES} {_runs_sql('PIPELINE', _SINCE)}",
    "runlog_job_runs": f"{_ROLES} {_runs_sql('JOB', _SINCE_JOBS)}",
    "runlog_whole_runs": f"""
        WITH {t.JOB_TIMELINE_SQL}, {t.VERSIONS_SQL},
        whole AS (
          SELECT job_id, strftime(period_start_time, '%Y-%m-%d') AS run_id, min(period_start_time) AS start_time,
                 max(period_end_time) AS end_time,
                 (max({{'e': period_end_time, 's': result_state}}) FILTER (WHERE result_state IS NOT NULL)).s AS status
          FROM job_timeline GROUP BY ALL)
        SELECT 'JOB' AS run_type, w.job_id AS id, d.name, w.run_id, w.status, w.start_time, w.end_time,
               date_sub('second', w.start_time, w.end_time) AS duration_seconds
        FROM whole w LEFT JOIN latest_jobs d ON w.job_id = d.job_id
        WHERE w.status IS NOT NULL AND w.start_time > {_SINCE_JOBS}""",
    "runlog_durations": """
        SELECT event_id,
               date_sub('second', ts, CASE WHEN event_type <> 'click'
                 THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END) AS duration_seconds
        FROM events""",
    "runlog_row_counts": f"{_ROLES} {_COUNTS}",
    "runlog_broken_logs": f"{_ROLES} SELECT *, 3::BIGINT AS skipped FROM ({_COUNTS})",
    "runlog_variant_counts": f"""{_ROLES}
        SELECT pipeline_id, update_id,
               CAST(sum(TRY_CAST(json_extract_string(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT)) AS BIGINT)
                 AS total_rows_processed,
               (SELECT count(*) FROM lineitem WHERE l_orderkey % 7 = 0) AS malformed
        FROM event_log
        WHERE event_type = 'flow_progress' AND CAST(update_id AS BIGINT) % 7 <> 0
          AND json_extract_string(details, '$.flow_progress.status') = 'COMPLETED'
        GROUP BY pipeline_id, update_id""",
    "union_frames": "SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R')",
    "runlog_unified": f"{_WITH_COUNTS} {_unified_sql(_SINCE)}",
    "runlog_no_counts": f"""{_ROLES}
        SELECT *, CAST(NULL AS BIGINT) AS total_rows_processed
        FROM ({_runs_sql("PIPELINE", _SINCE)} UNION ALL {_runs_sql("JOB", _SINCE)})""",
    "runlog_merge": f"""{_WITH_COUNTS},
        target AS (SELECT * FROM ({_unified_sql(_SINCE_EARLIER)}) WHERE start_time <= TIMESTAMP '{t.AS_OF_EARLIER}'),
        source AS (
          SELECT * REPLACE (CASE WHEN status = 'FAILED' THEN 'COMPLETED' ELSE status END AS status,
                            'renamed ' || name AS name, duration_seconds + 1 AS duration_seconds)
          FROM ({_unified_sql(_SINCE)})),
        both_sides AS (
          SELECT t AS old, s AS new
          FROM target t FULL OUTER JOIN source s ON t.id = s.id AND t.run_id = s.run_id AND t.run_type = s.run_type)
        SELECT coalesce(old.run_type, new.run_type) AS run_type, coalesce(old.id, new.id) AS id,
               CASE WHEN old.id IS NULL THEN new.name ELSE old.name END AS name,
               coalesce(old.run_id, new.run_id) AS run_id,
               CASE WHEN old.id IS NULL OR new.status <> old.status THEN new.status ELSE old.status END AS status,
               coalesce(old.start_time, new.start_time) AS start_time,
               CASE WHEN old.id IS NULL OR new.status <> old.status THEN new.end_time ELSE old.end_time END AS end_time,
               CASE WHEN old.id IS NULL OR new.status <> old.status THEN new.duration_seconds
                    ELSE old.duration_seconds END AS duration_seconds,
               CASE WHEN old.id IS NULL OR new.status <> old.status THEN new.total_rows_processed
                    ELSE old.total_rows_processed END AS total_rows_processed
        FROM both_sides""",
    "runlog_recent": f"""{_WITH_COUNTS}
        SELECT * FROM ({_unified_sql(_SINCE)}) ORDER BY start_time DESC, run_type, id, run_id LIMIT 20""",
    "runlog_counts": f"{_WITH_COUNTS} SELECT count(*) AS total_rows FROM ({_unified_sql(_SINCE)})",
}
