"""The unified run log: pipeline and job runs with names, durations and row counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import elapsed_seconds
from siltstone.operators.join import join_to_unique
from siltstone.operators.latest import latest_per_key
from siltstone.operators.merge import merge_on_change, unique_by
from siltstone.operators.snapshot import BUCKET, KeyedSnapshot
from siltstone.sources.scan import readable

# Labels, event filter and JSON fields of the log's inputs.
PIPELINE, JOB = "PIPELINE", "JOB"
FLOW_PROGRESS, COMPLETED = "flow_progress", "COMPLETED"
DETAILS = "flow_progress STRUCT<status: STRING, metrics: STRUCT<num_output_rows: STRING>>"
STATUS, OUTPUT_ROWS = "$.flow_progress.status", "$.flow_progress.metrics.num_output_rows"
EVENT_LOG = "origin STRUCT<pipeline_id: STRING, update_id: STRING>, event_type STRING, details STRING"
LOOKBACK_DAYS = 30
NEWEST = 20

# The table's columns, its key and what a changed run refreshes.
RUN_LOG = (
    T.StructType()
    .add("run_type", T.StringType())
    .add("id", T.StringType())
    .add("name", T.StringType())
    .add("run_id", T.StringType())
    .add("status", T.StringType())
    .add("start_time", T.TimestampType())
    .add("end_time", T.TimestampType())
    .add("duration_seconds", T.LongType())
    .add("total_rows_processed", T.LongType())
)
RUN_KEY = ("id", "run_id")
REFRESHED = ("status", "end_time", "duration_seconds", "total_rows_processed")


def started_since(
    timeline: DataFrame, lookback_days: int = LOOKBACK_DAYS, as_of: datetime | None = None
) -> DataFrame:
    """Periods that started less than ``lookback_days`` before ``as_of`` (now if not given)."""
    return timeline.filter(F.col("period_start_time") > _cutoff(timeline, lookback_days, as_of))


def _cutoff(timeline: DataFrame, lookback_days: int, as_of: datetime | None) -> Column:
    """Where the lookback begins, in the type of the column, so that a filter by it reaches the scan."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    begin = now - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    return begin.cast(timeline.schema["period_start_time"].dataType)


def active_ids(
    timeline: DataFrame, id_column: str, lookback_days: int = LOOKBACK_DAYS, as_of: datetime | None = None
) -> DataFrame:
    """Distinct ids with a period that started within the lookback, finished or not."""
    return started_since(timeline, lookback_days, as_of).select(id_column).distinct()


def latest_names(versions: DataFrame, id_column: str) -> DataFrame:
    """The newest ``name`` per workspace and id; the greater name if two changed at once."""
    named = versions.select("workspace_id", id_column, "name", "change_time")
    return latest_per_key(named, ["workspace_id", id_column], [F.col("change_time")], tie_break=["name"]).drop(
        "change_time"
    )


def runs_of(
    timeline: DataFrame,
    versions: DataFrame,
    run_type: str,
    id_column: str,
    run_column: str,
    lookback_days: int = LOOKBACK_DAYS,
    as_of: datetime | None = None,
    whole_runs: bool = False,
) -> DataFrame:
    """Finished runs within the lookback, with the latest name of what was run.

    A run that spans several periods is represented by the finishing one, whose
    duration it then shows; ``whole_runs`` measures from the first start of any
    of its periods to the last end instead.
    """
    keys = ["workspace_id", id_column, run_column]
    periods = timeline.select(*keys, "result_state", "period_start_time", "period_end_time")
    start = F.col("period_start_time")
    before = start <= _cutoff(periods, lookback_days, as_of)
    earlier = periods.filter(before).select(*(F.col(k).alias(f"_{k}") for k in keys))
    if whole_runs:
        last_state = F.max(F.when(F.col("result_state").isNotNull(), F.struct("period_end_time", "result_state")))
        periods = periods.filter(~before | start.isNull()).groupBy(*keys).agg(
            last_state["result_state"].alias("result_state"),
            F.min("period_start_time").alias("period_start_time"),
            F.max("period_end_time").alias("period_end_time"),
        )
    finished = started_since(periods, lookback_days, as_of).filter(F.col("result_state").isNotNull())
    if whole_runs:
        # A run that began before the lookback goes whole.  Of all older periods only those of the few runs left are kept.
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        finished = finished.join(earlier.join(finished.select(*keys), same, "left_semi"), same, "left_anti")
    named = join_to_unique(finished, latest_names(versions, id_column), ["workspace_id", id_column], "left")
    return named.select(
        F.lit(run_type).alias("run_type"),
        F.col(id_column).alias("id"),
        "name",
        F.col(run_column).alias("run_id"),
        F.col("result_state").alias("status"),
        F.col("period_start_time").alias("start_time"),
        F.col("period_end_time").alias("end_time"),
        elapsed_seconds(F.col("period_start_time"), F.col("period_end_time")).alias("duration_seconds"),
    )


def pipeline_runs(timeline: DataFrame, pipelines: DataFrame, **options) -> DataFrame:
    return runs_of(timeline, pipelines, PIPELINE, "pipeline_id", "update_id", **options)


def job_runs(timeline: DataFrame, jobs: DataFrame, **options) -> DataFrame:
    return runs_of(timeline, jobs, JOB, "job_id", "run_id", **options)


def row_counts(event_log: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """Rows written per pipeline update, from the completed flow events.

    One scan of the whole log, summed per task before the shuffle.  ``active``
    restricts the result to the ids it holds; as they are grouping keys, Spark
    may apply that before or after the sum.  Documents are text, or variants as
    ``with_variants`` stores them, which are not parsed again.
    """
    details, events = F.col("details"), event_log.filter(F.col("event_type") == FLOW_PROGRESS)
    if isinstance(event_log.schema["details"].dataType, T.VariantType):
        done = events.filter(F.try_variant_get(details, STATUS, "string") == COMPLETED)
        rows = F.try_variant_get(details, OUTPUT_ROWS, "string")
    else:
        # Text that neither holds the word nor an escape cannot parse to it.
        events = events.filter(details.contains(COMPLETED) | details.contains("\\"))
        # Put out by a generator, the parsed document cannot be parsed again for the filter.
        parsed = events.select("origin", F.inline(F.array(F.from_json(details, DETAILS))))
        done = parsed.filter(F.col("flow_progress.status") == COMPLETED)
        rows = F.col("flow_progress.metrics.num_output_rows")
    counts = done.groupBy(
        F.col("origin.pipeline_id").alias("pipeline_id"), F.col("origin.update_id").alias("update_id")
    ).agg(F.sum(rows.try_cast("bigint")).alias("total_rows_processed"))
    return counts if active is None else join_to_unique(counts, active, ["pipeline_id"], "left_semi")


def with_variants(event_log: DataFrame) -> DataFrame:
    """The log with its documents parsed once and for all; text that is no document stays in ``malformed``."""
    parsed = event_log.withColumn("_parsed", F.try_parse_json("details"))
    malformed = F.when(F.col("_parsed").isNull(), F.col("details"))
    return parsed.select(
        *(F.col("_parsed").alias(c) if c == "details" else F.col(c) for c in event_log.columns), malformed.alias("malformed")
    )


def read_event_logs(spark: SparkSession, logs: Sequence[str], columns: str = EVENT_LOG) -> tuple[DataFrame | None, DataFrame]:
    """The events of all parquet logs that can be read, and a table of those that cannot (``source``, ``reason``).

    A log is a file or a folder, such as that of one pipeline.
    """
    return readable(spark, logs, lambda paths: spark.read.schema(columns).parquet(*paths))


def with_row_counts(runs: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Attach the counts of pipeline updates; a null column if there are none to attach."""
    if counts is None:
        return runs.withColumn("total_rows_processed", F.lit(None).cast("bigint"))
    r, c = runs.alias("r"), counts.alias("c")
    same_run = (F.col("r.id") == F.col("c.pipeline_id")) & (F.col("r.run_id") == F.col("c.update_id"))
    return r.join(c, same_run, "left").select("r.*", "c.total_rows_processed")


def unified_runs(
    pipeline_timeline: DataFrame,
    pipelines: DataFrame,
    job_timeline: DataFrame,
    jobs: DataFrame,
    event_log: DataFrame | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    as_of: datetime | None = None,
    whole_runs: bool = False,
) -> DataFrame:
    """Pipeline and job runs in one layout.  ``event_log=None`` leaves the row counts empty."""
    options = {"lookback_days": lookback_days, "as_of": as_of, "whole_runs": whole_runs}
    runs = pipeline_runs(pipeline_timeline, pipelines, **options).unionByName(job_runs(job_timeline, jobs, **options))
    if event_log is None:
        return with_row_counts(runs, None)
    active = active_ids(pipeline_timeline, "pipeline_id", lookback_days, as_of)
    return with_row_counts(runs, row_counts(event_log, active))


def merge_runs(target: DataFrame, source: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """``target`` after merging ``source``: changed status refreshes a run, new runs are added.

    The key is ``(id, run_id)``; ``extra_keys`` may add ``run_type``.
    """
    return merge_on_change(target, source, RUN_KEY, "status", REFRESHED, extra_keys)


def merge_into_run_log(
    spark: SparkSession,
    root: str,
    runs: DataFrame,
    extra_keys: Sequence[str] = (),
    buckets: int | None = None,
) -> KeyedSnapshot:
    """Merge ``runs`` into the run log at ``root``, creating it if need be."""
    keys = (*RUN_KEY, *extra_keys)
    table = KeyedSnapshot(spark, root, RUN_KEY, buckets)
    source = unique_by(runs.select(*(F.col(f.name).cast(f.dataType) for f in RUN_LOG.fields)), keys)

    def merge(current: DataFrame | None, changes: DataFrame) -> DataFrame:
        if current is None:
            return table.by_bucket(changes)
        return table.by_bucket(merge_on_change(current, changes, RUN_KEY, "status", REFRESHED, (BUCKET, *extra_keys)))

    table.apply(source, merge)
    return table


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    """The run log, empty if nothing was merged yet."""
    rows = KeyedSnapshot(spark, root, RUN_KEY).read()
    return spark.createDataFrame([], RUN_LOG) if rows is None else rows


def newest_runs(runs: DataFrame, limit: int = NEWEST) -> DataFrame:
    """The ``limit`` runs that started last."""
    return runs.orderBy(F.desc("start_time"), "run_type", "id", "run_id").limit(limit)
