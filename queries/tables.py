"""The given tables, and the roles they play as raw input, timelines and logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Of every keyed table made here: about one per gigabyte, were it a real one.
BUCKETS = 8


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the checking engine holds them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


def spec(table: str, source_table: str, columns: list[dict], keys: list[str], **rest) -> dict:
    """A one-table spec as a YAML file would hold it."""
    bronze = {"source_table": source_table} | rest.pop("bronze", {})
    silver = {"primary_keys": keys} | rest.pop("silver", {})
    return {"tables": {table: {"bronze": bronze, "silver": silver, "columns": columns}}}


def column(name: str, kind: str, source: str | None = None, trim: bool = True, markers=None, fmt=None) -> dict:
    raw = {"name": name, "source": source or name, "type": kind, "cleansing": {"trim": trim}}
    if markers is not None:
        raw["cleansing"]["null_markers"] = markers
    if fmt:
        raw["format"] = fmt
    return raw


CUSTOMER_COLUMNS = [
    column("c_custkey", "long"),
    column("c_name", "string"),
    column("c_nationkey", "integer"),
    column("c_acctbal", "double"),
    column("c_mktsegment", "string"),
]
SUPPLIER_COLUMNS = [
    column("s_suppkey", "long"),
    column("s_name", "string"),
    column("s_nationkey", "integer"),
    column("s_acctbal", "double"),
]

# Run log roles.  One clock for both timelines; the lookback keeps the later
# part of the pipeline runs and all of the job runs.
AS_OF = datetime(2024, 1, 31)
LOOKBACK_DAYS = 9800
AS_OF_EARLIER = datetime(2024, 1, 16)
JOB_LOOKBACK_DAYS = 20


def pipeline_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    state = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "FAILED")
    return read(spark, sf_dir, "orders").select(
        F.lit("1").alias("workspace_id"),
        (key % 50).cast("string").alias("pipeline_id"),
        key.cast("string").alias("update_id"),
        state.alias("result_state"),
        F.col("o_orderdate").alias("period_start_time"),
        _later(F.col("o_orderdate"), key % 3600).alias("period_end_time"),
    )


def job_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").select(
        F.lit("1").alias("workspace_id"),
        F.col("user_id").cast("string").alias("job_id"),
        F.col("event_id").cast("string").alias("run_id"),
        F.when(kind == "error", "FAILED").when(kind != "signup", "COMPLETED").alias("result_state"),
        F.col("ts").alias("period_start_time"),
        _later(F.col("ts"), F.floor("value")).alias("period_end_time"),
    )


def pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of 45 of the 50 pipelines; the others have no name."""
    return _versions(spark, sf_dir, "pipeline_id", 45)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir, "job_id", 140)


def _versions(spark: SparkSession, sf_dir: str, id_column: str, ids: int) -> DataFrame:
    key = F.col("c_custkey")
    first = F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")
    return read(spark, sf_dir, "customer").select(
        F.lit("1").alias("workspace_id"),
        (key % ids).cast("string").alias(id_column),
        F.col("c_name").alias("name"),
        _later(first, key).alias("change_time"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow events with JSON details; line 3 of an order carries a malformed count."""
    key = F.col("l_orderkey")
    status = F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("RUNNING")
    count = F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    details = F.concat(
        F.lit('{"flow_progress":{"status":"'), status, F.lit('","metrics":{"num_output_rows":"'), count, F.lit('"}}}')
    )
    return read(spark, sf_dir, "lineitem").select(
        F.struct((key % 50).cast("string").alias("pipeline_id"), key.cast("string").alias("update_id")).alias("origin"),
        F.when(F.col("l_returnflag") == "N", "update_progress").otherwise("flow_progress").alias("event_type"),
        details.alias("details"),
    )


def _later(start: Column, seconds: Column) -> Column:
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


# The same roles in SQL, as common table expressions.
PIPELINE_TIMELINE_SQL = """
pipeline_timeline AS (
  SELECT '1' AS workspace_id, CAST(o_orderkey % 50 AS VARCHAR) AS pipeline_id,
         CAST(o_orderkey AS VARCHAR) AS update_id,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' END AS result_state,
         o_orderdate AS period_start_time,
         o_orderdate + to_seconds(o_orderkey % 3600) AS period_end_time
  FROM orders)"""
JOB_TIMELINE_SQL = """
job_timeline AS (
  SELECT '1' AS workspace_id, CAST(user_id AS VARCHAR) AS job_id, CAST(event_id AS VARCHAR) AS run_id,
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type <> 'signup' THEN 'COMPLETED' END AS result_state,
         ts AS period_start_time, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS period_end_time
  FROM events)"""
VERSIONS_SQL = """
pipelines AS (
  SELECT '1' AS workspace_id, CAST(c_custkey % 45 AS VARCHAR) AS pipeline_id, c_name AS name,
         TIMESTAMP '2000-01-01' + to_seconds(c_custkey) AS change_time
  FROM customer),
jobs AS (
  SELECT '1' AS workspace_id, CAST(c_custkey % 140 AS VARCHAR) AS job_id, c_name AS name,
         TIMESTAMP '2000-01-01' + to_seconds(c_custkey) AS change_time
  FROM customer),
latest_pipelines AS (
  SELECT * FROM pipelines
  QUALIFY row_number() OVER (PARTITION BY workspace_id, pipeline_id ORDER BY change_time DESC, name DESC) = 1),
latest_jobs AS (
  SELECT * FROM jobs
  QUALIFY row_number() OVER (PARTITION BY workspace_id, job_id ORDER BY change_time DESC, name DESC) = 1)"""
EVENT_LOG_SQL = """
event_log AS (
  SELECT CAST(l_orderkey % 50 AS VARCHAR) AS pipeline_id, CAST(l_orderkey AS VARCHAR) AS update_id,
         CASE WHEN l_returnflag = 'N' THEN 'update_progress' ELSE 'flow_progress' END AS event_type,
         '{"flow_progress":{"status":"' || CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'RUNNING' END
         || '","metrics":{"num_output_rows":"'
         || CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END
         || '"}}}' AS details
  FROM lineitem)"""
