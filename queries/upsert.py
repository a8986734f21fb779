"""SCD type 1: one current row per key, from batches and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import BUCKETS, column, read, spec
from siltstone import table_spec
from siltstone.operators.latest import change_order, latest_per_key
from siltstone.operators.merge import scd1_upsert
from siltstone.operators.snapshot import KeyedSnapshot
from siltstone.session import scratch_dir
from siltstone.streaming.scd1 import stream_scd1


def _event_order():
    return [F.col("ts"), F.col("event_id")]


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(read(spark, sf_dir, "events"), ["user_id"], _event_order())


def latest_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns, sequence with nulls, ties broken by the remaining columns."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("returned_at"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
    )
    return latest_per_key(lines, ["l_partkey", "l_suppkey"], [F.col("returned_at")])


def _as_batches(events: DataFrame, folder: str, batches: int) -> None:
    """Events dealt out of order into ``batches`` files' worth of change batches."""
    dealt = events.withColumn("batch", F.pmod(F.xxhash64("event_id"), F.lit(batches)))
    dealt.repartition(batches, "batch").drop("batch").write.parquet(folder)


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream of three micro-batches in no order."""
    root = scratch_dir(spark, "scd1_stream")
    events = read(spark, sf_dir, "events")
    _as_batches(events, f"{root}/changes", 3)
    changes = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/changes")
    )
    stream_scd1(changes, f"{root}/silver", ["user_id"], _event_order(), f"{root}/checkpoint", buckets=BUCKETS)
    return KeyedSnapshot(spark, f"{root}/silver", ["user_id"]).read()


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older half, newer half, then the older half once more under its number and under a new one."""
    root = scratch_dir(spark, "scd1_replay")
    events = read(spark, sf_dir, "events")
    middle = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    older, newer = events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)
    table = KeyedSnapshot(spark, root, ["user_id"], BUCKETS)
    for number, batch in ((0, older), (1, newer), (0, older), (2, older)):
        scd1_upsert(table, batch, _event_order(), writer="feed", batch_id=number)
    return table.read()


_INGEST = spec(
    "orders",
    "orders",
    [column("o_orderkey", "long"), column("o_custkey", "long")],
    keys=["o_custkey"],
)


def by_ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No incremental column: the row that came in last wins, of one load the greater order key."""
    parsed = table_spec(_INGEST, "orders")
    first = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    load = F.when(F.col("o_orderpriority") < "3", 0).otherwise(1)
    rows = read(spark, sf_dir, "orders").withColumn(
        "ingested_timestamp", first + F.make_dt_interval(hours=load)
    )
    return latest_per_key(rows, parsed.primary_keys, change_order(parsed), tie_break=["o_orderkey"])


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of no user are one key like any other, however many batches there are and however they are merged."""
    table = KeyedSnapshot(spark, scratch_dir(spark, "scd1_null_keys"), ["user_id"], BUCKETS)
    user = F.when(F.col("user_id") % 5 != 0, F.col("user_id"))
    events = read(spark, sf_dir, "events").select(user.alias("user_id"), "event_id", "ts", "event_type")
    dealt = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for number in range(3):
        scd1_upsert(table, events.filter(dealt == number), _event_order())
    return table.read()


_LATEST_SQL = """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
"""

QUERIES = {
    "scd1_latest": latest,
    "scd1_composite_key": latest_composite,
    "scd1_stream": streamed,
    "scd1_replay": replayed,
    "scd1_ingest_order": by_ingest_time,
    "scd1_null_keys": null_keys,
}

ORACLE = {
    "scd1_latest": _LATEST_SQL,
    "scd1_composite_key": """
        SELECT l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS returned_at,
               l_orderkey, l_linenumber, l_quantity
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
          ORDER BY returned_at DESC NULLS LAST, l_linenumber DESC, l_orderkey DESC, l_quantity DESC) = 1""",
    "scd1_stream": _LATEST_SQL,
    "scd1_replay": _LATEST_SQL,
    "scd1_null_keys": """
        SELECT CASE WHEN user_id % 5 <> 0 THEN user_id END AS user_id, event_id, ts, event_type
        FROM events
        QUALIFY row_number() OVER (PARTITION BY CASE WHEN user_id % 5 <> 0 THEN user_id END
          ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
    "scd1_ingest_order": """
        SELECT *, TIMESTAMP '2024-01-01' + CASE WHEN o_orderpriority < '3' THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END
                  AS ingested_timestamp
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY ingested_timestamp DESC, o_orderkey DESC) = 1""",
}
