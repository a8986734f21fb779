"""Helpers shared by the operators: stored steps, checked broadcasts, row numbers, connected components."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.session import scratch_dir

# A side is broadcast only if it has been counted and holds no more rows than
# this; beyond it the join is an ordinary shuffled one.
BROADCAST_ROWS = 1_000_000
# Edges that one task keeps, and the least number of tasks.
EDGES_A_TASK = 500_000
EDGE_TASKS = 8


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Smaller Arrow batches than the default, since a row may be a long text.

    Python workers also get this checkout on their path; where executors do not
    see it, ship the package with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def store(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, lost executors lose nothing."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count shows at most ``limit`` rows, else unmarked."""
    return F.broadcast(df) if df.count() <= limit else df


def numbered(df: DataFrame, key: str, salt: str, number: str) -> DataFrame:
    """Gapless numbers from 0 within each ``key``, for a stored ``df`` with a small integer ``salt``.

    Rows of a key are numbered per salt, then shifted by the rows of the lower
    salts, so no task holds all rows of a hot key.  ``df`` must be a stored
    table: it is read twice and both reads must agree.
    """
    counts = df.groupBy(key, salt).agg(F.count("*").alias("_n"))
    below = Window.partitionBy(key).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, salt, F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"))
    place = Window.partitionBy(key, salt).orderBy(*[c for c in df.columns if c not in (key, salt)])
    ranked = df.withColumn("_place", F.row_number().over(place) - 1)
    return (
        ranked.join(offsets, [key, salt])
        .withColumn(number, (F.col("_place") + F.col("_below")).cast("long"))
        .drop("_place", "_below")
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``id``, ``component`` (smallest id reachable) of every id in ``edges`` (``a``, ``b``).

    Alternating large-star and small-star steps, each an aggregate and a join;
    the edges of every round are stored, and it ends when they are stars around
    the smallest ids.  Lowest neighbours are broadcast while there are few, and
    few edges are kept in few files.
    """

    def tasks(count: int) -> int:
        return max(EDGE_TASKS, count // EDGES_A_TASK)

    def ended(pairs: DataFrame, count: int) -> bool:
        """Whether every id is either the lower end of its pairs or the upper end of one pair."""
        ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))
        ends = pairs.select(F.inline(ends)).groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("lowest"))
        return not ends.where("ups > 1 OR ups = 1 AND lowest = 0").coalesce(tasks(count)).count()

    def lowest(pairs: DataFrame, count: int) -> DataFrame:
        low = pairs.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        return F.broadcast(low.coalesce(tasks(count))) if count <= BROADCAST_ROWS else low

    pairs = store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    count = pairs.count()
    while not ended(pairs, count):
        # Every pair's upper end goes to the lowest neighbour of its lower end.
        large = pairs.join(lowest(pairs, count), F.col("v") == F.col("x"), "left").select("u", F.coalesce("m", "v").alias("v"))
        # The lowest of an id's lower ends stays its own, the others are tied to that.
        small = large.join(lowest(large, count), F.col("u") == F.col("x"))
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = store(small.distinct().coalesce(tasks(count)), "edges")
        count = pairs.count()
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        roots.select(F.col("v").alias("id"), F.col("v").alias("component"))
    )
