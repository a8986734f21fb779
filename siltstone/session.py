"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Joins and aggregates are declared without hints; adaptive execution splits
# skewed join partitions, sizes the reduce side and broadcasts only what it has
# measured to be small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "siltstone", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` (``a_b`` for ``a.b``) are added last."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold within a ``with`` block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster shares (``spark.checkpoint.dir``).

    Executors and a restarted driver must both reach it, so a machine-local
    folder is used only where the whole of Spark is one local process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/siltstone/{purpose}-{uuid.uuid4().hex}"
