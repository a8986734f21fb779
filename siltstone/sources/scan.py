"""Where a table's raw rows come from."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from siltstone.spec import TableSpec

#: What was left out of a scan, and why.
SKIPPED = "source string, reason string"

# The source kinds, and the session settings that choose one.
FILES, JDBC = "s3", "jdbc"
SOURCE_TYPE_CONF = "pipeline.source_type"
BASE_PATH_CONF = "pipeline.s3_bucket"


def source_type_of(spark: SparkSession, spec: TableSpec, source_type: str | None = None) -> str:
    """The argument, else the legacy spec's own choice, else the session's; file source if none says."""
    chosen = source_type or spec.source_type or spark.conf.get(SOURCE_TYPE_CONF, FILES)
    if chosen not in (FILES, JDBC):
        raise ValueError(f"unknown source type {chosen!r}: use {FILES!r} or {JDBC!r}")
    return chosen


def source_path_of(spark: SparkSession, spec: TableSpec, base_path: str | None = None) -> str:
    """``<base>/<source table>/``, or the legacy spec's literal path."""
    if base_path is None and spec.source_path:
        return spec.source_path
    base = base_path or spark.conf.get(BASE_PATH_CONF)
    return f"{base.rstrip('/')}/{spec.source_table}/"


def readable(
    spark: SparkSession, sources: Sequence[str], scan: Callable[[list[str]], DataFrame]
) -> tuple[DataFrame | None, DataFrame]:
    """One scan of those ``sources`` that can be read, and a table of the others with the reason of each.

    ``scan`` gives the rows of some sources (files, or folders such as one
    pipeline's log).  All are read through once, together; where that fails they
    are halved until what is broken stands alone, so every broken source costs a
    number of passes that grows with the logarithm of theirs.  What is left is
    read again by the scan that is returned, so that a source is in it whole or
    not at all.
    """
    skipped: list[tuple[str, str]] = []

    def sound(part: list[str]) -> list[str]:
        try:
            scan(part).write.format("noop").mode("overwrite").save()
            return part
        except (PySparkException, Py4JJavaError) as error:
            if len(part) == 1:
                skipped.append((part[0], _reason(error)))
                return []
        middle = len(part) // 2
        return sound(part[:middle]) + sound(part[middle:])

    kept = sound(list(sources)) if sources else []
    return (scan(kept) if kept else None), spark.createDataFrame(skipped, SKIPPED)


def _reason(error: Exception) -> str:
    """The first line of the innermost cause."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip() and not line.strip().startswith("at ")]
    causes = [line for line in lines if line.startswith("Caused by:")]
    return (causes[-1].removeprefix("Caused by:").strip() if causes else lines[0] if lines else type(error).__name__)[:500]
