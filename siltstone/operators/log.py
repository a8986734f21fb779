"""Small append-only logs kept beside a table: one row per file, the newest one counts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The log's rows, or ``None`` if nothing was ever written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_row(spark: SparkSession, path: str, schema: str) -> Row | None:
    """The row with the greatest ``number``."""
    log = read_log(spark, path, schema)
    newest = None if log is None else log.agg(F.max_by(F.struct("*"), "number").alias("row")).first()
    return newest and newest["row"]


def append_log(spark: SparkSession, path: str, columns: dict[str, tuple[pa.DataType, list]]) -> None:
    """Add one row, given column by column, under the next ``number``; there is one writer at a time."""
    log = read_log(spark, path, "number bigint")
    last = None if log is None else log.agg(F.max("number")).first()[0]
    columns = {"number": (pa.int64(), [0 if last is None else last + 1])} | columns
    arrays = [pa.array(values, kind) for kind, values in columns.values()]
    rows = spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))
    rows.coalesce(1).write.mode("append").parquet(path)
