"""Whole tables replaced load by load.

The rows of a load go to one of two folders in turn, and one row of a log, written
after them, says which folder holds the table.  A reader sees the old rows or the
new ones, a failed load leaves no trace, and who reads a table while the next load
is written is not disturbed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from siltstone.operators.log import append_log, newest_row

FOLDERS = ("rows_0", "rows_1")


@dataclass(frozen=True)
class Load:
    """The newest load: its number, where the rows are (nowhere, if there never were any), their columns, its writer's notes."""

    number: int
    folder: str | None
    columns: StructType
    notes: dict = field(default_factory=dict)


def newest_load(spark: SparkSession, root: str) -> Load | None:
    row = newest_row(spark, f"{root}/loads", "number bigint, folder string, columns string, notes string")
    return row and Load(row["number"], row["folder"], StructType.fromJson(json.loads(row["columns"])), json.loads(row["notes"]))


def read_load(spark: SparkSession, root: str, load: Load | None) -> DataFrame | None:
    return spark.read.schema(load.columns).parquet(f"{root}/{load.folder}") if load and load.folder else None


def write_load(
    rows: DataFrame, root: str, last: Load | None, notes: Callable[[], dict] = dict, begin_empty: bool = True
) -> None:
    """Make ``rows`` the table; they may be read from what ``last`` holds.

    ``notes`` is asked once they are written.  Without ``begin_empty`` a table
    that has no rows yet is not begun by a load without rows.
    """
    folder = FOLDERS[1] if last and last.folder == FOLDERS[0] else FOLDERS[0]
    rows.write.mode("overwrite").parquet(f"{root}/{folder}")
    begun = begin_empty or last and last.folder
    if not begun and rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/{folder}").isEmpty():
        folder = None
    _log(rows.sparkSession, root, folder, rows.schema, notes())


def note_load(spark: SparkSession, root: str, last: Load, notes: dict) -> None:
    """A load that leaves the rows as they are."""
    _log(spark, root, last.folder, last.columns, notes)


def _log(spark: SparkSession, root: str, folder: str | None, columns: StructType, notes: dict) -> None:
    values = {"folder": folder, "columns": columns.json(), "notes": json.dumps(notes)}
    append_log(spark, f"{root}/loads", {name: (pa.string(), [value]) for name, value in values.items()})


def replace_table(rows: DataFrame, root: str) -> None:
    """Replace the whole table at ``root``."""
    write_load(rows, root, newest_load(rows.sparkSession, root))


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The table at ``root``; ``None`` if it was never written."""
    return read_load(spark, root, newest_load(spark, root))


def refuse_other_types(*schemas: StructType) -> None:
    """A column keeps its type for good."""
    kinds = {}
    for f in (f for schema in schemas for f in schema.fields):
        if (known := kinds.setdefault(f.name.lower(), f.dataType)) != f.dataType:
            raise TypeError(f"column {f.name!r} is {known.simpleString()} in the table but {f.dataType.simpleString()} in the batch")
