"""Column names that hold characters such as ``#`` or ``.``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as one back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def qualified(name: str, alias: str | None = None) -> Column:
    """The column called exactly ``name``, optionally of the frame ``alias``."""
    return F.col(f"{alias}.{quoted(name)}" if alias else quoted(name))
