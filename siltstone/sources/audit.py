"""Audit columns of a bronze table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The audit columns, in table order.
AUDIT_COLUMNS = ("ingested_timestamp", "ingested_date", "source_file")


def with_audit(df: DataFrame, source: Column | str, as_of: datetime | None = None) -> DataFrame:
    """Append when the rows came in and from where.

    ``source`` is a column (a file path) or a text (a table name).  ``as_of``
    replaces the clock, for runs that must be repeatable.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    label = F.lit(source) if isinstance(source, str) else source
    return df.withColumns(dict(zip(AUDIT_COLUMNS, (now, F.to_date(now), label))))
