"""Cleansing and typing of one column, as a single built-in expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.spec import ColumnSpec

# The type names a spec may use.  Any other name leaves the
# column as it is.
SPEC_TYPES = {
    "string": "string",
    "integer": "int",
    "timestamp": "timestamp",
    "long": "bigint",
    "boolean": "boolean",
    "double": "double",
    "date": "date",
}

# on_error="fail" raises on a value that does not convert; "null" blanks it.
_TO_DATE = {"fail": F.to_date, "null": lambda c, fmt: F.try_to_date(c, fmt)}
_TO_TIMESTAMP = {"fail": F.to_timestamp, "null": lambda c, fmt: F.try_to_timestamp(c, F.lit(fmt))}


def cleansed(value: Column, spec: ColumnSpec, on_error: str = "fail") -> Column:
    """Trim, then blank the null markers, then convert to the spec's type."""
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    if spec.trim:
        value = F.trim(value)
    if spec.null_markers:
        # Markers are text, so numbers are compared in their text form.
        marked = value.cast("string").isin(*spec.null_markers)
        value = F.when(~F.coalesce(marked, F.lit(False)), value)
    return _typed(value, spec, on_error)


def _typed(value: Column, spec: ColumnSpec, on_error: str) -> Column:
    if spec.format and spec.type == "date":
        return _TO_DATE[on_error](value, spec.format)
    if spec.format and spec.type == "timestamp":
        return _TO_TIMESTAMP[on_error](value, spec.format)
    target = SPEC_TYPES.get(spec.type)
    if target is None:
        return value
    return value.cast(target) if on_error == "fail" else value.try_cast(target)
