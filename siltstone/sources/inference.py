"""Column types as a state that new files are merged into.

For every column it counts the values seen and how many of them fit each type of
a small lattice.  Counts of two sets of files are merged by adding them, so the
types that follow do not depend on how files are cut into batches or in which
order they come, and no file is looked at twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import qualified
from siltstone.sources.conversion import holding

_NUMBER = r"^\s*[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?\s*$"
_DATE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$"
_TIME = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[-+][0-9]{2}:?[0-9]{2})?)?\s*$"

# Narrowest first; the first type that holds every value is the column's.
TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}
VALUES = "values"

#: Per column: its name as first spelled, how many values were seen, how many fit each type.
Counts = dict[str, dict]


def _fits(text: Column) -> dict[str, Column]:
    number = text.rlike(_NUMBER)
    return {
        "int": number & text.try_cast("int").isNotNull(),
        "bigint": number & text.try_cast("bigint").isNotNull(),
        "double": number,
        "boolean": F.lower(F.trim(text)).isin("true", "false"),
        "date": text.rlike(_DATE) & text.try_cast("date").isNotNull(),
        "timestamp": text.rlike(_TIME) & text.try_cast("timestamp").isNotNull(),
    }


def counted_types(rows: DataFrame, columns: Iterable[str]) -> Counts:
    """One aggregate over text columns."""
    columns = list(columns)
    if not columns:
        return {}
    sums = []
    for k, name in enumerate(columns):
        text = qualified(name)
        sums.append(F.count(text).alias(f"{k} {VALUES}"))
        sums += [F.count_if(fit).alias(f"{k} {kind}") for kind, fit in _fits(text).items()]
    found = rows.agg(*sums).first()
    return {
        name.lower(): {"name": name, **{kind: found[f"{k} {kind}"] for kind in (VALUES, *TYPES)}}
        for k, name in enumerate(columns)
    }


def merged_counts(a: Counts, b: Counts) -> Counts:
    merged = dict(a)
    for name, new in b.items():
        old = merged.get(name)
        merged[name] = {k: v if k == "name" else v + new[k] for k, v in old.items()} if old else new
    return merged


def type_of(counts: dict) -> T.DataType:
    """The narrowest type that every value fits; text where there are none."""
    if counts[VALUES]:
        for kind, found in TYPES.items():
            if counts[kind] == counts[VALUES]:
                return found
    return T.StringType()


def merged_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Columns of both, each with a type that holds both's values, at any depth."""
    return holding(a, b)
