"""The current row of every key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import qualified
from siltstone.spec import TableSpec

INGESTED = "ingested_timestamp"
_RANK = "__rank"


def change_order(spec: TableSpec, ingested: str = INGESTED, sequence_format: str | None = None) -> list[Column]:
    """What decides which of two rows of a key is newer.

    The first incremental column, then the ingest time; the ingest time alone
    if the spec names no incremental column (further ones are not used).
    Packed dates may be given a ``sequence_format`` (``ddMMyy``) to be compared
    as dates instead of as numbers; a number that is no date counts as null.
    """
    if not spec.incremental_columns:
        return [qualified(ingested)]
    first = qualified(spec.incremental_columns[0])
    if sequence_format:
        first = F.try_to_date(F.lpad(first.cast("string"), len(sequence_format), "0"), sequence_format)
    return [first, qualified(ingested)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Iterable[Column],
    tie_break: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order``, nulls being the least.

    Rows that ``order`` leaves equal are told apart by ``tie_break``, by
    default every other sortable column in the order of their names.  The
    result then depends on the rows alone: neither their order, nor how they
    are cut into batches, nor applying a batch twice can change it.

    The rank filter is a plain ``= 1``, so each task keeps one row per key
    before the shuffle and a key that holds a third of the input sends no more
    than one row per task.  ``within`` names columns that are functions of the
    key and by which ``df`` may already be partitioned.
    """
    if tie_break is None:
        tie_break = tie_columns(df, (*within, *keys))
    ranking = [c.desc_nulls_last() for c in order] + [qualified(c).desc_nulls_last() for c in tie_break]
    window = Window.partitionBy(*(qualified(k) for k in (*within, *keys))).orderBy(*ranking)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def tie_columns(df: DataFrame, skipped: Sequence[str]) -> list[str]:
    """Sortable columns by name, so a column added later does not reorder the others."""
    skip = {name.lower() for name in skipped}
    return sorted(f.name for f in df.schema.fields if f.name.lower() not in skip and _sortable(f.dataType))


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))
