"""Clustered parquet writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import qualified


# Buckets of a column on the curve, as bits: 64 ranges of like many rows.
BITS = 6
PLACE = "__place"
# Rows that bounds of those ranges are taken from.
SAMPLE_ROWS = 20_000


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows ranged and sorted by ``columns``, so each file covers a narrow range.

    Parquet footers then let a filter on those columns skip files and row
    groups.  By several columns, rows are ranged along a space-filling curve, so
    that a filter on any of them skips files.  The random last range key splits a
    value that many rows share over several files instead of sending it to one
    task; it is seeded per partition, so a task that is run again places its rows
    as before.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    by, kept = [qualified(c) for c in columns], df.columns
    if len(by) > 1:
        df, by = with_place(df, columns), [F.col(PLACE), *by]
    spread = [*by, F.rand(seed=17)]
    ranged = df.repartitionByRange(partitions, *spread) if partitions else df.repartitionByRange(*spread)
    return ranged.sortWithinPartitions(*by).select(*map(qualified, kept))


def with_place(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the place of every row on a Z-order curve over the ranks of its columns.

    Ranks are those among bounds taken from a bounded sample, so every column
    counts alike whatever its type and distribution; nulls are the lowest.  A
    poor sample makes files wider, nothing else.
    """
    share = min(1.0, 2 * SAMPLE_ROWS / max(1, df.count()))
    sample = df.select(*map(qualified, columns)).sample(share, seed=17).limit(SAMPLE_ROWS).collect()
    bits = min(BITS, 62 // len(columns))
    ranks, place = {}, F.lit(0).cast("long")
    for k, name in enumerate(columns):
        values = sorted(row[k] for row in sample if row[k] is not None)
        cuts = sorted({values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)}) if values else []
        # A column of its own, so that it is worked out once and not for every bit.
        ranks[f"{PLACE}{k}"] = F.coalesce(_rank(qualified(name), [F.lit(v).cast(df.schema[name].dataType) for v in cuts]), F.lit(0))
        for bit in range(bits):
            one = F.shiftright(F.col(f"{PLACE}{k}"), bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + k))
    return df.withColumns(ranks).withColumn(PLACE, place).drop(*ranks)


def _rank(value: Column, cuts: Sequence[Column]) -> Column:
    """How many of the sorted ``cuts`` are not above ``value``, null for null: a search tree of comparisons."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < cuts[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(value.isNotNull(), search(0, len(cuts)))


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    partitions: int | None = None,
    mode: str = "overwrite",
    lookup: Sequence[str] = (),
) -> None:
    """``lookup`` names columns, such as a key, that get a bloom filter per row group for searches of single values."""
    writer = clustered(df, columns, partitions).write.mode(mode)
    for name in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)
