"""Joins to a side that holds each key once, or to few keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import qualified, quoted

_SPREAD = "__spread"


def join_to_unique(df: DataFrame, unique: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``df``, where a key may be hot, to ``unique``, where each key occurs once.

    A unique side mostly comes from an aggregate or a window by the key, and
    Spark joins it as it is partitioned; but adaptive execution splits a hot
    partition only where both sides were shuffled for the join.  A hash of the
    key as one more join column makes it shuffle the (small) unique side again,
    and a side of measured small size is broadcast as ever.
    """
    spread = F.xxhash64(*(qualified(k) for k in keys))
    joined = df.withColumn(_SPREAD, spread).join(unique.withColumn(_SPREAD, spread), [_SPREAD, *keys], how)
    return joined.drop(_SPREAD)


def split_by_keys(rows: DataFrame, few: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` without and with a key that ``few`` has, neither of them shuffled.

    ``few`` is broadcast, so its size has to be known.  A null key is a key like any other.
    """
    names = [f"_changed_{i}" for i in range(len(keys))]
    found = F.broadcast(few.select(*(qualified(k).alias(n) for k, n in zip(keys, names))))
    same = reduce(and_, (rows[quoted(k)].eqNullSafe(found[n]) for k, n in zip(keys, names)))
    return rows.join(found, same, "left_anti"), rows.join(found, same, "left_semi")
