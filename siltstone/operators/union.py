"""Union of any number of frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_frames(frames: Sequence[DataFrame], by_name: bool = False, allow_missing: bool = False) -> DataFrame | None:
    """Stack ``frames``, keeping duplicates; ``None`` if there is nothing to stack.

    Columns are matched by position, or by name if asked.  Where the frames are
    slices of one table, one scan with a filter is the cheaper plan.
    """
    stacked = None
    for frame in frames:
        if stacked is None:
            stacked = frame
        elif by_name:
            stacked = stacked.unionByName(frame, allowMissingColumns=allow_missing)
        else:
            stacked = stacked.union(frame)
    return stacked
