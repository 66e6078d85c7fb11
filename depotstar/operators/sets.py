"""Unions of many frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name.

    Halves are joined to halves, so that no frame is analysed more than a few times.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))
