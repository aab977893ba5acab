"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.operators.joins import exclude_keys


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept, columns matched by name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows that do not occur on the right; duplicates of the others stay."""
    return exclude_keys(left, right.dropDuplicates(), left.columns)


def distinct(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
