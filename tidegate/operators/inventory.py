"""Choosing files from an inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_per_entity(files: DataFrame, entity: str = "entity", path: str = "path") -> DataFrame:
    """The next file to process per entity: the lowest name."""
    return files.groupBy(entity).agg(F.min(path).alias(path))


def unpublished(inventory: DataFrame, published: DataFrame, name: str | Sequence[str] = "file_name") -> DataFrame:
    """Inventory rows whose file is not among those that are done."""
    names = [name] if isinstance(name, str) else list(name)
    return inventory.join(published.select(*names).dropDuplicates(), names, "left_anti")
