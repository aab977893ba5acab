"""Sorting, first rows, row positions and positional zips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.session import shared_folder


def sort_by(df: DataFrame, *columns: str | Column, split_copies: bool = False) -> DataFrame:
    """Global sort; all other columns break ties, so rows of one hot value spread over several ranges.

    Rows that are equal in every column still share a range. Where such copies may be a large part of
    the data, `split_copies` checkpoints the rows and numbers them, which spreads the copies as well;
    after the checkpoint a lost executor cannot change the numbers.
    """
    named = {c for c in columns if isinstance(c, str)}
    ties = [c for c in df.columns if c not in named]
    if not split_copies:
        return df.orderBy(*columns, *ties)
    shared_folder(df.sparkSession)
    numbered = df.checkpoint().withColumn("_copy", F.monotonically_increasing_id())
    return numbered.orderBy(*columns, *ties, "_copy").drop("_copy")


def first_rows(df: DataFrame, n: int, *columns: str | Column) -> DataFrame:
    """The first n rows of a defined order (a per-task top n, no full sort)."""
    return df.orderBy(*columns).limit(n)


def with_position(df: DataFrame, name: str = "pos", order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Zero-based global row positions.

    The (sorted) rows are checkpointed first, so partition numbers and the order inside partitions
    cannot change between the count and the numbering, not even when an executor is lost. Offsets
    are one row per partition; no task sees more than its own partition.
    """
    shared_folder(df.sparkSession)
    rows = (sort_by(df, *order_by) if order_by else df).checkpoint()
    marked = rows.withColumn("_id", F.monotonically_increasing_id())
    marked = marked.withColumn("_part", F.shiftright("_id", 33))
    sizes = marked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + inside)
        .select(*df.columns, name)
    )


def zip_by_position(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str | Column] = (),
    right_order: Sequence[str | Column] = (),
    name: str = "pos",
) -> DataFrame:
    """Row i of the left side next to row i of the right side; different sizes fail the query."""
    a = with_position(left, "_left", left_order)
    b = with_position(right, "_right", right_order)
    zipped = a.join(b, a["_left"] == b["_right"], "full")
    uneven = F.col("_left").isNull() | F.col("_right").isNull()
    position = F.when(uneven, F.raise_error(F.lit("zipped sides differ in size"))).otherwise(F.col("_left"))
    return zipped.select(position.cast("long").alias(name), *left.columns, *right.columns)
