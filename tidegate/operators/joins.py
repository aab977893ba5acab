"""Equi joins, exclusion and joins that stay balanced on hot keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StructField, StructType, VariantType

COPIES_PER_PIECE = 100_000


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi join; AQE picks the join from measured sizes and splits skewed partitions."""
    return left.join(right, _names(on))


def chain_join(first: DataFrame, *others: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner joins of several frames on one key, flat columns, each frame shuffled once."""
    joined = first
    for other in others:
        joined = joined.join(other, _names(on))
    return joined


def exclude_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not listed; duplicates of the remaining rows stay. A null key can be listed.

    Adaptive execution broadcasts the listed keys if their measured size allows it.
    """
    names = _names(on)
    listed = keys.select(*[F.col(n).alias(f"_listed_{n}") for n in names])
    same = [F.col(n).eqNullSafe(F.col(f"_listed_{n}")) for n in names]
    return df.join(listed, reduce(and_, same), "left_anti")


def hot_keys(df: DataFrame, on: str | Sequence[str], share: float = 0.01) -> DataFrame:
    """Every key that holds at least `share` of all rows, and none that holds less than half of that.

    One scan of the key columns: each task keeps Misra-Gries counters of its rows, at most 2 / share of them, and
    only these are shuffled. A key above the share outlives the others in one task at least, and the counters of all
    tasks fall short of its rows by share / 2 of the total at most. So there are never more than 2 / share hot keys.
    Null keys are none, as they join with nothing. Keys of nested types are counted exactly.
    """
    names = _names(on)
    keys = df.select(*names)
    if any(isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)) for field in keys.schema):
        counts = keys.groupBy(*names).agg(F.count("*").alias("_n"))
        total = counts.agg(F.sum("_n")).scalar()
        return counts.where(F.col("_n") >= total * F.lit(share)).select(*names)
    fields = [StructField(f"k{i}", field.dataType) for i, field in enumerate(keys.schema)]
    schema = StructType([*fields, StructField("n", LongType()), StructField("seen", LongType())])
    sketched = keys.toDF(*[f.name for f in fields]).mapInArrow(_sketcher(ceil(2 / share)), schema)
    counters = [f.name for f in fields]
    total = sketched.agg(F.sum("seen")).scalar()
    found = sketched.where("n > 0").groupBy(*counters).agg(F.sum("n").alias("n"))
    hot = found.where(F.col("n") >= total * F.lit(share / 2))
    return hot.select(*[F.col(c).alias(name) for c, name in zip(counters, names, strict=True)])


def _sketcher(size: int):
    """Misra-Gries counters of a task's rows (keys, n), and their number on a row without keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, schema = None, 0, None
        for batch in batches:
            seen, schema = seen + batch.num_rows, batch.schema
            rows = pa.Table.from_batches([batch]).drop_null()
            rows = rows.append_column("n", pa.array([1] * rows.num_rows, pa.int64()))
            held = rows if held is None else pa.concat_tables([held, rows])
            counted = held.group_by(schema.names).aggregate([("n", "sum")]).rename_columns([*schema.names, "n"])
            if counted.num_rows > size:
                # All counters fall by the largest that has no room; what is left above zero stays.
                least = int(np.partition(counted["n"].to_numpy(), -size - 1)[-size - 1])
                counted = counted.set_column(len(schema.names), "n", pc.subtract(counted["n"], least))
                counted = counted.filter(pc.greater(counted["n"], 0))
            held = counted
        if schema is None:
            return
        out = pa.schema([*[pa.field(f.name, f.type) for f in schema], ("n", pa.int64()), ("seen", pa.int64())])
        held = held.append_column("seen", pa.array([0] * held.num_rows, pa.int64()))
        yield from pa.Table.from_arrays(held.columns, schema=out).to_batches()
        none = [pa.nulls(1, field.type) for field in schema]
        yield pa.RecordBatch.from_arrays([*none, pa.array([0], pa.int64()), pa.array([seen], pa.int64())], schema=out)

    return run


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    share: float = 0.01,
    salts: int = 64,
    spread: Column | None = None,
    fold_copies: bool = False,
) -> DataFrame:
    """Inner equi join that spreads the hot keys of the left side over `salts` tasks.

    Rows of hot keys get a salt from their content (or from `spread`), the matching right rows are
    repeated once per salt; all other keys join as usual. Hot keys are at most 2 / share rows, so
    broadcasting them is bounded. Use it where adaptive skew handling cannot see the skew, for
    example below an aggregation on the same key.

    Equal rows have equal content and so share a salt. Where they may be many, `fold_copies` counts
    them before the shuffle, joins pieces of up to COPIES_PER_PIECE copies and unfolds these afterwards.
    """
    keys = _names(on)
    columns = left.columns
    hot = F.broadcast(hot_keys(left, keys, share).withColumn("_hot", F.lit(True)))
    spread = F.xxhash64(*columns) if spread is None else spread
    if fold_copies:
        left = _pieces_of_copies(left)
        spread = spread + F.col("_piece")
    salt = F.when(F.col("_hot"), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(F.lit(0))
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.join(hot, keys, "left").withColumn("_salt", salt).drop("_hot", "_piece")
    salted_right = right.join(hot, keys, "left").withColumn("_salt", F.explode(every_salt)).drop("_hot")
    joined = salted_left.join(salted_right, [*keys, "_salt"]).drop("_salt")
    if fold_copies:
        joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_here")))).drop("_copy", "_here")
    return joined


def _pieces_of_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with `_here` copies each; rows with very many copies come in several pieces."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    size = F.lit(COPIES_PER_PIECE)
    last = F.floor((F.col("_copies") - 1) / size)
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    here = F.least(size.cast("long"), F.col("_copies") - F.col("_piece") * size).cast("int")
    return pieces.withColumn("_here", here).drop("_copies")


def join_then_sum(left: DataFrame, right: DataFrame, on: str | Sequence[str], value: str, name: str) -> DataFrame:
    """Global sum of one joined text column as an integer."""
    return left.join(right, _names(on)).agg(F.sum(F.col(value).cast("int")).alias(name))
