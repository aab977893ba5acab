"""Keyed and global aggregations.

Plain sums, counts and averages rely on Spark's partial aggregation: a hot key leaves every task as
one row. A user's aggregate gets the same: each task folds its own values to states, and only states are
shuffled. Lists and sets are made as sorted runs in a number of buckets per key that the caller has to give, so a
hot key need not be one row in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sum_of(value: Column | str, scale: int | None = None) -> Column:
    """Sum of a number. With a scale the values are summed as decimals of that many places, which makes
    the result independent of row order; give it for amounts, not for arbitrary measurements."""
    value = F.col(value) if isinstance(value, str) else value
    if scale is None:
        return F.sum(value)
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def count_by_key(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*_names(keys)).agg(F.count("*").alias(name))


def sum_by_key(
    df: DataFrame, keys: str | Sequence[str], value: str, name: str = "total", scale: int | None = None
) -> DataFrame:
    return df.groupBy(*_names(keys)).agg(sum_of(value, scale).alias(name))


def count_and_sum_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    count: str = "n",
    total: str = "total",
    scale: int | None = None,
) -> DataFrame:
    """Row count and sum per key. Text keys are trimmed, so a trailing blank does not split a group."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    grouping = [F.trim(k).alias(k) if k in text else F.col(k) for k in _names(keys)]
    return df.groupBy(*grouping).agg(F.count("*").alias(count), sum_of(value, scale).alias(total))


def average_by_key(df: DataFrame, keys: str | Sequence[str], value: str, scale: int | None = None) -> DataFrame:
    """Average per key through its (count, sum) state, which stays visible."""
    state = df.groupBy(*_names(keys)).agg(F.count(value).alias("n"), sum_of(value, scale).alias("total"))
    return state.withColumn("average", F.col("total") / F.col("n"))


def sum_and_count(df: DataFrame, value: str, total: str = "total", count: str = "n") -> DataFrame:
    """Global sum and count in one pass."""
    return df.agg(F.sum(value).alias(total), F.count("*").alias(count))


def two_level_fold(df: DataFrame, part: str, value: str, zero: int, name: str = "folded") -> DataFrame:
    """Maximum per part starting from `zero`, then the sum over parts starting from `zero` again."""
    per_part = df.groupBy(part).agg(F.greatest(F.max(value), F.lit(zero)).alias("_top"))
    return per_part.agg((F.lit(zero) + F.coalesce(F.sum("_top"), F.lit(0))).alias(name))


def tag_partition(df: DataFrame, value: str, part: Column | None = None, name: str = "tag") -> DataFrame:
    """`[partID:i, val:v]` per row; `part` defaults to the physical partition."""
    part = F.spark_partition_id() if part is None else part
    return df.select(
        F.concat(F.lit("[partID:"), part.cast("string"), F.lit(", val:"), F.col(value).cast("string"), F.lit("]")).alias(name)
    )


def _bucket(df: DataFrame, buckets: int, spread: Column | None) -> Column:
    spread = F.xxhash64(*df.columns) if spread is None else spread
    return F.coalesce(F.pmod(spread.cast("long"), F.lit(buckets)), F.lit(0)).cast("int")


def list_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    buckets: int,
    spread: Column | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Values per key as sorted arrays: (keys, bucket, n, items), with one shuffle.

    Each key has up to `buckets` rows that together hold every value; their number is the caller's and never
    depends on the data. `spread`, an integer expression, says which bucket a row goes to: the hash of the
    whole row by default, so carry a row id along to spread the copies of one value as well. Null values are
    not listed, but their key is, if need be with an empty list.
    """
    names = _names(keys)
    if distinct and spread is None:
        spread = F.xxhash64(value)
    items = F.sort_array((F.collect_set if distinct else F.collect_list)(value))
    lists = df.withColumn("bucket", _bucket(df, buckets, spread)).groupBy(*names, "bucket").agg(items.alias("items"))
    return lists.select(*names, "bucket", F.size("items").cast("long").alias("n"), "items")


def set_by_key(
    df: DataFrame, keys: str | Sequence[str], value: str, buckets: int, spread: Column | None = None
) -> DataFrame:
    """Distinct values per key, in buckets like `list_by_key`; equal values share a bucket."""
    return list_by_key(df, keys, value, buckets, spread, distinct=True)


RUN_ROWS = 1 << 18
STATE_GROUPS = 64


def runs_by_key(df: DataFrame, keys: Sequence[str], value: str, most: int = RUN_ROWS) -> DataFrame:
    """(keys, values): the values that each task has of a key, gathered without a shuffle, `most` rows at a time.

    Rows only move inside their task and as Arrow batches; a key has one row per task and `most` rows of it.
    """
    names = _names(keys)
    rows = df.select(*names, F.struct(F.col(value).alias("v")).alias("values"))
    out = T.StructType([*rows.select(*names).schema.fields, T.StructField("values", T.ArrayType(rows.schema["values"].dataType))])

    def gathered(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        spread = table.select(names).append_column("_at", pa.array(range(table.num_rows), pa.int64()))
        groups = spread.group_by(names, use_threads=False).aggregate([("_at", "list")])
        order = groups["_at_list"].combine_chunks()
        own = table["values"].combine_chunks().take(order.flatten())
        lists = pa.ListArray.from_arrays(order.offsets, own)
        return pa.RecordBatch.from_arrays([*[groups[n].combine_chunks() for n in names], lists], [*names, "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= most:
                yield gathered(held)
                held, size = [], 0
        if size:
            yield gathered(held)

    return rows.mapInArrow(run, out)


def combine_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    create: Callable[[Column], Column],
    merge_value: Callable[[Column, Column], Column],
    merge_states: Callable[[Column, Column], Column],
    finish: Callable[[Column], Column] | None = None,
    name: str = "result",
) -> DataFrame:
    """A user's aggregate given as (create, merge value, merge states) over column expressions.

    Use it where no built-in aggregate says the same. `merge_states` must be associative and commutative.
    Each task gathers its own rows by key and folds them to a state before anything is shuffled, so a key has as
    many rows in the shuffle as there are tasks (more only where a task has several times RUN_ROWS rows). States are
    folded in two steps, by groups of tasks and then whole. Null values are folded like any other.
    """
    names = _names(keys)

    def fold(items: Column, first: Callable[[Column], Column], merge: Callable[[Column, Column], Column]) -> Column:
        return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), first(F.get(items, F.lit(0))), merge)

    def folded(states: DataFrame, *by: str) -> DataFrame:
        listed = states.groupBy(*names, *by).agg(F.collect_list("_state").alias("_states"))
        return listed.select(*names, fold(F.col("_states"), lambda s: s, merge_states).alias("_state"))

    runs = runs_by_key(df, names, value)
    state = fold(F.col("values"), lambda x: create(x["v"]), lambda s, x: merge_value(s, x["v"]))
    states = runs.select(*names, state.alias("_state"), (F.spark_partition_id() % STATE_GROUPS).alias("_group"))
    whole = folded(folded(states, "_group"))
    return whole.select(*names, (finish or (lambda s: s))(F.col("_state")).alias(name))


def items_text(df: DataFrame, items: str = "items", sep: str = ",") -> DataFrame:
    """The arrays as one delimited text per row."""
    return df.withColumn(items, F.array_join(F.col(items).cast("array<string>"), sep))
