"""Projections over delimited records and nested values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.digest import digest
from tidegate.functions.text import field, split_fields


def pick_fields(df: DataFrame, line: str, picks: dict[str, int], sep: str = ",") -> DataFrame:
    """Named columns from zero-based positions of a delimited line; only the fields needed are split."""
    limit = max(picks.values()) + 2
    parts = df.withColumn("_fields", split_fields(line, sep, limit))
    return parts.select(*[field(F.col("_fields"), i).alias(name) for name, i in picks.items()])


def prepend_concat(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A derived column, the concatenation of others, placed first."""
    return df.select(F.concat(*[F.col(c).cast("string") for c in columns]).alias(name), "*")


def concat_digests(columns: Sequence[Column | str], salt: str, sep: str = "|", algorithm: str = "MD5") -> Column:
    """Digests of several columns as one delimited text."""
    return F.concat_ws(sep, *[digest(c, salt, algorithm) for c in columns])


def record_map(header: Sequence[str], fields: Column) -> Column:
    """Header names zipped with the fields of a record; the shorter side decides the length."""
    if len(set(header)) != len(header):
        raise ValueError("header names repeat")
    n = F.least(F.size(fields), F.lit(len(header)))
    names = F.array(*[F.lit(h) for h in header])
    return F.map_from_arrays(F.slice(names, 1, n), F.slice(fields, 1, n))


def explode_pairs(df: DataFrame, pairs: str, keys: Sequence[str]) -> DataFrame:
    """One flat row per element of an array of structs, the key columns repeated."""
    return df.select(*keys, F.inline(pairs))


def pair_with_literal_key(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Every value name of the list paired with one literal key, for each row."""
    return df.select("*", F.lit(key).alias("key"), F.explode(F.array(*[F.lit(v) for v in values])).alias("value"))
