"""Text and delimited files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.filenames import scanned_path
from tidegate.functions.text import field, split_fields
from tidegate.operators.quality import field_count

CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, *paths: str, recursive: bool = False, with_path: bool = False) -> DataFrame:
    """Lines of one or several paths as one frame; `with_path` adds the file each line came from."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    lines = reader.text(list(paths))
    if with_path:
        return lines.select("value", scanned_path(F.col("_metadata.file_path")).alias("path"))
    return lines.select("value")


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines (value, path) of exactly these files; no other file is opened."""
    if not paths:
        return spark.createDataFrame([], "value string, path string")
    # The reader takes paths as patterns.
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in paths]
    return read_lines(spark, *plain, with_path=True)


def parse_records(
    lines: DataFrame,
    columns: Sequence[str],
    sep: str = "|",
    line: str = "value",
    keep: Sequence[str] = (),
    longer: bool = False,
) -> DataFrame:
    """String columns from delimited lines, blanks kept as blanks; `keep` names columns to carry along.

    A line with another number of fields has itself in `_corrupt_record` and what fields it has in the
    columns. With `longer` further fields are ignored. The line is split rather than read as CSV: CSV turns blanks into nulls and skips blank lines.
    """
    # Exploding a one-element array keeps the optimizer from repeating the split in a pushed-down filter.
    limit = len(columns) + 1 if longer else -1
    parts = lines.select("*", F.explode(F.array(split_fields(line, sep, limit))).alias("_fields"))
    fits = F.size("_fields") >= len(columns) if longer else F.size("_fields") == len(columns)
    return parts.select(
        *[field(F.col("_fields"), i).alias(c) for i, c in enumerate(columns)],
        F.when(~fits, F.col(line)).alias(CORRUPT),
        *keep,
    )


def good_records(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_records(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "|") -> DataFrame:
    """Delimited files with a known schema, usually the catalog's columns without the partition column."""
    return parse_records(read_lines(spark, path), columns, sep)


def read_generated(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Delimited files without a schema: `col0..colN`, as wide as the first line."""
    lines = read_lines(spark, path)
    first = lines.select(field_count("value", sep).alias("width")).first()
    columns = [f"col{i}" for i in range(first["width"] if first else 0)]
    return parse_records(lines, columns, sep)


def read_csv_header(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Separated files that each begin with a header row. Quotes are ordinary characters, blanks stay blanks.

    A record of another width keeps itself in `_corrupt_record`; nothing is padded or cut. The header is told
    by its text, so a header that is repeated inside a file is one as well.
    """
    lines = read_lines(spark, path).where(F.col("value") != F.lit(sep.join(columns)))
    return parse_records(lines, columns, sep)


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of the header row."""
    first = read_lines(spark, path).first()
    return first["value"].split(sep) if first else []


def read_csv_positional(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """The first fields of separated files without header; further fields are not read.

    A record with fewer fields keeps itself in `_corrupt_record`, a blank line too unless one field is enough.
    """
    return parse_records(read_lines(spark, path), columns, sep, longer=True)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, partitions: int | None = None) -> DataFrame:
    """A small in-memory collection, optionally in a given number of partitions."""
    df = spark.createDataFrame(list(rows), schema)
    return df.repartition(partitions) if partitions else df
