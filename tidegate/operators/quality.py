"""Record checks: date formats, field counts, good and bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.digest import as_column
from tidegate.functions.text import jvm_trim

# The four accepted date formats.
DATE_PATTERNS = (
    r"\d+\s\w{3},\s\d{4}",  # 11 Jan, 2015
    r"\d+/\d+/\d{4}",  # 6/17/2014
    r"\d+-\d+-\d{4}",  # 22-08-2013
    r"\w{3}\s\d+,\s\d{4}",  # Jan 11, 2015
)


def is_date_text(col: Column | str) -> Column:
    """Full match of one of the date formats; a missing value is not a date."""
    any_format = r"\A(?:" + "|".join(DATE_PATTERNS) + r")\z"
    return F.coalesce(jvm_trim(col).rlike(any_format), F.lit(False))


def field_count(line: Column | str, sep: str = "|") -> Column:
    """Number of fields of a delimited line, blanks at the end included, from the bytes its separators take."""
    line = as_column(line)
    separators = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(sep), F.lit("")))
    width = len(sep.encode())
    return (separators if width == 1 else (separators / width).cast("int")) + 1


def flag_rows(df: DataFrame, is_good: Column, name: str = "quality") -> DataFrame:
    """One column that says `good` or `bad`: partition a write by it to get both files in one pass."""
    return df.withColumn(name, F.when(F.coalesce(is_good, F.lit(False)), "good").otherwise("bad"))


def good_rows(df: DataFrame, is_good: Column) -> DataFrame:
    return df.where(F.coalesce(is_good, F.lit(False)))


def bad_rows(df: DataFrame, is_good: Column) -> DataFrame:
    return df.where(~F.coalesce(is_good, F.lit(False)))


def not_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column differs from the value; nulls differ."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))
