"""Word counts over text lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import CONTROL, jvm_trim, lines_of, split_dropping_trailing
from tidegate.operators.joins import exclude_keys

# The stop words of the multi-file word count.
STOP_WORDS = (
    "a", "the", "an", "as", "with", "this", "these", "is", "are", "in", "for", "to", "and", "The", "of",
)


def words_frame(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "w string")


def list_words(df: DataFrame, line: str = "value", sep: str = ",") -> DataFrame:
    """Words of a comma-separated list, trimmed."""
    return df.select(F.explode(split_dropping_trailing(line, sep)).alias("w")).select(jvm_trim("w").alias("w"))


def document_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Text lines of a table of whole documents."""
    return df.select(F.explode(lines_of(text)).alias("value"))


def line_words(df: DataFrame, line: str = "value", trim: bool = False) -> DataFrame:
    """Words between single blanks; blank words inside a line count, those at its end do not.

    Trimming only finds something in lines with control characters, so only their words are trimmed.
    """
    words = split_dropping_trailing(line, " ")
    if trim:
        words = F.when(F.col(line).rlike(CONTROL), F.transform(words, jvm_trim)).otherwise(words)
    return df.select(F.explode(words).alias("w"))


def count_words(words: DataFrame, word: str = "w") -> DataFrame:
    return words.groupBy(F.col(word).alias("w")).agg(F.count("*").alias("n"))


def count_words_except(words: DataFrame, stop_words: DataFrame, word: str = "w") -> DataFrame:
    """Word counts without the stop words.

    Counting comes first: it combines before the shuffle, so a word that makes up a third of the
    text reaches the exclusion as one row, whichever join Spark picks for it.
    """
    return exclude_keys(count_words(words, word), stop_words, "w")


def by_count_descending(counts: DataFrame) -> DataFrame:
    """(count, word), highest count first, ties by word."""
    return counts.select("n", "w").orderBy(F.desc("n"), F.asc("w"))
