"""File inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.filenames import scanned_path


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file below a folder; contents are not read.

    Paths are written as `read_lines` writes them, so both can be joined.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(scanned_path(F.col("_metadata.file_path")).alias("path"), "length", "modificationTime")
