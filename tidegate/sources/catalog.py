"""Column names from the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_columns(spark: SparkSession, table: str, lower: bool = False) -> DataFrame:
    """(pos, col_name) of a table in catalog order, without the `#` and blank rows of DESCRIBE."""
    rows = spark.sql(f"DESCRIBE {table}").select("col_name")
    if lower:
        rows = rows.select(F.lower("col_name").alias("col_name"))
    named = rows.withColumn("pos", F.monotonically_increasing_id())
    named = named.where(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
    return named.groupBy("col_name").agg(F.min("pos").alias("pos")).select("pos", "col_name")


def table_columns(
    spark: SparkSession, table: str, partition_column: str | None = None, lower: bool = False
) -> list[str]:
    """The column names as a list (metadata only), without the partition column."""
    listed = [c.name for c in spark.catalog.listColumns(table)]
    if lower:
        listed = [c.lower() for c in listed]
    return [c for c in dict.fromkeys(listed) if c and not c.startswith("#") and c != partition_column]
