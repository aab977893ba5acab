"""The control table: one pipe row per entity says what to anonymise and where it belongs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import field, lines_of, split_fields
from tidegate.operators.anonymize import match_columns
from tidegate.sources.catalog import table_columns

# Fixed value: header lines of a control table start with this name.
HEADER_START = "esquema_hive"

RULE_COLUMNS = (
    "schema_name", "table_name", "digest_columns", "partition_column",
    "server", "storage_schema", "owner", "folder",
)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules in file order: `line_no` and the eight fields. The configuration file is read as one text,
    which keeps its line numbers."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(lines_of("value")).alias("line_no", "value"))
    rules = lines.where(~F.col("value").startswith(HEADER_START)).withColumn("_f", split_fields("value", "|"))
    return rules.select("line_no", *[field(F.col("_f"), i).alias(c) for i, c in enumerate(RULE_COLUMNS)])


def resolve_rules(spark: SparkSession, rules: DataFrame) -> DataFrame:
    """Turn column names into one-based field positions with the catalog's help.

    Adds `positions` (array<int>) and `width`, the number of fields a record must have; both are null
    where the table is unknown. Only configuration rows and table metadata pass through the driver.
    """
    resolved = []
    for row in rules.toLocalIterator():
        table = f"{row.schema_name}.{row.table_name}" if row.schema_name else row.table_name
        positions = width = None
        if row.table_name and spark.catalog.tableExists(table):
            partition = (row.partition_column or "").lower()
            columns = table_columns(spark, table, partition, lower=True)
            known, _ = match_columns(columns, (row.digest_columns or "").split(","), case_sensitive=False)
            positions = [columns.index(c) + 1 for c in known]
            width = len(columns)
        resolved.append((*row, positions, width))
    schema = T.StructType(
        [
            *rules.schema.fields,
            T.StructField("positions", T.ArrayType(T.IntegerType())),
            T.StructField("width", T.IntegerType()),
        ]
    )
    return spark.createDataFrame(resolved, schema)
