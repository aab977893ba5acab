"""Landing a stream of key/value messages as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.text import tuple_line
from tidegate.streaming.ingest import BATCH_INTERVAL, trigger_options


def kafka_messages(
    spark: SparkSession, servers: str, topics: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Text key/value messages of Kafka topics; needs Spark's Kafka package on the class path.

    `options` are further reader options with `__` for dots, such as kafka__security__protocol.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    for key, value in options.items():
        reader = reader.option(key.replace("__", "."), value)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_messages(
    spark: SparkSession, path: str, schema: T.StructType, key: Column, value: Column, glob: str | None = None
) -> DataFrame:
    """Messages taken from arriving parquet files, where no broker is at hand."""
    reader = spark.readStream.schema(schema).format("parquet")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def land_messages(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    once: bool = False,
    interval: str = BATCH_INTERVAL,
) -> StreamingQuery:
    """Append `(key,value)` lines; the file sink's log makes every batch count once."""
    lines = messages.select(tuple_line(["key", "value"]).alias("value"))
    writer = lines.writeStream.format("text").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(once, interval)).start(target)
