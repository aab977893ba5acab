"""Continuous form of the publish job: new files in, anonymised files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.filenames import scanned_path
from tidegate.plans.publish import PLAN_COLUMNS, named, publish_files
from tidegate.sources.control import resolve_rules

BATCH_INTERVAL = "2 seconds"
FILES_PER_BATCH = 200


def file_lines(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    max_files: int = FILES_PER_BATCH,
    modified_after: str | None = None,
) -> DataFrame:
    """Stream of lines (value, path); whole files enter a batch, never parts of one, and `max_files` at most.

    A new checkpoint also sees files that already exist; `modified_after` leaves older ones out. A file without a line
    does not appear in it, nor one that is written again; `sources.listing.changed_files` has both.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.option("maxFilesPerTrigger", max_files).load(path)
    if modified_after:
        lines = lines.where(F.col("_metadata.file_modification_time") > F.lit(modified_after).cast("timestamp"))
    return lines.select("value", scanned_path(F.col("_metadata.file_path")).alias("path"))


def trigger_options(once: bool, interval: str = BATCH_INTERVAL) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def start_file_ingest(
    files: DataFrame,
    rules: DataFrame,
    landing: str,
    target: str,
    checkpoint: str,
    salt: str,
    sep: str = "|",
    algorithm: str = "MD5",
    once: bool = False,
    interval: str = BATCH_INTERVAL,
    max_files: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Per batch of files (path, length, modified; `changed_files` gives them): land the raw lines of complete files,
    then publish the anonymised and the rejected ones.

    A batch is worked on in slices of about `max_files` files. A file that comes again, because it was written again or because
    the batch runs again after a failure, replaces its output, also by none. The rules are resolved once per query. A
    slice's files are read once for each of the two outputs rather than kept. A real failure ends the query; the
    checkpoint retries the batch.
    """
    spark = files.sparkSession
    resolved = rules if "positions" in rules.columns else resolve_rules(spark, rules)

    def publish(batch: DataFrame, batch_id: int) -> None:
        chosen = named(batch).select(*PLAN_COLUMNS)
        publish_files(chosen, resolved, target, salt, f"batch{batch_id:09d}", sep, algorithm, landing=landing, files_per_slice=max_files)

    writer = files.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(once, interval)).start()
