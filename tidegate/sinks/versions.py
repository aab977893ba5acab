"""Outputs per source file that are replaced by a pointer, so readers see the old or the new output, never neither.

A run writes to a folder of its own, `run=<name>-<number>`, and then appends its files to the ledger `_processed`, as
one Parquet file that appears at once. The latest entry of a file says in which run its output is. Readers
follow the entries; what no entry points to any more stays until `vacuum` removes it. A run that fails before its
entries leaves nothing that a reader sees.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sinks.files import partition_folders, remove_folders
from tidegate.sources.listing import store_of

FILE_KEY = ("file_name", "extension")
LEDGER = "_processed"
LEDGER_SCHEMA = "file_name string, extension string, run string, tried_at timestamp, version string, modified timestamp"


def write_version(
    rows: DataFrame, files: DataFrame, target: str, folders: Sequence[str], run: str = "batch", compression: str | None = None
) -> str:
    """Write (value, folders) and point to it for all `files` (file_name, extension, perhaps modified).

    Files without a row point to the run as well and so have no output any more. Returns the version.
    """
    version = f"{run}-{uuid.uuid4().hex}"
    writer = rows.select("value", *folders).write.option("compression", compression or "none")
    writer.partitionBy(*folders).text(f"{target}/version={version}")
    modified = F.max("modified") if "modified" in files.columns else F.lit(None)
    entries = files.groupBy(*FILE_KEY).agg(modified.cast("timestamp").alias("modified"))
    entries = entries.select(*FILE_KEY, F.lit(run).alias("run"), F.current_timestamp().alias("tried_at"), F.lit(version).alias("version"), "modified")
    entries.coalesce(1).write.mode("append").parquet(f"{target}/{LEDGER}")
    return version


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """Every entry of all runs."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{target}/{LEDGER}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def current_versions(spark: SparkSession, target: str) -> DataFrame:
    """(file_name, extension, version, since): where the output of each file is."""
    latest = F.max(F.struct("tried_at", "version")).alias("latest")
    entries = ledger(spark, target).groupBy(*FILE_KEY).agg(latest)
    return entries.select(*FILE_KEY, "latest.version", F.col("latest.tried_at").alias("since"))


def read_version(spark: SparkSession, target: str, folders: Sequence[str]) -> DataFrame:
    """(value, folders) of the current output of every file."""
    schema = ", ".join(["value string", "version string", *[f"{c} string" for c in folders]])
    try:
        rows = spark.read.schema(schema).text(target)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    current = current_versions(spark, target).drop("since")
    return rows.join(current, [*FILE_KEY, "version"], "left_semi").select("value", *folders)


def vacuum(spark: SparkSession, target: str, keep: str = "1 day") -> int:
    """Remove output that has been without a pointer for longer than `keep`; returns the number of folders.

    What a reader that began before still reads must not go, so `keep` should be longer than any reader. Output of runs
    that ended without an entry goes too, once the ledger has entries that are `keep` younger than its folder's files.
    """
    folders = partition_folders(spark, target)
    if "version" not in folders.columns:
        return 0
    current = current_versions(spark, target)
    limit = F.current_timestamp() - F.expr(f"INTERVAL {keep}")
    # The entry that took over from a version says since when that version is not read.
    taken = ledger(spark, target).select(*FILE_KEY, "version").join(current.select(*FILE_KEY, F.col("version").alias("_new"), "since"), [*FILE_KEY])
    stale = taken.where((F.col("version") != F.col("_new")) & (F.col("since") < limit)).select(*FILE_KEY, "version").dropDuplicates()
    gone = folders.join(stale, [*FILE_KEY, "version"], "left_semi").select("folder")
    unknown = folders.join(ledger(spark, target).select("version").dropDuplicates(), "version", "left_anti")
    unknown = unknown.where(F.col("written") < limit).select("folder")
    return delete_folders(gone.unionByName(unknown).dropDuplicates(), target)


def delete_folders(folders: DataFrame, target: str) -> int:
    """Delete the folders (folder), by tasks where these reach the store."""
    try:
        store_of(target)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        rows = folders.toLocalIterator()
        return remove_folders(folders.sparkSession, (row.folder for row in rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("folder").to_pylist():
                store, inner, _ = store_of(path)
                if store.get_file_info(inner).type == fs.FileType.Directory:  # a task that runs again finds none
                    store.delete_dir(inner)
            yield batch

    return folders.select("folder").mapInArrow(run, "folder string").count()
