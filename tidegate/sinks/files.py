"""File sinks. All of them write in parallel."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import bracketed_line, delimited_line
from tidegate.session import session_setting, workspace
from tidegate.sources.listing import store_of

GZIP_CODEC = "org.apache.hadoop.io.compress.GzipCodec"
JOINED = {"none": "", "gzip": ".gz", "bzip2": ".bz2"}  # codecs whose files one after another are such a file
COPIED = 4 << 20  # bytes held at a time while parts are joined


def as_lines(df: DataFrame, sep: str = "|", bracketed: bool = False) -> DataFrame:
    """One text line per row: delimited, or `[a,b,c]` for compatibility."""
    line = bracketed_line(df.columns) if bracketed else delimited_line(df.columns, sep)
    return df.select(line.alias("value"))


def write_text(lines: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite") -> None:
    """Text files of a single string column; compression is gzip, bzip2, ... or none."""
    lines.write.mode(mode).option("compression", compression or "none").text(path)


def write_single_file(
    lines: DataFrame, path: str, sort_by: Sequence[str | Column] = (), compression: str | None = None
) -> None:
    """One output file in the folder `path`, made by many tasks.

    The lines are sorted, compressed and written in parts by all tasks; then one task puts the bytes of the parts one
    after another, which for JOINED codecs is a file of that codec. Equal sort keys are ordered by the line. `lines`
    may hold sort columns next to `value`; only `value` is written. No rows give an empty file. Where the codec or
    the store does not allow joining, one task sorts and writes all lines.
    """
    codec = (compression or "none").lower()
    parts, target = (_qualified(lines.sparkSession, x) for x in (workspace(lines.sparkSession, "parts"), path))
    if codec not in JOINED or not (_known_store(parts) and _known_store(target)):
        ordered = lines.repartition(1)
        if sort_by:
            ordered = ordered.sortWithinPartitions(*sort_by, "value")
        return write_text(ordered.select("value"), path, compression)
    write_text((lines.orderBy(*sort_by, "value") if sort_by else lines).select("value"), parts, codec)
    join_parts(lines.sparkSession, parts, target, ".txt" + JOINED[codec])
    remove_folders(lines.sparkSession, [parts])


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, so that tasks do not take one of the default store, or a relative one, for their own."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _known_store(path: str) -> bool:
    try:
        store_of(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _part_number(name: str) -> tuple[int, ...]:
    """Task and file of a part, as Spark names it: `part-<task>-<run>-c<file>...`."""
    found = re.match(r"part-(\d+)(?:.*-c(\d+))?", name)
    return tuple(int(x or 0) for x in found.groups())


def join_parts(spark: SparkSession, parts: str, path: str, extension: str) -> None:
    """The bytes of the part files of one folder, in their order, as the only file of the folder `path`.

    A task copies COPIED bytes at a time to a hidden name of its own attempt; what a lost attempt left is removed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("parts").to_pylist():
                (source, inner, _), (store, target, _) = store_of(folder), store_of(path)
                found = [x for x in source.get_file_info(fs.FileSelector(inner)) if x.base_name.startswith("part-")]
                store.create_dir(target, recursive=True)
                name = f"_joined-{uuid.uuid4().hex}"
                with store.open_output_stream(f"{target}/{name}", compression=None) as out:
                    for part in sorted(found, key=lambda x: _part_number(x.base_name)):
                        with source.open_input_stream(part.path, compression=None) as data:
                            while chunk := data.read(COPIED):
                                out.write(chunk)
                yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    one = spark.createDataFrame([(parts,)], "parts string").coalesce(1)
    name = one.mapInArrow(run, "name string").first().name
    store, target, _ = store_of(path)
    for old in store.get_file_info(fs.FileSelector(target)):
        if old.base_name != name:
            store.delete_dir(old.path) if old.type == fs.FileType.Directory else store.delete_file(old.path)
    store.move(f"{target}/{name}", f"{target}/part-00000-{name[8:]}-c000{extension}")


def write_by_key(lines: DataFrame, path: str, keys: str | Sequence[str], compression: str | None = None) -> None:
    """One folder per key value, in one job.

    Rebalancing by key keeps the number of files per folder low; it splits a key that is larger than
    the advisory partition size over several tasks, so a hot key does not land in one.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spread = lines.hint("rebalance", *keys)
    spread.write.mode("overwrite").option("compression", compression or "none").partitionBy(*keys).text(path)


def read_by_key(spark: SparkSession, path: str, keys: str | Sequence[str]) -> DataFrame:
    """Read a folder-per-key output back; key values stay text."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    schema = ", ".join(["value string", *[f"`{k}` string" for k in keys]])
    return spark.read.schema(schema).text(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str],
    file_format: str = "text",
    compression: str | None = None,
    rebalance: bool = False,
) -> None:
    """Replace exactly the partitions that occur in `df`; all others stay. Running it twice changes nothing."""
    out = df.hint("rebalance", *partition_columns) if rebalance else df
    writer = out.write.format(file_format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    writer.partitionBy(*partition_columns).save(path)


def partition_folders(spark: SparkSession, path: str, *below: str) -> DataFrame:
    """(folder, written, partition columns as text) of a folder-per-key output: a listing, no contents are read.

    `below` restricts it to some sub-folders, as patterns; a path that does not exist has no folders. `written` is
    when the last of a folder's files was.
    """
    reader = spark.read.format("binaryFile").option("basePath", path)
    with session_setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        try:
            listed = reader.load([f"{path}/{b}" for b in below] if below else path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], "folder string, written timestamp")
        keys = [c for c in listed.columns if c not in ("path", "modificationTime", "length", "content")]
        folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
        return listed.groupBy(folder, *keys).agg(F.max("modificationTime").alias("written"))


def remove_folders(spark: SparkSession, folders: Iterable[str]) -> int:
    """Delete folders and what is in them, in whichever store they are."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    count = 0
    for folder in folders:
        place = hadoop.Path(folder)
        place.getFileSystem(conf).delete(place, True)
        count += 1
    return count


def remove_outputs_of(files: DataFrame, path: str, *below: str) -> None:
    """Remove every output folder below `path` of the given files (file_name, extension).

    For tables, whose partitions are replaced in place: nothing stays of a file that has no good line any more.
    """
    existing = partition_folders(files.sparkSession, path, *below)
    keys = [c for c in ("file_name", "extension") if c in existing.columns]
    if len(keys) == 2:
        stale = existing.join(files.select(*keys).dropDuplicates(), keys, "left_semi").select("folder").collect()
        remove_folders(files.sparkSession, [row.folder for row in stale])


def write_binary(df: DataFrame, path: str) -> None:
    """Byte payloads in gzip-compressed columnar files."""
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def write_sequence_file(df: DataFrame, payload: str, path: str, codec: str = GZIP_CODEC) -> None:
    """Byte payloads as a SequenceFile with null keys; DataFrames have no writer for that format.

    Rows pass through Python one at a time: for compatibility and small exports. `write_binary` is the way to
    keep payloads.
    """
    pairs = df.select(payload).rdd.map(lambda row: (None, bytearray(row[0])))
    pairs.saveAsSequenceFile(path, codec)


def read_sequence_file(spark: SparkSession, path: str, payload: str = "payload") -> DataFrame:
    """The payloads of a SequenceFile, row by row like the writer."""
    rows = spark.sparkContext.sequenceFile(path).map(lambda pair: (bytes(pair[1]),))
    return spark.createDataFrame(rows, f"{payload} binary")


def folder_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the data files that an output consists of."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name")).dropDuplicates()
