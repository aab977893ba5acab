"""Files as rows: listed by tasks, folder by folder, in batch and as a stream.

A row is a file (path, length, modified), so a file without content has a row like any other. The tasks list through
Arrow's file systems (local folders, HDFS, S3, Google Cloud and Azure storage). For a store that these do not know
`list_folder_files` takes the list of Spark's reader, which passes through the driver.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidegate.functions.filenames import scanned_path
from tidegate.session import workspace

FILE_ROWS = "path string, length long, modified timestamp"
SOURCE_NAME = "tidegate_files"
MOST_LISTED = 10_000  # entries of one task before it hands on the folders it has left
_ENTRIES = "path string, folder boolean, length long, modified timestamp"
_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):/*")
_START = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


def store_of(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path inside it, and what stands before that path in the names of scans."""
    found = _SCHEME.match(path)
    if found is None or found[1] == "file":
        inner = "/" + path[found.end() :].lstrip("/") if found else path
        return fs.LocalFileSystem(), inner.rstrip("/") or "/", "file://"
    store, inner = fs.FileSystem.from_uri(quote(path, safe="/:@?&=%+,;~!*'()"))
    before = f"{found[1]}://" + ("" if not inner.startswith("/") else path[found.end() :].split("/")[0])
    return store, inner.rstrip("/"), before


def _children(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What stands directly in a folder; names that begin with `_` or `.` are hidden, as Spark has it."""
    inside = store.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))
    return [x for x in inside if not x.base_name.startswith(("_", "."))]


def _listed(folders: DataFrame) -> DataFrame:
    """(path, folder, length, modified) of the files below the folders; a task that has listed MOST_LISTED entries
    returns the folders that it has not looked into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner, before = store_of(path)
                left = [inner]
                while left:
                    if listed >= MOST_LISTED:
                        rows = [(before + x, True, None, None) for x in left]
                        left = []
                    else:
                        found = _children(store, left.pop())
                        listed += len(found) + 1
                        left += [x.path for x in found if x.type == fs.FileType.Directory]
                        rows = [(before + x.path, False, x.size, x.mtime) for x in found if x.type == fs.FileType.File]
                    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
                    kinds = pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")
                    arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["path", "folder", "length", "modified"])

    return folders.select("path").mapInArrow(run, _ENTRIES)


def list_folder_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, modified) of every file below a folder, also of empty ones, as a written table.

    A task looks into a bounded number of folders; those that it leaves are dealt to the tasks of the next round. The
    driver learns how many are left, never their names.
    """
    try:
        store_of(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        found = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
        files = spark.createDataFrame([(x,) for x in found], "path string").select(scanned_path(F.col("path")).alias("path"))
        files = files.withColumns({"length": F.lit(None).cast("long"), "modified": F.lit(None).cast("timestamp")})
    else:
        folder, left, number = workspace(spark, "listing"), spark.createDataFrame([(path,)], "path string").coalesce(1), 0
        while True:
            _listed(left).write.parquet(f"{folder}/round={number}")
            left = spark.read.schema(_ENTRIES).parquet(f"{folder}/round={number}").where("folder").select("path")
            count = left.count()
            if not count:
                break
            left, number = left.repartition(min(count, spark.sparkContext.defaultParallelism * 8)), number + 1
        files = spark.read.schema(f"{_ENTRIES}, round int").parquet(folder).where(~F.col("folder")).select("path", "length", "modified")
    if glob:
        name = F.substring_index("path", "/", -1)
        files = files.where(name.rlike(_glob_pattern(glob)))
    return files


def _glob_pattern(glob: str) -> str:
    plain = {"*": ".*", "?": "."}
    return r"\A" + "".join(plain.get(c, re.escape(c)) for c in glob) + r"\z"


def _walk(path: str, deep: bool) -> Iterator[tuple[str, fs.FileInfo]]:
    store, inner, before = store_of(path)
    left = [inner]
    while left:
        for x in _children(store, left.pop()):
            if x.type == fs.FileType.Directory:
                if deep:
                    left.append(x.path)
            else:
                yield before + x.path, x


class FolderPart(InputPartition):
    """One folder for one task: its own files only, or the whole tree below it."""

    def __init__(self, path: str, deep: bool, after: int, until: int):
        self.path, self.deep, self.after, self.until = path, deep, after, until


class ChangedFiles(DataSourceStreamReader):
    """The files that were written after one moment and up to another, each time they are written.

    An offset is a moment in microseconds, so nothing is listed to know where a batch ends, and a batch that is
    run again asks for the same moments. A file that is written again, also if it is empty now, comes again.
    """

    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("glob")
        self.first = int(options.get("after") or 0)
        self.lag = int(float(options.get("lag") or 0) * 1e6)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"until": self.first}

    def latestOffset(self) -> dict:  # noqa: N802
        now = dt.datetime.now(dt.UTC) - _START
        return {"until": max(now // dt.timedelta(microseconds=1) - self.lag, self.first)}

    def partitions(self, start: dict, end: dict) -> list[FolderPart]:
        store, inner, before = store_of(self.path)
        folders = [x.path for x in _children(store, inner) if x.type == fs.FileType.Directory]
        span = start["until"], end["until"]
        return [FolderPart(self.path, False, *span), *[FolderPart(before + x, True, *span) for x in folders]]

    def read(self, partition: FolderPart) -> Iterator[tuple]:
        for path, x in _walk(partition.path, partition.deep):
            written = (x.mtime - _START) // dt.timedelta(microseconds=1)
            if partition.after < written <= partition.until and (not self.glob or fnmatchcase(x.base_name, self.glob)):
                yield path, x.size, x.mtime

    def commit(self, end: dict) -> None:
        """Nothing is kept."""


class FilesSource(DataSource):
    """`spark.readStream.format(SOURCE_NAME)`: rows that are files."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return FILE_ROWS

    def streamReader(self, schema) -> ChangedFiles:  # noqa: ANN001, N802
        return ChangedFiles(self.options)


def changed_files(
    spark: SparkSession, path: str, glob: str | None = None, modified_after: str | None = None, lag_seconds: float = 0
) -> DataFrame:
    """Stream of (path, length, modified): every file below a folder, and again whenever it is written again.

    `modified_after` (a timestamp in UTC) leaves out older files. Where the clock of the store is behind that of
    the driver, `lag_seconds` keeps a batch that far from the present.
    """
    spark.dataSource.register(FilesSource)
    reader = spark.readStream.format(SOURCE_NAME).option("path", path).option("lag", str(lag_seconds))
    if glob:
        reader = reader.option("glob", glob)
    if modified_after:
        moment = dt.datetime.fromisoformat(modified_after)
        moment = moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)
        reader = reader.option("after", str((moment - _START) // dt.timedelta(microseconds=1)))
    return reader.load()
