"""Anonymise delimited files of many entities in one job and publish one output per file.

A file is known by its name, extension included. What is known of it, the parts of its name, its rule, the slice it
is worked on with, stands in a plan: a written table with a row per file, made from a listing by tasks. Slices hold
at most some thousand files, and only the paths of one slice pass through the driver at a time, because Spark's
reader wants them from there. Lines meet their file's row by the path; nothing is parsed per line.

A run writes to a folder of its own; the ledger beside the output points to it afterwards (`sinks.versions`), and names
all files that were tried, whatever became of their lines, so that a queue moves on past a bad or empty file.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.filenames import base_name, extension, is_accepted, parse_names, plain_path, source_file
from tidegate.operators.anonymize import anonymize_lines
from tidegate.operators.inventory import unpublished
from tidegate.operators.quality import field_count
from tidegate.operators.routing import route_files
from tidegate.session import workspace
from tidegate.sinks.versions import FILE_KEY, ledger, read_version, write_version
from tidegate.sources.control import resolve_rules
from tidegate.sources.listing import list_folder_files
from tidegate.sources.text import read_files

PUBLISHED = "published"
REJECTED = "rejected"
OUTCOME_FOLDERS = ("outcome", "entity", "date_range", "file_name", "extension")
FILES_PER_SLICE = 2_000
PLAN_COLUMNS = ("path", "modified", "entity", "date_range", "from_ts", *FILE_KEY)


def named(rows: DataFrame) -> DataFrame:
    """Rows with a `path`: accepted files only, with the parts of their names and the extension."""
    rows = rows.where(is_accepted(source_file("path"))).withColumn("extension", extension(source_file("path")))
    return parse_names(rows).withColumn("entity", F.lower("entity"))


def list_files(spark: SparkSession, archive: str, done: DataFrame | None = None) -> DataFrame:
    """Accepted files of a folder with their name parts, without those that are done; a listing only."""
    files = named(list_folder_files(spark, archive))
    return files if done is None else unpublished(files, done, FILE_KEY)


def with_rules(files: DataFrame, rules: DataFrame) -> DataFrame:
    """Named files with the `positions` and the `width` of their rule; null where there is none."""
    slim = rules.select("line_no", "table_name", F.col("positions"), F.col("width"))
    return route_files(files, slim).drop("line_no", "table_name")


class Plan:
    """A written table of files in slices."""

    def __init__(self, files: DataFrame, most: int = FILES_PER_SLICE):
        """`files` has the PLAN_COLUMNS and whatever else lines shall carry; all paths of a file share a slice."""
        self.spark = files.sparkSession
        folder = workspace(self.spark, "plan")
        placed = files.withColumn("_place", F.xxhash64(*FILE_KEY))
        placed.write.parquet(folder)
        self.files = self.spark.read.schema(placed.schema).parquet(folder)
        self.count = self.files.count()
        self.slices = -(-self.count // most)

    def each(self) -> Iterator[tuple[list[Row], DataFrame, DataFrame]]:
        """Per slice its files, as rows and as a frame, and their lines: (value, path and all that is known of the file)."""
        for number in range(self.slices):
            chosen = self.files.where(F.pmod("_place", F.lit(self.slices)) == number).drop("_place")
            rows = chosen.collect()  # a slice
            if rows:
                files = self.spark.createDataFrame(rows, chosen.schema)
                yield rows, files, lines_of(files, [row.path for row in rows])


def lines_of(files: DataFrame, paths: list[str]) -> DataFrame:
    """The lines of a slice's files with what is known of each file; a line of another file fails the query."""
    known = files.select(F.col("path").alias("_path"), *[c for c in files.columns if c != "path"])
    same = plain_path(F.col("path")) == plain_path(F.col("_path"))
    joined = read_files(files.sparkSession, paths).join(F.broadcast(known), same, "left")
    checked = F.when(F.col("_path").isNull(), F.raise_error(F.concat(F.lit("not in the plan: "), "path"))).otherwise(F.col("value"))
    return joined.withColumn("value", checked).drop("_path")


def anonymize_tagged(tagged: DataFrame, salt: str, last_position: int, sep: str = "|", algorithm: str = "MD5") -> DataFrame:
    """Lines that carry their file's name parts, `positions` and `width` as (value, outcome, entity, date_range, file_name, extension).

    Lines without a rule and lines of the wrong width are rejected unchanged; all others are anonymised by
    their file's rule.
    """
    fits = F.col("positions").isNotNull() & (field_count("value", sep) == F.col("width"))
    tagged = tagged.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    tagged = tagged.withColumn("outcome", F.when(F.col("_fits"), PUBLISHED).otherwise(REJECTED))
    tagged = tagged.withColumn("positions", F.when(F.col("_fits"), F.col("positions")))
    hashed = anonymize_lines(
        tagged, "value", "positions", salt, sep=sep, algorithm=algorithm, last_position=last_position
    )
    entity = F.when(F.col("entity") == "", "unknown").otherwise(F.col("entity"))
    return hashed.select("value", "outcome", entity.alias("entity"), "date_range", *FILE_KEY)


def highest_position(rules: DataFrame) -> int:
    """The highest field position any rule names (one number from the configuration)."""
    top = rules.agg(F.max(F.array_max("positions")).alias("top")).first()["top"]
    return top or 0


def publish_outcomes(outcomes: DataFrame, files: DataFrame, target: str, run: str, compression: str = "bzip2") -> None:
    """Published and rejected lines in one pass, a folder per file and outcome, in place of earlier ones.

    `files` (file_name, extension) are all files of the run, also those without a line.
    """
    write_version(outcomes, files, target, OUTCOME_FOLDERS, run, compression)


def read_outcomes(spark: SparkSession, target: str) -> DataFrame:
    return read_version(spark, target, OUTCOME_FOLDERS).drop("extension")


def read_published(spark: SparkSession, target: str) -> DataFrame:
    return read_outcomes(spark, target).where(F.col("outcome") == PUBLISHED).drop("outcome")


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    return read_outcomes(spark, target).where(F.col("outcome") == REJECTED).drop("outcome")


def processed_files(spark: SparkSession, target: str) -> DataFrame:
    """(file_name, extension, run, tried_at and more): the ledger of all files that a run has tried."""
    return ledger(spark, target)


def publish_archive(
    spark: SparkSession,
    archive: str,
    rules: DataFrame,
    target: str,
    salt: str,
    run: str = "batch",
    sep: str = "|",
    algorithm: str = "MD5",
    compression: str = "bzip2",
    already_published: DataFrame | None = None,
    files_per_slice: int = FILES_PER_SLICE,
) -> int:
    """Anonymise every archived file, one job per slice of files; returns the number of files.

    `already_published` (file_name, extension; `processed_files` gives them) leaves out files that are done. Only
    chosen files are opened. A slice that is done has its entries, so a job that failed goes on with the next one.
    """
    resolved = rules if "positions" in rules.columns else resolve_rules(spark, rules)
    files = list_files(spark, archive, already_published).select(*PLAN_COLUMNS)
    return publish_files(files, resolved, target, salt, run, sep, algorithm, compression, files_per_slice=files_per_slice)


def publish_files(
    files: DataFrame,
    rules: DataFrame,
    target: str,
    salt: str,
    run: str,
    sep: str = "|",
    algorithm: str = "MD5",
    compression: str = "bzip2",
    landing: str | None = None,
    files_per_slice: int = FILES_PER_SLICE,
) -> int:
    """Publish named files by resolved rules, and keep their raw lines in `landing` if that is given."""
    plan = Plan(with_rules(files, rules), files_per_slice)
    last = highest_position(rules) if plan.count else 0
    for _, known, lines in plan.each():
        if landing:
            write_version(lines, known, landing, FILE_KEY, run)
        publish_outcomes(anonymize_tagged(lines, salt, last, sep, algorithm), known, target, run, compression)
    return plan.count


def land_raw(lines: DataFrame, target: str, compression: str | None = None, files: DataFrame | None = None, run: str = "landing") -> None:
    """Raw copy of lines (value, path or name columns), one folder per source file, before any transformation.

    `files` (file_name, extension) names all files if some may have no line now; else those of the lines are taken.
    """
    if "file_name" not in lines.columns:
        name = source_file("path")
        keys = {"file_name": base_name(name), "extension": extension(name)}
        files = lines.select("path").distinct().withColumns(keys) if files is None else files
        lines = lines.withColumns(keys)
    write_version(lines, lines.select(*FILE_KEY).distinct() if files is None else files, target, FILE_KEY, run, compression)


def read_raw(spark: SparkSession, target: str) -> DataFrame:
    return read_version(spark, target, FILE_KEY).drop("extension")
