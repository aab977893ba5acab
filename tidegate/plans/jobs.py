"""Word count, single-table anonymisation, and the load / extract / publish chain."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.filenames import partition_date
from tidegate.functions.text import delimited_line
from tidegate.operators.anonymize import anonymize_lines, entity_positions, match_columns
from tidegate.operators.inventory import next_per_entity
from tidegate.operators.quality import field_count
from tidegate.operators.words import count_words, line_words
from tidegate.plans.publish import FILE_KEY, PLAN_COLUMNS, PUBLISHED, REJECTED, Plan, list_files, named, publish_outcomes
from tidegate.session import session_setting, workspace
from tidegate.sinks.files import remove_outputs_of, replace_partitions, write_text
from tidegate.sinks.versions import write_version
from tidegate.sources.catalog import table_columns
from tidegate.sources.text import CORRUPT, good_records, parse_records, read_lines


def count_words_job(spark: SparkSession, source: str, target: str) -> None:
    """Word counts of text files, written as `(word,count)` lines."""
    counts = count_words(line_words(read_lines(spark, source)))
    lines = counts.select(F.concat(F.lit("("), "w", F.lit(","), F.col("n").cast("string"), F.lit(")")).alias("value"))
    write_text(lines, target)


class AnonymizeReport(NamedTuple):
    columns: list[str]
    unknown: list[str]


def anonymize_file_job(
    spark: SparkSession,
    source: str,
    table: str,
    columns: Iterable[str],
    target: str,
    salt: str,
    partition_column: str | None = None,
    rejects: str | None = None,
    sep: str = "|",
    algorithm: str = "MD5",
    case_sensitive: bool = True,
    bracketed: bool = False,
    compression: str = "bzip2",
) -> AnonymizeReport:
    """Anonymise delimited files by column name and replace the target.

    The catalog gives the column order, so the names become field positions: a line is split only up
    to the last anonymised field and nothing is shuffled. Lines with another number of fields go to
    `rejects`, by default a folder of the target's name with `.rejected` behind it.
    """
    rejects = rejects or f"{target.rstrip('/')}.rejected"
    fields = table_columns(spark, table, partition_column)
    known, unknown = match_columns(fields, columns, case_sensitive)
    lines = read_lines(spark, source)
    fits = field_count("value", sep) == len(fields)
    hashed = anonymize_lines(
        lines.where(fits), "value", [fields.index(c) + 1 for c in known], salt, sep=sep, algorithm=algorithm
    )
    if bracketed:
        body = F.replace("value", F.lit(sep), F.lit(","))
        hashed = hashed.select(F.concat(F.lit("["), body, F.lit("]")).alias("value"))
    write_text(hashed, target, compression)
    write_text(lines.where(~fits), rejects)
    return AnonymizeReport(known, unknown)


def load_partition(
    spark: SparkSession,
    lines: DataFrame,
    columns: Sequence[str],
    table: str,
    frequency: str,
    rejects: str,
    sep: str = "|",
    files: DataFrame | None = None,
) -> None:
    """Load lines (value, path) into the `fecha` partitions of a table, the dates of their files.

    Each file has its own sub-partition: loading it again replaces it, and a second file of the same date does
    not erase the first. Lines of another width go to `rejects`, one folder per file. `files` (path) lists
    files that may have no line left; by default the files are those of the lines.
    """
    folder = workspace(spark, "known")
    named(lines.select("path").distinct()).select("path", "from_ts", *FILE_KEY).write.parquet(f"{folder}/lines")
    places = spark.read.parquet(f"{folder}/lines")
    tried = (places if files is None else named(files)).select("from_ts", *FILE_KEY).dropDuplicates()
    if files is not None:
        tried.write.parquet(f"{folder}/files")
        tried = spark.read.parquet(f"{folder}/files")
    dates = sorted(row.fecha for row in tried.select(partition_date("from_ts", frequency).alias("fecha")).distinct().collect())
    # Names are parsed once per file; a line meets those of its file by the path.
    _load(spark, lines.select("value", "path").join(places, "path"), tried, dates, columns, table, frequency, sep, rejects)


def _load(
    spark: SparkSession, lines: DataFrame, tried: DataFrame, dates: Sequence[str], columns: Sequence[str], table: str, frequency: str, sep: str,
    rejects: str | None,
) -> None:
    """Load lines of the `tried` files, whose partitions are `dates`."""
    dated = lines.select("value", partition_date("from_ts", frequency).alias("fecha"), *FILE_KEY)
    records = parse_records(dated, columns, sep, keep=["fecha", *FILE_KEY])
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    remove_outputs_of(tried, detail.data_type, *[f"fecha={date}" for date in dates])
    with session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        good_records(records).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    if rejects:
        bad = records.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"), *FILE_KEY)
        write_version(bad, tried, rejects, FILE_KEY, "load")


def create_partitioned_table(spark: SparkSession, table: str, columns: Sequence[str], location: str) -> None:
    """Catalog entry of a table folder that `load_partition` fills."""
    listed = ", ".join([*[f"`{c}` STRING" for c in columns], "fecha STRING", "file_name STRING", "extension STRING"])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet "
        f"PARTITIONED BY (fecha, file_name, extension) LOCATION '{location}'"
    )


def extract_partition(
    spark: SparkSession,
    table: str,
    dates: Sequence[str],
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    sep: str = "|",
) -> DataFrame:
    """Delimited lines (value, fecha, file_name, extension) of chosen `fecha` partitions, enriched on the way.

    The date filter prunes partitions, so other dates are not read.
    """
    rows = spark.table(table).where(F.col("fecha").isin(list(dates)))
    if enrich is not None:
        rows = enrich(rows)
    data = [c for c in rows.columns if c not in ("fecha", *FILE_KEY)]
    return rows.select(delimited_line(data, sep).alias("value"), "fecha", *FILE_KEY)


def write_extract(lines: DataFrame, target: str) -> None:
    """Text output of an extraction, one folder per date and file."""
    replace_partitions(lines, target, ["fecha", *FILE_KEY])


def pending_files(
    spark: SparkSession, inbox: str, entity: str, done: DataFrame | None = None, only_next: bool = False
) -> DataFrame:
    """Accepted files of an entity that are not done yet; `only_next` keeps the lowest name."""
    files = list_files(spark, inbox, done).where(F.col("entity") == entity.lower())
    if only_next:
        whole = files.withColumn("_whole", F.concat_ws(".", *FILE_KEY))
        lowest = next_per_entity(whole, "entity", "_whole").select("_whole")
        files = whole.join(lowest, "_whole", "left_semi").drop("_whole")
    return files


def load_extract_publish(
    spark: SparkSession,
    inbox: str,
    entity: str,
    frequency: str,
    columns: Sequence[str],
    table: str,
    target: str,
    salt: str,
    positions: Sequence[int] | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    published: DataFrame | None = None,
    only_next: bool = False,
    sep: str = "|",
    algorithm: str = "MD5",
    index_base: int = 1,
    run: str = "batch",
) -> list[str]:
    """Load the pending files of an entity, extract their dates when an enrichment is given,
    anonymise by position and publish one output per file. Returns the loaded dates.

    `published` are the files that are done (`processed_files`). Only pending files are opened. Lines of
    another width are published as rejected, and a file counts as done whatever its lines were. A failing
    load ends the job before anything is published, so the files stay pending.
    """
    if positions is None:
        positions = entity_positions(entity)
    pending = pending_files(spark, inbox, entity, published, only_next)
    plan = Plan(pending.select(*PLAN_COLUMNS, partition_date("from_ts", frequency).alias("fecha")))
    loaded: set[str] = set()
    for rows, files, lines in plan.each():
        dates = sorted({row.fecha for row in rows})
        _load(spark, lines, files, dates, columns, table, frequency, sep, rejects=None)
        fits = field_count("value", sep) == len(columns)
        good, folders = lines.where(fits), ["entity", "date_range", *FILE_KEY]
        if enrich is not None:
            keys = files.select(*folders).dropDuplicates()  # of a slice
            good = extract_partition(spark, table, dates, enrich, sep).join(F.broadcast(keys), [*FILE_KEY])
        hashed = anonymize_lines(good, "value", positions, salt, sep=sep, algorithm=algorithm, index_base=index_base)
        outcomes = hashed.select("value", F.lit(PUBLISHED).alias("outcome"), *folders).unionByName(
            lines.where(~fits).select("value", F.lit(REJECTED).alias("outcome"), *folders)
        )
        publish_outcomes(outcomes, files, target, run)
        loaded.update(dates)
    return sorted(loaded)
