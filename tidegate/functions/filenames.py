"""What a file name says: entity, date range, run time, chunk, partition date.

Names look like `<entity>_<from>_<to>_<run>_<nn>.<ext>` with times as yyyyMMddTHHmmss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.digest import as_column

# The accepted name patterns.
STAMPS = r"(?:\d{8}T\d{6}_){3}\d{2}"
THREE_STAMPS = r"(\d{8}T\d{6}_){3}"
ENTITY = r"^((?:[A-Za-z]+_)*[A-Za-z]+)_\d{8}T"
IN_FLIGHT = "COPYING"
MONTHLY = "mensual"

NAME_COLUMNS = ("file_name", "entity", "from_ts", "to_ts", "run_ts", "chunk", "date_range")


def base_name(path: Column | str) -> Column:
    """Last path element without its extension."""
    return F.regexp_replace(F.substring_index(as_column(path), "/", -1), r"\.[^.]*+\z", "")


def extension(path: Column | str) -> Column:
    """What `base_name` leaves out, without the dot; `-` for a name that has none."""
    name = F.substring_index(as_column(path), "/", -1)
    found = F.regexp_extract(name, r"\.([^.]*+)\z", 1)
    return F.when(found == "", "-").otherwise(found)


def source_file(path: Column | str) -> Column:
    """The logical file of a path.

    A text output is a folder of part files, so for `.../X.txt/part-00000` and
    `.../drop=X.txt/part-00000` the answer is `X.txt`; for any other path it is the last element.
    """
    in_folder = r"(?:\A|/)(?:[A-Za-z_]++=)?+([^/]++)/part-[^/]*+\z"
    path = as_column(path)
    logical = F.when(path.contains("/part-"), F.regexp_replace(path, in_folder, "/$1")).otherwise(path)
    return F.substring_index(logical, "/", -1)


def scanned_path(path: Column) -> Column:
    """The plain path of a scan's `_metadata.file_path`, where special characters are URL-encoded."""
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), F.coalesce(plain, path)).otherwise(path)


def plain_path(path: Column) -> Column:
    """Local paths without `file:` and whatever slashes follow it, which differ between readers; others as they are."""
    local = F.concat(F.lit("/"), F.ltrim(F.substring(path, 6, 1 << 20), F.lit("/")))
    return F.when(path.startswith("file:"), local).otherwise(path)


def entity_of(name: Column | str) -> Column:
    return F.regexp_extract(as_column(name), ENTITY, 1)


def partition_date(from_ts: Column | str, frequency: Column | str) -> Column:
    """yyyyMM for monthly files, yyyyMMdd for the others. A plain string is a frequency, not a column."""
    frequency = F.lit(frequency) if isinstance(frequency, str) else frequency
    stamp = as_column(from_ts)
    return F.when(F.lower(frequency) == MONTHLY, F.substring(stamp, 1, 6)).otherwise(F.substring(stamp, 1, 8))


def is_accepted(name: Column | str) -> Column:
    """Complete file: not being copied, and three timestamps in its name."""
    name = as_column(name)
    return name.rlike(THREE_STAMPS) & ~name.contains(IN_FLIGHT)


def parse_names(df: DataFrame, path: str = "path") -> DataFrame:
    """Add the name columns of a path column; a rejected name gives blanks."""
    named = df.withColumn("file_name", base_name(source_file(path)))
    stamped = named.select(
        "*", entity_of("file_name").alias("entity"), F.regexp_extract("file_name", STAMPS, 0).alias("_stamps")
    )
    # the stamps have fixed widths, so one match gives all of them
    return stamped.select(
        *named.columns,
        "entity",
        F.substring("_stamps", 1, 15).alias("from_ts"),
        F.substring("_stamps", 17, 15).alias("to_ts"),
        F.substring("_stamps", 33, 15).alias("run_ts"),
        F.substring("_stamps", 49, 2).alias("chunk"),
        F.substring("_stamps", 1, 31).alias("date_range"),
    )
