"""Replacing chosen columns or field positions by their digest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.digest import digest
from tidegate.functions.text import field, split_fields

# One-based positions to anonymise per entity; `*` stands for any text.
ENTITY_POSITIONS = {
    "mobile_line": (2, 3, 5, 6),
    "call_cdr": (2, 3, 6, 7),
    "data_xdr": (2, 3),
    "sms": (2, 3, 5, 6),
    "mobile_line_*_traffic": (5,),
    "mobile_line_*_tariff": (5,),
    "mobile_service": (4, 5),
    "mobile_service_movement": (4, 5),
}


def match_columns(
    actual: Sequence[str], requested: Iterable[str], case_sensitive: bool = True
) -> tuple[list[str], list[str]]:
    """Split the requested names into those that exist (in table order) and the unknown rest."""
    fold = (lambda s: s) if case_sensitive else str.lower
    wanted = {fold(name.strip()): name for name in requested}
    known = [name for name in actual if fold(name) in wanted]
    found = {fold(name) for name in known}
    return known, [name for key, name in wanted.items() if key not in found]


def anonymize_by_name(
    df: DataFrame,
    columns: Iterable[str],
    salt: str,
    algorithm: str = "MD5",
    drop: Iterable[str] = (),
    case_sensitive: bool = True,
    null_policy: str = "text",
) -> DataFrame:
    """Digest the named columns, pass the others through, keep the order.

    Names the table lacks are ignored here; `match_columns` tells which they are.
    """
    kept = [c for c in df.columns if c not in set(drop)]
    known, _ = match_columns(kept, columns, case_sensitive)
    return df.select(
        *[digest(F.col(f"`{c}`"), salt, algorithm, null_policy).alias(c) if c in known else F.col(f"`{c}`") for c in kept]
    )


def entity_positions(entity: str) -> tuple[int, ...]:
    """The positions of one entity; an entity without a rule is an error."""
    for pattern, positions in ENTITY_POSITIONS.items():
        if fnmatchcase(entity.lower(), pattern):
            return positions
    raise ValueError(f"no positions for entity {entity!r}")


def positions_for(entity: Column | str) -> Column:
    """The positions of an entity as array<int>, null for an entity without a rule."""
    name = F.lower(F.col(entity) if isinstance(entity, str) else entity)
    chosen = F.lit(None).cast("array<int>")
    for pattern, positions in ENTITY_POSITIONS.items():
        hit = name.like(pattern.replace("_", r"\_").replace("*", "%")) if "*" in pattern else name == pattern
        chosen = F.when(hit, F.array(*[F.lit(p) for p in positions])).otherwise(chosen)
    return chosen


def anonymize_lines(
    df: DataFrame,
    line: str,
    positions: Sequence[int] | str,
    salt: str,
    sep: str = "|",
    algorithm: str = "MD5",
    index_base: int = 1,
    last_position: int | None = None,
) -> DataFrame:
    """Digest fields of a delimited line by position, in place.

    `positions` is a list, or the name of an array<int> column when every row has its own rule (a null
    changes nothing); then `last_position` is the highest position any rule names. Only the fields up to that position are
    split off; the rest of the line is carried over as one piece.
    """
    by_row = isinstance(positions, str)
    if by_row and last_position is None:
        raise ValueError("last_position is required when positions come from a column")
    if not by_row and any(p < index_base for p in positions):
        raise ValueError(f"positions start at {index_base}")
    last = last_position if by_row else max(positions, default=index_base - 1)
    width = last - index_base + 1
    if width < 1:
        return df
    fields = F.col("_fields")

    def piece(i: int) -> Column:
        raw = field(fields, i)
        if not by_row:
            # a record that ends before this field stays as short as it is
            return F.when(raw.isNotNull(), digest(raw, salt, algorithm)) if i + index_base in positions else raw
        hit = F.coalesce(F.array_contains(F.col(positions), i + index_base), F.lit(False)) & raw.isNotNull()
        return F.when(hit, digest(raw, salt, algorithm)).otherwise(raw)

    rebuilt = F.concat_ws(sep, *[piece(i) for i in range(width)], field(fields, width))
    return (
        df.withColumn("_fields", split_fields(line, sep, width + 1))
        .withColumn(line, F.when(F.col(line).isNotNull(), rebuilt))
        .drop("_fields")
    )


def digest_lookup_join(
    original: DataFrame,
    source: DataFrame,
    key: str,
    values: Sequence[str],
    salt: str,
    algorithm: str = "MD5",
) -> DataFrame:
    """Inner join of the original rows with (key, digest(value)) lookups, one digest column per value.

    All lookups come from one pass over the source and one join. The key must be unique in the
    source: a second row for a key would multiply the result, so it fails the query instead.
    """
    lookup = source.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.first(v).alias(f"{v}_digest") for v in values]
    )
    checked = F.when(
        F.col("_rows") > 1, F.raise_error(F.concat(F.lit("lookup key is not unique: "), F.col(key).cast("string")))
    ).otherwise(F.col(key))
    digests = lookup.select(
        checked.alias("_key"), *[digest(f"{v}_digest", salt, algorithm).alias(f"{v}_digest") for v in values]
    )
    return original.join(digests, original[key] == digests["_key"]).drop("_key")
