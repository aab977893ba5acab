"""Splitting, trimming and rendering of text records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.digest import as_column

# Fixed value: the characters that trimming on the JVM removes (code points 0 to 32).
CONTROL_AND_SPACE = "".join(chr(i) for i in range(33))

# Any of them except the blank.
CONTROL = r"[\x00-\x1f]"

# Line terminators of the text reader.
LINE_BREAK = r"\r\n|\r|\n"

_REGEX_SPECIALS = set("\\^$.|?*+()[]{}")


def separator_pattern(sep: str) -> str:
    """A regular expression for a literal separator; one character stays on the JVM's fast path."""
    return "".join("\\" + ch if ch in _REGEX_SPECIALS else ch for ch in sep)


def split_fields(col: Column | str, sep: str, limit: int = -1) -> Column:
    """Fields of a record, trailing blanks kept. With limit n the last field is the unsplit rest."""
    return F.split(as_column(col), separator_pattern(sep), limit)


def split_dropping_trailing(col: Column | str, sep: str) -> Column:
    """Fields of a record without trailing blanks: a line of separators only has no fields."""
    text = as_column(col)
    if len(sep) == 1:
        stripped = F.rtrim(text, F.lit(sep))
    else:
        stripped = F.regexp_replace(text, f"(?:{separator_pattern(sep)})+$", "")
    nothing = F.array().cast("array<string>")
    return F.when((stripped == "") & (text != ""), nothing).otherwise(F.split(stripped, separator_pattern(sep)))


def field(fields: Column, position: int) -> Column:
    """The field at a zero-based position, null where the record is shorter."""
    return F.get(fields, F.lit(position))


def lines_of(text: Column | str) -> Column:
    """The lines of a whole text, as the text reader sees them: no line after a final break."""
    text = as_column(text)
    body = F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


def jvm_trim(col: Column | str) -> Column:
    """Trim blanks and control characters on both sides."""
    return F.btrim(as_column(col), F.lit(CONTROL_AND_SPACE))


def blank_to(fields: Column, replacement: str = "0") -> Column:
    """Replace every blank field of an array."""
    return F.transform(fields, lambda x: F.when(x == "", F.lit(replacement)).otherwise(x))


def delimited_line(columns: Sequence[Column | str], sep: str = "|") -> Column:
    """One output line per row; a null becomes a blank field, so positions hold."""
    return F.concat_ws(sep, *[F.coalesce(as_column(c).cast("string"), F.lit("")) for c in columns])


def bracketed_line(columns: Sequence[Column | str]) -> Column:
    """The `[a,b,c]` rendering of a row; nulls print as `null`."""
    body = F.concat_ws(",", *[F.coalesce(as_column(c).cast("string"), F.lit("null")) for c in columns])
    return F.concat(F.lit("["), body, F.lit("]"))


def tuple_line(columns: Sequence[Column | str]) -> Column:
    """The `(a,b)` rendering of a pair; nulls print as `null`."""
    body = F.concat_ws(",", *[F.coalesce(as_column(c).cast("string"), F.lit("null")) for c in columns])
    return F.concat(F.lit("("), body, F.lit(")"))
