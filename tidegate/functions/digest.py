"""Salted Base64 digests as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The digest algorithm names of the Java platform that Spark has natively.
ALGORITHMS = ("MD5", "SHA-1", "SHA-224", "SHA-256", "SHA-384", "SHA-512")

NULL_POLICIES = ("text", "keep")


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def algorithm_name(algorithm: str) -> str:
    """The canonical name: `sha256`, `SHA-256` and `Sha_256` are the same algorithm."""
    plain = algorithm.upper().replace("-", "").replace("_", "")
    if plain == "SHA":
        plain = "SHA1"
    for name in ALGORITHMS:
        if name.replace("-", "") == plain:
            return name
    raise ValueError(f"unknown digest algorithm {algorithm!r}, expected one of {', '.join(ALGORITHMS)}")


def digest(col: Column | str, salt: str, algorithm: str = "MD5", null_policy: str = "text") -> Column:
    """Base64 of hash(text + salt).

    null_policy "text" hashes a null as the text `null`, as string concatenation on the JVM does;
    "keep" leaves it null. A blank is a value under both.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {', '.join(NULL_POLICIES)}")
    name = algorithm_name(algorithm)
    text = as_column(col).cast("string")
    if null_policy == "text":
        text = F.coalesce(text, F.lit("null"))
    salted = F.concat(text, F.lit(salt))
    if name == "MD5":
        hexed = F.md5(salted)
    elif name == "SHA-1":
        hexed = F.sha1(salted)
    else:
        hexed = F.sha2(salted, int(name.split("-")[1]))
    encoded = F.base64(F.unhex(hexed))
    # Spark breaks Base64 text after 76 characters; only the 88 of SHA-512 reach that.
    return F.translate(encoded, "\r\n", "") if name == "SHA-512" else encoded


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_digest(
    spark: SparkSession, name: str = "digest", salt: str | None = None, algorithm: str = "MD5"
) -> None:
    """Make the digest callable from SQL text.

    With a salt the function takes the text alone; without one it takes (text, algorithm, salt).
    It is a SQL function, so Catalyst inlines it: no Python runs and a literal algorithm folds away.
    """
    if salt is not None:
        body = {
            "MD5": "md5({x})",
            "SHA-1": "sha1({x})",
        }.get(algorithm_name(algorithm), f"sha2({{x}}, {algorithm_name(algorithm)[-3:]})")
        salted = f"concat(coalesce(t, 'null'), {_quoted(salt)})"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING "
            f"RETURN translate(base64(unhex({body.format(x=salted)})), '\\r\\n', '')"
        )
        return
    salted = "concat(coalesce(t, 'null'), salt)"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING, algorithm STRING, salt STRING)
        RETURNS STRING
        RETURN translate(base64(unhex(
          CASE upper(replace(algorithm, '-', ''))
            WHEN 'MD5' THEN md5({salted})
            WHEN 'SHA' THEN sha1({salted})
            WHEN 'SHA1' THEN sha1({salted})
            WHEN 'SHA224' THEN sha2({salted}, 224)
            WHEN 'SHA256' THEN sha2({salted}, 256)
            WHEN 'SHA384' THEN sha2({salted}, 384)
            WHEN 'SHA512' THEN sha2({salted}, 512)
            ELSE raise_error(concat('unknown digest algorithm ', algorithm))
          END)), '\\r\\n', '')
        """
    )
