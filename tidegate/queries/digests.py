"""Digest and anonymisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.digest import digest, register_digest
from tidegate.operators.anonymize import (
    ENTITY_POSITIONS,
    anonymize_by_name,
    anonymize_lines,
    digest_lookup_join,
)
from tidegate.operators.projections import concat_digests, pair_with_literal_key
from tidegate.queries.base import CUSTOMER_SQL, SALT, Query, customer_lines, md5_sql, table


def digest_column(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        digest("c_name", SALT).alias("md5_digest"),
        digest("c_name", SALT, "SHA-1").alias("sha1_digest"),
        digest("c_name", SALT, "SHA-256").alias("sha256_digest"),
        digest(F.expr("nullif(c_mktsegment, 'BUILDING')"), SALT).alias("null_digest"),
    )


def by_name(spark, sf):
    return anonymize_by_name(table(spark, sf, "customer"), ["c_name", "c_mktsegment"], SALT, drop=["c_nationkey"])


def by_position(spark, sf):
    return anonymize_lines(customer_lines(spark, sf), "value", ENTITY_POSITIONS["mobile_line"], SALT)


def unknown_columns(spark, sf):
    wanted = ["S_NAME", "no_such_column"]
    return anonymize_by_name(table(spark, sf, "supplier"), wanted, SALT, case_sensitive=False)


def sql_function(spark, sf):
    register_digest(spark)
    part = table(spark, sf, "part")
    return part.selectExpr(
        "p_partkey", f"digest(p_name, 'MD5', '{SALT}') AS p_name", f"digest(p_brand, 'SHA-256', '{SALT}') AS p_brand"
    )


def digest_concat(spark, sf):
    return table(spark, sf, "part").select("p_partkey", concat_digests(["p_name", "p_type"], SALT).alias("pair"))


def lookup_join(spark, sf):
    c = table(spark, sf, "customer")
    return digest_lookup_join(c, c, "c_custkey", ["c_name", "c_mktsegment"], SALT)


def literal_key(spark, sf):
    wide = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return pair_with_literal_key(wide, "c_custkey", ["c_name", "c_mktsegment"]).select(
        "c_custkey",
        "key",
        "value",
        digest(F.when(F.col("value") == "c_name", F.col("c_name")).otherwise(F.col("c_mktsegment")), SALT).alias("digest"),
    )


QUERIES = {
    "digest_column": Query(
        digest_column,
        f"""SELECT c_custkey, {md5_sql("c_name")} AS md5_digest,
                   base64(unhex(sha1(c_name || '{SALT}'))) AS sha1_digest,
                   base64(unhex(sha256(c_name || '{SALT}'))) AS sha256_digest,
                   {md5_sql("coalesce(nullif(c_mktsegment, 'BUILDING'), 'null')")} AS null_digest
            FROM customer""",
    ),
    "anonymize_by_name": Query(
        by_name,
        f"""SELECT c_custkey, {md5_sql("c_name")} AS c_name, c_acctbal, {md5_sql("c_mktsegment")} AS c_mktsegment
            FROM customer""",
    ),
    "anonymize_by_position": Query(
        by_position,
        f"""SELECT custkey || '|' || {md5_sql("name")} || '|' || {md5_sql("nation")} || '|' || acctbal || '|'
                   || {md5_sql("segment")} || '|' || {md5_sql("note")} AS value
            FROM {CUSTOMER_SQL}""",
    ),
    "anonymize_unknown_cols": Query(
        unknown_columns,
        f"SELECT s_suppkey, {md5_sql('s_name')} AS s_name, s_nationkey, s_acctbal FROM supplier",
    ),
    "digest_sql_function": Query(
        sql_function,
        f"""SELECT p_partkey, {md5_sql("p_name")} AS p_name,
                   base64(unhex(sha256(p_brand || '{SALT}'))) AS p_brand FROM part""",
    ),
    "proj_digest_concat": Query(
        digest_concat, f"SELECT p_partkey, {md5_sql('p_name')} || '|' || {md5_sql('p_type')} AS pair FROM part"
    ),
    "digest_lookup_join": Query(
        lookup_join,
        f"""SELECT c.*, d.n AS c_name_digest, d.s AS c_mktsegment_digest
            FROM customer c JOIN (SELECT c_custkey AS k, {md5_sql("c_name")} AS n, {md5_sql("c_mktsegment")} AS s
                                  FROM customer) d ON c.c_custkey = d.k""",
    ),
    "proj_literal_key": Query(
        literal_key,
        f"""SELECT c_custkey, 'c_custkey' AS key, 'c_name' AS value, {md5_sql("c_name")} AS digest FROM customer
            UNION ALL
            SELECT c_custkey, 'c_custkey', 'c_mktsegment', {md5_sql("c_mktsegment")} FROM customer""",
    ),
}
