"""Shared parts of the registered queries: tables, lines and files derived from them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import delimited_line
from tidegate.session import workspace
from tidegate.sinks.files import write_by_key

SALT = "s1"


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def md5_sql(expr: str) -> str:
    return f"base64(unhex(md5({expr} || '{SALT}')))"


# Customer records with blanks inside and at the end.
CUSTOMER_FIELDS = ("custkey", "name", "nation", "acctbal", "segment", "note")


def customer_records(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("custkey"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 5 == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
        F.col("c_acctbal").cast("string").alias("acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.lit("").alias("note"),
    )


CUSTOMER_SQL = """(
  SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_name AS name,
         CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
         CAST(c_acctbal AS VARCHAR) AS acctbal,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment,
         '' AS note
  FROM customer)"""

def customer_lines(spark: SparkSession, sf: str) -> DataFrame:
    return customer_records(spark, sf).select(delimited_line(CUSTOMER_FIELDS).alias("value"))


# File names derived from orders: entity by status, one day per name, one in 17 still being copied.
def order_entity(status: Column) -> Column:
    return F.when(status == "P", "Mobile_Line").when(status == "F", "SMS").otherwise("Call_CDR")


ORDER_ENTITY_SQL = "CASE o_orderstatus WHEN 'P' THEN 'Mobile_Line' WHEN 'F' THEN 'SMS' ELSE 'Call_CDR' END"


def order_file_names(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "yyyyMMdd"))
    day = F.col("day")
    chunk = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    ending = F.when(F.col("o_orderkey") % 17 == 0, ".COPYING.txt").otherwise(".txt")
    entity = order_entity(F.col("o_orderstatus"))
    name = F.concat(
        entity, F.lit("_"), day, F.lit("T000000_"), day, F.lit("T235959_"), day, F.lit("T010000_"), chunk, ending
    )
    return o.select("o_orderkey", F.concat(F.lit("/landing/"), F.lower(entity), F.lit("/"), name).alias("path"))


ORDER_FILE_SQL = f"""(
  SELECT o_orderkey, o_orderstatus, entity, day, chunk, ending,
         entity || '_' || day || 'T000000_' || day || 'T235959_' || day || 'T010000_' || chunk AS stem,
         '/landing/' || lower(entity) || '/' || entity || '_' || day || 'T000000_' || day || 'T235959_'
           || day || 'T010000_' || chunk || ending AS path
  FROM (SELECT o_orderkey, o_orderstatus, {ORDER_ENTITY_SQL} AS entity,
               strftime(o_orderdate, '%Y%m%d') AS day,
               lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS chunk,
               CASE WHEN o_orderkey % 17 = 0 THEN '.COPYING.txt' ELSE '.txt' END AS ending
        FROM orders))"""


# Archive files derived from orders: entity by status, one year per file in two chunks. One line in 50
# lacks its last field.
ORDER_FIELDS = ("orderkey", "custkey", "status", "price", "orderdate", "priority")


def order_drops(spark: SparkSession, sf: str) -> DataFrame:
    """(value, drop): a delimited line and the name of the file it belongs to."""
    o = table(spark, sf, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    year = F.col("year")
    name = F.concat(
        order_entity(F.col("o_orderstatus")),
        F.lit("_"), year, F.lit("0101T000000_"), year, F.lit("1231T235959_"), year, F.lit("1231T235959_0"),
        (F.col("o_orderkey") % 2 + 1).cast("string"), F.lit(".txt"),
    )
    whole = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd")]
    line = F.when(F.col("o_orderkey") % 50 == 0, delimited_line(whole)).otherwise(
        delimited_line([*whole, "o_orderpriority"])
    )
    return o.select(line.alias("value"), name.alias("drop"))


ORDER_DROP_SQL = f"""(
  SELECT *, CASE WHEN short THEN head ELSE head || '|' || o_orderpriority END AS value,
         CAST(o_orderkey AS VARCHAR) || '|' || {md5_sql("CAST(o_custkey AS VARCHAR)")} || '|' || o_orderstatus || '|'
           || {md5_sql("CAST(o_totalprice AS VARCHAR)")} || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|'
           || o_orderpriority AS hashed
  FROM (SELECT *, o_orderkey % 50 = 0 AS short, {ORDER_ENTITY_SQL} AS entity,
               year(o_orderdate) || '0101T000000_' || year(o_orderdate) || '1231T235959' AS date_range,
               {ORDER_ENTITY_SQL} || '_' || year(o_orderdate) || '0101T000000_' || year(o_orderdate)
                 || '1231T235959_' || year(o_orderdate) || '1231T235959_0' || (o_orderkey % 2 + 1) AS file_name,
               o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || CAST(o_totalprice AS VARCHAR)
                 || '|' || strftime(o_orderdate, '%Y-%m-%d') AS head
        FROM orders))"""


def write_drops(drops: DataFrame, label: str) -> str:
    """Write (value, drop) as one folder per file name and return the archive folder."""
    archive = workspace(drops.sparkSession, label)
    write_by_key(drops, archive, "drop")
    return archive


def write_lines(lines: DataFrame, label: str) -> str:
    """Write text lines to a new folder and return it."""
    path = workspace(lines.sparkSession, label)
    lines.write.text(path)
    return path
