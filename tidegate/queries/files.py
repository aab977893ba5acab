"""File names, routing, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.filenames import parse_names, partition_date
from tidegate.functions.text import delimited_line, tuple_line
from tidegate.operators.inventory import next_per_entity, unpublished
from tidegate.operators.joins import inner_join
from tidegate.operators.quality import not_equal
from tidegate.operators.routing import route_files
from tidegate.queries.base import (
    CUSTOMER_SQL,
    ORDER_FILE_SQL,
    Query,
    customer_lines,
    customer_records,
    order_file_names,
    table,
    write_lines,
)
from tidegate.session import workspace
from tidegate.sinks import files as sinks
from tidegate.sources import text as sources
from tidegate.sources.catalog import catalog_columns, table_columns
from tidegate.sources.control import read_rules
from tidegate.sources.files import file_inventory

CONTROL_TABLE = """esquema_hive|nomtabla|cols|partcol|server|schema|user|file
depot|mobile_line|orderkey|fecha|store|depot|loader|Lines
depot|sms|custkey|fecha|store|depot|loader|Messages
depot|line|price|fecha|store|depot|loader|AnyLine
depot|sms_2000|custkey,price|fecha|store|depot|loader|Messages2000
depot|Upper|price|fecha|store|depot|loader|Never
"""


def control_rules(spark, text=CONTROL_TABLE):
    path = workspace(spark, "control")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return read_rules(spark, path)


def parsed(spark, sf):
    return parse_names(order_file_names(spark, sf))


def dates(spark, sf):
    frequency = F.when(F.col("entity") == "SMS", "Mensual").otherwise("diario")
    return parsed(spark, sf).select("o_orderkey", partition_date("from_ts", frequency).alias("fecha"))


def routed(spark, sf):
    names = parsed(spark, sf).select("file_name").dropDuplicates()
    return route_files(names, control_rules(spark)).select("file_name", "table_name", "digest_columns", "folder")


def next_file(spark, sf):
    return next_per_entity(parsed(spark, sf).where(F.col("entity") != ""), "entity", "path")


def unpublished_files(spark, sf):
    files = parsed(spark, sf).select("file_name", "entity")
    done = files.where(F.col("entity") == "SMS").select("file_name")
    return unpublished(files, done).dropDuplicates()


def text_lines(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    return sources.read_lines(spark, write_lines(docs, "lines")).groupBy("value").agg(F.count("*").alias("n"))


def text_multi(spark, sf):
    paths = [
        write_lines(table(spark, sf, name).select(delimited_line([key, value]).alias("value")), name)
        for name, key, value in (
            ("customer", "c_custkey", "c_name"),
            ("supplier", "s_suppkey", "s_name"),
            ("part", "p_partkey", "p_name"),
        )
    ]
    return sources.read_lines(spark, *paths)


def pipe_catalog(spark, sf):
    customer_records(spark, sf).withColumn("fecha", F.lit("20170930")).createOrReplaceTempView("tidegate_customer")
    columns = table_columns(spark, "tidegate_customer", "fecha")
    return sources.good_records(sources.read_delimited(spark, write_lines(customer_lines(spark, sf), "pipe"), columns))


def pipe_generated(spark, sf):
    return sources.good_records(sources.read_generated(spark, write_lines(customer_lines(spark, sf), "pipe")))


def csv_header(spark, sf):
    path = workspace(spark, "header")
    users = table(spark, sf, "customer").select(
        F.col("c_name").alias("id"), F.col("c_mktsegment").alias("topic"), F.col("c_custkey").alias("hits")
    )
    line = delimited_line(["id", "topic", "hits"], ",")
    # One record in 30 is short, one in 40 long; a header leads each file.
    ragged = F.when(F.col("hits") % 30 == 0, F.substring_index(line, ",", 2)).when(F.col("hits") % 40 == 0, F.concat(line, F.lit(",x")))
    users = users.select(F.coalesce(ragged, line).alias("id,topic,hits"))
    users.write.option("header", "true").option("quote", "").option("sep", "\u0001").csv(path)
    columns = sources.header_of(spark, path)
    return not_equal(sources.read_csv_header(spark, path, columns), "id", "Customer#000000001")


def csv_positional(spark, sf):
    lines = table(spark, sf, "part").select(delimited_line(["p_partkey", "p_name", "p_brand"], ",").alias("value"))
    rows = sources.read_csv_positional(spark, write_lines(lines, "csv"), ["id", "name"])
    return sources.good_records(rows)


def catalog(spark, sf):
    orders = table(spark, sf, "orders")
    orders.createOrReplaceTempView("tidegate_orders")
    listed = catalog_columns(spark, "tidegate_orders")
    filled = orders.select(*[F.count(c).alias(c) for c in table_columns(spark, "tidegate_orders")])
    filled = filled.unpivot([], list(filled.columns), "col_name", "n_filled")
    return inner_join(listed, filled, "col_name").select("col_name", "n_filled")


def inventory(spark, sf):
    o = table(spark, sf, "orders")
    lines = o.select(delimited_line(["o_orderkey", "o_totalprice"]).alias("value"), "o_orderpriority")
    path = workspace(spark, "inventory")
    sinks.write_by_key(lines, path, "o_orderpriority")
    files = file_inventory(spark, path, "part-*")
    folder = F.regexp_extract("path", r"o_orderpriority=([^/]*)/", 1)
    return files.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"))


def roundtrip(compression):
    def run(spark, sf):
        path = workspace(spark, "text")
        lines = table(spark, sf, "orders").select(tuple_line(["o_orderkey", "o_orderpriority"]).alias("value"))
        sinks.write_text(lines, path, compression)
        return sources.read_lines(spark, path)

    return run


def payloads(spark, sf):
    return table(spark, sf, "orders").select(
        F.encode(delimited_line(["o_orderkey", "o_orderpriority"]), "UTF-8").alias("payload")
    )


def binary(spark, sf):
    path = workspace(spark, "binary")
    sinks.write_binary(payloads(spark, sf), path)
    return spark.read.schema("payload binary").parquet(path).select(F.decode("payload", "UTF-8").alias("value"))


def sequence_file(spark, sf):
    path = workspace(spark, "sequence")
    sinks.write_sequence_file(payloads(spark, sf), "payload", path)
    return sinks.read_sequence_file(spark, path).select(F.decode("payload", "UTF-8").alias("value"))


def single_file(spark, sf):
    c = table(spark, sf, "customer").select(
        delimited_line(["c_custkey", "c_name"], ",").alias("value"), "c_name", "c_custkey"
    )
    path = workspace(spark, "single")
    sinks.write_single_file(c, path, ["c_name", "c_custkey"])
    return sources.read_lines(spark, path)


def by_key(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("value"))
    salaries = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("salary"))
    path = workspace(spark, "bykey")
    sinks.write_by_key(inner_join(names, salaries, "id").select("value", "salary"), path, "salary")
    return sinks.read_by_key(spark, path, "salary")


def idempotent(spark, sf):
    path = workspace(spark, "replace")
    lines = table(spark, sf, "orders").select(delimited_line(["o_orderkey"]).alias("value"), F.col("o_orderstatus").alias("k"))
    for _ in range(2):
        sinks.replace_partitions(lines, path, ["k"])
    sinks.replace_partitions(lines.where(F.col("k") == "P"), path, ["k"])
    return sinks.read_by_key(spark, path, "k")


ROUNDTRIP_SQL = "SELECT '(' || o_orderkey || ',' || o_orderpriority || ')' AS value FROM orders"
PAYLOAD_SQL = "SELECT o_orderkey || '|' || o_orderpriority AS value FROM orders"

QUERIES = {
    "parse_file_names": Query(
        parsed,
        f"""SELECT o_orderkey, path, CASE ending WHEN '.txt' THEN stem ELSE stem || '.COPYING' END AS file_name, entity,
                   day || 'T000000' AS from_ts, day || 'T235959' AS to_ts, day || 'T010000' AS run_ts, chunk,
                   day || 'T000000_' || day || 'T235959' AS date_range FROM {ORDER_FILE_SQL}""",
    ),
    "partition_date": Query(
        dates,
        f"""SELECT o_orderkey, CASE WHEN entity = 'SMS' THEN substr(day, 1, 6) ELSE day END AS fecha
            FROM {ORDER_FILE_SQL}""",
    ),
    "route_files_to_rules": Query(
        routed,
        f"""SELECT file_name, rule[1] AS table_name, rule[2] AS digest_columns, rule[3] AS folder
            FROM (SELECT file_name,
                         CASE WHEN contains(name, 'sms_2000') THEN ['sms_2000', 'custkey,price', 'Messages2000']
                              WHEN contains(name, 'line') THEN ['line', 'price', 'AnyLine']
                              WHEN contains(name, 'sms') THEN ['sms', 'custkey', 'Messages'] END AS rule
                  FROM (SELECT DISTINCT file_name, lower(file_name) AS name
                        FROM (SELECT CASE ending WHEN '.txt' THEN stem ELSE stem || '.COPYING' END AS file_name
                              FROM {ORDER_FILE_SQL})))""",
    ),
    "next_file_per_entity": Query(
        next_file, f"SELECT entity, min(path) AS path FROM {ORDER_FILE_SQL} GROUP BY entity"
    ),
    "unpublished_files": Query(
        unpublished_files,
        f"""SELECT DISTINCT CASE ending WHEN '.txt' THEN stem ELSE stem || '.COPYING' END AS file_name, entity
            FROM {ORDER_FILE_SQL} WHERE entity <> 'SMS'""",
    ),
    "src_text_lines": Query(
        text_lines,
        r"""SELECT line AS value, count(*) AS n
            FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents) GROUP BY line""",
    ),
    "src_text_multi": Query(
        text_multi,
        """SELECT c_custkey || '|' || c_name AS value FROM customer
           UNION ALL SELECT s_suppkey || '|' || s_name FROM supplier
           UNION ALL SELECT p_partkey || '|' || p_name FROM part""",
    ),
    "src_pipe_catalog_schema": Query(
        pipe_catalog, f"SELECT custkey, name, nation, acctbal, segment, note FROM {CUSTOMER_SQL}"
    ),
    "src_pipe_generated_schema": Query(
        pipe_generated,
        f"""SELECT custkey AS col0, name AS col1, nation AS col2, acctbal AS col3, segment AS col4, note AS col5
            FROM {CUSTOMER_SQL}""",
    ),
    "src_csv_header": Query(
        csv_header,
        """SELECT c_name AS id, c_mktsegment AS topic, CASE WHEN c_custkey % 30 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS hits,
                  CASE WHEN c_custkey % 30 = 0 THEN c_name || ',' || c_mktsegment
                       WHEN c_custkey % 40 = 0 THEN c_name || ',' || c_mktsegment || ',' || c_custkey || ',x' END AS _corrupt_record
           FROM customer WHERE c_name <> 'Customer#000000001'""",
    ),
    "src_csv_positional": Query(csv_positional, "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part"),
    "src_catalog_columns": Query(
        catalog,
        " UNION ALL ".join(
            f"SELECT '{c}' AS col_name, count({c}) AS n_filled FROM orders"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ),
    ),
    "src_file_inventory": Query(
        inventory,
        """SELECT o_orderpriority AS folder,
                  CAST(sum(length(o_orderkey || '|' || CAST(o_totalprice AS VARCHAR)) + 1) AS BIGINT) AS bytes
           FROM orders GROUP BY o_orderpriority""",
    ),
    "sink_text_roundtrip": Query(roundtrip(None), ROUNDTRIP_SQL),
    "sink_gzip_roundtrip": Query(roundtrip("gzip"), ROUNDTRIP_SQL),
    "sink_bzip2_roundtrip": Query(roundtrip("bzip2"), ROUNDTRIP_SQL),
    "sink_binary_roundtrip": Query(binary, PAYLOAD_SQL),
    "sink_sequence_file_roundtrip": Query(sequence_file, PAYLOAD_SQL),
    "sink_single_file": Query(single_file, "SELECT c_custkey || ',' || c_name AS value FROM customer"),
    "sink_partition_by_key": Query(
        by_key,
        "SELECT c_name AS value, o_orderpriority AS salary FROM customer JOIN orders ON o_custkey = c_custkey",
    ),
    "sink_overwrite_idempotent": Query(
        idempotent, "SELECT CAST(o_orderkey AS VARCHAR) AS value, o_orderstatus AS k FROM orders"
    ),
}
