"""Whole jobs and their streaming forms."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tidegate.functions.text import delimited_line
from tidegate.plans import jobs, publish
from tidegate.queries.base import (
    CUSTOMER_FIELDS,
    CUSTOMER_SQL,
    ORDER_DROP_SQL,
    ORDER_FIELDS,
    SALT,
    Query,
    customer_lines,
    md5_sql,
    order_drops,
    table,
    write_drops,
    write_lines,
)
from tidegate.queries.files import control_rules
from tidegate.session import workspace
from tidegate.sinks.files import read_by_key
from tidegate.sources.text import read_lines
from tidegate.sources.listing import changed_files
from tidegate.streaming.ingest import start_file_ingest
from tidegate.streaming.messages import file_messages, land_messages

ORDER_RULES = """esquema_hive|nomtabla|cols|partcol|server|schema|user|file
tidegate_rules|mobile_line|custkey,price,no_such_column|fecha|store|depot|loader|Mobile_Line
tidegate_rules|sms|PRICE,custkey|fecha|store|depot|loader|SMS
"""

EVENT_FIELDS = ("event_id", "user_id", "kind", "amount")

EVENT_RULES = """esquema_hive|nomtabla|cols|partcol|server|schema|user|file
tidegate_rules|web|user_id|fecha|store|depot|loader|Web
"""


@contextmanager
def schemas(spark, *names, columns):
    """Catalog entries with the given text columns and a partition column, while rules are resolved.

    Views of the caller with these names stay as they are: the entries live in a schema of their own.
    """
    listed = ", ".join(f"{c} STRING" for c in [*columns, "fecha"])
    spark.sql("CREATE DATABASE IF NOT EXISTS tidegate_rules")
    for name in names:
        spark.sql(f"CREATE TABLE IF NOT EXISTS tidegate_rules.{name} ({listed}) USING parquet")
    try:
        yield
    finally:
        spark.sql("DROP DATABASE IF EXISTS tidegate_rules CASCADE")


def word_count_job(spark, sf):
    target = workspace(spark, "wc")
    source = write_lines(table(spark, sf, "documents").select("text"), "wc-in")
    jobs.count_words_job(spark, source, target)
    return read_lines(spark, target)


def anonymize_file(spark, sf):
    target = workspace(spark, "anonymized")
    with schemas(spark, "subscribers", columns=CUSTOMER_FIELDS):
        jobs.anonymize_file_job(
            spark,
            write_lines(customer_lines(spark, sf), "subscribers"),
            "tidegate_rules.subscribers",
            ["name", "segment", "note", "no_such_column"],
            target,
            SALT,
            partition_column="fecha",
        )
    return read_lines(spark, target)


def batch_publish(spark, sf):
    archive = write_drops(order_drops(spark, sf), "archive")
    target = workspace(spark, "published")
    with schemas(spark, "mobile_line", "sms", columns=ORDER_FIELDS):
        publish.publish_archive(spark, archive, control_rules(spark, ORDER_RULES), target, SALT)
    return publish.read_outcomes(spark, target)


def republish_corrected(spark, sf):
    """Publish, then publish again: short lines are complete now, and the rules no longer know one entity."""
    drops = order_drops(spark, sf)
    archive = write_drops(drops, "archive")
    target = workspace(spark, "published")
    short = F.size(F.split("value", r"\|")) < len(ORDER_FIELDS)
    corrected = drops.withColumn("value", F.when(short, F.concat("value", F.lit("|none"))).otherwise(F.col("value")))
    with schemas(spark, "mobile_line", "sms", columns=ORDER_FIELDS):
        publish.publish_archive(spark, archive, control_rules(spark, ORDER_RULES), target, SALT)
        only_sms = "\n".join(line for line in ORDER_RULES.split("\n") if "mobile_line" not in line)
        publish.publish_archive(spark, write_drops(corrected, "archive"), control_rules(spark, only_sms), target, SALT)
    return publish.read_outcomes(spark, target)


def raw_landing(spark, sf):
    archive = write_drops(order_drops(spark, sf), "archive")
    target = workspace(spark, "landing")
    publish.land_raw(read_lines(spark, archive, recursive=True, with_path=True), target)
    return publish.read_raw(spark, target)


def load_orders(spark, sf, frequency):
    archive = write_drops(order_drops(spark, sf), "inbox")
    location = workspace(spark, "table")
    lines = read_lines(spark, archive, recursive=True, with_path=True)
    name = "tidegate_" + location.rsplit("-", 1)[1]
    jobs.create_partitioned_table(spark, name, ORDER_FIELDS, location)
    rejects = workspace(spark, "load-rejects")
    jobs.load_partition(spark, lines, ORDER_FIELDS, name, frequency, rejects)
    return name, location, rejects


def load_partition(spark, sf):
    name, location, rejects = load_orders(spark, sf, "mensual")
    loaded = spark.read.schema(spark.table(name).schema).parquet(location).drop("extension")
    spark.sql(f"DROP TABLE {name}")
    bad = publish.read_raw(spark, rejects).withColumnRenamed("value", "rejected")
    return loaded.unionByName(bad, allowMissingColumns=True)


def extract_partition(spark, sf):
    name, _, _ = load_orders(spark, sf, "diario")
    days = [r.fecha for r in spark.table(name).select("fecha").distinct().collect()]
    target = workspace(spark, "extract")
    enriched = jobs.extract_partition(
        spark, name, days, lambda rows: rows.withColumn("label", F.concat("status", F.lit("-"), "priority"))
    )
    jobs.write_extract(enriched, target)
    spark.sql(f"DROP TABLE {name}")
    return read_by_key(spark, target, ["fecha", "file_name", "extension"]).drop("extension")


def load_extract_publish(spark, sf):
    archive = write_drops(order_drops(spark, sf), "inbox")
    location = workspace(spark, "table")
    target = workspace(spark, "published")
    name = "tidegate_" + location.rsplit("-", 1)[1]
    jobs.create_partitioned_table(spark, name, ORDER_FIELDS, location)
    enrich = lambda rows: rows.withColumn("label", F.concat("status", F.lit("-"), "priority"))
    for entity, extra in (("mobile_line", enrich), ("sms", None)):
        jobs.load_extract_publish(
            spark, archive, entity, "mensual", ORDER_FIELDS, name, target, SALT, positions=[2, 4], enrich=extra
        )
    spark.sql(f"DROP TABLE {name}")
    return publish.read_outcomes(spark, target)


def event_drops(spark, sf):
    """Event lines as files per kind and month; errors belong to an entity without a rule."""
    e = table(spark, sf, "events")
    entity = F.when(F.col("event_type") == "error", "Failures").otherwise("Web_Visits")
    month = F.date_format("ts", "yyyyMM")
    name = F.concat(
        entity, F.lit("_"), month, F.lit("01T000000_"), month, F.lit("28T235959_"), month, F.lit("28T235959_0"),
        (F.col("event_id") % 3 + 1).cast("string"), F.lit(".txt"),
    )
    whole = delimited_line(["event_id", "user_id", "event_type", F.col("value")])
    line = F.when(F.col("event_id") % 40 == 0, F.concat(whole, F.lit("|extra"))).otherwise(whole)
    return e.select(line.alias("value"), name.alias("drop"))


def run_ingest(spark, sf):
    drops = write_drops(event_drops(spark, sf), "stream-in")
    landing, target = workspace(spark, "stream-landing"), workspace(spark, "stream-published")
    with schemas(spark, "web", columns=EVENT_FIELDS):
        query = start_file_ingest(
            changed_files(spark, drops),
            control_rules(spark, EVENT_RULES),
            landing,
            target,
            workspace(spark, "stream-checkpoint"),
            SALT,
            once=True,
            max_files=8,
        )
    query.awaitTermination()
    return landing, target


def stream_file_ingest(spark, sf):
    landing, target = run_ingest(spark, sf)
    landed = publish.read_raw(spark, landing).select(F.lit("landed").alias("stage"), "value", "file_name")
    done = publish.read_published(spark, target).select(F.lit("published").alias("stage"), "value", "file_name")
    return landed.unionByName(done)


def stream_rejects(spark, sf):
    _, target = run_ingest(spark, sf)
    return publish.read_rejected(spark, target)


def message_landing(spark, sf):
    schema = table(spark, sf, "events").schema
    messages = file_messages(spark, sf, schema, F.col("user_id"), F.col("props"), glob="events.parquet")
    target = workspace(spark, "messages")
    land_messages(messages, target, workspace(spark, "messages-checkpoint"), once=True).awaitTermination()
    return spark.read.text(target)


EVENT_SQL = f"""(
  SELECT *, CASE WHEN long THEN head || '|extra' ELSE head END AS value,
         event_id || '|' || {md5_sql("CAST(user_id AS VARCHAR)")} || '|' || event_type || '|' || CAST(amount AS VARCHAR) AS hashed
  FROM (SELECT event_id, user_id, event_type, value AS amount, event_id % 40 = 0 AS long, entity,
               strftime(ts, '%Y%m') || '01T000000_' || strftime(ts, '%Y%m') || '28T235959' AS date_range,
               entity || '_' || strftime(ts, '%Y%m') || '01T000000_' || strftime(ts, '%Y%m') || '28T235959_'
                 || strftime(ts, '%Y%m') || '28T235959_0' || (event_id % 3 + 1) AS file_name,
               event_id || '|' || user_id || '|' || event_type || '|' || CAST(value AS VARCHAR) AS head
        FROM (SELECT *, CASE WHEN event_type = 'error' THEN 'Failures' ELSE 'Web_Visits' END AS entity FROM events)))"""

QUERIES = {
    "job_word_count": Query(
        word_count_job,
        r"""SELECT '(' || w || ',' || count(*) || ')' AS value
            FROM (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS w
                  FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents)
                  WHERE line = '' OR rtrim(line, ' ') <> '')
            GROUP BY w""",
    ),
    "job_anonymize_file": Query(
        anonymize_file,
        f"""SELECT custkey || '|' || {md5_sql("name")} || '|' || nation || '|' || acctbal || '|' || {md5_sql("segment")}
                   || '|' || {md5_sql("note")} AS value FROM {CUSTOMER_SQL}""",
    ),
    "job_batch_publish": Query(
        batch_publish,
        f"""SELECT CASE WHEN short OR entity = 'Call_CDR' THEN value ELSE hashed END AS value,
                   CASE WHEN short OR entity = 'Call_CDR' THEN 'rejected' ELSE 'published' END AS outcome,
                   lower(entity) AS entity, date_range, file_name FROM {ORDER_DROP_SQL}""",
    ),
    "job_republish_corrected": Query(
        republish_corrected,
        f"""SELECT CASE WHEN entity = 'SMS' AND short
                        THEN CAST(o_orderkey AS VARCHAR) || '|' || {md5_sql("CAST(o_custkey AS VARCHAR)")} || '|' || o_orderstatus
                             || '|' || {md5_sql("CAST(o_totalprice AS VARCHAR)")} || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|none'
                        WHEN entity = 'SMS' THEN hashed WHEN short THEN value || '|none' ELSE value END AS value,
                   CASE entity WHEN 'SMS' THEN 'published' ELSE 'rejected' END AS outcome,
                   lower(entity) AS entity, date_range, file_name FROM {ORDER_DROP_SQL}""",
    ),
    "job_raw_landing": Query(raw_landing, f"SELECT value, file_name FROM {ORDER_DROP_SQL}"),
    "job_load_partition": Query(
        load_partition,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, CAST(o_custkey AS VARCHAR) AS custkey,
                   o_orderstatus AS status, CAST(o_totalprice AS VARCHAR) AS price,
                   strftime(o_orderdate, '%Y-%m-%d') AS orderdate, o_orderpriority AS priority,
                   year(o_orderdate) || '01' AS fecha, file_name, CAST(NULL AS VARCHAR) AS rejected
            FROM {ORDER_DROP_SQL} WHERE NOT short
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, file_name, value FROM {ORDER_DROP_SQL} WHERE short""",
    ),
    "job_extract_partition": Query(
        extract_partition,
        f"""SELECT value || '|' || o_orderstatus || '-' || o_orderpriority AS value,
                   year(o_orderdate) || '0101' AS fecha, file_name FROM {ORDER_DROP_SQL} WHERE NOT short""",
    ),
    "job_load_extract_publish": Query(
        load_extract_publish,
        f"""SELECT CASE WHEN short THEN value
                        WHEN entity = 'Mobile_Line' THEN hashed || '|' || o_orderstatus || '-' || o_orderpriority
                        ELSE hashed END AS value,
                   CASE WHEN short THEN 'rejected' ELSE 'published' END AS outcome,
                   lower(entity) AS entity, date_range, file_name
            FROM {ORDER_DROP_SQL} WHERE entity <> 'Call_CDR'""",
    ),
    "stream_file_ingest": Query(
        stream_file_ingest,
        f"""SELECT 'landed' AS stage, value, file_name FROM {EVENT_SQL}
            UNION ALL SELECT 'published', hashed, file_name FROM {EVENT_SQL} WHERE NOT long AND event_type <> 'error'""",
    ),
    "stream_rejects": Query(
        stream_rejects,
        f"""SELECT value, lower(entity) AS entity, date_range, file_name FROM {EVENT_SQL}
            WHERE long OR event_type = 'error'""",
    ),
    "stream_message_landing": Query(
        message_landing, "SELECT '(' || user_id || ',' || props || ')' AS value FROM events"
    ),
}
