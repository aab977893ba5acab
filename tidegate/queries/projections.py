"""Projection and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.filenames import is_accepted, source_file
from tidegate.functions.text import blank_to, bracketed_line, delimited_line, field, split_fields
from tidegate.operators.projections import explode_pairs, pick_fields, prepend_concat, record_map
from tidegate.operators.quality import flag_rows, is_date_text, not_equal
from tidegate.queries.base import (
    CUSTOMER_FIELDS,
    CUSTOMER_SQL,
    ORDER_FILE_SQL,
    Query,
    customer_lines,
    order_file_names,
    table,
)


def split_positions(spark, sf):
    o = table(spark, sf, "orders")
    lines = o.select(delimited_line(["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], ",").alias("value"))
    return pick_fields(lines, "value", {"id": 0, "priority": 3})


def split_keep_blanks(spark, sf):
    fields = customer_lines(spark, sf).select(split_fields("value", "|").alias("f"))
    return fields.select(field(F.col("f"), 0).alias("custkey"), F.size("f").cast("long").alias("n_fields"),
                         F.element_at("f", -1).alias("last_field"))


def blank_to_zero(spark, sf):
    fields = customer_lines(spark, sf).select(split_fields("value", "|").alias("f"))
    return fields.select(F.array_join(blank_to(F.col("f")), "|").alias("value"))


def row_to_map(spark, sf):
    fields = customer_lines(spark, sf).select(record_map(CUSTOMER_FIELDS, split_fields("value", "|")).alias("m"))
    return fields.where(F.col("m")["custkey"] != "1").select(
        F.col("m")["custkey"].alias("custkey"), F.col("m")["segment"].alias("segment"),
        F.col("m")["absent"].alias("absent"), F.size("m").cast("long").alias("n"),
    )


def concat_prepend(spark, sf):
    return prepend_concat(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"], "new_col")


def nested_pairs(spark, sf):
    e = table(spark, sf, "events")
    nested = e.select(
        "event_id", "event_type",
        F.array(
            F.struct(F.col("user_id").alias("first"), F.col("event_id").alias("second")),
            F.struct((F.col("user_id") + 1).alias("first"), (F.col("event_id") * 2).alias("second")),
        ).alias("pairs"),
    )
    return explode_pairs(nested, "pairs", ["event_id", "event_type"])


def row_rendering(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    return c.select(
        bracketed_line(c.columns).alias("bracketed"), delimited_line(c.columns).alias("delimited")
    )


def filter_not_equal(spark, sf):
    return not_equal(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "5-LOW")


def regex_good_bad(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 6
    text = (
        F.when(k == 0, F.date_format("o_orderdate", "MMM d, yyyy"))
        .when(k == 1, F.date_format("o_orderdate", "d MMM, yyyy"))
        .when(k == 2, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(k == 3, F.concat(F.lit(" "), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" ")))
        .when(k == 4, F.date_format("o_orderdate", "yyyy"))
        .otherwise("")
    )
    rows = o.select("o_orderkey", text.alias("subscribed"), "o_orderpriority")
    return flag_rows(rows, is_date_text("subscribed"))


def file_names(spark, sf):
    return order_file_names(spark, sf).where(is_accepted(source_file("path")))


QUERIES = {
    "proj_split_positions": Query(
        split_positions, "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS priority FROM orders"
    ),
    "proj_split_keep_blanks": Query(
        split_keep_blanks, f"SELECT custkey, CAST(6 AS BIGINT) AS n_fields, note AS last_field FROM {CUSTOMER_SQL}"
    ),
    "proj_blank_to_zero": Query(
        blank_to_zero,
        f"""SELECT custkey || '|' || name || '|' || CASE WHEN nation = '' THEN '0' ELSE nation END || '|' || acctbal
                   || '|' || CASE WHEN segment = '' THEN '0' ELSE segment END || '|0' AS value FROM {CUSTOMER_SQL}""",
    ),
    "proj_row_to_map": Query(
        row_to_map,
        f"""SELECT custkey, segment, CAST(NULL AS VARCHAR) AS absent, CAST(6 AS BIGINT) AS n
            FROM {CUSTOMER_SQL} WHERE custkey <> '1'""",
    ),
    "proj_concat_prepend": Query(
        concat_prepend, "SELECT p_name || p_brand AS new_col, p_partkey, p_name, p_brand FROM part"
    ),
    "explode_nested_pairs": Query(
        nested_pairs,
        """SELECT event_id, event_type, user_id AS first, event_id AS second FROM events
           UNION ALL SELECT event_id, event_type, user_id + 1, event_id * 2 FROM events""",
    ),
    "sink_row_rendering": Query(
        row_rendering,
        """SELECT '[' || c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_acctbal || ','
                  || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') || ']' AS bracketed,
                  c_custkey || '|' || c_name || '|' || c_nationkey || '|' || c_acctbal || '|'
                  || coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS delimited FROM customer""",
    ),
    "filter_not_equal": Query(
        filter_not_equal, "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'"
    ),
    "filter_regex_good_bad": Query(
        regex_good_bad,
        r"""SELECT *, CASE WHEN regexp_full_match(trim(subscribed),
                '\d+\s\w{3},\s\d{4}|\d+/\d+/\d{4}|\d+-\d+-\d{4}|\w{3}\s\d+,\s\d{4}') THEN 'good' ELSE 'bad' END AS quality
            FROM (SELECT o_orderkey, CASE o_orderkey % 6
                    WHEN 0 THEN strftime(o_orderdate, '%b %-d, %Y') WHEN 1 THEN strftime(o_orderdate, '%-d %b, %Y')
                    WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                    WHEN 3 THEN ' ' || strftime(o_orderdate, '%d-%m-%Y') || ' '
                    WHEN 4 THEN strftime(o_orderdate, '%Y') ELSE '' END AS subscribed, o_orderpriority
                  FROM orders)""",
    ),
    "filter_file_names": Query(
        file_names,
        f"""SELECT o_orderkey, path FROM {ORDER_FILE_SQL}
            WHERE regexp_matches(path, '([0-9]{{8}}T[0-9]{{6}}_){{3}}') AND NOT contains(path, 'COPYING')""",
    ),
}
