"""Word counts, joins, aggregations, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import aggregates, joins, ordering, sets
from tidegate.operators.words import (
    STOP_WORDS,
    by_count_descending,
    count_words,
    count_words_except,
    document_lines,
    line_words,
    list_words,
    words_frame,
)
from tidegate.queries.base import Query, table
from tidegate.session import widen
from tidegate.sources.text import inline_rows

REMOVE_LIST = "der, of, and, und"

# Words as the text reader and the blank split give them: lines first, blanks at a line's end dropped,
# a line of blanks only has no words, an empty line has one empty word.
LINES_SQL = r"""(SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS line
               FROM documents WHERE text <> '')"""
WORDS_SQL = f"""(SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS w FROM {LINES_SQL}
               WHERE line = '' OR rtrim(line, ' ') <> '')"""
TRIM_SQL = " || ".join(f"chr({i})" for i in range(1, 33))


def document_words(spark, sf, trim=False):
    return line_words(document_lines(widen(table(spark, sf, "documents").select("text"))), trim=trim)


def wc_basic(spark, sf):
    return count_words(document_words(spark, sf))


def wc_stopwords(spark, sf):
    return by_count_descending(count_words_except(document_words(spark, sf, True), words_frame(spark, STOP_WORDS)))


def wc_broadcast(spark, sf):
    listed = list_words(inline_rows(spark, [(REMOVE_LIST,)], "value string"))
    return count_words_except(document_words(spark, sf), listed)


def pairs(df, **names):
    return df.select(*[F.col(source).alias(name) for name, source in names.items()])


def join_inner(spark, sf):
    return joins.inner_join(
        pairs(table(spark, sf, "orders"), id="o_custkey", num1="o_orderkey", num2="o_orderpriority"),
        pairs(table(spark, sf, "customer"), id="c_custkey", s1="c_name", s2="c_mktsegment"),
        "id",
    )


def join_salted(spark, sf):
    """Every third line belongs to one order, so that a third of the left rows has one key."""
    order = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_orderkey"))
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part"), order.alias("order"), F.col("l_linenumber").alias("line"), "l_orderkey")
    orders = pairs(table(spark, sf, "orders"), order="o_orderkey", customer="o_custkey")
    return joins.salted_join(lines, orders, "order", share=0.01, salts=16)


def three_way(spark, sf):
    names = pairs(table(spark, sf, "customer"), id="c_custkey", name="c_name")
    orders = pairs(table(spark, sf, "orders"), id="o_custkey", order_id="o_orderkey", price="o_totalprice")
    visits = aggregates.count_by_key(pairs(table(spark, sf, "events"), id="user_id"), "id", "visits")
    return ordering.sort_by(joins.chain_join(names, orders, visits, on="id"), "id")


def composite_key(spark, sf):
    e = table(spark, sf, "events")
    left = pairs(e, first="user_id", last="event_type", technology="event_id")
    right = aggregates.sum_by_key(pairs(e, first="user_id", last="event_type", v="value"), ["first", "last"], "v", "salary", 2)
    return joins.inner_join(left, right, ["first", "last"])


def join_sum(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    right = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("num2"))
    return joins.join_then_sum(left, right, "id", "num2", "total")


def zip_rows(spark, sf):
    c = table(spark, sf, "customer")
    left = pairs(c, id="c_custkey")
    right = pairs(c, balance="c_acctbal", balance_id="c_custkey")
    return ordering.zip_by_position(left, right, ["id"], ["balance", "balance_id"])


def count_key(spark, sf):
    return aggregates.count_by_key(table(spark, sf, "events"), "event_type")


def sets_key(spark, sf):
    e = table(spark, sf, "events")
    user = F.when(F.col("event_type") != "error", F.col("user_id"))  # errors have no user: a key of nulls only
    return aggregates.items_text(
        aggregates.set_by_key(e.select("event_type", user.alias("user_id")), "event_type", "user_id", 8, F.col("user_id"))
    )


def lists_key(spark, sf):
    customer = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    hot = F.when(F.col("o_orderkey") % 3 == 1, "a third").otherwise(F.col("o_orderpriority"))
    o = table(spark, sf, "orders").select(hot.alias("o_orderpriority"), "o_orderkey", customer.alias("o_custkey"))
    return aggregates.items_text(aggregates.list_by_key(o, "o_orderpriority", "o_custkey", 16, F.col("o_orderkey")))


def average_key(spark, sf):
    return aggregates.average_by_key(table(spark, sf, "events"), "event_type", "value", 2)


def custom_combine(spark, sf):
    customer = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", customer.alias("o_custkey"))
    return aggregates.combine_by_key(
        o,
        "o_orderpriority",
        "o_custkey",
        create=lambda v: F.struct(F.lit(1).cast("long").alias("n"), v.alias("total")),
        merge_value=lambda s, v: F.struct((s["n"] + 1).alias("n"), (s["total"] + v).alias("total")),
        merge_states=lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), (a["total"] + b["total"]).alias("total")),
        finish=lambda s: s["total"] / s["n"],
        name="average",
    )


def multikey(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_returnflag", F.concat("l_returnflag", F.lit(" ")))
    return aggregates.count_and_sum_by_key(li, ["l_returnflag", "l_linestatus", "l_linenumber"], "l_extendedprice", scale=2)


def two_keys(spark, sf):
    return aggregates.sum_by_key(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_totalprice", scale=2)


def global_sum(spark, sf):
    return aggregates.sum_and_count(table(spark, sf, "part"), "p_size")


def fold(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_orderkey") % 64).alias("part"), F.col("o_custkey").alias("v"))
    return aggregates.two_level_fold(o, "part", "v", 5)


def tags(spark, sf):
    return aggregates.tag_partition(table(spark, sf, "orders"), "o_custkey", F.col("o_orderkey") % 8)


def inline(spark, sf):
    weights = inline_rows(
        spark, [("click", 1), ("view", 2), ("purchase", 3), ("signup", 4)], "event_type string, weight int", 2
    )
    e = table(spark, sf, "events").select("event_id", "event_type")
    return joins.inner_join(e, weights, "event_type")


def sort_value(spark, sf):
    return ordering.sort_by(pairs(table(spark, sf, "part"), id="p_partkey", name="p_name"), "name")


def topn(spark, sf):
    o = pairs(table(spark, sf, "orders"), id="o_orderkey", price="o_totalprice")
    return ordering.first_rows(o, 10, F.desc("price"), "id")


def union(spark, sf):
    def arrays(name, key, *values):
        return table(spark, sf, name).select(
            F.col(key).alias("k"), F.array_join(F.array(*[F.col(v).cast("string") for v in values]), ",").alias("v")
        )

    return sets.union_all(
        arrays("customer", "c_mktsegment", "c_custkey", "c_nationkey"), arrays("events", "event_type", "user_id")
    )


def subtract(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("id"))
    builders = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return sets.subtract(e, pairs(builders, id="c_custkey"))


QUERIES = {
    "wc_basic": Query(wc_basic, f"SELECT w, count(*) AS n FROM {WORDS_SQL} GROUP BY w"),
    "wc_stopwords_desc": Query(
        wc_stopwords,
        f"""SELECT count(*) AS n, w FROM (SELECT trim(w, {TRIM_SQL}) AS w FROM {WORDS_SQL})
            WHERE w NOT IN ({", ".join(repr(w) for w in sorted(set(STOP_WORDS)))}) GROUP BY w ORDER BY n DESC, w""",
    ),
    "wc_broadcast_filter": Query(
        wc_broadcast, f"SELECT w, count(*) AS n FROM {WORDS_SQL} WHERE w NOT IN ('der', 'of', 'and', 'und') GROUP BY w"
    ),
    "join_inner": Query(
        join_inner,
        """SELECT c_custkey AS id, o_orderkey AS num1, o_orderpriority AS num2, c_name AS s1, c_mktsegment AS s2
           FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "join_inner_salted": Query(
        join_salted,
        """SELECT o_orderkey AS "order", l_partkey AS part, l_linenumber AS line, l_orderkey, o_custkey AS customer
           FROM lineitem JOIN orders ON CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END = o_orderkey""",
    ),
    "join_three_way": Query(
        three_way,
        """SELECT c_custkey AS id, c_name AS name, o_orderkey AS order_id, o_totalprice AS price, visits
           FROM customer JOIN orders ON o_custkey = c_custkey
           JOIN (SELECT user_id, count(*) AS visits FROM events GROUP BY user_id) ON user_id = c_custkey
           ORDER BY id, name, order_id, price, visits""",
    ),
    "join_composite_key": Query(
        composite_key,
        """SELECT user_id AS first, event_type AS last, event_id AS technology, salary
           FROM events JOIN (SELECT user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS salary
                             FROM events GROUP BY user_id, event_type) USING (user_id, event_type)""",
    ),
    "join_then_sum": Query(
        join_sum,
        "SELECT CAST(sum(c_nationkey) AS BIGINT) AS total FROM orders JOIN customer ON o_custkey = c_custkey",
    ),
    "zip_by_position": Query(
        zip_rows,
        """SELECT pos, id, balance, balance_id
           FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_custkey AS id FROM customer)
           JOIN (SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS pos, c_acctbal AS balance,
                        c_custkey AS balance_id FROM customer) USING (pos)""",
    ),
    "agg_count_by_key": Query(count_key, "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"),
    "agg_set_by_key": Query(
        sets_key,
        """SELECT event_type, CAST(coalesce(user_id % 8, 0) AS INTEGER) AS bucket, count(user_id) AS n,
                  coalesce(string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id), '') AS items
           FROM (SELECT DISTINCT event_type, CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events)
           GROUP BY event_type, bucket""",
    ),
    "agg_list_by_key": Query(
        lists_key,
        """SELECT o_orderpriority, CAST(o_orderkey % 16 AS INTEGER) AS bucket, count(o_custkey) AS n,
                  coalesce(string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY o_custkey), '') AS items
           FROM (SELECT CASE WHEN o_orderkey % 3 = 1 THEN 'a third' ELSE o_orderpriority END AS o_orderpriority, o_orderkey,
                        CASE WHEN orders.o_orderpriority <> '5-LOW' THEN orders.o_custkey END AS o_custkey FROM orders)
           GROUP BY o_orderpriority, bucket""",
    ),
    "agg_avg_by_key": Query(
        average_key,
        """SELECT event_type, n, total, total / n AS average
           FROM (SELECT event_type, count(value) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
                 FROM events GROUP BY event_type)""",
    ),
    "agg_custom_combine": Query(
        custom_combine,
        """SELECT o_orderpriority, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(sum(o_custkey) AS DOUBLE) / count(*) END AS average
           FROM orders GROUP BY o_orderpriority""",
    ),
    "agg_count_sum_multikey": Query(
        multikey,
        """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
           FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber""",
    ),
    "agg_sum_two_keys": Query(
        two_keys,
        """SELECT o_orderstatus, o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
           FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    ),
    "agg_global_sum_count": Query(
        global_sum, "SELECT CAST(sum(p_size) AS BIGINT) AS total, count(*) AS n FROM part"
    ),
    "agg_two_level_fold": Query(
        fold,
        """SELECT CAST(5 + sum(top) AS BIGINT) AS folded
           FROM (SELECT greatest(max(o_custkey), 5) AS top FROM orders GROUP BY o_orderkey % 64)""",
    ),
    "partition_tag": Query(
        tags, "SELECT '[partID:' || (o_orderkey % 8) || ', val:' || o_custkey || ']' AS tag FROM orders"
    ),
    "src_inline_rows": Query(
        inline,
        """SELECT event_type, event_id, CAST(weight AS INTEGER) AS weight FROM events JOIN
           (VALUES ('click', 1), ('view', 2), ('purchase', 3), ('signup', 4)) t(event_type, weight) USING (event_type)""",
    ),
    "sort_by_value": Query(sort_value, "SELECT p_partkey AS id, p_name AS name FROM part ORDER BY name, id"),
    "topn_after_sort": Query(
        topn, "SELECT o_orderkey AS id, o_totalprice AS price FROM orders ORDER BY price DESC, id LIMIT 10"
    ),
    "set_union_all": Query(
        union,
        """SELECT c_mktsegment AS k, c_custkey || ',' || c_nationkey AS v FROM customer
           UNION ALL SELECT event_type, CAST(user_id AS VARCHAR) FROM events""",
    ),
    "set_subtract": Query(
        subtract,
        """SELECT user_id AS id FROM events
           WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    ),
}
