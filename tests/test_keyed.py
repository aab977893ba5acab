from collections import Counter, defaultdict

import pytest
from common import plan_of
from pyspark.sql import functions as F

from tidegate.operators import aggregates, joins, ordering, sets
from tidegate.sources.text import inline_rows

PAIRS = ["red=pin", "red=pin", "red=pin", "red=pin", "red=cup", "tan=jar", "tan=lid", "tan=lid"]


@pytest.fixture
def kv(spark):
    lines = spark.createDataFrame([(p,) for p in PAIRS], "value string")
    return lines.select(F.split("value", "=")[0].alias("k"), F.split("value", "=")[1].alias("v"))


def test_count_and_set_by_key(kv, rows):
    assert rows(aggregates.count_by_key(kv, "k")) == [("red", 5), ("tan", 3)]
    got = aggregates.set_by_key(kv, "k", "v", 1)
    assert rows(got, "k", "bucket", "items") == [("red", 0, ["cup", "pin"]), ("tan", 0, ["jar", "lid"])]


def test_list_by_key_keeps_copies(kv, rows):
    got = aggregates.list_by_key(kv, "k", "v", 1)
    assert rows(got, "k", "n", "items") == [
        ("red", 5, ["cup", "pin", "pin", "pin", "pin"]), ("tan", 3, ["jar", "lid", "lid"]),
    ]


def test_global_sum_and_count(spark):
    people = inline_rows(spark, [("P", 51), ("Q", 22), ("R", 37), ("S", 60), ("T", 9)], "name string, age int")
    assert tuple(aggregates.sum_and_count(people, "age").first()) == (179, 5)


def test_two_level_fold(spark):
    numbers = inline_rows(spark, [(i, 0 if i < 4 else 1) for i in range(1, 7)], "v int, part int")
    assert aggregates.two_level_fold(numbers, "part", "v", 5).first()[0] == 16
    assert aggregates.two_level_fold(numbers.where("v > 9"), "part", "v", 5).first()[0] == 5


def test_partition_tags(spark, rows):
    numbers = inline_rows(spark, [(i, 0 if i < 4 else 1) for i in range(1, 7)], "v int, part int")
    tags = aggregates.tag_partition(numbers, "v", F.col("part"))
    assert rows(tags)[0] == ("[partID:0, val:1]",) and rows(tags)[-1] == ("[partID:1, val:6]",)
    physical = aggregates.tag_partition(spark.range(6).repartition(2), "id")
    assert {r.tag[:10] for r in physical.collect()} == {"[partID:0,", "[partID:1,"}


def test_average_by_key(spark):
    scores = inline_rows(
        spark, [("X", 71.0), ("X", 64.5), ("X", 80.5), ("Y", 59.0), ("Y", 77.0), ("Y", 69.0)], "name string, score double"
    )
    got = {r.name: (r.n, r.total, r.average) for r in aggregates.average_by_key(scores, "name", "score").collect()}
    assert got == {"X": (3, 216.0, 72.0), "Y": (3, 205.0, 205.0 / 3)}


def test_employees_by_three_keys(spark, rows):
    lines = [("Yard", "Novice", 900.0, "N")]
    lines += [("Yard", "Chief", 2500.0, s) for s in ("N", "E", "S", "N", "S ", "E", "E")]
    lines += [("Dock", "Clerk", 1300.0, "S")] * 2 + [("Desk", "Head", 4100.0, "S")]
    df = inline_rows(spark, lines, "dept string, desg string, cost double, state string")
    got = rows(aggregates.count_and_sum_by_key(df, ["dept", "desg", "state"], "cost"))
    assert [r for r in got if r[1] == "Chief"] == [
        ("Yard", "Chief", "E", 3, 7500.0), ("Yard", "Chief", "N", 2, 5000.0), ("Yard", "Chief", "S", 2, 5000.0),
    ]


def test_sum_by_two_keys(spark, rows):
    work = [("U", "x", 310), ("U", "y", 420), ("U", "x", 55), ("V", "y", 70)]
    df = inline_rows(spark, work, "name string, sex string, cost int")
    assert rows(aggregates.sum_by_key(df, ["name", "sex"], "cost")) == [("U", "x", 365), ("U", "y", 420), ("V", "y", 70)]


def test_join_and_sum(spark, rows):
    a = inline_rows(spark, [("1", "9", "5"), ("2", "7", "4"), ("3", "8", "3")], "id string, n1 string, n2 string")
    b = inline_rows(spark, [("1", "g", "h"), ("2", "i", "j"), ("3", "k", "l")], "id string, s1 string, s2 string")
    assert rows(joins.inner_join(a, b, "id"))[0] == ("1", "9", "5", "g", "h")
    assert joins.join_then_sum(a, b, "id", "n2", "total").first()[0] == 12


def test_three_way_and_composite_joins(spark):
    boats = inline_rows(spark, [("w7", "heron"), ("w3", "otter")], "id string, boat string")
    lengths = inline_rows(spark, [("w3", "11.5"), ("w7", "8.2"), ("w9", "4.0")], "id string, metres string")
    berths = inline_rows(spark, [("w3", "north"), ("w7", "quay"), ("w1", "slip")], "id string, berth string")
    out = ordering.sort_by(joins.chain_join(boats, lengths, berths, on="id"), "id")
    assert [tuple(r) for r in out.collect()] == [("w3", "otter", "11.5", "north"), ("w7", "heron", "8.2", "quay")]
    tides = inline_rows(spark, [("may", "am", "high"), ("may", "pm", "low")], "month string, half string, tide string")
    winds = inline_rows(spark, [("may", "pm", "6")], "month string, half string, wind string")
    assert [tuple(r) for r in joins.inner_join(tides, winds, ["month", "half"]).collect()] == [("may", "pm", "low", "6")]


def test_exclusion_keeps_duplicates(spark, rows):
    left = inline_rows(spark, [("a",), ("a",), ("b",), ("b",), ("c",)], "w string")
    right = inline_rows(spark, [("b",), ("b",)], "w string")
    assert rows(sets.subtract(left, right)) == [("a",), ("a",), ("c",)]
    assert rows(joins.exclude_keys(left, right, "w")) == [("a",), ("a",), ("c",)]


def test_exclusion_of_nulls(spark, rows):
    left = inline_rows(spark, [("a", 1), (None, 1), (None, 2)], "w string, n int")
    assert joins.exclude_keys(left, left.where("w IS NULL"), "w").count() == 1
    assert sets.subtract(left, left.where("n = 1")).collect()[0].n == 2


def test_sorting_spreads_copies(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("w"))
        out = ordering.sort_by(df, "w", split_copies=True)
        parts = out.where("w = 'same'").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1 and [r.w for r in out.collect()] == sorted(r.w for r in df.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_union_and_distinct(spark, rows):
    one = inline_rows(spark, [("a", [1, 2]), ("b", [1, 2])], "k string, v array<int>")
    two = inline_rows(spark, [("a", [3]), ("b", [2])], "k string, v array<int>")
    assert rows(sets.union_all(one, two)) == [("a", [1, 2]), ("a", [3]), ("b", [1, 2]), ("b", [2])]
    assert sets.distinct(sets.union_all(one, one)).count() == 2


def test_positions_and_zip(spark):
    df = spark.range(1000).repartition(7).withColumn("x", F.col("id") % 10)
    got = ordering.with_position(df, "pos", ["x", "id"]).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1000))
    assert [(r.x, r.id) for r in got] == sorted((i % 10, i) for i in range(1000))
    left = inline_rows(spark, [("k", i) for i in range(4)], "key string, i int", 2)
    right = inline_rows(spark, [(f"v{i}",) for i in range(4)], "value string", 3)
    zipped = ordering.zip_by_position(left, right, ["i"], ["value"]).orderBy("pos").collect()
    assert [(r.i, r.value) for r in zipped] == [(i, f"v{i}") for i in range(4)]
    with pytest.raises(Exception, match="differ in size"):
        ordering.zip_by_position(left, right.limit(3), ["i"], ["value"]).collect()


def hot_rows(spark, n=9000):
    """A third of the rows under one key, most of those equal."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
        .alias("k"),
        F.when(F.col("id") % 6 == 0, 7).otherwise(F.col("id")).alias("v"),
    )


@pytest.mark.parametrize("distinct", [False, True])
def test_lists_of_a_hot_key_are_whole_and_dealt(spark, distinct):
    df = hot_rows(spark)
    want = defaultdict(list)
    for r in df.collect():
        want[r.k].append(r.v)
    if distinct:
        want = {k: list(set(v)) for k, v in want.items()}
    got, sizes = defaultdict(list), []
    numbered = df.withColumn("id", F.monotonically_increasing_id())
    for r in aggregates.list_by_key(numbered, "k", "v", buckets=32, distinct=distinct).collect():
        assert r.n == len(r["items"]) and 0 <= r.bucket < 32
        got[r.k] += r["items"]
        sizes.append(r.n)
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in want.items()}
    assert max(sizes) < 200 and None in got


def test_a_key_of_nulls_stays(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", None), ("b", None)], "k string, v int")
    assert rows(aggregates.list_by_key(df, "k", "v", 1), "k", "items") == [("a", [1]), ("b", [])]
    assert rows(aggregates.set_by_key(df, "k", "v", 4), "k", "n") == [("a", 1), ("b", 0)]
    count = aggregates.combine_by_key(
        df, "k", "v", lambda v: F.lit(1), lambda s, v: s + 1, lambda a, b: a + b
    )
    assert rows(count) == [("a", 1), ("b", 2)]


def test_custom_combine_equals_the_built_in(spark, rows):
    df = hot_rows(spark)
    struct = lambda n, t: F.struct(n.alias("n"), t.alias("t"))
    got = aggregates.combine_by_key(
        df, "k", "v",
        create=lambda v: struct(F.lit(1).cast("long"), v),
        merge_value=lambda s, v: struct(s["n"] + 1, s["t"] + v),
        merge_states=lambda a, b: struct(a["n"] + b["n"], a["t"] + b["t"]),
        finish=lambda s: s["t"] / s["n"],
    )
    want = {r.k: r.a for r in df.groupBy("k").agg(F.avg("v").alias("a")).collect()}
    assert {r.k: r.result for r in got.collect()} == want


def test_salted_join_equals_the_plain_one(spark):
    df = hot_rows(spark).withColumn("id", F.monotonically_increasing_id())
    names = df.where("k IS NOT NULL").groupBy("k").agg(F.max("v").alias("top"))
    plain = df.join(names, "k")
    assert [r.k for r in joins.hot_keys(df, "k", 0.1).collect()] == ["hot"]
    want = Counter(map(tuple, plain.collect()))
    for copies in (False, True):
        salted = joins.salted_join(df, names, "k", share=0.1, salts=8, fold_copies=copies)
        assert Counter(map(tuple, salted.select(*plain.columns).collect())) == want


def test_folded_copies_unfold_again(spark, monkeypatch):
    monkeypatch.setattr(joins, "COPIES_PER_PIECE", 7)
    df = hot_rows(spark).where("k IS NOT NULL")
    names = df.groupBy("k").agg(F.max("v").alias("top"))
    plain = df.join(names, "k")
    folded = joins.salted_join(df, names, "k", share=0.1, salts=8, fold_copies=True)
    assert folded.columns == plain.columns
    assert Counter(map(tuple, folded.collect())) == Counter(map(tuple, plain.collect()))


def test_salting_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = hot_rows(spark).withColumn("id", F.monotonically_increasing_id())
        names = df.where("k IS NOT NULL").groupBy("k").agg(F.max("v").alias("top"))
        salted = joins.salted_join(df, names, "k", share=0.1, salts=32)
        parts = salted.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 3000 * 0.6
        lists = aggregates.list_by_key(df, "k", "v", buckets=60)
        parts = lists.where("k = 'hot'").groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()
        assert len(parts) == 4 and max(r.n for r in parts) < 3000 * 0.6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_user_aggregate_shuffles_states_only(spark):
    df = spark.range(50_000).repartition(5).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    runs = aggregates.runs_by_key(df, ["k"], "v")
    counted = runs.select("k", F.size("values").alias("n"))
    assert counted.count() <= 3 * 5 and counted.agg(F.sum("n")).first()[0] == 50_000
    pieces = aggregates.runs_by_key(df, ["k"], "v", most=1000).select("k", F.explode("values").alias("x")).select("k", "x.v")
    assert pieces.exceptAll(df).count() == 0 and pieces.count() == 50_000
    total = aggregates.combine_by_key(
        df, "k", "v", lambda v: F.coalesce(v, F.lit(0)), lambda s, v: s + F.coalesce(v, F.lit(0)), lambda a, b: a + b
    )
    want = df.groupBy("k").agg(F.sum("v").alias("result"))
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, want.collect()))
    plan = plan_of(total).split("== Initial Plan ==")[0]
    assert plan.index("MapInArrow") > plan.rindex("Exchange hashpartitioning")  # the rows are gathered below every shuffle


def test_lists_ask_for_buckets(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for make in (aggregates.list_by_key, aggregates.set_by_key):
        with pytest.raises(TypeError):
            make(df, "k", "v")
