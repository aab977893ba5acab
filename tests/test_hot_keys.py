"""Hot keys from counters that tasks keep."""

import decimal

from pyspark.sql import functions as F

from tidegate.operators import joins


def test_hot_keys_are_all_found_and_no_rare_ones(spark):
    # A third of the rows has key 0, 2 % have key 1 spread over all tasks, the others are nearly unique.
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, 1).otherwise(F.col("id") + 10)
    rows = spark.range(0, n, numPartitions=12).select(key.alias("key"), (F.col("id") % 2).cast("string").alias("other"))
    assert {r.key for r in joins.hot_keys(rows, "key", 0.01).collect()} == {0, 1}
    assert {(r.key, r.other) for r in joins.hot_keys(rows, ["key", "other"], 0.1).collect()} == {(0, "0"), (0, "1")}


def test_only_counters_are_shuffled(spark):
    rows = spark.range(0, 200_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"))
    share = 0.02
    names = rows.select(F.col("key").alias("k0"))
    sketched = names.mapInArrow(joins._sketcher(100), "k0 long, n long, seen long").cache()
    assert sketched.count() <= 8 * 101 and sketched.agg(F.sum("seen")).first()[0] == 200_000
    true = 66_667
    assert true - share / 2 * 200_000 <= sketched.where("k0 = 7").agg(F.sum("n")).first()[0] <= true
    sketched.unpersist()


def test_null_keys_types_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [(None, 1.0, decimal.Decimal("1.50"), b"x", [1])] * 5 + [(1, 0.0, decimal.Decimal("2.50"), b"y", [2])] * 3 + [(1, -0.0, decimal.Decimal("2.50"), b"y", [2])] * 2,
        "a int, b double, c decimal(10,2), d binary, e array<int>",
    )
    assert [r.a for r in joins.hot_keys(rows, "a", 0.3).collect()] == [1]
    for key in ("b", "c", "d", "e", ["a", "b"]):
        found = joins.hot_keys(rows, key, 0.4).count()
        assert found == (1 if key == ["a", "b"] else 2), key
    assert joins.hot_keys(rows.limit(0), "a").count() == 0


def test_salted_join_with_a_hot_key_of_another_type(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("int").alias("key"), F.col("id").alias("row"))
    right = spark.range(2000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    got = joins.salted_join(left, right, "key", share=0.1, salts=8)
    want = left.join(right, "key")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert joins.salted_join(left.limit(0), right, "key").count() == 0
