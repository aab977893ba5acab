import base64
import hashlib

import pytest
from common import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegate.functions.digest import ALGORITHMS, algorithm_name, digest, register_digest
from tidegate.operators.anonymize import (
    anonymize_by_name,
    anonymize_lines,
    digest_lookup_join,
    entity_positions,
    match_columns,
    positions_for,
)


def expected(text, salt, algorithm="MD5"):
    name = algorithm.replace("-", "").lower()
    return base64.b64encode(hashlib.new(name, (text + salt).encode()).digest()).decode()


GOLDEN = {
    "abc": "x81zUkk5ltZxdQOqLhyB9w==",
    "": "jd+HgDm3B2fEpbz08MT2Xg==",
    None: "zjIEL4VX4TGg7U+I/qG3Dw==",
    "CL-0001": "mr+w7z2UCZR5Ld2gexDpoQ==",
}


def test_golden_values(spark):
    df = spark.createDataFrame([(t,) for t in GOLDEN], "t string")
    assert {r.t: r.d for r in df.select("t", digest("t", "s1").alias("d")).collect()} == GOLDEN


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_every_algorithm_matches_the_library(spark, algorithm):
    texts = ["abc", "", "ñandú|x", "a" * 500]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in df.select("t", digest("t", "pepper", algorithm).alias("d")).collect()}
    assert got == {t: expected(t, "pepper", algorithm) for t in texts}


def test_null_policy_and_bad_names(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(digest("t", "s", null_policy="keep")).first()[0] is None
    with pytest.raises(ValueError):
        digest("t", "s", null_policy="drop")
    with pytest.raises(ValueError):
        digest("t", "s", "CRC32")
    assert algorithm_name("sha256") == "SHA-256" and algorithm_name("SHA") == "SHA-1"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",))), min_size=1, max_size=20), st.text("abc'\\é", max_size=5))
def test_digest_of_any_text(spark, texts, salt):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", digest("t", salt).alias("d")).collect()}
    assert got == {i: expected(t, salt) for i, t in enumerate(texts)}


def test_sql_function(spark):
    register_digest(spark, "digest_any")
    register_digest(spark, "digest_own", salt="it's\\", algorithm="SHA-512")
    register_digest(spark, "digest_md5", salt="s1")
    spark.createDataFrame([("abc",), (None,)], "t string").createOrReplaceTempView("digest_input")
    df = spark.sql(
        "SELECT t, digest_any(t, 'MD5', 's1') a, digest_any(t, 'sha-1', 's1') b, digest_own(t) c, digest_md5(t) d FROM digest_input"
    )
    row = df.where("t IS NOT NULL").first()
    assert (row.a, row.d) == (GOLDEN["abc"],) * 2
    assert row.b == expected("abc", "s1", "SHA-1")
    assert row.c == expected("abc", "it's\\", "SHA-512")
    assert df.where("t IS NULL").first().a == GOLDEN[None]
    assert "Python" not in plan_of(df)
    with pytest.raises(Exception, match="unknown digest algorithm"):
        spark.sql("SELECT digest_any(t, 'CRC32', 's1') FROM digest_input").collect()


def test_by_name_keeps_order_and_reports_unknown(spark):
    df = spark.createDataFrame([("1", "n", "20170930", "g")], "id string, name string, time string, geo string")
    out = anonymize_by_name(df, ["geo", "id", "nothing"], "s1", drop=["time"])
    assert out.columns == ["id", "name", "geo"]
    assert tuple(out.first()) == (expected("1", "s1"), "n", expected("g", "s1"))
    assert match_columns(df.columns, ["geo", "GEO", "nothing"]) == (["geo"], ["GEO", "nothing"])
    assert match_columns(df.columns, ["GEO", " id "], case_sensitive=False) == (["id", "geo"], [])


@pytest.mark.parametrize(
    "line, positions, base, result",
    [
        ("a|b|c", [2], 1, lambda d: f"a|{d('b')}|c"),
        ("a|b|c", [2], 0, lambda d: f"a|b|{d('c')}"),
        ("a|b|c", [1, 3], 1, lambda d: f"{d('a')}|b|{d('c')}"),
        ("a||", [2, 3], 1, lambda d: f"a|{d('')}|{d('')}"),
        ("a|b", [2, 5], 1, lambda d: f"a|{d('b')}"),
        ("a|b|c|d||", [1], 1, lambda d: f"{d('a')}|b|c|d||"),
        ("", [1], 1, lambda d: d("")),
        ("a|b", [], 1, lambda d: "a|b"),
        (None, [1], 1, lambda d: None),
    ],
)
def test_by_position(spark, line, positions, base, result):
    df = spark.createDataFrame([(line, positions)], "value string, p array<int>")
    want = result(lambda t: expected(t, "s1"))
    fixed = anonymize_lines(df.select("value"), "value", positions, "s1", index_base=base)
    assert fixed.first().value == want
    by_row = anonymize_lines(df, "value", "p", "s1", index_base=base, last_position=max(positions, default=base))
    assert by_row.first().value == want


def test_by_position_rejects_bad_arguments(spark):
    df = spark.createDataFrame([("a|b",)], "value string")
    with pytest.raises(ValueError):
        anonymize_lines(df, "value", [0], "s1")
    with pytest.raises(ValueError):
        anonymize_lines(df, "value", "p", "s1")


def test_entity_positions(spark):
    names = ["Mobile_Line", "sms", "mobile_line_data_traffic", "mobile_line_x_tariff", "mobile_service", "other", "mobileXservice"]
    df = spark.createDataFrame([(n,) for n in names], "e string").select("e", positions_for("e").alias("p"))
    got = {r.e: r.p for r in df.collect()}
    assert got["Mobile_Line"] == [2, 3, 5, 6] and got["sms"] == [2, 3, 5, 6]
    assert got["mobile_line_data_traffic"] == [5] and got["mobile_line_x_tariff"] == [5]
    for name in names:
        if got[name] is None:
            with pytest.raises(ValueError):
                entity_positions(name)
        else:
            assert list(entity_positions(name)) == got[name]
    assert got["mobile_service"] == [4, 5] and got["other"] is None and got["mobileXservice"] is None


def test_lookup_join_needs_a_unique_key(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "k string, a string, b string")
    out = digest_lookup_join(df, df, "k", ["a", "b"], "s1")
    assert out.columns == ["k", "a", "b", "a_digest", "b_digest"]
    assert {(r.k, r.a_digest) for r in out.collect()} == {("1", expected("a", "s1")), ("2", expected("b", "s1"))}
    with pytest.raises(Exception, match="not unique"):
        digest_lookup_join(df, df.union(df), "k", ["a"], "s1").collect()
