import pytest
from pyspark.sql import functions as F

from tidegate.functions.text import (
    blank_to,
    bracketed_line,
    delimited_line,
    jvm_trim,
    lines_of,
    split_dropping_trailing,
    split_fields,
    tuple_line,
)
from tidegate.operators import words
from tidegate.operators.projections import explode_pairs, pick_fields, prepend_concat, record_map
from tidegate.operators.quality import bad_rows, field_count, flag_rows, good_rows, is_date_text, not_equal
from tidegate.sources.text import header_of, read_csv_header, read_lines


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "value string").select(expr).first()[0]


@pytest.mark.parametrize(
    "text, kept, dropped",
    [
        ("a|b||", ["a", "b", "", ""], ["a", "b"]),
        ("||a", ["", "", "a"], ["", "", "a"]),
        ("", [""], [""]),
        ("||", ["", "", ""], []),
        ("a", ["a"], ["a"]),
    ],
)
def test_split(spark, text, kept, dropped):
    assert one(spark, text, split_fields("value", "|")) == kept
    assert one(spark, text, split_dropping_trailing("value", "|")) == dropped
    long = text.replace("|", "<>")
    assert one(spark, long, split_fields("value", "<>")) == kept
    assert one(spark, long, split_dropping_trailing("value", "<>")) == dropped
    assert one(spark, text, field_count("value", "|")) == len(kept)
    assert one(spark, long, field_count("value", "<>")) == len(kept)


def test_trim_takes_control_characters(spark):
    assert one(spark, "\t \x01\x00word x\r\n \x00", jvm_trim("value")) == "word x"


def test_blank_to_zero(spark):
    text = '8123,1977,,"AB",,"QX",7,,'
    got = one(spark, text, blank_to(split_fields("value", ",")))
    assert got == ["8123", "1977", "0", '"AB"', "0", '"QX"', "7", "0", "0"]


def test_row_renderings(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    row = df.select(bracketed_line(df.columns), delimited_line(df.columns), tuple_line(["x", "y"])).first()
    assert tuple(row) == ("[a,null,3]", "a||3", "(a,null)")


def test_nested_pairs(spark):
    df = spark.createDataFrame([(1, "two", [(3, 4), (5, 6)])], "id int, s string, p array<struct<a:int,b:int>>")
    assert [tuple(r) for r in explode_pairs(df, "p", ["id", "s"]).collect()] == [(1, "two", 3, 4), (1, "two", 5, 6)]


def test_pick_and_prepend(spark):
    df = spark.createDataFrame([("a,b,c,d,e",)], "value string")
    assert tuple(pick_fields(df, "value", {"first": 0, "fourth": 3}).first()) == ("a", "d")
    wide = spark.createDataFrame([("a", "b", "c")], "c0 string, c1 string, c2 string")
    out = prepend_concat(wide, ["c0", "c2"], "new_col")
    assert out.columns == ["new_col", "c0", "c1", "c2"] and out.first().new_col == "ac"


def test_header_to_map(spark, text_file):
    path = text_file("user.csv", "id,topic,hits\nana,kites,12\nself,boats,18\nluz,tents\n")
    header = header_of(spark, path)
    lines = read_lines(spark, path).where(F.col("value") != ",".join(header))
    maps = lines.select(record_map(header, split_fields("value", ",")).alias("m")).where(F.col("m")["id"] != "self")
    got = [r.m for r in maps.collect()]
    assert got == [{"id": "ana", "topic": "kites", "hits": "12"}, {"id": "luz", "topic": "tents"}]
    rows = not_equal(read_csv_header(spark, path, header), "id", "self")
    assert [tuple(r) for r in rows.collect()] == [("ana", "kites", "12", None), ("luz", "tents", None, "luz,tents")]
    with pytest.raises(ValueError):
        record_map(["a", "a"], F.array(F.lit("x")))


def test_good_and_bad_dates(spark):
    feedback = [("C", "Jan 11, 2015"), ("K", "11 Jan, 2015"), ("T", " 6/17/2014 "), ("J", "22-08-2013"),
                ("M", "2013"), ("I", ""), ("N", None), ("X", "6/17/2014 or so")]
    df = spark.createDataFrame(feedback, "name string, subscribed string")
    assert [r.name for r in good_rows(df, is_date_text("subscribed")).collect()] == ["C", "K", "T", "J"]
    assert [r.name for r in bad_rows(df, is_date_text("subscribed")).collect()] == ["M", "I", "N", "X"]
    flagged = flag_rows(df, is_date_text("subscribed")).groupBy("quality").count()
    assert {tuple(r) for r in flagged.collect()} == {("good", 4), ("bad", 4)}


def test_word_count_sample(spark):
    df = spark.createDataFrame([("uno dos  tres ",), ("cuatro uno",), ("   ",), ("",)], "value string")
    got = {r.w: r.n for r in words.count_words(words.line_words(df)).collect()}
    assert got == {"uno": 2, "dos": 1, "": 2, "tres": 1, "cuatro": 1}


def test_broadcast_filter_sample(spark):
    content = spark.createDataFrame([("low tide leaves mud ",), ("mud and reeds and herons",), ("reeds hide herons",)], "value string")
    remove = spark.createDataFrame([("and, low, hide",)], "value string")
    got = {r.w: r.n for r in words.count_words_except(words.line_words(content), words.list_words(remove)).collect()}
    assert got == {"tide": 1, "leaves": 1, "mud": 2, "reeds": 2, "herons": 2}


def test_stop_words_order_and_trim(spark):
    df = spark.createDataFrame([("the \tbig\t of big a small",)], "value string")
    counts = words.count_words_except(words.line_words(df, trim=True), words.words_frame(spark, words.STOP_WORDS))
    assert [tuple(r) for r in words.by_count_descending(counts).collect()] == [(2, "big"), (1, "small")]


@pytest.mark.parametrize("text", ["a\nb", "a\nb\n", "a\r\nb\rc", "\n", "", "a\n\nb\n\n", "one"])
def test_lines_of_equals_the_text_reader(spark, text_file, text):
    path = text_file("t.txt", "")
    with open(path, "w", newline="") as out:
        out.write(text)
    read = [r.value for r in read_lines(spark, path).collect()]
    assert one(spark, text, lines_of("value")) == read
