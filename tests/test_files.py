import bz2
import gzip
import os
import random

import pytest
from common import plan_of
from pyspark.sql import functions as F

from tidegate.functions.filenames import NAME_COLUMNS, is_accepted, parse_names, partition_date, source_file
from tidegate.operators.inventory import next_per_entity, unpublished
from tidegate.operators.routing import automaton, route_files
from tidegate.session import session_setting
from tidegate.sinks import files as sinks
from tidegate.sources import text as sources
from tidegate.sources.catalog import catalog_columns, table_columns
from tidegate.sources.control import read_rules, resolve_rules
from tidegate.sources.files import file_inventory

SMS = "SMS_20170930T000000_20170930T235959_20171001T010000"
LINE = "Mobile_Line_20170901T000000_20170930T235959_20171001T020000"


def frame(spark, values, name="path"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_parse_names(spark):
    paths = [f"hdfs://h/stage/{SMS}_01.txt", f"{LINE}_01.txt", "x.COPYING.txt"]
    got = {r.path: tuple(r[c] for c in NAME_COLUMNS) for r in parse_names(frame(spark, paths)).collect()}
    assert got[paths[0]] == (f"{SMS}_01", "SMS", "20170930T000000", "20170930T235959", "20171001T010000", "01",
                             "20170930T000000_20170930T235959")
    assert got[paths[1]][1] == "Mobile_Line"
    assert got[paths[2]] == ("x.COPYING", "", "", "", "", "", "")


def test_partition_date(spark):
    df = frame(spark, ["20170930T000000"], "d")
    assert tuple(df.select(partition_date("d", "diario"), partition_date("d", "MENSUAL")).first()) == ("20170930", "201709")


def test_acceptance_and_logical_names(spark):
    cases = {
        f"/a/{SMS}_01.txt": (f"{SMS}_01.txt", True),
        f"/a/{SMS}_01.txt/part-00000-x.txt": (f"{SMS}_01.txt", True),
        f"/a/drop={SMS}_01.txt/part-00000-x.txt": (f"{SMS}_01.txt", True),
        f"/a/{SMS}_01.txt._COPYING_": (f"{SMS}_01.txt._COPYING_", False),
        "/a/SMS_20170930T000000_20170930T235959_01.txt": ("SMS_20170930T000000_20170930T235959_01.txt", False),
        "part-0": ("part-0", False),
        f"/a/k=v_{SMS}_01.txt": (f"k=v_{SMS}_01.txt", True),
    }
    df = frame(spark, cases).select("path", source_file("path"), is_accepted(source_file("path")))
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == cases


def test_inventory_choices(spark, tmp_path, text_file, rows):
    for name in (f"{SMS}_02.txt", f"{SMS}_01.txt", f"{LINE}_01.txt"):
        text_file(f"in/deep/{name}", "a|b\n")
    files = parse_names(file_inventory(spark, str(tmp_path / "in")))
    assert rows(files, "file_name", "length") == [(f"{LINE}_01", 4), (f"{SMS}_01", 4), (f"{SMS}_02", 4)]
    nxt = next_per_entity(files, path="file_name")
    assert rows(nxt) == [("Mobile_Line", f"{LINE}_01"), ("SMS", f"{SMS}_01")]
    left = unpublished(files, frame(spark, [f"{SMS}_01", f"{SMS}_01"], "file_name"))
    assert rows(left, "file_name") == [(f"{LINE}_01",), (f"{SMS}_02",)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def brute_force(names, rules):
    out = {}
    for name in names:
        hit = [no for no, t in rules if t in name.lower()]
        out[name] = max(hit) if hit else None
    return out


def test_routing_against_brute_force(spark):
    rnd = random.Random(3)
    names = ["".join(rnd.choice("aBc_1") for _ in range(rnd.randint(0, 8))) for _ in range(150)] + ["ñandú_a", None]
    rules = [(i, "".join(rnd.choice("abc_1") for _ in range(rnd.randint(1, 4)))) for i in range(12)]
    rules += [(12, "Ac"), (13, "ú_")]
    files = frame(spark, names, "file_name").withColumn("extra", F.length("file_name"))
    table = spark.createDataFrame(rules + [(99, None)], "line_no int, table_name string")
    routed = route_files(files, table)
    assert routed.columns == ["file_name", "extra", "line_no", "table_name"]
    got = routed.collect()
    assert len(got) == len(names)
    want = brute_force([n for n in names if n is not None], rules) | {None: None}
    assert {r.file_name: r.line_no for r in got} == want
    none = route_files(files, table.where("line_no < 0"))
    assert none.where("line_no IS NOT NULL").count() == 0 and none.count() == len(names)


def test_an_empty_pattern_matches_every_name(spark):
    files = frame(spark, ["abc"], "file_name")
    table = spark.createDataFrame([(1, "")], "line_no int, table_name string")
    assert route_files(files, table).first().line_no == 1


def test_control_table(spark, text_file):
    spark.createDataFrame([], "Cycle string, account string, area string, time string").createOrReplaceTempView("lines_t")
    text = (
        "esquema_hive|nomtabla|cols|part|server|schema|user|file\n"
        "|lines_t|area,CYCLE,other|time|s|u|o|f\ndepot|nowhere|a|time|s|u|o|f\n"
    )
    rules = read_rules(spark, text_file("conf.txt", text))
    got = {r.table_name: r for r in resolve_rules(spark, rules).collect()}
    assert (got["lines_t"].line_no, got["lines_t"].positions, got["lines_t"].width) == (1, [1, 3], 3)
    assert (got["nowhere"].positions, got["nowhere"].width, got["nowhere"].folder) == (None, None, "f")


def test_many_rules_and_long_patterns(spark):
    long = "x" * 1100
    rules = spark.createDataFrame([(i, f"rule_{i}_") for i in range(600)] + [(600, long)], "line_no int, table_name string")
    files = frame(spark, ["a_rule_599_b", long + "_y", "none"], "file_name")
    got = {r.file_name: r.line_no for r in route_files(files, rules).collect()}
    assert got == {"a_rule_599_b": 599, long + "_y": 600, "none": None}


def test_ten_thousand_rules(spark):
    chance = random.Random(4)
    rules = [(n, "".join(chance.choices("abcé😀_1", k=chance.randrange(1, 9)))) for n in range(10_000)]
    names = ["".join(chance.choices("abcABCé😀_1zÉ", k=chance.randrange(0, 30))) for _ in range(300)]
    table = spark.createDataFrame(rules, "line_no int, table_name string").repartition(4)
    routed = route_files(frame(spark, names, "file_name"), table)
    want = {n: max((k for k, p in rules if p in n.lower()), default=None) for n in names}
    assert {r.file_name: r.line_no for r in routed.collect()} == want
    assert "Join" not in plan_of(routed)


def test_the_automaton_finds_what_searching_finds():
    chance = random.Random(9)
    for _ in range(200):
        patterns = ["".join(chance.choices("ab", k=chance.randrange(0, 5))) for _ in range(chance.randrange(0, 8))]
        text = "".join(chance.choices("abc", k=20))
        letters, width, steps, found = automaton(patterns)
        state = 0
        best = found[0]
        for c in text:
            state = steps[state * width + (letters[ord(c)] if ord(c) < len(letters) else 0)]
            best = max(best, found[state])
        assert best == max((k for k, p in enumerate(patterns) if p in text), default=-1)


def test_catalog_columns(spark, tmp_path):
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS cat_t (b STRING, A STRING, time STRING) USING parquet PARTITIONED BY (time) LOCATION '{tmp_path}/t'"
    )
    listed = [r.col_name for r in catalog_columns(spark, "cat_t").orderBy("pos").collect()]
    assert [c.lower() for c in listed] == ["b", "a", "time"]
    assert table_columns(spark, "cat_t", "time", lower=True) == ["b", "a"]


def test_delimited_records_and_rejects(spark, text_file, rows):
    path = text_file("d.txt", 'a|b|\n|"x|y\nshort|row\n\na|b|c|d\n')
    records = sources.read_delimited(spark, path, ["c1", "c2", "c3"])
    assert rows(sources.good_records(records)) == [("", '"x', "y"), ("a", "b", "")]
    assert rows(sources.corrupt_records(records)) == [("",), ("a|b|c|d",), ("short|row",)]
    generated = sources.good_records(sources.read_generated(spark, path))
    assert generated.columns == ["col0", "col1", "col2"] and generated.count() == 2


def test_several_paths_and_positional_csv(spark, text_file, rows):
    paths = [text_file(f"m/{i}/f.txt", f"{i},n{i},rest\n") for i in range(3)]
    assert rows(sources.read_lines(spark, *paths)) == [(f"{i},n{i},rest",) for i in range(3)]
    assert rows(sources.read_csv_positional(spark, paths[1], ["id", "name"])) == [("1", "n1", None)]
    ragged = text_file("b.csv", 'id,n\n"1",\n,x\nshort\nlong,b,1\n')
    header = sources.read_csv_header(spark, ragged, ["id", "n"])
    assert rows(sources.good_records(header)) == [("", "x"), ('"1"', "")]
    assert rows(sources.corrupt_records(header)) == [("long,b,1",), ("short",)]
    positional = sources.read_csv_positional(spark, ragged, ["id", "n"])
    assert rows(sources.good_records(positional)) == [("", "x"), ('"1"', ""), ("id", "n"), ("long", "b")]
    assert rows(sources.corrupt_records(positional)) == [("short",)]


@pytest.mark.parametrize("codec, ending", [(None, ".txt"), ("gzip", ".txt.gz"), ("bzip2", ".txt.bz2")])
def test_text_codecs(spark, tmp_path, rows, codec, ending):
    path = str(tmp_path / "out")
    sinks.write_text(frame(spark, ["x", "y"], "value"), path, codec)
    assert all(f.endswith(ending) for f in os.listdir(path) if f.startswith("part-"))
    assert rows(sources.read_lines(spark, path)) == [("x",), ("y",)]
    if codec == "gzip":
        parts = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".gz")]
        assert sorted(b"".join(gzip.open(p).read() for p in parts).split()) == [b"x", b"y"]


def test_single_file_is_sorted_and_keeps_the_tasks_before_it(spark, tmp_path):
    df = spark.range(100).repartition(5).select(F.col("id").cast("string").alias("value"), "id", F.spark_partition_id().alias("p"))
    path = str(tmp_path / "one")
    sinks.write_single_file(df.withColumn("value", F.concat_ws(":", "value", "p")), path, ["id"])
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(parts) == 1
    written = [line.split(":") for line in open(os.path.join(path, parts[0])).read().split()]
    assert [v for v, _ in written] == [str(i) for i in range(100)] and len({p for _, p in written}) == 5


@pytest.mark.parametrize(("codec", "opened"), [(None, open), ("gzip", gzip.open), ("bzip2", bz2.open)])
def test_single_file_is_joined_from_compressed_parts(spark, tmp_path, codec, opened):
    chance = random.Random(3)
    values = [f"{chance.random()}-{i % 7}" * 5 for i in range(20_000)] + ["", "", "x" * 100_000]
    df = frame(spark, values, "value").withColumn("hot", F.lit(1)).repartition(6)
    path = str(tmp_path / "one")
    for _ in range(2):  # again over the first
        sinks.write_single_file(df, path, ["hot"], codec)
        parts = os.listdir(path)
        assert len(parts) == 1 and parts[0].startswith("part-00000-") and parts[0].endswith(".txt" + sinks.JOINED[codec or "none"])
        with opened(os.path.join(path, parts[0]), "rt") as text:
            assert text.read() == "".join(f"{v}\n" for v in sorted(values))
        assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(values)
    with session_setting(spark, "spark.sql.files.maxPartitionBytes", "100000"):  # cut where readers can cut
        assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(values)


@pytest.mark.parametrize("codec", [None, "gzip", "bzip2", "deflate"])
def test_single_file_of_no_rows_and_of_empty_parts(spark, tmp_path, codec):
    none, some = str(tmp_path / "none"), str(tmp_path / "some")
    sinks.write_single_file(frame(spark, [], "value").repartition(3), none, ["value"], codec)
    sinks.write_single_file(spark.range(0, 8, 1, 8).where("id % 4 = 1").selectExpr("'v' || id AS value"), some, (), codec)
    assert spark.read.text(none).count() == 0 and len([x for x in os.listdir(some) if x.startswith("part-")]) == 1
    assert sorted(r.value for r in spark.read.text(some).collect()) == ["v1", "v5"]


def test_single_file_at_a_relative_path_and_with_a_scheme(spark, tmp_path):
    lines = frame(spark, ["b", "a", "c"], "value").repartition(3)
    for path in (os.path.relpath(tmp_path / "near"), f"file://{tmp_path}/far"):
        sinks.write_single_file(lines, path, [F.desc("value")], "gzip")
    for name in ("near", "far"):
        (part,) = [x for x in os.listdir(tmp_path / name) if not x.startswith((".", "_"))]
        with gzip.open(tmp_path / name / part, "rt") as text:
            assert text.read() == "c\nb\na\n"


def test_parts_are_joined_in_the_order_of_their_numbers():
    names = ["part-100000-u-c000.txt", "part-99999-u-c001.txt", "part-00002-u-c000.txt", "part-99999-u-c000.txt"]
    assert sorted(names, key=sinks._part_number) == [names[2], names[3], names[1], names[0]]


def test_folder_per_key(spark, tmp_path, rows):
    df = spark.createDataFrame([("L", "50000"), ("B", "50000"), ("S", "10000"), ("N", None)], "value string, salary string")
    path = str(tmp_path / "keys")
    sinks.write_by_key(df, path, "salary")
    assert {d for d in os.listdir(path) if d.startswith("salary=")} == {
        "salary=50000", "salary=10000", "salary=__HIVE_DEFAULT_PARTITION__",
    }
    got = {tuple(r) for r in sinks.read_by_key(spark, path, "salary").collect()}
    assert got == {("L", "50000"), ("B", "50000"), ("S", "10000"), ("N", None)}


def test_replacing_touches_only_its_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "r")
    sinks.replace_partitions(spark.createDataFrame([("a", "1"), ("b", "2")], "value string, k string"), path, ["k"])
    sinks.replace_partitions(spark.createDataFrame([("c", "2")], "value string, k string"), path, ["k"])
    assert rows(sinks.read_by_key(spark, path, "k")) == [("a", "1"), ("c", "2")]


def test_bytes_survive(spark, tmp_path):
    data = [bytes(range(256)), b"", b"\x00\xff"]
    df = spark.createDataFrame([(d,) for d in data], "payload binary")
    sinks.write_binary(df, str(tmp_path / "p"))
    assert sorted(bytes(r.payload) for r in spark.read.parquet(str(tmp_path / "p")).collect()) == sorted(data)
    sinks.write_sequence_file(df, "payload", str(tmp_path / "s"))
    assert sorted(bytes(r.payload) for r in sinks.read_sequence_file(spark, str(tmp_path / "s")).collect()) == sorted(data)
