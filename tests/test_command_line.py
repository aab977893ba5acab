import pytest
from test_jobs import RULES, SALT, SMS, d, rules  # noqa: F401

from tidegate.__main__ import main, parser
from tidegate.plans import jobs, publish
from tidegate.sources.text import read_lines


@pytest.fixture
def salt_file(text_file):
    return ["--salt-file", text_file("salt.txt", SALT + "\n")]


def test_word_count(spark, tmp_path, text_file, rows):
    main(["count-words", "--source", text_file("in.txt", "uno dos uno\n"), "--target", str(tmp_path / "out")])
    assert rows(read_lines(spark, str(tmp_path / "out"))) == [("(dos,1)",), ("(uno,2)",)]


def test_anonymize(spark, tmp_path, text_file, rows, rules, salt_file, capsys):  # noqa: F811
    source, out = text_file("in.txt", "1|2|3\nbad\n"), str(tmp_path / "out")
    main(["anonymize", "--source", source, "--table", "sms", "--columns", "B,zz", "--target", out, "--any-case",
          "--partition-column", "time", "--rejects", str(tmp_path / "bad"), *salt_file])
    assert rows(read_lines(spark, out)) == [(f"1|{d('2')}|3",)]
    assert rows(read_lines(spark, str(tmp_path / "bad"))) == [("bad",)]
    assert capsys.readouterr().out == "anonymised: b; unknown: zz\n"


def test_publish_and_ingest_agree(spark, tmp_path, text_file, rows, rules, salt_file):  # noqa: F811
    text_file(f"in/{SMS}_01.txt", "1|2|3\nbad\n")
    conf = text_file("rules.txt", RULES)
    main(["publish", "--archive", str(tmp_path / "in"), "--rules", conf, "--target", str(tmp_path / "a"), *salt_file])
    main(["ingest", "--path", str(tmp_path / "in"), "--rules", conf, "--target", str(tmp_path / "b"), "--once",
          "--landing", str(tmp_path / "raw"), "--checkpoint", str(tmp_path / "cp"), *salt_file])
    text_file(f"in/{SMS}_02.txt", "4|5|6\n")
    main(["publish", "--archive", str(tmp_path / "in"), "--rules", conf, "--target", str(tmp_path / "a"),
          "--run", "second", "--skip-published", *salt_file])
    first = (f"1|{d('2')}|3", f"{SMS}_01")
    assert rows(publish.read_published(spark, str(tmp_path / "b")), "value", "file_name") == [first]
    assert rows(publish.read_published(spark, str(tmp_path / "a")), "value", "file_name") == [first, (f"4|{d('5')}|6", f"{SMS}_02")]
    assert publish.read_rejected(spark, str(tmp_path / "a")).count() == 1


def test_load_publish(spark, tmp_path, text_file, rows, salt_file, capsys):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    jobs.create_partitioned_table(spark, "cli_table", ["a", "b", "c"], str(tmp_path / "t"))
    main(["load-publish", "--inbox", str(tmp_path / "in"), "--entity", "sms", "--table", "cli_table", "--frequency", "mensual",
          "--target", str(tmp_path / "out"), "--positions", "1,3", *salt_file])
    assert rows(publish.read_published(spark, str(tmp_path / "out")), "value") == [(f"{d('1')}|2|{d('3')}",)]
    assert capsys.readouterr().out == "loaded: 201709\n" and spark.table("cli_table").count() == 1


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        parser().parse_args(["publish", "--archive", "x"])
    args = parser().parse_args("land-messages --servers s --topics t --target o --checkpoint c".split())
    assert args.interval == "2 seconds" and not args.once
