import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidegate.plans import jobs, publish
from tidegate.sinks import versions
from tidegate.sources.control import read_rules
from tidegate.sources.text import read_lines

SALT = "s1"
SMS = "SMS_20170930T000000_20170930T235959_20171001T010000"
LINE = "Mobile_Line_20170901T000000_20170930T235959_20171001T020000"
RANGE = "20170930T000000_20170930T235959"
RULES = "esquema_hive|nomtabla|cols|part|server|schema|user|file\n|sms|b|time|s|u|o|f\n|mobile_line|A,c|time|s|u|o|f\n"


def d(text):
    return base64.b64encode(hashlib.md5((text + SALT).encode()).digest()).decode()


@pytest.fixture
def rules(spark, text_file):
    for name in ("sms", "mobile_line"):
        spark.createDataFrame([], "a string, b string, c string, time string").createOrReplaceTempView(name)
    return read_rules(spark, text_file("rules.txt", RULES))


def test_word_count_job(spark, tmp_path, text_file, rows):
    jobs.count_words_job(spark, text_file("in.txt", "uno dos\nuno\n"), str(tmp_path / "out"))
    assert rows(read_lines(spark, str(tmp_path / "out"))) == [("(dos,1)",), ("(uno,2)",)]


@pytest.mark.parametrize("bracketed", [False, True])
def test_anonymize_file(spark, tmp_path, text_file, rows, rules, bracketed):
    source = text_file("in.txt", "1|2|3\n||\nshort\n4|5|\n")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    for _ in range(2):
        report = jobs.anonymize_file_job(
            spark, source, "sms", ["c", "b", "zz"], out, SALT, "time", rejects=rejects, bracketed=bracketed
        )
    assert report == (["b", "c"], ["zz"])
    want = [f"1|{d('2')}|{d('3')}", f"|{d('')}|{d('')}", f"4|{d('5')}|{d('')}"]
    if bracketed:
        want = ["[" + w.replace("|", ",") + "]" for w in want]
    assert rows(read_lines(spark, out)) == sorted((w,) for w in want)
    assert rows(read_lines(spark, rejects)) == [("short",)]
    assert any(f.endswith(".bz2") for f in os.listdir(out))


def test_publish_archive(spark, tmp_path, text_file, rows, rules):
    text_file(f"in/{SMS}_01.txt", "1|2|3\nbad\n")
    text_file(f"in/x/{SMS}_02.txt", "4|5|6\n")
    text_file(f"in/{LINE}_01.txt", "7|8|9\n")
    text_file(f"in/Other_{SMS[4:]}_01.txt", "o|o|o\n")
    text_file(f"in/{SMS}_03.txt._COPYING_", "not|yet|here\n")
    archive, target = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        publish.publish_archive(spark, archive, rules, target, SALT)
    want = [
        (f"1|{d('2')}|3", "sms", RANGE, f"{SMS}_01"),
        (f"4|{d('5')}|6", "sms", RANGE, f"{SMS}_02"),
        (f"{d('7')}|8|{d('9')}", "mobile_line", "20170901T000000_20170930T235959", f"{LINE}_01"),
    ]
    assert rows(publish.read_published(spark, target)) == sorted(want)
    bad = rows(publish.read_rejected(spark, target), "value", "file_name")
    assert bad == [("bad", f"{SMS}_01"), ("o|o|o", f"Other_{SMS[4:]}_01")]
    tried = publish.processed_files(spark, target).select("file_name", "extension").distinct()
    assert rows(tried) == [(n, "txt") for n in sorted([f"{LINE}_01", f"{SMS}_01", f"{SMS}_02", f"Other_{SMS[4:]}_01"])]
    (version,) = [f for f in os.listdir(target) if f.startswith("version=") and os.path.exists(f"{target}/{f}")][:1]
    folder = f"{target}/{version}/outcome=published/entity=sms/date_range={RANGE}/file_name={SMS}_01/extension=txt"
    assert any(f.endswith(".bz2") for f in os.listdir(folder))


def test_publishing_skips_what_is_published(spark, tmp_path, text_file, rows, rules):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    archive, target = str(tmp_path / "in"), str(tmp_path / "out")
    publish.publish_archive(spark, archive, rules, target, SALT)
    text_file(f"in/{SMS}_01.txt", "9|9|9\n")
    text_file(f"in/{SMS}_02.txt", "4|5|6\n")
    assert publish.processed_files(spark, str(tmp_path / "nothing")).count() == 0
    done = publish.processed_files(spark, target)
    publish.publish_archive(spark, archive, rules, target, SALT, already_published=done)
    got = rows(publish.read_published(spark, target), "value", "file_name")
    assert got == [(f"1|{d('2')}|3", f"{SMS}_01"), (f"4|{d('5')}|6", f"{SMS}_02")]


def outcomes_of(spark, target, rows):
    return rows(publish.read_outcomes(spark, target), "value", "outcome", "file_name")


def test_nothing_stays_of_an_earlier_outcome(spark, tmp_path, text_file, rows, rules):
    archive, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run(first, second):
        text_file(f"in/{SMS}_01.txt", first)
        text_file(f"in/{SMS}_02.txt", second)
        publish.publish_archive(spark, archive, rules, target, SALT)
        return outcomes_of(spark, target, rows)

    good, bad = (f"1|{d('2')}|3", "published", f"{SMS}_01"), ("bad", "rejected", f"{SMS}_01")
    other = (f"4|{d('5')}|6", "published", f"{SMS}_02")
    assert run("1|2|3\nbad\n", "4|5|6\n") == sorted([good, bad, other])
    assert run("1|2|3\n", "4|5|6\n") == sorted([good, other])  # corrected
    assert run("bad\n", "4|5|6\n") == sorted([bad, other])  # all bad now
    assert run("", "4|5|6\n") == [other]  # empty now


def test_two_files_of_one_stem_are_both_kept(spark, tmp_path, text_file, rows, rules):
    text_file(f"x/{SMS}_01.txt", "1|2|3\n")
    text_file(f"y/{SMS}_01.csv", "4|5|6\n")
    for folder in ("x", "y"):
        publish.publish_archive(spark, str(tmp_path / folder), rules, str(tmp_path / "out"), SALT)
    assert rows(publish.read_published(spark, str(tmp_path / "out")), "value") == [(f"1|{d('2')}|3",), (f"4|{d('5')}|6",)]


def test_only_pending_files_are_opened(spark, tmp_path, text_file, rows, rules):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    publish.publish_archive(spark, inbox, rules, target, SALT)
    # Neither what is published nor another entity's file can be read any more.
    for name in (f"{SMS}_00.txt.gz", f"{LINE}_01.txt.gz"):
        text_file(f"in/{name}", "this is not gzip")
    text_file(f"in/{SMS}_02.txt", "4|5|6\n")
    done = publish.processed_files(spark, target).select("file_name", "extension")
    done = done.union(spark.createDataFrame([(f"{SMS}_00.txt", "gz")], done.schema))
    jobs.create_partitioned_table(spark, "pending_t", ["a", "b", "c"], str(tmp_path / "t"))
    jobs.load_extract_publish(
        spark, inbox, "sms", "diario", ["a", "b", "c"], "pending_t", target, SALT, positions=[2], published=done
    )
    assert rows(publish.read_published(spark, target), "value") == [(f"1|{d('2')}|3",), (f"4|{d('5')}|6",)]


def test_lines_meet_the_plan_without_a_shuffle(spark, tmp_path, text_file, rules):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    files = publish.list_files(spark, str(tmp_path / "in")).select(*publish.PLAN_COLUMNS)
    plan = publish.Plan(publish.with_rules(files, publish.resolve_rules(spark, rules)))
    ((_, known, lines),) = plan.each()
    text = publish.anonymize_tagged(lines, SALT, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text and "regexp" not in text
    lost = publish.lines_of(known.where("false"), [r.path for r in known.collect()])
    with pytest.raises(Exception, match="not in the plan"):
        lost.collect()


def test_the_queue_moves_past_bad_and_empty_files(spark, tmp_path, text_file, rows):
    text_file(f"in/{SMS}_01.txt", "bad\nworse\n")
    text_file(f"in/{SMS}_02.txt", "")
    text_file(f"in/{SMS}_03.txt", "1|2|3\n")
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    jobs.create_partitioned_table(spark, "queue_t", ["a", "b", "c"], str(tmp_path / "t"))
    for _ in range(3):
        jobs.load_extract_publish(
            spark, inbox, "sms", "diario", ["a", "b", "c"], "queue_t", target, SALT, positions=[2],
            only_next=True, published=publish.processed_files(spark, target),
        )
    assert outcomes_of(spark, target, rows) == sorted(
        [("bad", "rejected", f"{SMS}_01"), ("worse", "rejected", f"{SMS}_01"), (f"1|{d('2')}|3", "published", f"{SMS}_03")]
    )


def test_raw_landing(spark, tmp_path, text_file, rows):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n\nbad\n")
    lines = read_lines(spark, str(tmp_path / "in"), recursive=True, with_path=True)
    for _ in range(2):
        publish.land_raw(lines, str(tmp_path / "raw"))
    assert rows(publish.read_raw(spark, str(tmp_path / "raw"))) == [(v, f"{SMS}_01") for v in ("", "1|2|3", "bad")]


def test_unusual_file_names_stay_as_they_are(spark, tmp_path, text_file, rows, rules):
    name = f"a b+c%41é=d_{SMS}_01"
    text_file(f"in/{name}.txt", "1|2|3\n")
    archive = str(tmp_path / "in")
    publish.land_raw(read_lines(spark, archive, with_path=True), str(tmp_path / "raw"))
    assert rows(publish.read_raw(spark, str(tmp_path / "raw"))) == [("1|2|3", name)]
    publish.publish_archive(spark, archive, rules, str(tmp_path / "out"), SALT)
    want = [(f"1|{d('2')}|3", "unknown", RANGE, name)]
    assert rows(publish.read_published(spark, str(tmp_path / "out"))) == want


def test_load_keeps_other_files_of_the_date(spark, tmp_path, text_file, rows):
    columns = ["a", "b"]
    jobs.create_partitioned_table(spark, "load_t", columns, str(tmp_path / "t"))

    def load(name, text):
        path = text_file(f"{name}/{name}.txt", text)
        lines = read_lines(spark, path, with_path=True)
        jobs.load_partition(spark, lines, columns, "load_t", "mensual", str(tmp_path / "rejects"))

    load(f"{SMS}_01", "1|2\n3|\nbad|bad|bad\n")
    load(f"{SMS}_02", "5|6\n")
    load(f"{SMS}_01", "7|8\n")
    want = [("5", "6", "201709", f"{SMS}_02", "txt"), ("7", "8", "201709", f"{SMS}_01", "txt")]
    assert rows(spark.table("load_t")) == want
    assert publish.read_raw(spark, str(tmp_path / "rejects")).count() == 0  # the bad line is gone
    plan = jobs.extract_partition(spark, "load_t", ["201709"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha" in plan or "PartitionFilters: [(fecha" in plan
    assert rows(jobs.extract_partition(spark, "load_t", ["201709"]), "value") == [("5|6",), ("7|8",)]
    assert jobs.extract_partition(spark, "load_t", ["201710"]).count() == 0
    load(f"{SMS}_01", "bad\n")
    assert rows(spark.table("load_t")) == want[:1]
    assert rows(publish.read_raw(spark, str(tmp_path / "rejects"))) == [("bad", f"{SMS}_01")]


@pytest.mark.parametrize("enriched", [False, True])
def test_load_extract_publish(spark, tmp_path, text_file, rows, enriched):
    text_file(f"in/{SMS}_01.txt", "1|2|3\nbad\n")
    text_file(f"in/{SMS}_02.txt", "4|5|6\n")
    text_file(f"in/{LINE}_01.txt", "7|8|9\n")
    inbox, target, table = str(tmp_path / "in"), str(tmp_path / "out"), f"chain_{int(enriched)}"
    jobs.create_partitioned_table(spark, table, ["a", "b", "c"], str(tmp_path / "t"))
    enrich = (lambda df: df.withColumn("more", F.concat("a", F.lit("!")))) if enriched else None
    tail = (lambda a: f"|{a}!") if enriched else (lambda a: "")

    def run(published=None):
        return jobs.load_extract_publish(
            spark, inbox, "sms", "diario", ["a", "b", "c"], table, target, SALT,
            positions=[2], enrich=enrich, only_next=True, published=published,
        )

    assert run() == ["20170930"]
    first = [(f"1|{d('2')}|3{tail('1')}", "sms", RANGE, f"{SMS}_01")]
    assert rows(publish.read_published(spark, target)) == first
    run(publish.processed_files(spark, target))
    second = first + [(f"4|{d('5')}|6{tail('4')}", "sms", RANGE, f"{SMS}_02")]
    assert rows(publish.read_published(spark, target)) == second
    assert spark.table(table).count() == 2


def test_a_failing_load_publishes_nothing(spark, tmp_path, text_file):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    with pytest.raises(Exception):
        jobs.load_extract_publish(
            spark, str(tmp_path / "in"), "sms", "diario", ["a", "b", "c"], "no_such_table", str(tmp_path / "out"), SALT
        )
    assert not os.path.exists(tmp_path / "out")


def test_a_reader_sees_the_old_or_the_new_output(spark, tmp_path, text_file, rows, rules, monkeypatch):
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    text_file(f"in/{SMS}_02.txt", "4|5|6\n")
    archive, target = str(tmp_path / "in"), str(tmp_path / "out")
    publish.publish_archive(spark, archive, rules, target, SALT)
    old = outcomes_of(spark, target, rows)
    text_file(f"in/{SMS}_01.txt", "1|0|3\n")
    seen, write = [], versions.write_version

    def watched(outcomes, files, *args):
        seen.append(outcomes_of(spark, target, rows))
        outcomes.write.partitionBy(*publish.OUTCOME_FOLDERS).text(f"{target}/version=lost")  # a run that dies here
        seen.append(outcomes_of(spark, target, rows))
        begun = publish.read_outcomes(spark, target)
        write(outcomes, files, *args)
        seen.append(rows(begun, "value", "outcome", "file_name"))  # planned before the pointer moved

    monkeypatch.setattr(publish, "write_version", watched)
    publish.publish_archive(spark, archive, rules, target, SALT)
    new = outcomes_of(spark, target, rows)
    assert new != old and len(new) == len(old) == 2
    assert seen[:2] == [old, old] and seen[2] in (old, new)
    assert versions.vacuum(spark, target, "1 day") == 0
    assert versions.vacuum(spark, target, "0 seconds") == 4
    assert outcomes_of(spark, target, rows) == new
    assert sorted(f for f in os.listdir(target) if f.startswith("version=")) and versions.vacuum(spark, str(tmp_path / "none")) == 0


def test_an_archive_of_100_000_names(spark, tmp_path, monkeypatch, rules):
    """The listing never reaches the driver; of the chosen files one slice does."""
    for folder in range(100):
        os.makedirs(tmp_path / "in" / f"{folder:03d}")
        for i in range(1000):
            with open(tmp_path / "in" / f"{folder:03d}" / f"Old_{SMS[4:]}_{folder:03d}x{i}.txt", "w"):
                pass
    for i in range(25):
        (tmp_path / "in" / f"{i:03d}" / f"{SMS}_{i:02d}.txt").write_text(f"{i}|2|3\n")
    archive, target = str(tmp_path / "in"), str(tmp_path / "out")
    from tidegate.sources.listing import list_folder_files

    done = publish.named(list_folder_files(spark, archive)).where("entity <> 'sms'").select(*publish.FILE_KEY)
    held, collect = [], type(done).collect
    monkeypatch.setattr(type(done), "collect", lambda self: held.append(out := collect(self)) or out)
    assert publish.publish_archive(spark, archive, rules, target, SALT, already_published=done, files_per_slice=10) == 25
    assert max(len(x) for x in held) <= 20
    monkeypatch.undo()
    assert publish.read_published(spark, target).count() == 25
    assert publish.processed_files(spark, target).select("version").distinct().count() == 3
