import os

import pytest
from pyspark.sql import functions as F
from test_jobs import LINE, SALT, SMS, d, rules  # noqa: F401

from tidegate.plans import publish
from tidegate.sources.listing import changed_files
from tidegate.streaming.ingest import BATCH_INTERVAL, start_file_ingest, trigger_options
from tidegate.streaming.messages import file_messages, kafka_messages, land_messages


@pytest.fixture
def ingest(spark, tmp_path, rules):  # noqa: F811
    def run(checkpoint="cp", max_files=200, **options):
        query = start_file_ingest(
            changed_files(spark, str(tmp_path / "in"), **options), rules,
            str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / checkpoint), SALT, once=True, max_files=max_files,
        )
        query.awaitTermination()

    return run


def test_new_files_only_and_replays_add_nothing(spark, tmp_path, text_file, rows, ingest):
    target, landing = str(tmp_path / "out"), str(tmp_path / "landing")
    text_file(f"in/{SMS}_01.txt", "1|2|3\nbad\n")
    text_file(f"in/{SMS}_09.txt.COPYING", "not|yet|done\n")
    ingest()
    text_file(f"in/{SMS}_02.txt", "4|5|6\n")
    text_file(f"in/{LINE}_01.txt", "7|8|9\n")
    ingest()
    want = [
        (f"1|{d('2')}|3", f"{SMS}_01"), (f"4|{d('5')}|6", f"{SMS}_02"), (f"{d('7')}|8|{d('9')}", f"{LINE}_01"),
    ]
    landed = [("1|2|3", f"{SMS}_01"), ("4|5|6", f"{SMS}_02"), ("7|8|9", f"{LINE}_01"), ("bad", f"{SMS}_01")]
    for checkpoint in ("cp", "cp", "new"):  # nothing new, nothing new, everything again
        ingest(checkpoint)
        assert rows(publish.read_published(spark, target), "value", "file_name") == sorted(want)
        assert rows(publish.read_raw(spark, landing)) == landed
    outcomes = {r.outcome for r in publish.read_outcomes(spark, target).select("outcome").distinct().collect()}
    assert outcomes == {"published", "rejected"}
    text_file(f"in/{SMS}_01.txt", "1|2|3\n")  # corrected
    ingest("third")
    assert publish.read_rejected(spark, target).count() == 0
    text_file(f"in/{SMS}_01.txt", "1|2|3\nbad\n")
    ingest("fourth")
    assert rows(publish.read_rejected(spark, target), "value") == [("bad",)]


def test_a_file_without_rule_is_rejected(spark, tmp_path, text_file, rows, ingest):
    text_file(f"in/Other_{SMS[4:]}_01.txt", "1|2|3\n")
    ingest()
    assert rows(publish.read_rejected(spark, str(tmp_path / "out")), "value", "entity") == [("1|2|3", "other")]
    assert publish.read_published(spark, str(tmp_path / "out")).count() == 0


def test_batches_glob_and_age(spark, tmp_path, text_file, rows, ingest):
    for i in range(1, 6):
        path = text_file(f"in/{SMS}_0{i}.txt", f"{i}|{i}|{i}\n")
        if i == 1:
            os.utime(path, (1_000_000, 1_000_000))
    text_file(f"in/{SMS}_07.dat", "7|7|7\n")
    ingest(glob="*.txt", max_files=2, modified_after="2000-01-01 00:00:00")
    got = rows(publish.read_published(spark, str(tmp_path / "out")), "file_name")
    assert got == [(f"{SMS}_0{i}",) for i in range(2, 6)]
    versions = publish.processed_files(spark, str(tmp_path / "out")).select("version").distinct().count()
    assert 2 <= versions <= 4


def test_a_file_that_is_written_again_or_emptied_replaces_its_output(spark, tmp_path, text_file, rows, ingest):
    text_file(f"in/{SMS}_01.txt", "1|2|3\nbad\n")
    text_file(f"in/x/{SMS}_02.txt", "4|5|6\n")
    text_file(f"in/x/y/{SMS}_03.txt", "7|8|9\n")
    ingest()
    target, landing = str(tmp_path / "out"), str(tmp_path / "landing")
    assert publish.read_outcomes(spark, target).count() == 4
    text_file(f"in/{SMS}_01.txt", "")
    text_file(f"in/x/{SMS}_02.txt", "4|0|6\n")
    ingest()
    got = rows(publish.read_outcomes(spark, target), "value", "file_name")
    assert got == sorted([(f"4|{d('0')}|6", f"{SMS}_02"), (f"7|{d('8')}|9", f"{SMS}_03")])
    assert rows(publish.read_raw(spark, landing)) == [("4|0|6", f"{SMS}_02"), ("7|8|9", f"{SMS}_03")]
    ingest()
    assert publish.processed_files(spark, target).count() == 5  # what has not changed did not come again


def test_a_failure_ends_the_query_and_the_batch_is_retried(spark, tmp_path, text_file, rows, ingest, monkeypatch):
    import tidegate.streaming.ingest as module

    text_file(f"in/{SMS}_01.txt", "1|2|3\n")
    real = module.publish_files
    monkeypatch.setattr(module, "publish_files", lambda *_, **__: 1 / 0)
    with pytest.raises(Exception):
        ingest()
    monkeypatch.setattr(module, "publish_files", real)
    ingest()
    assert rows(publish.read_published(spark, str(tmp_path / "out")), "value") == [(f"1|{d('2')}|3",)]
    assert publish.read_raw(spark, str(tmp_path / "landing")).count() == 1


def test_message_landing_is_exactly_once(spark, tmp_path, rows):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string").write.parquet(source)
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        messages = file_messages(spark, source, schema, F.col("k"), F.col("v"))
        land_messages(messages, target, checkpoint, once=True).awaitTermination()
    assert rows(spark.read.text(target)) == [("(1,x)",), ("(null,y)",)]


def test_triggers_and_kafka_options(spark):
    assert trigger_options(False) == {"processingTime": BATCH_INTERVAL} and trigger_options(True) == {"availableNow": True}
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "host:9093", "topic", kafka__security__protocol="SASL_SSL")
