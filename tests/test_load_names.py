"""A load parses names once per file."""

from tidegate.plans import jobs, publish
from tidegate.sources.text import read_lines

STAMPS = "20170901T000000_20170901T235959_20170901T010000"


def test_names_are_parsed_per_file_and_lines_meet_them_by_path(spark, tmp_path, text_file, rows, monkeypatch):
    for name, text in ((f"SMS_{STAMPS}_01", "1|2\n" * 3 + "bad\n"), (f"SMS_{STAMPS}_02", "3|4\n"), ("SMS_01", "5|6\n")):
        text_file(f"in/{name}.txt", text)
    parsed, named = [], jobs.named
    monkeypatch.setattr(jobs, "named", lambda rows: parsed.append(sorted(rows.columns)) or named(rows))
    lines = read_lines(spark, str(tmp_path / "in"), with_path=True)
    # The list of files may spell their paths in another way than the scan, and name files without a line.
    files = spark.createDataFrame([(f"{tmp_path}/in/SMS_{STAMPS}_0{k}.txt",) for k in (1, 2, 3)], "path string")
    for number, known in enumerate((None, files)):
        table = f"load_names_{number}"
        jobs.create_partitioned_table(spark, table, ["a", "b"], str(tmp_path / table))
        jobs.load_partition(spark, lines, ["a", "b"], table, "mensual", str(tmp_path / f"rejects_{number}"), files=known)
        first, second = (("1", "2", "201709", f"SMS_{STAMPS}_01", "txt"), ("3", "4", "201709", f"SMS_{STAMPS}_02", "txt"))
        assert rows(spark.table(table)) == [first] * 3 + [second]
        assert rows(publish.read_raw(spark, str(tmp_path / f"rejects_{number}"))) == [("bad", f"SMS_{STAMPS}_01")]
        tried = publish.processed_files(spark, str(tmp_path / f"rejects_{number}"))
        assert rows(tried, "file_name") == [(f"SMS_{STAMPS}_0{k}",) for k in ((1, 2) if known is None else (1, 2, 3))]
    assert parsed and all(columns == ["path"] for columns in parsed)
