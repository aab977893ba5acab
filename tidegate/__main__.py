"""Command line of the jobs.

`spark-submit --py-files tidegate.zip tidegate/__main__.py <job> ...`, or `python -m tidegate <job> ...`.
The salt is read from a file, so that it does not show in process lists.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidegate.plans import jobs, publish
from tidegate.session import build_session
from tidegate.sinks.versions import vacuum
from tidegate.sources.catalog import table_columns
from tidegate.sources.control import read_rules
from tidegate.sources.listing import changed_files
from tidegate.streaming.ingest import BATCH_INTERVAL, FILES_PER_BATCH, start_file_ingest
from tidegate.streaming.messages import kafka_messages, land_messages


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidegate", description=__doc__.splitlines()[0])
    sub = root.add_subparsers(dest="job", required=True)

    def add(name: str, text: str, *required: str, salted: bool = False) -> argparse.ArgumentParser:
        command = sub.add_parser(name, help=text)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        if salted:
            command.add_argument("--salt-file", required=True)
            command.add_argument("--algorithm", default="MD5")
            command.add_argument("--sep", default="|")
        return command

    add("count-words", "word counts of text files", "source", "target")

    one = add("anonymize", "anonymise one table's files by column name", "source", "table", "columns", "target", salted=True)
    one.add_argument("--partition-column")
    one.add_argument("--rejects")
    one.add_argument("--any-case", action="store_true")
    one.add_argument("--bracketed", action="store_true")

    archive = add("publish", "anonymise every file of an archive", "archive", "rules", "target", salted=True)
    archive.add_argument("--run", default="batch")
    archive.add_argument("--skip-published", action="store_true")

    chain = add(
        "load-publish", "load, anonymise and publish the files of an entity", "inbox", "entity", "table", "target", salted=True
    )
    chain.add_argument("--frequency", default="diario")
    chain.add_argument("--positions", help="comma list; the entity's own positions by default")
    chain.add_argument("--index-base", type=int, default=1)
    chain.add_argument("--only-next", action="store_true")
    chain.add_argument("--skip-published", action="store_true")

    stream = add("ingest", "the publish job as a stream", "path", "rules", "landing", "target", "checkpoint", salted=True)
    stream.add_argument("--glob")
    stream.add_argument("--max-files", type=int, default=FILES_PER_BATCH)
    stream.add_argument("--modified-after")

    old = add("vacuum", "remove outputs that were replaced", "target")
    old.add_argument("--keep", default="1 day")

    messages = add("land-messages", "land Kafka messages as text", "servers", "topics", "target", "checkpoint")
    for command in (stream, messages):
        command.add_argument("--once", action="store_true", help="stop when everything present is processed")
        command.add_argument("--interval", default=BATCH_INTERVAL)
    return root


def salt_of(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value.rstrip("\r\n")


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"tidegate-{args.job}")
    salted = {}
    if hasattr(args, "salt_file"):
        salted = {"salt": salt_of(spark, args.salt_file), "algorithm": args.algorithm, "sep": args.sep}
    done = publish.processed_files(spark, args.target) if getattr(args, "skip_published", False) else None
    if args.job == "count-words":
        jobs.count_words_job(spark, args.source, args.target)
    elif args.job == "anonymize":
        report = jobs.anonymize_file_job(
            spark, args.source, args.table, args.columns.split(","), args.target,
            partition_column=args.partition_column, rejects=args.rejects,
            case_sensitive=not args.any_case, bracketed=args.bracketed, **salted,
        )
        print(f"anonymised: {', '.join(report.columns)}; unknown: {', '.join(report.unknown)}")
    elif args.job == "publish":
        rules = read_rules(spark, args.rules)
        publish.publish_archive(spark, args.archive, rules, args.target, run=args.run, already_published=done, **salted)
    elif args.job == "load-publish":
        columns = [c for c in table_columns(spark, args.table) if c not in ("fecha", *publish.FILE_KEY)]
        positions = [int(p) for p in args.positions.split(",")] if args.positions else None
        dates = jobs.load_extract_publish(
            spark, args.inbox, args.entity, args.frequency, columns, args.table, args.target, positions=positions,
            published=done, only_next=args.only_next, index_base=args.index_base, **salted,
        )
        print(f"loaded: {', '.join(dates)}")
    elif args.job == "vacuum":
        print(f"removed: {vacuum(spark, args.target, args.keep)}")
    elif args.job == "ingest":
        files = changed_files(spark, args.path, args.glob, args.modified_after)
        query = start_file_ingest(
            files, read_rules(spark, args.rules), args.landing, args.target, args.checkpoint,
            once=args.once, interval=args.interval, max_files=args.max_files, **salted,
        )
        query.awaitTermination()
    else:
        messages = kafka_messages(spark, args.servers, args.topics)
        land_messages(messages, args.target, args.checkpoint, args.once, args.interval).awaitTermination()


if __name__ == "__main__":
    main()
