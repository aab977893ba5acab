"""No licence rule is held back from a text that it matches."""

import re
import re._parser as parser

import duckdb

from tidegate.llm import license_scan


def matches(sequence):
    """Shortest matches of every alternative of a parsed pattern; of a class its first and last member."""
    out = [""]
    for op, value in sequence:
        if op is parser.LITERAL:
            ways = [chr(value)]
        elif op is parser.IN:
            ways = [chr(c) for kind, v in value for c in (v if kind is parser.RANGE else [v])]
        elif op is parser.SUBPATTERN:
            ways = matches(value[3])
        elif op is parser.BRANCH:
            ways = [x for branch in value[1] for x in matches(branch)]
        else:
            assert op is parser.MAX_REPEAT, op
            ways = ([""] if value[0] == 0 else []) + matches(value[2])
        out = list(dict.fromkeys(a + b for a in out for b in ways))
    return out


def test_every_match_holds_its_gate():
    for rule in license_scan.read_rules():
        for text in matches(parser.parse(rule.pattern)):
            assert re.fullmatch(rule.pattern, text)
            assert rule.gate in text.replace("  ", " ").strip(), (rule, text)


def test_matches_without_the_keyword_are_labelled(spark):
    want = {
        "under the Expat licence": "mit", "ISC licence": "isc", "X11 licence": "x11", "Licence: MIT": "mit", "Released under MIT.": "mit",
        "ASL 2.0": "apache-2.0", "either version 3 of the License, or (at your option) any later version": "gpl-3.0+",
        "the simplified licence": "bsd-2-clause", "do what the heck you want to public licence": "wtfpl", "Open RAIL-M": "openrail",
    }
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in rows} == dict(enumerate(want.values()))
    assert all(r.n_base == 0 and r.base_labels == "" for r in rows)


def test_sql_equals_the_operator(spark):
    texts = [
        None, "", "under the Expat licence", "Released under MIT.", "ISC licence and X11 licence", "MİT LİCENSE", "MIT LICENSE mit License",
        "the Kelvin licence: MIT", "GNU GENERAL PUBLIC LICENSE Version 3", "ÉMIT LICENSE apache license", "Open RAIL-M", "mit license " * 300,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    database = duckdb.connect()
    documents = rows.toPandas()  # noqa: F841
    database.execute("CREATE TABLE documents AS SELECT * FROM documents")
    want = database.execute(license_scan.scan_sql()).fetchall()
    assert sorted(map(tuple, license_scan.scan(rows).collect())) == sorted(want)


def test_only_ascii_letters_are_lowered(spark):
    rows = spark.createDataFrame([(1, "MİT LİCENSE İİ MIT LICENSE"), (2, "K MIT LICENSE")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word) for r in license_scan.scan(rows).collect()}
    assert got == {1: (5, 1, 3), 2: (3, 1, 1)}
