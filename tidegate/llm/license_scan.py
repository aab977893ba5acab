"""Licence scan with ordered signature rules, in DataFrame functions only.

A text becomes its words with A-Z in lower case, each between two spaces of its own, so that neighbouring matches share
nothing. Rules (license_rules.py) are grouped by gate, a string that every match holds; only the groups whose gate
occurs in the text are tried. A detection is (priority, rule, label, start, end). A detection that lies inside another is suppressed
if the other has a higher priority, or the same and is longer, or is equal in both and earlier in the list of
rules. The labels of a text are those of the detections left, together with the base phrases, which always
count: a phrase's label stands wherever its words stand one after another.

The score is the highest priority of what was found as a part of 1, with base phrases at 80; 0 without any.

Defined results: a null or empty text has no word and no label; base_labels and labels are empty strings and
first_word and last_word null. Repeated rows and ids are scanned one by one; other columns are not read.
Letters outside A-Z keep their words apart from those of the rules.
"""

from __future__ import annotations

import json
import string
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.license_rules import GATES, RULES

BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
BASE_PRIORITY = 80
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Rule(NamedTuple):
    number: int
    label: str
    priority: int
    keyword: str
    pattern: str  # over words that stand between two spaces
    gate: str  # what every match holds: the keyword or, where it isn't implied, another string


def read_rules(lines: str = RULES) -> list[Rule]:
    out = []
    for line in lines.strip().splitlines():
        label, priority, keyword, pattern = (part.strip() for part in line.split("|", 3))
        out.append(Rule(len(out), label, int(priority), keyword, spaced(pattern), GATES.get(pattern, keyword)))
    return out


def spaced(pattern: str) -> str:
    return f" {pattern.replace(' ', '  ')} ".replace("  ?", "(?:  )?")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def starts_of(text: Column, pattern: Column) -> Column:
    """(start, end) of each match of a pattern, in order."""

    def found(matches: Column) -> Column:
        before = F.split(text, pattern, -1)

        def add(state: Column, piece: Column) -> Column:
            start = state["at"] + F.length(piece)
            end = start + F.length(F.get(matches, F.size(state["spans"])))
            return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("spans"))

        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
        pieces = F.slice(before, 1, F.size(matches))
        return F.when(F.size(matches) > 0, F.aggregate(pieces, first, add, lambda state: state["spans"]))

    return F.coalesce(
        _let(F.regexp_extract_all(text, pattern, F.lit(0)), found), F.array().cast("array<struct<start:int,end:int>>")
    )


def detections(text: Column, words: Column, rules: Sequence[Rule]) -> Column:
    """All detections in the order start, longest, highest priority, first rule."""
    groups: dict[str, list[dict]] = {}
    for rule in rules:
        groups.setdefault(rule.gate, []).append(
            {"number": rule.number, "label": rule.label, "priority": rule.priority, "pattern": rule.pattern}
        )
    table = F.from_json(
        F.lit(json.dumps([{"gate": k, "rules": v} for k, v in groups.items()])),
        "array<struct<gate:string,rules:array<struct<number:int,label:string,priority:int,pattern:string>>>>",
    )
    tried = F.flatten(F.transform(F.filter(table, lambda g: F.contains(words, g["gate"])), lambda g: g["rules"]))
    found = F.transform(
        tried,
        lambda rule: F.transform(
            starts_of(text, rule["pattern"]),
            lambda span: F.struct(
                span["start"].alias("start"),
                (-span["end"]).alias("minus_end"),
                (-rule["priority"]).alias("minus_priority"),
                rule["number"].alias("number"),
                rule["label"].alias("label"),
            ),
        ),
    )
    return F.array_sort(F.flatten(found))


def suppress(found: Column, priorities: Sequence[int]) -> Column:
    """(label, priority) of the detections that do not lie inside another of at least their priority.

    What stands before a detection in the order starts no later, so it holds the detection if it ends no
    earlier; the furthest end so far of each priority decides.
    """

    def step(state: Column, d: Column) -> Column:
        inside = F.lit(False)
        for p in priorities:
            inside = inside | ((-d["minus_priority"] <= p) & (state[f"end_{p}"] >= -d["minus_end"]))
        ends = [
            F.when(-d["minus_priority"] == p, F.greatest(state[f"end_{p}"], -d["minus_end"])).otherwise(state[f"end_{p}"]).alias(f"end_{p}")
            for p in priorities
        ]
        one = F.array(F.struct(d["label"].alias("label"), (-d["minus_priority"]).alias("priority")))
        return F.struct(*ends, F.when(inside, state["out"]).otherwise(F.concat(state["out"], one)).alias("out"))

    start = F.struct(
        *[F.lit(0).alias(f"end_{p}") for p in priorities], F.array().cast("array<struct<label:string,priority:int>>").alias("out")
    )
    return F.aggregate(found, start, step, lambda state: state["out"])


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    rules = read_rules() if rules is None else rules
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    rows = rows.select("doc_id", F.trim(F.regexp_replace(F.translate("_text", UPPER, LOWER), OTHER, " ")).alias("_words"))
    rows = rows.withColumn("_spaced", F.concat(F.lit(" "), F.replace("_words", F.lit(" "), F.lit("  ")), F.lit(" ")))
    none = F.array().cast("array<struct<label:string,start:int>>")

    def places(phrase: str, label: str) -> Column:
        spans = starts_of(F.col("_spaced"), F.lit(spaced(phrase)))
        return F.transform(spans, lambda span: F.struct(F.lit(label).alias("label"), span["start"].alias("start")))

    base = F.concat(*[places(phrase, label) for phrase, label in BASE])
    rows = rows.withColumn("_base", F.when(F.contains("_words", F.lit(" license")), base).otherwise(none))
    left = suppress(detections(F.col("_spaced"), F.col("_words"), rules), sorted({r.priority for r in rules}))
    rows = rows.withColumn("_left", left)

    def word_at(start: Column) -> Column:
        """Words before a place: each has two spaces of its own."""
        return F.floor(F.regexp_count(F.substring("_spaced", F.lit(1), start), F.lit(" ")) / 2)

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    names = F.transform("_base", lambda b: b["label"])
    starts = F.transform("_base", lambda b: b["start"])
    best = F.greatest(
        F.coalesce(F.array_max(F.transform("_left", lambda d: d["priority"])), F.lit(0)),
        F.when(F.size("_base") > 0, BASE_PRIORITY).otherwise(0),
    )
    return rows.select(
        "doc_id",
        F.when(F.col("_words") == "", 0).otherwise(F.regexp_count("_words", F.lit(" ")) + 1).cast("long").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        F.when(F.size("_base") > 0, word_at(F.array_min(starts))).cast("long").alias("first_word"),
        F.when(F.size("_base") > 0, word_at(F.array_max(starts))).cast("long").alias("last_word"),
        joined(names).alias("base_labels"),
        joined(F.concat(names, F.transform("_left", lambda d: d["label"]))).alias("labels"),
        (best / 100).alias("score"),
    )


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def scan_sql() -> str:
    """The same scan as SQL, written from the same rules."""
    rules = ",\n    ".join(
        f"({r.number}, {_quoted(r.label)}, {r.priority}, {_quoted(r.gate)}, {_quoted(r.pattern)})" for r in read_rules()
    )
    base = ", ".join(f"({_quoted(spaced(phrase))}, {_quoted(label)})" for phrase, label in BASE)
    return rf"""
WITH rules(number, label, priority, gate, pattern) AS (VALUES
    {rules}),
base(pattern, label) AS (VALUES {base}),
plain AS (
  SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g'), ' ') AS words FROM documents),
texts AS (SELECT doc_id, words, ' ' || replace(words, ' ', '  ') || ' ' AS spaced FROM plain),
base_hits AS (
  SELECT doc_id, label, spaced, regexp_split_to_array(spaced, pattern) AS pieces, regexp_extract_all(spaced, pattern) AS matches
  FROM texts JOIN base ON contains(spaced, pattern)),
base_places AS (
  SELECT doc_id, label, length(regexp_replace(substr(spaced, 1, place), '[^ ]', '', 'g')) // 2 AS word
  FROM (SELECT *, CAST(list_sum(list_transform(pieces[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS place
        FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS k FROM base_hits))),
based AS (
  SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word FROM base_places GROUP BY doc_id),
rule_hits AS (
  SELECT doc_id, number, label, priority, regexp_split_to_array(spaced, pattern) AS pieces,
         regexp_extract_all(spaced, pattern) AS matches
  FROM texts JOIN rules ON contains(words, gate) AND regexp_matches(spaced, pattern)),
found AS (
  SELECT doc_id, number, label, priority, place AS s, place + length(matches[k]) AS e
  FROM (SELECT *, CAST(list_sum(list_transform(pieces[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS place
        FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS k FROM rule_hits))),
kept AS (
  SELECT doc_id, label, priority FROM found d
  WHERE NOT EXISTS (
    SELECT 1 FROM found o
    WHERE o.doc_id = d.doc_id AND o.s <= d.s AND o.e >= d.e AND (o.number <> d.number OR o.s <> d.s)
      AND (o.priority > d.priority OR o.priority = d.priority AND (o.e - o.s > d.e - d.s OR o.number < d.number)))),
named AS (
  SELECT doc_id, label, priority, FALSE AS base FROM kept
  UNION ALL SELECT doc_id, label, {BASE_PRIORITY}, TRUE FROM base_places),
labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, max(priority) AS best
  FROM named GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN words = '' THEN 0 ELSE length(words) - length(replace(words, ' ', '')) + 1 END AS BIGINT) AS n_words,
       CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(best, 0) / 100 AS score
FROM texts LEFT JOIN based USING (doc_id) LEFT JOIN labelled USING (doc_id)"""
