"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition that rejects a document. On a bounded sample every rule is run alone: its cost is the
time it takes per document beyond that of the same job without a rule, its selectivity the share it rejects. Rules then stand in order of rejections per cost in one
CASE expression, which stops at the first that fires, so most rejected documents never meet the costly rules.
The order changes the time, never the verdict.

Defined results: a null or empty text has no word, fails the base and isn't kept. A text of one or two words
has no window of three. Null and repeated ids and repeated rows are judged one by one; the columns of the
result are new, other columns of the input are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.stages import stored

SPACES = r"[\x20\x09-\x0D]"
NO_SPACES = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 1000  # bound of the sample on which costs and selectivities are estimated
REPEATS = 2  # times that a job judges each of its rows, so that rules weigh more than the job itself
ROUNDS = 2  # jobs of each rule, of which the quickest counts
LEAST_COST = 1e-8  # seconds a document: rules below what can be measured cost the same


class Rule(NamedTuple):
    name: str
    rejects: Callable[[], Column]  # over the columns of `signals`, its text included
    sql: str  # the same condition in SQL


RULES = (
    Rule("symbols", lambda: F.expr("10 * n_symbols > 3 * n_words"), "10 * n_symbols > 3 * n_words"),
    Rule(
        "word_length",
        lambda: F.expr("word_chars < 2 * n_words OR word_chars > 15 * n_words"),
        "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    ),
    Rule(
        "repeated_lines",
        lambda: 10 * F.col("n_dup_lines") > 3 * (F.regexp_count("text", F.lit(r"\n")) + 1),
        "10 * n_dup_lines > 3 * (length(text) - length(replace(text, chr(10), '')) + 1)",
    ),
    Rule(
        "few_letters",
        lambda: 2 * F.regexp_count("text", F.lit(r"[\p{L}]")) < F.col("word_chars"),
        "2 * length(regexp_replace(text, '[^\\p{L}]', '', 'g')) < word_chars",
    ),
    Rule(
        "shouting",
        lambda: 2 * F.regexp_count("text", F.lit("[A-Z]")) > F.col("word_chars"),
        "2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars",
    ),
    Rule(
        "exclamations",
        lambda: F.regexp_count("text", F.lit("!")) * 3 > F.col("n_words"),
        "3 * (length(text) - length(replace(text, '!', ''))) > n_words",
    ),
)


def signals(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_words", F.array_remove(F.split("text", SPACES + "+"), ""))
    rows = rows.withColumn("_lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(NO_SPACES)))
    # Windows of three words: words hold no space, so the joined text tells any two windows apart.
    last = F.size("_words") - 2
    window = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.concat_ws(" ", F.get("_words", i - 1), F.get("_words", i), F.get("_words", i + 1)),
    )
    rows = rows.withColumn("_windows", F.when(last >= 1, window).otherwise(F.array().cast("array<string>")))
    # Only a text in which a window repeats has its windows sorted. Equal ones stand side by side then.
    placed = F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed))
    repeated = F.filter(
        F.transform(
            "_sorted",
            lambda x, k: F.when(
                (F.get("_sorted", k - 1)["w"] == x["w"]) | (F.get("_sorted", k + 1)["w"] == x["w"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    rows = rows.withColumn("_starts", F.array_sort(repeated))
    # A window covers its three words up to where the next repeated one begins.
    covered = F.aggregate(
        F.transform("_starts", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("_starts", k + 1) - i, F.lit(3)))),
        F.lit(0),
        lambda n, x: n + x,
    )
    return rows.select(
        "doc_id",
        "text",
        F.size("_words").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(SPACES))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def in_order(rows: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per cost, both measured on about SAMPLE_ROWS of the documents (doc_id, text)."""
    total = max(rows.select("doc_id").count(), 1)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = stored(signals(rows.where(place <= SAMPLE_ROWS / total)), "rules")
    size = max(sample.count(), 1)
    # Aggregates are not moved below the repetition, so every copy of a row is judged.
    copies = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
    columns = F.count_if(F.col("text").isNull() | (F.col("n_words") + F.col("word_chars") + F.col("n_symbols") + F.col("n_dup_lines") < 0))
    empty, _ = _seconds(copies, columns)
    ranked = []
    for rule in rules:
        seconds, rejected = _seconds(copies, F.count_if(rule.rejects()))
        cost = max((seconds - empty) / (REPEATS * size), LEAST_COST)
        ranked.append((rejected / (REPEATS * size) / cost, rule.name, rule))
    return [rule for _, _, rule in sorted(ranked, key=lambda r: (-r[0], r[1]))]


def _seconds(rows: DataFrame, count: Column) -> tuple[float, int]:
    """The quickest of ROUNDS jobs, and what they count."""
    times, found = [], 0
    for _ in range(ROUNDS):
        start = time.perf_counter()
        found = rows.agg(count).first()[0]
        times.append(time.perf_counter() - start)
    return min(times), found


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are not evaluated."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        out = out.when(F.coalesce(rule.rejects(), F.lit(False)), F.lit(rule.name))
    return out


def judge(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = in_order(rows, rules)
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return signals(rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(cascade(ordered).isNull()).alias("kept"),
    )
