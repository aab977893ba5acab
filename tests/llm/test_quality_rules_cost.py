"""The order of the cascade follows cost per document and share of rejections."""

from pyspark.sql import functions as F

from tidegate.llm import quality_rules
from tidegate.llm.quality_rules import Rule


def test_costly_rules_come_after_cheap_ones_that_reject_as_much(spark):
    texts = spark.createDataFrame([(None if i % 3 == 0 else i, f"some words {i} " * 150) for i in range(300)], "doc_id long, text string")
    slow = r"(?:[a-z]+ ?){1,6}[0-9]+ (?=some)"
    rules = [
        Rule("dear", lambda: F.regexp_count("text", F.lit(slow)) >= 0, ""),
        Rule("cheap", lambda: F.col("n_words") >= 0, ""),
        Rule("never", lambda: F.col("n_words") < 0, ""),
    ]
    assert [r.name for r in quality_rules.in_order(texts, rules)] == ["cheap", "dear", "never"]


def test_a_sample_of_rows_without_ids_is_a_sample(spark):
    texts = spark.range(20_000).selectExpr("CAST(NULL AS long) AS doc_id", "concat('some words ', id) AS text")
    seen = []
    count = quality_rules._seconds

    def spy(rows, column):
        seen.append(rows.count() / quality_rules.REPEATS)
        return count(rows, column)

    quality_rules._seconds = spy
    try:
        quality_rules.in_order(texts, quality_rules.RULES[:1])
    finally:
        quality_rules._seconds = count
    assert 500 < seen[0] < 2000


def test_no_rows(spark):
    assert len(quality_rules.in_order(spark.createDataFrame([], "doc_id long, text string"), quality_rules.RULES)) == len(quality_rules.RULES)
