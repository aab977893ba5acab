"""The physical plans are the intended ones."""

import re

import pytest
from common import SMALL, plan_of
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidegate.operators import aggregates
from tidegate.operators.anonymize import anonymize_by_name, anonymize_lines
from tidegate.queries import ALL as LIBRARY
from tidegate.queries.base import table
from tidegate.session import RUNTIME_SETTINGS, build_session, shared_folder, tune, widen, workspace

NO_SHUFFLE = (
    "digest_column", "anonymize_by_name", "anonymize_by_position", "anonymize_unknown_cols", "digest_sql_function",
    "proj_digest_concat", "proj_split_positions", "proj_row_to_map", "explode_nested_pairs", "filter_not_equal",
    "filter_regex_good_bad", "filter_file_names", "parse_file_names", "partition_date", "set_union_all", "partition_tag",
)

SEQUENCE_FILE = "sink_sequence_file_roundtrip"


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_work_does_not_shuffle(spark, name):
    plan = plan_of(contract.queries()[name](spark, SMALL))
    assert "Exchange" not in plan and "WholeStageCodegen" in plan or "*(" in plan


@pytest.mark.parametrize("name", [n for n in sorted(LIBRARY) if not n.startswith(("job_", "stream_"))])
def test_no_python_and_no_products(spark, name):
    plan = plan_of(contract.queries()[name](spark, SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name != SEQUENCE_FILE:
        assert "PythonRDD" not in plan


def test_scans_are_pruned_and_filtered(spark):
    c = table(spark, SMALL, "customer")
    plan = plan_of(anonymize_by_name(c, ["c_name"], "s1").where("c_nationkey = 3").select("c_name"))
    assert re.search(r"ReadSchema: struct<c_name:string,c_nationkey:int>", plan)
    assert "EqualTo(c_nationkey,3)" in plan
    counts = plan_of(aggregates.count_by_key(table(spark, SMALL, "events"), "event_type"))
    assert "ReadSchema: struct<event_type:string>" in counts and "partial_count" in counts


def test_a_line_is_split_once_and_only_as_far_as_needed(spark):
    lines = spark.createDataFrame([("a|b|c|d",)], "value string")
    plan = plan_of(anonymize_lines(lines, "value", [1, 2], "s1"))
    assert len(re.findall(r"split\(", plan)) == 1 and re.search(r"split\(value#\d+, \\\|, 3\)", plan)


def test_lists_take_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(aggregates.list_by_key(df, "k", "id", 10))
    assert plan.count("Exchange hashpartitioning") == 1 and re.search(r"hashpartitioning\(k#\d+L, bucket#\d+, \d+\)", plan)


@pytest.mark.parametrize("name", ["set_subtract", "wc_stopwords_desc", "agg_list_by_key", "agg_custom_combine"])
def test_building_a_plan_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        contract.queries()[name](spark, SMALL)
        # reading a table's schema may take a job of its own, so only wider ones count
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build-{name}")]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        assert all(s.numTasks == 1 and "parquet" in s.name for s in stages if s)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_session_settings(spark, tmp_path):
    assert build_session().sparkContext is spark.sparkContext
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == shared
    assert workspace(spark, "x").startswith(shared + "/tidegate/x-") and workspace(spark, "x") != workspace(spark, "x")
    assert widen(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 4
    many = spark.range(10).repartition(9)
    assert widen(many) is many
