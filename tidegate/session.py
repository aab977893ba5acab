"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on: AQE sizes the shuffles, picks broadcast joins from
# measured sizes (so nothing is measured beforehand), and splits skewed join partitions even where the join output is grouped again.
# Batches to Python are bounded by size, whatever the length of the texts.
# Writes by folder keep a few files open per task, which saves sorting the rows by folder first.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tidegate", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the runtime settings; `settings` uses `__` for the dots of a setting name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a runtime setting for one write that has no writer option for it."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for local sessions without it."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="tidegate-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder path below the shared folder; Spark creates it on the first write."""
    return f"{shared_folder(spark).rstrip('/')}/tidegate/{label}-{uuid.uuid4().hex}"


def widen(scan: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer partitions than there are cores.

    For expensive per-row work on small or unsplittable files. A large scan has more partitions than
    cores and is returned as it is, so nothing large is shuffled. Pass a plain scan: asking a derived
    frame for its partitions may run its shuffles.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
