"""Cutting lineage with tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.session import workspace


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written once as Parquet below spark.checkpoint.dir and read again.

    What follows survives the loss of an executor without computing the rows again.
    """
    path = workspace(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
