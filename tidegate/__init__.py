"""tidegate: file and stream ingest, anonymisation and keyed operators on Spark DataFrames."""

from tidegate.session import build_session, tune, workspace

__all__ = ["build_session", "tune", "workspace"]
