"""The registered queries: a Spark callable and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from tidegate.queries import digests, files, jobs, keyed, projections
from tidegate.queries.base import Query

ALL: dict[str, Query] = {
    **digests.QUERIES,
    **projections.QUERIES,
    **keyed.QUERIES,
    **files.QUERIES,
    **jobs.QUERIES,
}
