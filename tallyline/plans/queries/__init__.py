"""Registered queries: each reads the general test tables whole.

``REGISTRY`` maps a name to ``(callable(spark, sf_dir), sql or None)``; the SQL is
the same result written independently for another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.plans.queries import changes, indicators, pages, refresh, summaries

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Query, str | None]] = {
    **changes.QUERIES,
    **indicators.QUERIES,
    **summaries.QUERIES,
    **pages.QUERIES,
    **refresh.QUERIES,
}
