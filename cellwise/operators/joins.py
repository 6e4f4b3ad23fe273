"""Join helpers: Catalyst's size estimate of a DataFrame."""
from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (from file sizes and statistics; no
    job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


__all__ = ["estimated_bytes"]
