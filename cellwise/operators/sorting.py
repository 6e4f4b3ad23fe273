"""Ordering helpers the reference's queries use."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_by(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-distribute by ``key`` and sort within each partition (no global
    sort, no single-task merge)."""
    parted = df.repartition(partitions, key) if partitions else df.repartition(key)
    return parted.sortWithinPartitions(key)


def sample_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` rows chosen by a stable hash of ``key`` (same rows every run):
    a top-n by md5, which Spark runs as a per-task top-n then a merge of at
    most n rows per task."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)


__all__ = ["cluster_by", "sample_rows"]
