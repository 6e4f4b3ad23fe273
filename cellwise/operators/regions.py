"""Regions: contiguous row-key ranges given by sorted split points.

Region ``r`` holds keys ``k`` with ``points[r-1] <= k < points[r]``, so the
region of a key is the number of split points ``<= k``.  Split points are a
short driver-side list (one per region); everything else is a Spark job.
"""
from __future__ import annotations

import bisect
import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _key_col(df: DataFrame, key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


# ---------------------------------------------------------------------- B6
# Keys sampled for each range wanted: the standard error of a range's size is
# then about 1 / sqrt(2000), 2.2 percent.
SAMPLE_PER_RANGE = 2000
_GRAIN = 1 << 30


def _key_sample(keys: DataFrame, share: float) -> DataFrame:
    """Distinct keys of the column ``k`` whose hash falls in the first ``share``
    of the hash range: a uniform sample of the distinct keys, the same on every
    run; all keys for a share of 1 or more."""
    k = keys.where(F.col("k").isNotNull())
    if share < 1:
        k = k.where(F.pmod(F.xxhash64("k", F.lit("sample")), F.lit(_GRAIN)) < int(share * _GRAIN) + 1)
    return k.distinct()


def split_points(df: DataFrame, key: str | Column, n: int) -> list:
    """Up to ``n - 1`` split points that cut ``df``'s distinct keys into ``n``
    ranges of about equal row count.

    One pass estimates the number of distinct keys, a second takes a hash sample
    of about ``SAMPLE_PER_RANGE * n`` of them (all, if there are fewer), and only
    the sample is range-partitioned; the smallest key of each range but the
    first is a split point.  At most ``n`` keys reach the driver.
    """
    if n <= 1:
        return []
    k = df.select(_key_col(df, key).alias("k"))
    total = k.agg(F.approx_count_distinct("k")).first()[0]
    sample = _key_sample(k, SAMPLE_PER_RANGE * n / max(1, total))
    firsts = (sample.repartitionByRange(n, "k")
              .groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("k"))
              .collect())
    return sorted({_plain(r["k"]) for r in firsts})[1:]


def _plain(k):
    return bytes(k) if isinstance(k, bytearray) else k


def uniform_split_points(df: DataFrame, key: str, n: int, width: int) -> list[str]:
    """Split points for zero-padded numeric text keys: up to ``n`` equal-width
    ranges between the smallest and largest key (one aggregate row to the
    driver); fewer where the key range holds fewer than ``n`` numbers."""
    r = df.agg(F.min(F.col(key)).alias("lo"), F.max(F.col(key)).alias("hi")).first()
    if r["lo"] is None:
        return []
    lo, hi = int(r["lo"]), int(r["hi"])
    points = {lo + (hi - lo + 1) * i // n for i in range(1, n)} - {lo}
    return [str(p).zfill(width) for p in sorted(points)]


# ---------------------------------------------------------------------- B7
#: up to so many split points the bisection is unrolled into compiled comparisons
UNROLL_POINTS = 512
#: of more points, so many are searched by compiled comparisons, and the points of at most
#: so many between two of them are counted
COARSE_POINTS, BETWEEN_POINTS = 32, 64


def region_expr(key: Column, points: Sequence) -> Column:
    """Region number of ``key``: the split points that are not above it, NULL
    for a NULL key.  Found by bisection: log2(regions) comparisons per key, no
    join and no broadcast; as nested CASE branches, or over array literals
    where there are more than ``UNROLL_POINTS``.  ``key`` had better be a column
    (each comparison evaluates it)."""
    pts = [_plain(p) for p in points]
    if any(pts[i] >= pts[i + 1] for i in range(len(pts) - 1)):
        raise ValueError("split points must be strictly increasing")
    n = len(pts)
    def find(among: Sequence, lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(among[mid]), find(among, lo, mid)).otherwise(find(among, mid + 1, hi))

    if n <= UNROLL_POINTS:
        return F.when(key.isNotNull(), find(pts, 0, n)).cast("int")
    step = -(-n // COARSE_POINTS)
    if step <= BETWEEN_POINTS:
        runs = [pts[i:i + step] for i in range(0, n, step)]
        firsts = [r[0] for r in runs[1:]]
        run = find(firsts, 0, len(firsts))
        own = F.get(F.array(*[F.array(*[F.lit(p) for p in r]) for r in runs]), run)
        return F.when(key.isNotNull(), run * step + F.size(F.filter(own, lambda p: p <= key))).cast("int")
    arr = F.array(*[F.lit(p) for p in pts])

    def narrow(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        right = F.element_at(arr, F.least(mid + 1, F.lit(n))) <= key
        return (F.when(lo >= hi, acc)
                .when(right, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
                .otherwise(F.struct(lo.alias("lo"), mid.alias("hi"))))

    init = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length() + 1)), init, narrow)["lo"]
    return F.when(key.isNotNull(), found).cast("int")


def region_weights(df: DataFrame, region: str = "region") -> dict[int, int]:
    """Rows per region: one aggregate that reads the key column only; one row per
    region reaches the driver."""
    counts = df.groupBy(F.coalesce(F.col(region), F.lit(0)).alias("r")).count().collect()
    return {r["r"]: r["count"] for r in counts}


def task_shares(weights: dict[int, int], n: int, tasks: int) -> list[int]:
    """Write tasks of each of ``n`` regions: its share of ``tasks`` by weight,
    rounded up, at least one."""
    total = max(1, sum(weights.values()))
    return [max(1, -(-tasks * weights.get(r, 0) // total)) for r in range(n)]


def assign_region(df: DataFrame, key: str | Column, points: Sequence,
                  name: str = "region") -> DataFrame:
    return df.withColumn(name, region_expr(_key_col(df, key), points))


def region_of(points: Sequence, key) -> int:
    """Driver-side region of one key (for pruning bounds)."""
    return bisect.bisect_right([_plain(p) for p in points], _plain(key))


def region_bounds(points: Sequence, lo=None, hi=None) -> tuple[int, int]:
    """Regions a key range [lo, hi] can touch."""
    r_lo = region_of(points, lo) if lo is not None else 0
    r_hi = region_of(points, hi) if hi is not None else len(points)
    return r_lo, r_hi


# --------------------------------------------------------------------- B12
def region_skew(cells: DataFrame, region: str = "region") -> DataFrame:
    """Per region: rows (distinct keys), cells, bytes, first and last key, and
    the ratio of its rows and bytes to the median region.

    The per-region aggregate has one row per region, so the final window over
    all regions handles a few thousand rows at most.
    """
    per = cells.groupBy(region).agg(
        F.count_distinct("row_key").alias("rows"),
        F.count(F.lit(1)).alias("cells"),
        F.sum(F.octet_length("value") + F.octet_length("row_key") + F.octet_length("qualifier"))
        .alias("bytes"),
        F.min("row_key").alias("first_key"),
        F.max("row_key").alias("last_key"),
    )
    allw = Window.partitionBy()
    return (per
            .withColumn("median_rows", F.median("rows").over(allw))
            .withColumn("median_bytes", F.median("bytes").over(allw))
            .withColumn("rows_to_median", F.round(F.col("rows") / F.col("median_rows"), 4))
            .withColumn("bytes_to_median", F.round(F.col("bytes") / F.col("median_bytes"), 4))
            .withColumn("max_to_median",
                        F.round(F.max("rows").over(allw) / F.col("median_rows"), 4))
            .drop("median_rows", "median_bytes"))


# --------------------------------------------------------------------- B13
def refine_splits(cells: DataFrame, points: Sequence, max_rows: int,
                  region: str = "region") -> list:
    """Add split points inside every region holding more than ``max_rows``
    rows, so that each heavy region is cut into ``ceil(rows / max_rows)``
    pieces; other regions keep their bounds.  A single row key is never split
    (it may exceed ``max_rows`` alone).

    Row counts and cuts come from a hash sample of the distinct keys, about
    ``SAMPLE_PER_RANGE`` for every ``max_rows`` (all keys where ``max_rows`` is
    less than that)."""
    share = min(1.0, SAMPLE_PER_RANGE / max(1, max_rows))
    keys = cells.select(F.col(region).alias("r"), F.col("row_key").alias("k"))
    sample = _key_sample(keys, share)
    counts = sample.groupBy("r").agg(F.count(F.lit(1)).alias("n")).collect()
    pieces = {r["r"]: math.ceil(r["n"] / share / max_rows) for r in counts
              if r["n"] / share > max_rows}
    if not pieces:
        return list(points)
    size = sum((F.when(F.col("r") == reg, F.lit(n)).otherwise(0) for reg, n in pieces.items()), F.lit(0))
    heavy = sample.where(F.col("r").isin(list(pieces)))
    # equal pieces of each heavy region: by rank within it
    place = Window.partitionBy("r").orderBy("k")
    cut = F.floor((F.row_number().over(place) - 1) * size / F.count(F.lit(1)).over(Window.partitionBy("r")))
    firsts = (heavy.withColumn("piece", cut).groupBy("r", "piece").agg(F.min("k").alias("k"))
              .where("piece > 0").collect())
    return sorted({_plain(p) for p in points} | {_plain(r["k"]) for r in firsts})


__all__ = ["split_points", "uniform_split_points", "region_expr", "assign_region", "region_of",
           "region_bounds", "region_weights", "task_shares", "region_skew", "refine_splits"]
