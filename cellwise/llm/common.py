"""Shared helpers: scratch tables, word hashing, Arrow batch loops, components."""
from __future__ import annotations

import os
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path

U64 = np.uint64
_P1, _P2, _P3 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the
    lineage, and lost executors do not lose the rows."""
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these tables, once no table that is still to be read derives from them."""
    for t in tables:
        drop_path(t.sparkSession, t._scratch)


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per session, so
    that tasks can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_cellwise_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(top):                       # else the package came in a zip, as shipped code does
        made = os.path.join(SparkFiles.getRootDirectory(), "made")
        os.makedirs(made, exist_ok=True)
        path = os.path.join(made, "cellwise_source.zip")
        with zipfile.ZipFile(path, "w") as z:
            for d, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), os.path.dirname(top)))
        sc.addPyFile(path)
    sc._cellwise_shipped = True


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this package at hand on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def prefilter(df: DataFrame, key, keys: DataFrame, buckets: int = 1 << 20) -> DataFrame:
    """Rows of ``df`` whose ``key`` may occur in the one column of ``keys``.

    Both sides are hashed into ``buckets`` values; the set of values that occur,
    never more than ``buckets`` rows, is broadcast. No row with a matching key
    is lost, so a join on the key itself may follow with fewer rows to shuffle.
    """
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    seen = keys.select(bucket(F.col(keys.columns[0])).alias("_bucket")).distinct()
    return df.withColumn("_bucket", bucket(key)).join(F.broadcast(seen), "_bucket", "left_semi").drop("_bucket")


def doc_crc_mod(col, m: int):
    """crc32 of the id's decimal text, modulo ``m``."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(m))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a few hundred rows, so that a task holds little at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class HashCache(dict):
    """word bytes → 64-bit hash. Holds up to ``cap`` words; beyond that, words
    are hashed each time."""

    def __init__(self, cap: int = 250_000):
        super().__init__()
        self.cap = cap

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < self.cap:
            self[word] = h
        return h


_WORDS = HashCache()


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 bytes."""
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), U64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = (h ^ (h >> U64(32))) * _P3
    h = (h ^ (h >> U64(29))) * _P1
    return h ^ (h >> U64(32))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive 64-bit hash of word pairs."""
    return mix(a * _P1 + (b ^ (b >> U64(31))) * _P2 + U64(1))


def shingles(h: np.ndarray, w: int) -> np.ndarray:
    """Sorted distinct hashes of the w-word shingles; a text of fewer words is
    one shingle, a text without words has none."""
    n = len(h)
    if n == 0:
        return h
    k = min(w, n)
    acc = mix(h[: n - k + 1] + U64(k))
    for i in range(1, k):
        acc = pair_hash(acc, h[i: n - k + 1 + i])
    return np.unique(acc)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(id, component)``, where the
    component is the smallest id reachable.

    Alternates the large-star and small-star steps until the edges no longer
    change: O(log n) rounds, each a min per node (partial aggregate) and a join
    that AQE can split for hot nodes. Every round is written to the shared
    checkpoint folder; only its row count and checksum reach the driver.
    """
    e = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "cc")

    def mark(df):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    seen = mark(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        # large star: each node hands its smallest neighbour to its larger ones
        both = e.union(e.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        low = materialise(low, "cc")
        large = (both.join(low, both.a == low.u).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = materialise(large.distinct(), "cc")
        # small star: each node joins its smaller neighbours to the smallest of them
        low = materialise(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "cc")
        pulled = large.join(low, large.a == low.u).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialise(pulled.union(low.select("u", "m")).filter("a <> b").distinct(), "cc")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    roots = e.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
