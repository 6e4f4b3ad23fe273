"""Queries for regions and the versioned store."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..mapping import Mapping
from ..operators import scan
from ..operators.regions import (assign_region, refine_splits, region_skew, split_points,
                                 uniform_split_points)
from ..session import scratch_path
from ..sources.store import CellStore, buckets_for, export_table
from ..sources.text import cells_to_lines, text_to_cells
from . import testcells as tc
from .reads import LI_NEWEST
from .registry import query

N_REGIONS = 8

# region of a lineitem key under 8 equal-width ranges of the order key
_LI_REGION_CTE = f"""
bounds AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem),
pts AS (SELECT lpad(CAST(lo + (hi - lo + 1) * i // {N_REGIONS} AS VARCHAR), 10, '0') AS p
        FROM bounds, range(1, {N_REGIONS}) t(i)),
keyed AS (SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$'
                 || CAST(l_linenumber AS VARCHAR) AS row_key, l_returnflag, l_linestatus FROM lineitem),
reg AS (SELECT *, CAST((SELECT count(*) FROM pts WHERE p <= row_key) AS INTEGER) AS region
        FROM keyed)"""


def li_points(spark, sf_dir):
    li = tc.load(spark, sf_dir, "lineitem")
    return uniform_split_points(li, "l_orderkey", N_REGIONS, 10)


@query("b6_split_points", f"""
WITH keyed AS (SELECT DISTINCT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$'
                      || CAST(l_linenumber AS VARCHAR) AS row_key FROM lineitem)
SELECT {N_REGIONS} AS regions, count(*) AS rows, true AS points_inside, true AS ordered,
       true AS balanced FROM keyed
""")
def b6_split_points(spark, sf_dir):
    """Split points from a hash sample of the lineitem keys.  The exact cut
    depends on the sample, so the result states what must hold: the number of
    regions, all rows assigned, points inside the key range and increasing, and
    no region above 1.2 times its share."""
    keys = scan.scan_keys(tc.li_cells(spark, sf_dir))
    pts = split_points(keys, "row_key", N_REGIONS)
    per = (assign_region(keys, "row_key", pts).groupBy("region")
           .agg(F.count(F.lit(1)).alias("n"), F.min("row_key").alias("lo"), F.max("row_key").alias("hi")))
    return per.agg(F.count(F.lit(1)).cast("int").alias("regions"), F.sum("n").alias("rows"),
                   ((F.min("lo") < pts[0]) & (F.max("hi") >= pts[-1])).alias("points_inside"),
                   F.lit(pts == sorted(set(pts))).alias("ordered"),
                   (F.max("n") <= 1.2 * F.sum("n") / N_REGIONS).alias("balanced"))


@query("b7_assign_region", f"""
WITH {_LI_REGION_CTE}
SELECT region, count(DISTINCT row_key) AS rows, min(row_key) AS first_key,
       max(row_key) AS last_key
FROM reg GROUP BY region
""")
def b7_assign_region(spark, sf_dir):
    """Region of every key by binary search over the split points."""
    keys = scan.scan_keys(tc.li_cells(spark, sf_dir))
    r = assign_region(keys, "row_key", li_points(spark, sf_dir))
    return r.groupBy("region").agg(F.count(F.lit(1)).alias("rows"),
                                   F.min("row_key").alias("first_key"),
                                   F.max("row_key").alias("last_key"))


@query("b8_bulk_write", f"""
WITH {_LI_REGION_CTE}
SELECT region, count(DISTINCT row_key) AS rows, count(*) * 6 AS cells,
       min(row_key) AS first_key, max(row_key) AS last_key
FROM reg GROUP BY region
""")
def b8_bulk_write(spark, sf_dir):
    """Total-order bulk write of the lineitem cells into 8 regions, read
    back from the published version; per region its rows, cells and key span."""
    store = CellStore(spark, scratch_path(spark, "b8"))
    store.write(tc.li_cells(spark, sf_dir), points=li_points(spark, sf_dir), mode="range")
    return (store.read().groupBy("region")
            .agg(F.count_distinct("row_key").alias("rows"), F.count(F.lit(1)).alias("cells"),
                 F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key")))


MANY_REGIONS, WRITE_TASKS = 1000, 200


@query("b8_weighted_regions", f"""
WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem),
pts AS (SELECT DISTINCT lpad(CAST(lo + ((hi - lo + 1) * i) // {3 * MANY_REGIONS} AS VARCHAR), 10, '0') AS p FROM b, range(1, {MANY_REGIONS + 1}) t(i)),
cut AS (SELECT max(p) AS p FROM pts WHERE p > (SELECT lpad(CAST(lo AS VARCHAR), 10, '0') FROM b)),
keyed AS (SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$' || CAST(l_linenumber AS VARCHAR) AS row_key FROM lineitem)
SELECT (SELECT count(*) + 1 FROM pts WHERE p > (SELECT lpad(CAST(lo AS VARCHAR), 10, '0') FROM b)) AS regions,
       count(*) * 6 AS cells, count(*) FILTER (WHERE row_key >= cut.p) * 6 AS cells_of_last,
       true AS balanced, true AS regions_kept_apart
FROM keyed, cut
""")
def b8_weighted_regions(spark, sf_dir):
    """A thousand regions of which the last holds two thirds of the keys. Tasks go
    to regions by size: no file is above twice the cells that a task should write,
    and none holds cells of two regions."""
    li = tc.load(spark, sf_dir, "lineitem")
    lo, hi = (int(x) for x in li.agg(F.min("l_orderkey"), F.max("l_orderkey")).first())
    points = sorted({lo + (hi - lo + 1) * i // (3 * MANY_REGIONS) for i in range(1, MANY_REGIONS + 1)} - {lo})
    store = CellStore(spark, scratch_path(spark, "b8w"))
    res = store.stage_rows(tc.li_rows(spark, sf_dir), tc.LI_MAPPING, ts=tc.CU_WRITE_TS, seq=F.col("li_seq"),
                           points=[str(p).zfill(10) for p in points], tasks=WRITE_TASKS)
    store.publish(res)
    files = (spark.read.parquet(res.stage).withColumn("file", F.col("_metadata.file_name"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("region").alias("lo"), F.max("region").alias("hi")))
    last = F.sum(F.when(F.col("lo") == len(points), F.col("n")).otherwise(0))
    return files.agg(F.lit(len(points) + 1).cast("bigint").alias("regions"), F.sum("n").alias("cells"), last.alias("cells_of_last"),
                     (F.max("n") <= 2 * F.sum("n") / WRITE_TASKS).alias("balanced"),
                     F.bool_and(F.col("lo") == F.col("hi")).alias("regions_kept_apart"))


@query("b9_publish", """
SELECT 'staged' AS phase, 0::BIGINT AS visible_cells,
       count(o_custkey) + count(o_orderstatus) + count(o_totalprice) + count(o_orderpriority)
         AS stage_cells FROM orders
UNION ALL
SELECT 'published',
       count(o_custkey) + count(o_orderstatus) + count(o_totalprice) + count(o_orderpriority),
       count(o_custkey) + count(o_orderstatus) + count(o_totalprice) + count(o_orderpriority)
FROM orders
""")
def b9_publish(spark, sf_dir):
    """A staged version is invisible until published, then all of it is."""
    store = CellStore(spark, scratch_path(spark, "b9"))
    res = store.stage(tc.or_cells(spark, sf_dir), points=[])
    staged = spark.read.parquet(res.stage).count()
    before = store.read().count()
    store.publish(res)
    after = store.read()
    return spark.createDataFrame(
        [("staged", before, staged)], "phase string, visible_cells bigint, stage_cells bigint"
    ).unionByName(after.agg(F.count(F.lit(1)).alias("visible_cells"))
                  .select(F.lit("published").alias("phase"), "visible_cells",
                          F.lit(staged).cast("bigint").alias("stage_cells")))


CU_LAYOUT = {
    "p": {"compression": "zstd", "parquet.block.size": 8 << 20},
    "n": {"compression": "snappy", "parquet.bloom.filter.enabled#row_key": "true",
          "parquet.enable.dictionary": "false"},
}


_LAYOUT_SQL = """
SELECT 'p' AS family, 'zstd' AS codec, false AS key_bloom_filter, true AS dictionary,
       count(*) * 2 AS cells, sum(10) * 2 AS key_bytes FROM customer
UNION ALL
SELECT 'n', 'snappy', true, false, count(*) * 2, sum(10) * 2 FROM customer
"""


def _layout_report(spark, store, res):
    """Per family, codec, bloom filter and dictionary by the footers of the files its cells are read from."""
    store.publish(res)
    cells = spark.read.parquet(res.stage).withColumn("file", F.col("_metadata.file_name"))
    facts = store.layout_facts(res.version).drop("family")
    return (cells.join(facts, "file").groupBy("family", "codec", "key_bloom_filter", "dictionary")
            .agg(F.count(F.lit(1)).alias("cells"), F.sum(F.octet_length("row_key")).alias("key_bytes")))


@query("b10_layout", _LAYOUT_SQL)
def b10_layout(spark, sf_dir):
    """Per-family physical layout (codec, row-group size, bloom filter on
    the key, dictionary) on write; what the footers of the files say, and the
    data, which is the same."""
    store = CellStore(spark, scratch_path(spark, "b10"))
    return _layout_report(spark, store, store.stage(tc.cu_cells(spark, sf_dir), points=[], layout=CU_LAYOUT))


@query("b10_layout_rows", _LAYOUT_SQL)
def b10_layout_rows(spark, sf_dir):
    """B10 from typed rows: each family's shuffle takes that family's columns only."""
    store = CellStore(spark, scratch_path(spark, "b10"))
    return _layout_report(spark, store, store.stage_rows(tc.cu_rows(spark, sf_dir), tc.CU_MAPPING, ts=tc.CU_WRITE_TS,
                                                         points=[], layout=CU_LAYOUT))


@query("b12_region_skew", f"""
WITH {_LI_REGION_CTE},
per AS (SELECT region, count(DISTINCT row_key) AS rows, count(*) * 2 AS cells,
               sum(2 * length(row_key) + 10 + strlen(l_returnflag) + strlen(l_linestatus)) AS bytes,
               min(row_key) AS first_key, max(row_key) AS last_key FROM reg GROUP BY region)
SELECT region, rows, cells, bytes, first_key, last_key,
       round(rows / median(rows) OVER (), 4) AS rows_to_median,
       round(max(rows) OVER () / median(rows) OVER (), 4) AS max_to_median
FROM per
""")
def b12_region_skew(spark, sf_dir):
    """Rows, cells and bytes per region against the median region, over the
    text columns (the bytes of doubles depend on how they are printed)."""
    li = tc.li_cells(spark, sf_dir).where(F.col("qualifier").isin("flag", "status"))
    cells = assign_region(li, "row_key", li_points(spark, sf_dir))
    return region_skew(cells).select("region", "rows", "cells", "bytes", "first_key", "last_key",
                                     "rows_to_median", "max_to_median")


@query("b12_region_skew_all", f"""
WITH {_LI_REGION_CTE},
per AS (SELECT region, count(DISTINCT row_key) AS rows, count(*) * 6 AS cells,
               min(row_key) AS first_key, max(row_key) AS last_key FROM reg GROUP BY region)
SELECT region, rows, cells, first_key, last_key,
       round(rows / median(rows) OVER (), 4) AS rows_to_median,
       round(max(rows) OVER () / median(rows) OVER (), 4) AS max_to_median
FROM per
""")
def b12_region_skew_all(spark, sf_dir):
    """Rows and cells per region over all columns; b12_region_skew checks the
    bytes, over the text columns."""
    cells = assign_region(tc.li_cells(spark, sf_dir), "row_key", li_points(spark, sf_dir))
    return region_skew(cells).select("region", "rows", "cells", "first_key", "last_key",
                                     "rows_to_median", "max_to_median")


@query("b13_refine_splits", """
WITH keyed AS (SELECT DISTINCT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$'
                      || CAST(l_linenumber AS VARCHAR) AS row_key FROM lineitem)
SELECT count(*) AS rows, true AS old_points_kept, true AS more_regions, true AS balanced FROM keyed
""")
def b13_refine_splits(spark, sf_dir):
    """Regions above 1.5x the mean row count get extra split points.  The
    result states what must hold: all rows assigned, old points kept, regions
    added, and no region above 1.2 times the target. The distinct keys are written
    once: every later step reads them alone."""
    path = scratch_path(spark, "b13-keys")
    scan.scan_keys(tc.li_cells(spark, sf_dir)).write.parquet(path)
    keys = spark.read.schema("row_key string").parquet(path)
    pts = li_points(spark, sf_dir)[:3]          # 4 regions, the last one holds 5/8 of the keys
    tagged = assign_region(keys, "row_key", pts)
    target = max(1, int(keys.count() / len(pts) / 1.5))
    new = refine_splits(tagged, pts, target)
    per = assign_region(keys, "row_key", new).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("rows"), F.lit(set(pts) <= set(new)).alias("old_points_kept"),
                   (F.count(F.lit(1)) > len(pts) + 1).alias("more_regions"),
                   (F.max("n") <= 1.2 * target).alias("balanced"))


@query("b14_export", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_orderstatus AS status,
       o_totalprice AS total
FROM orders
WHERE lpad(CAST(o_orderkey AS VARCHAR), 12, '0') BETWEEN '000000002000' AND '000000009000'
""")
def b14_export(spark, sf_dir):
    """Some columns of a key range exported to a plain Parquet table."""
    return export_table(tc.or_cells(spark, sf_dir), tc.OR_MAPPING,
                        scratch_path(spark, "b14"), columns=["status", "total"],
                        key_lo="000000002000", key_hi="000000009000", fmt="parquet")


_OR_M = Mapping.parse(":key,o:status,o:total", ["order_key", "status", "total"],
                      ["string", "string", "double"])


@query("b15_snapshots", """
SELECT 'first' AS name, 1 AS n_versions, count(*) FILTER (WHERE o_orderstatus = 'F') AS rows
FROM orders
UNION ALL
SELECT 'second', 2, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) FROM orders
UNION ALL
SELECT 'live', 3, count(*) FROM orders
""")
def b15_snapshots(spark, sf_dir):
    """Snapshots created after each of three writes, one replaced, one
    dropped; each remaining snapshot still reads what it froze."""
    store = CellStore(spark, scratch_path(spark, "b15"))
    rows = tc.or_rows(spark, sf_dir).select("order_key", "status", "total")
    store.write_table(rows.where(F.col("status") == "F"), _OR_M, ts=1, points=[])
    store.snapshot_create("first")
    store.snapshot_create("scratch")
    store.write_table(rows.where(F.col("status") == "O"), _OR_M, ts=2, points=[])
    store.snapshot_create("second")
    store.write_table(rows.where(~F.col("status").isin("F", "O")), _OR_M, ts=3, points=[])
    store.snapshot_create("live")
    store.snapshot_drop("scratch")
    parts = []
    for r in store.snapshot_list().collect():
        n = scan.row_count(store.read(snapshot=r["name"])).select(
            F.lit(r["name"]).alias("name"), F.lit(len(r["versions"])).alias("n_versions"),
            F.col("rows"))
        parts.append(n)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("a7_snapshot_read", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cust_key, c_acctbal AS acctbal_before,
       CASE WHEN c_nationkey < 10 THEN c_acctbal * 2 ELSE c_acctbal END AS acctbal_now
FROM customer
""")
def a7_snapshot_read(spark, sf_dir):
    """A snapshot taken before an upsert keeps reading the old values."""
    store = CellStore(spark, scratch_path(spark, "a7"))
    rows = tc.cu_rows(spark, sf_dir)
    store.write_table(rows, tc.CU_MAPPING, ts=1000, points=[])
    store.snapshot_create("before")
    bal = Mapping.parse(":key,n:acctbal", ["cust_key", "acctbal"], ["string", "double"])
    store.write_table(rows.where(F.col("nation") < 10)
                      .select("cust_key", (F.col("acctbal") * 2).alias("acctbal")), bal, ts=2000,
                      points=[])
    before = scan.scan_table(store.read(snapshot="before"), bal) \
        .withColumnRenamed("acctbal", "acctbal_before")
    now = scan.scan_table(store.read(), bal).withColumnRenamed("acctbal", "acctbal_now")
    return before.join(now, "cust_key")


@query("a8_text_source", """
SELECT 'flag' AS qualifier, count(*) FILTER (WHERE l_returnflag <> 'N') AS cells,
       0::BIGINT AS empty_values FROM lineitem
UNION ALL
SELECT 'status', count(*), 0 FROM lineitem
UNION ALL
SELECT 'ship', count(*), count(*) FILTER (WHERE l_linestatus = 'F') FROM lineitem
""")
def a8_text_source(spark, sf_dir):
    """Lineitem as \\x01-delimited text lines (NULL flags for N, ship date
    missing at the end of F lines) loaded into cells."""
    li = tc.load(spark, sf_dir, "lineitem")
    rows = li.select(
        F.concat_ws("$$", tc.padded("l_orderkey", 10), F.col("l_linenumber").cast("string"))
        .alias("k"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").cast("date").cast("string").alias("ship"))
    path = scratch_path(spark, "a8")
    (cells_to_lines(rows.where(F.col("status") != "F"), ["k", "flag", "status", "ship"])
     .unionByName(cells_to_lines(rows.where(F.col("status") == "F"), ["k", "flag", "status"]))
     .write.text(path))
    cells = text_to_cells(spark, path, "l", ["flag", "status", "ship"])
    return cells.groupBy("qualifier").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.length("value") == 0).alias("empty_values"))


@query("a1_bucketed_read", f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS orderkey, l_linenumber AS linenumber,
       CAST(l_quantity AS INTEGER) AS qty, l_linestatus AS status, CAST(l_shipdate AS DATE) AS ship
FROM {LI_NEWEST}
""")
def a1_bucketed_read(spark, sf_dir):
    """A1 over the bucketed store layout: lineitem cells written
    bucketBy(n, row_key), 8 buckets or more by the number of cells; the full pivot
    reads each bucket in one task and needs no shuffle."""
    n = buckets_for(tc.load(spark, sf_dir, "lineitem").count() * len(tc.LI_MAPPING.cell_fields))
    store = CellStore(spark, scratch_path(spark, "a1-bucketed"), buckets=n)
    store.write(tc.li_cells(spark, sf_dir))
    t = scan.scan_table(store.read(bucketed=True), tc.LI_MAPPING, ["qty", "status", "ship"])
    return t.select(F.col("li_key.orderkey").alias("orderkey"),
                    F.col("li_key.linenumber").alias("linenumber"), "qty", "status", "ship")
