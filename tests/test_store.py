"""Store invariants: regions sorted and disjoint, published = staged,
snapshots frozen, unpublished stages invisible; split points vs brute force."""
import bisect
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cellwise.mapping import Mapping
from cellwise.operators import scan
from cellwise.operators.regions import (assign_region, refine_splits, region_expr, region_skew,
                                        split_points)
from cellwise.plans import testcells as tc
from cellwise.session import scratch_path
from cellwise.sources.store import CellStore, StoreError, export_table
from conftest import SF_SMALL


def _files(stage):
    return sorted(glob.glob(os.path.join(stage.replace("file:", ""), "family=*", "region=*", "*.parquet")))


@pytest.mark.parametrize("mode", ["range", "exact"])
def test_bulk_write_total_order(spark, mode):
    cells = tc.li_cells(spark, SF_SMALL)
    store = CellStore(spark, scratch_path(spark, "t-bulk"))
    pts = split_points(cells, "row_key", 4)
    res = store.stage(cells, points=pts, mode=mode)
    files = _files(res.stage)
    assert files
    spans = {}
    for f in files:
        t = pq.read_table(f, columns=["row_key", "qualifier", "ts"]).to_pylist()
        keys = [(r["row_key"], r["qualifier"], -r["ts"]) for r in t]
        assert keys == sorted(keys), f"{f} is not sorted"
        region = int(f.split("region=")[1].split("/")[0])
        lo = pts[region - 1] if region > 0 else None
        hi = pts[region] if region < len(pts) else None
        assert all((lo is None or k[0] >= lo) and (hi is None or k[0] < hi) for k in keys)
        fam = f.split("family=")[1].split("/")[0]
        spans.setdefault((fam, region), []).append((keys[0][0], keys[-1][0], f))
    for parts in spans.values():
        parts.sort(key=lambda x: x[2])         # files of a region: consecutive key ranges
        for a, b in zip(parts, parts[1:]):
            assert a[1] <= b[0]
    assert store.read().count() == 0           # staged, not published
    store.publish(res)
    assert store.read().count() == cells.count()


def test_region_expr_matches_bisect(spark):
    pts = ["b", "d", "f", "h", "k", "m", "p"]
    keys = ["", "a", "b", "c", "d", "dz", "f", "g", "h", "j", "k", "l", "m", "n", "p", "z"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.region for r in assign_region(df, "k", pts).collect()}
    assert got == {k: bisect.bisect_right(pts, k) for k in keys}
    with pytest.raises(ValueError):
        region_expr(F.col("k"), ["b", "a"])


def test_split_points_near_equal_against_exact(spark):
    keys = tc.li_cells(spark, SF_SMALL).select("row_key").distinct()
    n = 4
    pts = split_points(keys, "row_key", n)
    assert pts == sorted(set(pts)) and 1 <= len(pts) <= n - 1
    exact = sorted(r.row_key for r in keys.collect())
    counts = [0] * (len(pts) + 1)
    for k in exact:
        counts[bisect.bisect_right(pts, k)] += 1
    assert sum(counts) == len(exact) and min(counts) > 0
    assert max(counts) < 2.5 * len(exact) / n      # sampled cut, within a loose bound


def test_refine_splits_cuts_heavy_region(spark):
    cells = tc.li_cells(spark, SF_SMALL)
    keys = sorted(r.row_key for r in cells.select("row_key").distinct().collect())
    pts = [keys[len(keys) // 10]]                 # region 1 holds 90% of the keys
    tagged = assign_region(cells, "row_key", pts)
    new = refine_splits(tagged, pts, max_rows=len(keys) // 4)
    assert set(pts) <= set(new) and new == sorted(new)
    counts = [0] * (len(new) + 1)
    for k in keys:
        counts[bisect.bisect_right(new, k)] += 1
    assert max(counts) < 0.6 * len(keys)


def test_region_skew_report(spark):
    cells = assign_region(tc.li_cells(spark, SF_SMALL), "row_key", ["0000000500", "0000001000"])
    rep = {r.region: r for r in region_skew(cells).collect()}
    assert set(rep) == {0, 1, 2}
    assert sum(r.cells for r in rep.values()) == cells.count()


def test_snapshots_and_upsert(spark):
    store = CellStore(spark, scratch_path(spark, "t-snap"))
    rows = tc.cu_rows(spark, SF_SMALL)
    store.write_table(rows, tc.CU_MAPPING, ts=1, points=[])
    store.snapshot_create("s")
    store.write_table(rows.withColumn("name", F.lit("renamed")), tc.CU_MAPPING, ts=2, points=[])
    old = scan.scan_table(store.read(snapshot="s"), tc.CU_MAPPING)
    new = scan.scan_table(store.read(), tc.CU_MAPPING)
    assert old.where("name = 'renamed'").count() == 0
    assert new.where("name <> 'renamed'").count() == 0
    store.snapshot_create("s")                 # replace keeps the name
    assert scan.scan_table(store.read(snapshot="s"), tc.CU_MAPPING).where(
        "name = 'renamed'").count() == rows.count()
    store.snapshot_drop("s")
    with pytest.raises(StoreError):
        store.read(snapshot="s")
    v = store.compact()
    assert store.committed() == [v]
    assert scan.scan_table(store.read(), tc.CU_MAPPING).where("name = 'renamed'").count() == rows.count()


def test_store_key_range_prunes_regions(spark):
    store = CellStore(spark, scratch_path(spark, "t-prune"))
    cells = tc.or_cells(spark, SF_SMALL)
    store.write(cells, points=["000000000300", "000000000600", "000000000900"])
    df = store.read(key_lo="000000000650", key_hi="000000000700")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "region" in plan.split("PartitionFilters")[1][:300]
    assert "PushedFilters" in plan and "row_key" in plan.split("PushedFilters")[1][:300]
    assert df.select("region").distinct().collect()[0].region == 2


def test_layout_options_and_errors(spark):
    store = CellStore(spark, scratch_path(spark, "t-layout"))
    with pytest.raises(StoreError):
        store.write(tc.cu_cells(spark, SF_SMALL), points=[], layout={"bogus.option": 1})
    store2 = CellStore(spark, scratch_path(spark, "t-layout2"))
    store2.write(tc.cu_cells(spark, SF_SMALL), points=[],
                 layout={"p": {"compression": "zstd"}, "n": {"compression": "snappy"}})
    files = _files(f"{store2.data}/v=1")
    codecs = {f.split("family=")[1][0]: pq.ParquetFile(f).metadata.row_group(0).column(0).compression
              for f in files}
    assert codecs == {"p": "ZSTD", "n": "SNAPPY"}


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
def test_export_formats(spark, fmt):
    out = export_table(tc.or_cells(spark, SF_SMALL), tc.OR_MAPPING, scratch_path(spark, "t-exp"),
                       columns=["status"], key_lo="000000000100", key_hi="000000000199", fmt=fmt)
    assert out.count() == 100 and set(out.columns) == {"order_key", "status"}


@pytest.mark.parametrize("how", ["checkpoint", "none"])
def test_multi_insert_materialize(spark, how):
    from cellwise.sources.store import multi_insert
    rows = tc.or_rows(spark, SF_SMALL).select("order_key", "status")
    out = multi_insert(rows, [(F.col("status") == "F", lambda d: d.count()),
                              (F.col("status") != "F", lambda d: d.count())], materialize=how)
    assert sum(out) == rows.count()


def test_rebalance_mode_writes_everything(spark):
    store = CellStore(spark, scratch_path(spark, "t-rebal"))
    cells = tc.or_cells(spark, SF_SMALL)
    store.write(cells, points=["000000000500", "000000001000"], mode="rebalance")
    assert store.read().count() == cells.count()
    assert scan.scan_table(store.read(), tc.OR_MAPPING).count() == 1500


def test_region_search_for_many_points(spark):
    import random
    random.seed(7)
    pts = sorted({f"{random.randrange(10**6):06d}" for _ in range(1500)})
    keys = [f"{random.randrange(10**6):06d}" for _ in range(3000)] + pts[:5] + ["", "999999", "000000"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.region for r in assign_region(df, "k", pts).collect()}
    assert got == {k: bisect.bisect_right(pts, k) for k in keys}


def test_bucketed_compaction_keeps_layout_and_values(spark):
    store = CellStore(spark, scratch_path(spark, "t-bcompact"), buckets=4)
    rows = tc.cu_rows(spark, SF_SMALL)
    store.write_table(rows, tc.CU_MAPPING, ts=1)
    store.write_table(rows.select("cust_key", F.lit("z").alias("name")),
                      Mapping.parse(":key,p:name", ["cust_key", "name"]), ts=2)
    before = sorted(tuple(r) for r in scan.scan_table(store.read(), tc.CU_MAPPING).collect())
    v = store.compact()
    assert store.committed() == [v]
    after = scan.scan_table(store.read(bucketed=True), tc.CU_MAPPING)
    assert "Bucketed: true" in after._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in after.collect()) == before
    assert store.read().count() == rows.count() * 5        # every version is kept
    store.compact(keep="latest")
    assert store.read().count() == rows.count() * 4        # one version per cell left


def test_family_filter_prunes_directories(spark):
    store = CellStore(spark, scratch_path(spark, "t-fam"))
    store.write(tc.cu_cells(spark, SF_SMALL), points=[])
    df = store.read(families=["n"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "family" in plan.split("PartitionFilters")[1][:200]
    assert {r.family for r in df.select("family").distinct().collect()} == {"n"}



def test_publish_errors_and_unpublished_stage(spark):
    store = CellStore(spark, scratch_path(spark, "t-pub"))
    cells = tc.or_cells(spark, SF_SMALL)
    res = store.stage(cells, points=[])
    v = store.publish(res)
    with pytest.raises(StoreError):
        store.publish(res)                       # a version is published once
    res2 = store.stage(cells.where("qualifier = 'status'"), points=[])
    assert res2.version == v + 1
    assert store.committed() == [v]              # the second stage stays invisible
    assert store.read().count() == cells.count()
    with pytest.raises(StoreError):
        store.stage(cells.drop("seq"), points=[])
    with pytest.raises(StoreError):
        CellStore(spark, "")


def test_key_range_after_points_change_loses_nothing(spark):
    cell = lambda k, ts: (k, "f", "q", ts, 0, bytearray(b"v"))
    ddl = "row_key string, family string, qualifier string, ts bigint, seq bigint, value binary"
    store = CellStore(spark, scratch_path(spark, "t-points"))
    store.write(spark.createDataFrame([cell(k, 1) for k in "abcdefghijklmnop"], ddl), points=["h"])
    store.snapshot_create("one")
    store.write(spark.createDataFrame([cell("k", 2)], ddl), points=["c", "f", "j"])
    got = store.read(key_lo="k", key_hi="o")
    assert sorted(r.row_key for r in got.collect()) == ["k", "k", "l", "m", "n", "o"]
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString()
    assert store.read(snapshot="one", key_lo="k", key_hi="o").count() == 5
    store.snapshot_create("two")
    v = store.compact(versions=store.committed()[:1])
    assert len(store.committed()) == 2 and v in store.committed()
    assert store.read(key_lo="k", key_hi="o").count() == store.read(snapshot="two", key_lo="k", key_hi="o").count() == 6


def test_binary_keys_points_and_type(spark):
    ddl = "row_key binary, family string, qualifier string, ts bigint, seq bigint, value binary"
    key = lambda n: n.to_bytes(8, "big")
    store = CellStore(spark, scratch_path(spark, "t-binary"))
    rows = [(bytearray(key(n)), "f", "q", 1, 0, bytearray(b"v")) for n in range(100)]
    store.write(spark.createDataFrame(rows, ddl), points=[key(30), key(60)])
    store.write(spark.createDataFrame(rows, ddl))                     # the recorded points, read back
    assert store.points() == [key(30), key(60)] and store.key_type() == "binary"
    assert store.read(key_lo=key(20), key_hi=key(39)).count() == 40
    with pytest.raises(StoreError):
        store.write(spark.createDataFrame([("a", "f", "q", 1, 0, bytearray(b"v"))], ddl.replace("row_key binary", "row_key string")))


def test_compact_keeps_history_unless_told(spark):
    ddl = "row_key string, family string, qualifier string, ts bigint, seq bigint, value binary"
    store = CellStore(spark, scratch_path(spark, "t-history"))
    for ts in (1, 2, 3):
        store.write(spark.createDataFrame([("k", "f", "q", ts, 0, bytearray(str(ts).encode()))], ddl), points=[])
    store.compact()
    assert sorted(r.ts for r in store.read().collect()) == [1, 2, 3]
    store.compact(keep="latest")
    assert [r.ts for r in store.read().collect()] == [3]


def test_hot_region_is_always_split(spark):
    cells = spark.range(3000).select(
        F.when(F.col("id") < 2000, "a").otherwise(F.concat(F.lit("z"), "id")).alias("row_key"), F.lit("f").alias("family"),
        F.concat(F.lit("q"), "id").alias("qualifier"), F.lit(1).cast("bigint").alias("ts"),
        F.lit(0).cast("bigint").alias("seq"), F.lit(b"v").alias("value"))
    store = CellStore(spark, scratch_path(spark, "t-hot"))
    points = [f"z{i}" for i in range(1, 9)] * 1 + [f"zz{i}" for i in range(8)]
    store.write(cells, points=points, tasks=4)                        # more regions than tasks
    hot = store.read().where("region = 0").select(F.input_file_name().alias("f")).groupBy("f").count()
    assert hot.count() >= 2 and hot.agg(F.max("count")).first()[0] < 1900


def test_bucketed_table_refuses_a_region_layout(spark):
    store = CellStore(spark, scratch_path(spark, "t-brefuse"), buckets=4)
    for kw in ({"layout": {"compression": "zstd"}}, {"points": ["m"]}, {"mode": "range"}):
        with pytest.raises(StoreError):
            store.write(tc.cu_cells(spark, SF_SMALL), **kw)


def test_rows_are_dealt_before_they_fan_out(spark):
    store = CellStore(spark, scratch_path(spark, "t-rows"))
    rows = tc.or_rows(spark, SF_SMALL).withColumn("region", F.lit("a column of this name"))
    store.write_table(rows, tc.OR_MAPPING, points=["000000000500"])
    a = store.read().drop("v").exceptAll(tc.or_cells(spark, SF_SMALL).select(
        "row_key", "family", "qualifier", "ts", "seq", "value",
        (F.col("row_key") >= "000000000500").cast("int").alias("region")))
    assert a.isEmpty() and store.read().count() == tc.or_cells(spark, SF_SMALL).count()
