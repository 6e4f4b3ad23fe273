"""A key that holds a third of all cells: results stay whole and exact, the
pivot collapses it map-side, and writes spread its region over several files."""
import glob
import os

from pyspark.sql import functions as F

from cellwise.mapping import Mapping
from cellwise.operators import scan
from cellwise.session import scratch_path
from cellwise.sources.store import CellStore

M = Mapping.parse(":key,f:a,f:b", ["key", "a", "b"], ["string", "bigint", "bigint"])


def skewed_cells(spark, n=30000):
    """Row 'hot' gets a third of the cells (many versions of a and b)."""
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%06d", "id"))
        .alias("row_key"),
        F.lit("f").alias("family"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("qualifier"),
        F.col("id").alias("ts"), F.lit(0).cast("bigint").alias("seq"),
        F.col("id").cast("string").cast("binary").alias("value"))
    return df


def test_hot_key_pivot_exact(spark):
    cells = skewed_cells(spark)
    t = scan.scan_table(cells, M)
    hot = t.where("key = 'hot'").first()
    # newest a: largest even multiple of 3 below n, newest b: largest odd one
    assert hot.a == 29994 and hot.b == 29997
    assert t.count() == 1 + 20000
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan          # map-side collapse before the shuffle


def test_hot_region_split_over_tasks(spark):
    cells = skewed_cells(spark)
    store = CellStore(spark, scratch_path(spark, "t-skew"))
    v = store.write(cells, points=["k010000", "k020000"], mode="split", tasks=12)
    region_of_hot = 2                      # 'hot' sorts after every 'k…' key
    files = glob.glob(os.path.join(store.data.replace("file:", ""), f"v={v}", "family=f",
                                   f"region={region_of_hot}", "*.parquet"))
    assert len(files) >= 3                  # the hot region is written by several tasks
    assert store.read().count() == cells.count()
    t = scan.scan_table(store.read(), M).where("key = 'hot'").first()
    assert (t.a, t.b) == (29994, 29997)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_store_reads_without_shuffle(spark):
    from cellwise.plans import testcells as tc
    from conftest import SF_SMALL
    store = CellStore(spark, scratch_path(spark, "t-bucket"), buckets=8)
    rows_df = tc.cu_rows(spark, SF_SMALL)
    store.write_table(rows_df, tc.CU_MAPPING, ts=1)
    store.snapshot_create("one")
    store.write_table(rows_df.select("cust_key", F.lit("x").alias("name")),
                      Mapping.parse(":key,p:name", ["cust_key", "name"]), ts=2)
    t = scan.scan_table(store.read(bucketed=True), tc.CU_MAPPING)
    p = _plan(t)
    assert "Bucketed: true" in p and "Exchange" not in p
    assert t.count() == rows_df.count() and t.where("name <> 'x'").count() == 0
    old = scan.scan_table(store.read(snapshot="one", bucketed=True), tc.CU_MAPPING)
    assert old.where("name = 'x'").count() == 0
    # reopened by path: the bucket count comes from the manifest
    again = CellStore(spark, store.path)
    assert again.buckets == 8 and again.read().count() == store.read().count()


def test_default_read_of_a_bucketed_store_is_skew_safe(spark):
    cells = skewed_cells(spark)
    store = CellStore(spark, scratch_path(spark, "t-bucket-skew"), buckets=8)
    store.write(cells, tasks=16)
    skew = list(store.bucket_skew().values())[0]
    assert skew > 2                          # the hot key's bucket holds > 1/3 of the bytes
    t = scan.scan_table(store.read(), M)
    p = _plan(t)
    assert "Exchange" in p and "partial_max(" in p     # skew-safe path
    hot = t.where("key = 'hot'").first()
    assert (hot.a, hot.b) == (29994, 29997) and t.count() == 20001


def test_hot_row_map_from_pieces(spark):
    """A third of all cells in one row, one of its cells with half of them: the same
    maps whatever the size of the pieces, newest values by brute force."""
    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%04d", F.col("id") % 40)).alias("row_key"),
        F.lit("f").alias("family"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).otherwise(F.format_string("q%d", F.col("id") % 500)).alias("qualifier"),
        (F.col("id") * 7919 % 1000).alias("ts"), (F.col("id") % 5).cast("bigint").alias("seq"),
        F.when(F.col("id") % 11 == 0, F.lit("")).otherwise(F.col("id").cast("string")).cast("binary").alias("value"))
    df = df.union(df)                       # each cell twice
    m = Mapping.parse(":key,f:,f:x,f:q1.*,:timestamp", ["key", "all", "x", "some", "at"],
                      ["string", "map<string,bigint>", "bigint", "map<string,string>", "timestamp_ntz"])
    want, newest = {}, {}
    for r in df.collect():
        cell = newest.setdefault(r.row_key, {})
        cell[r.qualifier] = max(cell.get(r.qualifier, (-1, 0, b"")), (r.ts, r.seq, bytes(r.value)))
    for k, cell in newest.items():
        text = {q: v[2].decode() for q, v in cell.items() if v[2]}
        want[k] = ({q: int(v) for q, v in text.items()}, int(text["x"]) if "x" in text else None,
                   {q: v for q, v in text.items() if q.startswith("q1")}, max(v[0] for v in cell.values()))
    for pieces_of in (100, 1000, 100_000):
        got = scan.scan_table(df, m, hot_cells=pieces_of).select("*", F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', at)").alias("ms"))
        assert {r.key: (r["all"], r.x, r.some, r.ms) for r in got.collect()} == want
