"""Work that a plan must not hold: these fail where a step is done once more than needed."""
import bisect
import random
import struct

from pyspark.sql import functions as F

from cellwise.functions.codec import encode_float_bytes
from cellwise.mapping import Mapping
from cellwise.operators import scan
from cellwise.operators.encode import table_to_cells
from cellwise.operators.regions import region_expr
from cellwise.plans import filters, storage
from cellwise.plans import testcells as tc
from conftest import SF_SMALL
from helpers import cells


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_many_points_need_no_loop(spark):
    for n in (600, 1000, 2048, 2100):
        points = sorted(f"{p:06d}" for p in random.Random(n).sample(range(100_000), n))
        keys = points[:40] + points[-3:] + [f"{i:06d}" for i in range(0, 100_000, 997)] + [f"{i:06d}x" for i in range(0, 100_000, 991)] + ["", "z", None]
        df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", region_expr(F.col("k"), points).alias("r"))
        assert [r.r for r in df.collect()] == [None if k is None else bisect.bisect_right(points, k) for k in keys]
        if n <= 2048:
            assert "aggregate(" not in _plan(df)


def test_ordered_floats_take_their_bits_as_they_are(spark):
    df = spark.createDataFrame([(1, -1500.5, "a", 3, 4)], "supp int, price double, flag string, orderkey bigint, line int")
    assert "conv(" not in _plan(df.select(filters.ORDERED_KEY.encode(F.struct("*")).alias("k")))
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), -float("inf"),
              4503599627370497.5, 0.9999999999999999, -2.0, None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(encode_float_bytes("v", True).alias("b")).collect()
    assert [None if r.b is None else bytes(r.b) for r in got] == [None if v is None else struct.pack(">d", v) for v in values]


def test_reads_of_keys_encode_no_value(spark):
    rows = spark.createDataFrame([("a", 1.5, None), ("b", None, None), ("a", None, "x")], "k string, v double, w string")
    m = Mapping.parse(":key,f:v,f:w", ["k", "v", "w"], ["string", "double", "string"])
    found = table_to_cells(rows, m, ts=1)
    assert sorted((r.row_key, r.qualifier, bytes(r.value)) for r in found.collect()) == [("a", "v", b"1.5"), ("a", "w", b"x")]
    assert "as binary" not in _plan(scan.scan_keys(found)) and "as binary" in _plan(found)


def test_rows_of_few_cells_are_packed_without_pieces(spark):
    """Hot rows are counted by a bounded number of hash values first; both ways give the same map."""
    rows = [("hot", "f", f"q{i % 30}", i, str(i)) for i in range(90)] + [("cold", "f", "q1", 1, "x"), ("cold", "f", "q1", 2, "y")]
    read = lambda n: {r.row_key: r.value for r in scan.scan_family_map(cells(spark, rows), "f", hot_cells=n).collect()}
    assert read(10) == read(1000) == {"hot": {f"q{i}": str(60 + i) for i in range(30)}, "cold": {"q1": "y"}}
    assert "262144" in _plan(scan.scan_family_map(cells(spark, rows), "f"))


def test_refined_splits_read_the_table_once(spark, monkeypatch):
    seen, refine = [], storage.refine_splits
    monkeypatch.setattr(storage, "refine_splits", lambda df, *a: (seen.extend(df.inputFiles()), refine(df, *a))[1])
    assert storage.b13_refine_splits(spark, SF_SMALL).first()["balanced"]
    assert seen and not any("lineitem" in f for f in seen)
