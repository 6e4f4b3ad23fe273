"""Order-preserving keys, escapes in delimited text, point lookups and weighted dealing."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.functions import codec, keys
from cellwise.mapping import Field, Mapping, MappingError
from cellwise.operators.predicates import composite_key_filter
from cellwise.operators.regions import region_expr, region_of, task_shares
from cellwise.session import scratch_path
from cellwise.sources.store import CellStore

FIELDS = [("i", "int"), ("d", "double"), ("s", "string"), ("l", "bigint"), ("t", "date"), ("b", "boolean"), ("y", "tinyint"), ("f", "float")]
DDL = "i int, d double, s string, l bigint, t date, b boolean, y tinyint, f float"


def odd_rows():
    rnd = random.Random(4)
    ints = [-(1 << 31), -300, -1, 0, 1, 255, 256, (1 << 31) - 1]
    floats = [float("-inf"), -1e300, -1.5, -5e-324, 0.0, 5e-324, 0.1, 1.5, 1e300, float("inf"), float("nan")]
    texts = ["", "\x00", "\x00\x00", "\x00\x01", "\x00\x02", "\x01", "a", "a\x00", "a\x00b", "ab", "é", "\U0010ffff", "漢" * 3]
    longs = [-(1 << 63), -1, 0, 1, (1 << 63) - 1]
    days = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(9999, 12, 31)]
    pick = rnd.choice
    return [(pick(ints[2:6]), pick(floats), pick(texts), pick(longs), pick(days), pick([True, False]), pick([-128, -1, 0, 127]),
             pick([-1.5, 0.25, float("inf")])) for _ in range(600)] + [(i, 0.0, "", 0, days[2], True, 0, 0.0) for i in ints]


def test_ordered_keys_sort_like_their_fields_and_read_back(spark):
    rows = odd_rows()
    k = keys.ordered(FIELDS)
    df = spark.createDataFrame(rows, DDL).distinct().select(F.struct("*").alias("k"))
    got = df.select("k", k.encode(F.col("k")).alias("key")).orderBy("key").select("k", k.decode(F.col("key")).alias("back")).collect()
    show = lambda r: tuple((x != x, x) if isinstance(x, float) and x == x else (True, 0.0) if isinstance(x, float) else x
                           for x in (v.encode() if isinstance(v, str) else v for v in r))
    assert [show(r["k"]) for r in got] == [show(r["back"]) for r in got]
    assert [show(r["k"]) for r in got] == sorted(show(r["k"]) for r in got)


def test_minus_zero_is_zero_and_odd_keys_decode_to_null(spark):
    k = keys.ordered([("d", "double"), ("s", "string")])
    df = spark.createDataFrame([(-0.0, "x"), (0.0, "x")], "d double, s string")
    assert df.select(k.encode(F.struct("d", "s")).alias("e")).distinct().count() == 1
    bad = spark.createDataFrame([(bytearray(b""),), (bytearray(b"\x01\x02"),), (bytearray(b"\x80" + b"\x00" * 7 + b"abc"),)], "e binary")
    assert [tuple(r[0]) for r in bad.select(k.decode(F.col("e"))).collect()][1:] == [(None, None), (0.0, None)]
    with pytest.raises(Exception, match="NULL key field s"):
        spark.createDataFrame([(1.0, None)], "d double, s string").select(k.encode(F.struct("d", "s"))).collect()
    with pytest.raises(TypeError, match="no ordered form"):
        keys.ordered([("x", T.DecimalType(10, 2))])


@pytest.mark.parametrize("equal, ranges", [
    ([], [("i", ">", -2)]), ([], [("i", "<", 1.5)]), ([], [("i", "<=", -1)]), ([], [("i", ">=", 1 << 40)]), ([], [("i", "<", 1 << 40)]),
    ([("i", -1)], []), ([("i", 0)], [("d", ">", -1.5), ("d", "<=", 1.5)]), ([("i", 1)], [("d", "<", 0.0)]),
    ([("i", 0), ("d", 0.1)], [("s", ">", "a"), ("s", "<", "ab")]), ([("i", 0), ("d", 0.1)], [("s", "<=", "a\x00")])])
def test_bounds_hold_all_matching_keys(spark, equal, ranges):
    k = keys.ordered(FIELDS)
    df = spark.createDataFrame(odd_rows(), DDL).select(F.struct("*").alias("k"), F.lit(1).alias("n"))
    cells = df.select(k.encode(F.col("k")).alias("row_key"), "n")
    ops = {"<": "lt", "<=": "le", ">": "gt", ">=": "ge"}
    cond = F.lit(True)
    for n, v in equal:
        cond = cond & (F.col("k")[n] == F.lit(v))
    for n, op, v in ranges:
        cond = cond & getattr(F.col("k")[n], f"__{ops[op]}__")(F.lit(v))
    assert composite_key_filter(cells, k, equal, ranges=ranges).count() == df.where(cond).count()


def test_numeric_range_is_pushed_to_the_scan(spark):
    k = keys.ordered([("supp", "int"), ("price", "double")])
    m = Mapping((Field("k", k.struct_type, "key"), Field("q", "int", "column", "l", "q")), key_codec=k)
    df = spark.range(200).select(F.struct((F.col("id") % 5 - 2).cast("int").alias("supp"), (F.col("id") * 1.5 - 100).alias("price")).alias("k"),
                                 F.col("id").cast("int").alias("q"))
    store = CellStore(spark, scratch_path(spark, "ordered"))
    store.write_table(df, m, ts=1, regions=4)
    assert store.key_type() == "binary"
    got = composite_key_filter(store.read(), k, [("supp", -1)], ranges=[("price", ">=", -50.0), ("price", "<", 100.0)])
    assert got.count() == df.where("k.supp = -1 and k.price >= -50 and k.price < 100").count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(row_key" in pushed and "LessThanOrEqual(row_key" in pushed


ESCAPED = [None, "", "\\", "\\\\", "\\N", "\\\\N", "a\x02b", "\x02", "\\\x02", "\x03\\", "N", "\\a", "\\e\x02a", "plain", "\x01\x08", "x\\"]


def test_escaped_text_round_trip(spark):
    """Every text in every place; NULL elements of arrays are written as empty text, as before."""
    rows = [([a, b], {(a or "k") + "1": b, "z": a}, (a, [b], {"q": a}), a) for a in ESCAPED for b in ESCAPED]
    ddl = "w array<string>, m map<string,string>, s struct<a:string,b:array<string>,c:map<string,string>>, p string"
    df = spark.createDataFrame(rows, ddl)
    for f in df.schema.fields:
        kw = {"escape": "\\"}
        back = df.select(F.col(f.name).alias("was"), codec.decode_text(codec.encode_text(f.name, f.dataType, **kw), f.dataType, **kw).alias("now"))
        for r in back.collect():
            if f.name == "p":
                assert r["now"] == r["was"]
            elif f.name == "w":
                assert r["now"] == [x or "" for x in r["was"]]
            elif f.name == "m":
                assert r["now"] == r["was"]
            else:
                assert (r["now"]["a"], r["now"]["c"]) == (r["was"]["a"], r["was"]["c"])
                assert r["now"]["b"] == ([r["was"]["b"][0]] if r["was"]["b"][0] else [])


def test_escapes_of_ordinary_characters_fall_away_and_the_escape_is_checked(spark):
    df = spark.createDataFrame([("a\\bc\\\x02d\x02e\\",)], "t string")
    assert df.select(codec.decode_text("t", T.ArrayType(T.StringType()), escape="\\")).first()[0] == ["abc\x02d", "e\\"]
    assert df.select(codec.decode_text("t", T.ArrayType(T.StringType()))).first()[0] == ["a\\bc\\", "d", "e\\"]
    for bad in ("", "ab", "x", "\x02"):
        with pytest.raises(MappingError, match="escape"):
            Mapping.parse(":key,a:b", escape=bad)


def test_lookup_prunes_each_version_by_its_own_points(spark):
    cells = spark.range(1000).select(F.format_string("%04d", "id").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
                                     F.lit(1).cast("long").alias("ts"), F.lit(0).cast("long").alias("seq"), F.lit(b"v").alias("value"))
    store = CellStore(spark, scratch_path(spark, "lookup"))
    store.write(cells, points=["0250", "0500", "0750"])
    store.write(cells, points=["0100"])
    got = store.read(keys=["0007", "0600", "0600", "none"])
    assert sorted((r["row_key"], r["v"]) for r in got.collect()) == [("0007", 1), ("0007", 2), ("0600", 1), ("0600", 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "region" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0] and "In(row_key" in plan
    regions = {(r["v"], r["region"]) for r in store.read(keys=["0007", "0600"]).select("v", "region").distinct().collect()}
    assert regions == {(1, 0), (1, 2), (2, 0), (2, 1)}
    assert store.read(keys=[]).count() == 0
    wanted = spark.createDataFrame([("0003",), ("0003",), (None,), ("zzz",)], "k string")
    assert store.lookup(wanted, "k").count() == 2


@pytest.mark.parametrize("n", [1, 2, 3, 100, 512, 600])
def test_region_search_for_any_number_of_points(spark, n):
    points = [f"{i * 7:05d}" for i in range(1, n + 1)]
    ids = [f"{i:05d}" for i in range(0, 7 * n + 15, max(1, n // 50))] + ["", None]
    got = spark.createDataFrame([(k,) for k in ids], "k string").select("k", region_expr(F.col("k"), points).alias("r")).collect()
    assert all(r["r"] == (None if r["k"] is None else region_of(points, r["k"])) for r in got)


def test_task_shares():
    assert task_shares({0: 10, 2: 980, 3: 10}, 4, 100) == [1, 1, 98, 1]
    assert task_shares({}, 3, 8) == [1, 1, 1]
    assert sum(task_shares({i: 1 for i in range(1000)}, 1000, 200)) == 1000 and math.isclose(task_shares({0: 2, 1: 1}, 2, 300)[0], 200)
