"""Round trips of every type and storage, delimited complex values, key
codecs, null formats and timestamp patterns."""
import datetime as dt
import math

import pytest
from helpers import cells, rows
from pyspark.sql import functions as F

from cellwise.functions import codec, keys
from cellwise.mapping import Field, Mapping, MappingError, generated_names
from cellwise.operators import scan
from cellwise.operators.encode import table_to_cells

NUM_COLS = ["byte", "short", "int", "long", "float", "double", "boolean"]
NUM_TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double", "boolean"]
VALUES = [
    (127, 32767, 2147483647, 9223372036854775807, 3.4028235e38, 1.7976931348623157e308, True),
    (-128, -32768, -2147483648, -9223372036854775808, -0.01, -5.3, False),
    (0, 0, 0, 0, 0.0, 5e-324, True),
    (123, 456, 789, 1000, -0.01, 5.3, False),
]


@pytest.mark.parametrize("storage", ["string", "binary"])
def test_numeric_round_trip(spark, storage):
    tag = "#b" if storage == "binary" else "#s"
    spec = ":key," + ",".join(f"cf:{c}{tag}" for c in NUM_COLS)
    m = Mapping.parse(spec, ["key"] + NUM_COLS, ["string"] + NUM_TYPES)
    df = spark.createDataFrame([(f"k{i}",) + v for i, v in enumerate(VALUES)],
                               "key string, " + ", ".join(f"{c} {t}" for c, t in zip(NUM_COLS, NUM_TYPES)))
    back = rows(scan.scan_table(table_to_cells(df, m, ts=1), m))
    assert back == rows(df)


def test_binary_widths_and_bytes(spark):
    df = spark.createDataFrame([(-2, 1.5)], "x bigint, d double")
    r = df.select(F.hex(codec.encode_int_bytes(F.col("x"), 8)).alias("l"),
                  F.hex(codec.encode_int_bytes(F.col("x"), 2)).alias("s"),
                  F.hex(codec.encode_binary(F.col("d"), "double")).alias("d"),
                  F.hex(codec.encode_binary(F.col("d").cast("float"), "float")).alias("f")).first()
    assert (r.l, r.s, r.d, r.f) == ("FFFFFFFFFFFFFFFE", "FFFE", "3FF8000000000000", "3FC00000")
    wrong = spark.createDataFrame([(bytearray(b"\x00\x01\x02"),)], "b binary")
    assert wrong.select(codec.decode_binary(F.col("b"), "int")).first()[0] is None


def test_float_specials(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (-0.0,)], "d double")
    back = df.select(codec.decode_binary(codec.encode_binary(F.col("d"), "double"), "double")).collect()
    vals = [r[0] for r in back]
    assert vals[0] == math.inf and vals[1] == -math.inf and math.isnan(vals[2])
    assert vals[3] == 0.0 and math.copysign(1, vals[3]) == -1


def test_delimited_values_with_custom_separators(spark):
    seps = (" ", ":", "=")
    df = spark.createDataFrame([(bytearray(b":a::"), bytearray(b"d=\\N:f=g:h"), bytearray(b""))],
                               "a binary, m binary, e binary")
    r = df.select(
        codec.decode_text(F.col("a"), "array<string>", separators=seps).alias("a"),
        codec.decode_text(F.col("m"), "map<string,string>", separators=seps).alias("m"),
        codec.decode_text(F.col("e"), "array<string>", separators=seps).alias("ea"),
        codec.decode_text(F.col("e"), "map<string,string>", separators=seps).alias("em"),
        codec.decode_text(F.col("e"), "string", separators=seps).alias("es")).first()
    assert r.a == ["", "a", "", ""]
    assert r.m == {"d": None, "f": "g", "h": None}
    assert r.ea == [] and r.em == {} and r.es == ""


def test_complex_round_trip_and_nulls(spark):
    m = Mapping((Field("key", "int", "key"),
                 Field("arr", "array<string>", "column", "cf", "arr"),
                 Field("mp", "map<string,int>", "column", "cf", "mp"),
                 Field("st", "struct<s_int:int,s_string:string,s_date:date>", "column", "cf", "st")))
    df = spark.createDataFrame(
        [(1, ["a", None, "b"], {"x": 1, "y": None}, (None, "s", dt.date(2012, 1, 2)))],
        "key int, arr array<string>, mp map<string,int>, st struct<s_int:int,s_string:string,s_date:date>")
    r = scan.scan_table(table_to_cells(df, m, ts=1), m).first()
    assert r.arr == ["a", "", "b"]                # a NULL element reads back as ""
    assert r.mp == {"x": 1, "y": None}            # a NULL map value stays NULL
    assert r.st.s_int is None and r.st.s_date == dt.date(2012, 1, 2)


def test_json_fallback_keeps_nulls(spark):
    m = Mapping.parse(":key,cf:j", ["key", "j"])
    df = spark.createDataFrame([("k", (1, None))], "key string, j struct<a:int,b:string>")
    assert scan.scan_table(table_to_cells(df, m, ts=1), m).first().j == '{"a":1,"b":null}'


def test_timestamp_patterns_in_order(spark):
    m = Mapping.parse(":key,m:t", ["key", "t"], ["string", "timestamp_ntz"],
                      timestamp_formats=("yyyy-MM-dd-HH.mm.ss.SSSSSS",))
    c = cells(spark, [("a", "m", "t", 1, "2012-02-23-01.15.54.123456"),
                      ("b", "m", "t", 1, "2012-02-23 01:15:54"), ("c", "m", "t", 1, "junk")])
    got = dict(rows(scan.scan_table(c, m)))
    assert got["a"] == dt.datetime(2012, 2, 23, 1, 15, 54, 123456)
    assert got["b"] == dt.datetime(2012, 2, 23, 1, 15, 54) and got["c"] is None


@pytest.mark.parametrize("codec_fn", [keys.delimited, keys.fixed_width, keys.collection_delimited])
def test_composite_key_round_trip(spark, codec_fn):
    kc = codec_fn([("col1", "string"), ("col2", "string"), ("col3", "string")])
    m = Mapping((Field("key", "struct<col1:string,col2:string,col3:string>", "key"),
                 Field("v", "string", "column", "cf", "string")), key_codec=kc)
    df = spark.createDataFrame([(("1000", "2000", "3000"), "x")],
                               "key struct<col1:string,col2:string,col3:string>, v string")
    back = scan.scan_table(table_to_cells(df, m, ts=1), m).first()
    assert tuple(back.key) == ("1000", "2000", "3000")
    if codec_fn is keys.delimited:
        assert table_to_cells(df, m, ts=1).first().row_key == "1000$$2000$$3000"


def test_one_byte_key(spark):
    kc = keys.one_byte_fields([("a", "string"), ("b", "int")])
    df = spark.createDataFrame([("x7",)], "k string")
    assert tuple(df.select(kc.decode(F.col("k")).alias("s")).first().s) == ("x", 7)


def test_mapping_errors_and_names():
    with pytest.raises(MappingError):
        Mapping.parse(":key", ["key"])
    with pytest.raises(MappingError):
        Mapping.parse(":key,cf:a:b", ["key", "a"])
    with pytest.raises(MappingError):
        Mapping.parse(":key,cf:a", ["key"])
    with pytest.raises(MappingError):
        Mapping.parse(":key,cf:a#x", ["key", "a"])
    with pytest.raises(MappingError):
        Field("m", "map<array<int>,string>", "family", "cf")
    m = Mapping.parse("cf:a#bin,cf:#s:b", ["key", "a", "m"], ["string", "int", "map<string,int>"])
    assert m.key.name == "key" and m.field("a").storage == "binary"
    assert m.field("m").key_storage == "string" and m.field("m").storage == "binary"
    assert generated_names(":key,cf:Qual-1,cf:,cf:p_.*") == ["key", "cf_qual1", "cf_col2", "cf_prefix3"]


@pytest.mark.parametrize("storage", ["#s:s", "#b:b", "#b:s", "#s:b"])
def test_typed_family_map_round_trip(spark, storage):
    m = Mapping.parse(f":key,cf-int:{storage},cf-dbl:#b,cf-bool:", ["key", "ints", "dbls", "flags"],
                      ["string", "map<int,int>", "map<string,double>", "map<string,boolean>"])
    df = spark.createDataFrame(
        [("k1", {1: -5, -2: 7, 300000: None}, {"x": -0.5, "y": 1e300}, {"t": True, "f": False}),
         ("k2", {}, None, {"n": None, "z": True})],
        "key string, ints map<int,int>, dbls map<string,double>, flags map<string,boolean>")
    back = {r.key: r for r in scan.scan_table(table_to_cells(df, m, ts=1), m).collect()}
    assert back["k1"].ints == {1: -5, -2: 7}          # a NULL map value writes no cell
    assert back["k1"].dbls == {"x": -0.5, "y": 1e300}
    assert back["k1"].flags == {"t": True, "f": False}
    assert back["k2"].ints == {} and back["k2"].dbls == {}   # no cells → empty map


def test_text_source_padding_nulls_and_rejects(spark):
    from cellwise.sources.text import line_rejects, lines_to_cells
    good = [("k1\x01a\x01b",), ("k2\x01\\N\x01c",), ("k3\x01d",)]
    lines = spark.createDataFrame([*good, ("\x01x",), ("k4\x01a\x01b\x01extra",), (None,)], "value string")
    got = sorted((r.row_key, r.qualifier, bytes(r.value)) for r in
                 lines_to_cells(lines, "cf", ["q1", "q2"], strict=False).collect())
    assert got == [("k1", "q1", b"a"), ("k1", "q2", b"b"), ("k2", "q2", b"c"),
                   ("k3", "q1", b"d"), ("k3", "q2", b"")]      # missing trailing field → ''
    assert sorted((r.reason, r.value or "") for r in line_rejects(lines, ["q1", "q2"]).collect()) == [
        ("empty key", ""), ("empty key", "\x01x"), ("too many fields", "k4\x01a\x01b\x01extra")]
    with pytest.raises(Exception, match="empty key|too many fields"):
        lines_to_cells(lines, "cf", ["q1", "q2"]).collect()
    assert lines_to_cells(spark.createDataFrame(good, "value string"), "cf", ["q1", "q2"]).count() == 5


def test_records_missing_null_and_malformed(spark):
    from cellwise.functions.records import decode_records, malformed_records
    c = cells(spark, [
        ("new", "d", "rec", 1, '{"city": "Oslo", "zip": 150, "gone": true}'),
        ("null", "d", "rec", 1, '{"city": "Rome", "zip": null, "tier": null}'),
        ("full", "d", "rec", 1, '{"city": "Bern", "zip": 3000, "tier": "gold"}'),
        ("text", "d", "rec", 1, "not json"), ("list", "d", "rec", 1, "[1]"),
        ("type", "d", "rec", 1, '{"city": "Kyiv", "zip": "many"}')])
    got = {r.row_key: r.record for r in decode_records(
        c, "d", "rec", "city string, zip int, tier string", defaults={"tier": "basic", "zip": 0}).collect()}
    assert tuple(got["new"]) == ("Oslo", 150, "basic")          # a field the writer lacked takes the default
    assert tuple(got["null"]) == ("Rome", None, None)           # an explicit null stays
    assert tuple(got["full"]) == ("Bern", 3000, "gold")
    assert got["text"] is got["list"] is got["type"] is None
    bad = malformed_records(c, "d", "rec", "city string, zip int, tier string")
    assert {r.row_key for r in bad.collect()} == {"text", "list", "type"}
    nested = cells(spark, [("a", "d", "rec", 1, '{"at": {"city": "Oslo"}, "n": 2}')])
    assert decode_records(nested, "d", "rec", "at struct<city:string>, n int").first().record.at.city == "Oslo"


def test_mapping_check_strict_raises(spark):
    from cellwise.operators.quality import mapping_check
    m = Mapping.parse(":key,cf:a,cf:b", ["key", "a", "b"])
    c = cells(spark, [("k", "cf", "a", 1, "x"), ("k", "cf", "zz", 1, "y")])
    rows_ = {(r.problem, r.qualifier) for r in mapping_check(c, m).collect()}
    assert rows_ == {("unmapped", "zz"), ("no_cells", "b")}
    with pytest.raises(Exception, match="mapping check failed"):
        mapping_check(c, m, strict=True).collect()


def test_float32_specials_and_boolean_bytes(spark):
    df = spark.createDataFrame([(float("inf"), True), (float("-inf"), False), (float("nan"), None),
                                (1.401298464324817e-45, True), (-3.4028234663852886e38, False)],
                               "f float, b boolean")
    r = df.select(codec.decode_binary(codec.encode_binary(F.col("f"), "float"), "float").alias("f"),
                  F.hex(codec.encode_binary(F.col("b"), "boolean")).alias("hb"),
                  codec.decode_binary(codec.encode_binary(F.col("b"), "boolean"), "boolean").alias("b")
                  ).collect()
    fs = [x.f for x in r]
    assert fs[0] == math.inf and fs[1] == -math.inf and math.isnan(fs[2])
    assert fs[3] == 1.401298464324817e-45 and fs[4] == -3.4028234663852886e38   # subnormal, extreme
    assert [x.hb for x in r] == ["FF", "00", None, "FF", "00"]
    assert [x.b for x in r] == [True, False, None, True, False]


def test_composite_prefix_uses_the_stored_encoding(spark):
    from cellwise.operators.predicates import composite_key_filter
    kc = keys.delimited([("flag", "boolean"), ("x", "double"), ("s", "string")])
    rows_in = [(True, 1e20, "a"), (False, 0.5, "b"), (True, 0.5, "c")]
    df = spark.createDataFrame(rows_in, "flag boolean, x double, s string")
    c = df.select(kc.encode(F.struct("flag", "x", "s")).alias("row_key"), "s")
    assert [r.s for r in composite_key_filter(c, kc, [("flag", True), ("x", 1e20)]).collect()] == ["a"]
    assert sorted(r.s for r in composite_key_filter(c, kc, [("flag", True)]).collect()) == ["a", "c"]
    for bad in ((None, 1.0, "a"), (True, 1.0, "a$$b"), ):
        one = spark.createDataFrame([bad], df.schema)
        with pytest.raises(Exception, match="key field"):
            one.select(kc.encode(F.struct("flag", "x", "s"))).collect()


def test_composite_bounds_match_brute_force(spark):
    from cellwise.operators.predicates import composite_key_filter
    texts = ["a", "a!", "a#", "a%", "aa", "ab", "b", "b!", "", "z"]
    for kc in (keys.delimited([("p", "string"), ("q", "string")]), keys.fixed_width([("p", "string"), ("q", "string")]),
               keys.collection_delimited([("p", "string"), ("q", "string")])):
        df = spark.createDataFrame([(p, q) for p in texts for q in texts], "p string, q string")
        c = df.select(kc.encode(F.struct("p", "q")).alias("row_key"), "p", "q")
        for op, test in (("<", str.__lt__), ("<=", str.__le__), (">", str.__gt__), (">=", str.__ge__), ("=", str.__eq__)):
            for v in ("a!", "ab", "a"):
                got = composite_key_filter(c, kc, ranges=[("p", op, v)]).count()
                assert got == sum(test(p, v) for p in texts) * len(texts), (kc.name, op, v)
                got = composite_key_filter(c, kc, [("p", "a")], ranges=[("q", op, v)]).count()
                assert got == sum(test(q, v) for q in texts), (kc.name, op, v)
        plan = composite_key_filter(c, kc, ranges=[("p", ">=", "a"), ("p", "<", "b")])._jdf.queryExecution().toString()
        assert ">= a" in plan


def test_salted_key_holds_any_text(spark):
    kc = keys.salted()
    df = spark.createDataFrame([("p|q",), ("",), ("é|",)], "id string")
    back = df.select("id", kc.decode(kc.encode(F.struct("id")))["id"].alias("b")).collect()
    assert all(r.id == r.b for r in back)


def test_float_bytes_exact(spark):
    import struct
    import numpy as np
    rnd = np.random.default_rng(3)
    bits = np.concatenate([rnd.integers(0, 1 << 64, 4000, dtype=np.uint64), np.array(
        [0, 1 << 63, 1, (1 << 52) - 1, 1 << 52, 0x7FEFFFFFFFFFFFFF, 0x7FF0000000000000, 0xFFF0000000000000], np.uint64)])
    dbl = [float(x) for x in bits.view(np.float64) if not math.isnan(x)]
    flt = [float(x) for x in rnd.integers(0, 1 << 32, 4000, dtype=np.uint32).view(np.float32) if not math.isnan(x)]
    flt += [0.0, -0.0, 2.0 ** -149, 2.0 ** -126, math.inf, -math.inf]
    got = spark.createDataFrame([(x,) for x in dbl], "x double").select("x", codec.encode_float_bytes("x", True).alias("b"))
    assert all(bytes(r.b) == struct.pack(">d", r.x) for r in got.collect())
    got = spark.createDataFrame([(x,) for x in flt], "x float").select("x", codec.encode_float_bytes("x", False).alias("b"))
    assert all(bytes(r.b) == struct.pack(">f", r.x) for r in got.collect())


def test_mapping_without_names():
    m = Mapping.parse(":key,cf:Name,cf:,cg:p_.*,:timestamp")
    assert [f.name for f in m.fields] == generated_names(":key,cf:Name,cf:,cg:p_.*,:timestamp")
    assert [f.dtype.simpleString() for f in m.fields] == ["string", "string", "map<string,string>", "map<string,string>", "timestamp"]
