"""Queries for value and key codecs."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec, keys
from ..functions.registry import register_codec
from ..mapping import Field, Mapping
from ..operators import quality, scan
from ..operators.encode import table_to_cells
from . import testcells as tc
from .reads import map_text
from .registry import query

_CKEY = "lpad(CAST(c_custkey AS VARCHAR), 10, '0')"
_OKEY = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"
_PKEY = "lpad(CAST(p_partkey AS VARCHAR), 10, '0')"


@query("b1_cu_roundtrip", f"""
SELECT {_CKEY} AS cust_key, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation,
       c_acctbal AS acctbal
FROM customer
""")
def b1_cu_roundtrip(spark, sf_dir):
    """B1 + I1: customer rows → text cells → rows again, unchanged."""
    return scan.scan_table(tc.cu_cells(spark, sf_dir), tc.CU_MAPPING)


# ------------------------------------------------------------------ binary
OR_NUMS = Mapping.parse(
    ":key,b:big#b,b:int#b,b:small#b,b:tiny#b,b:flag#b",
    ["order_key", "big", "int_v", "small", "tiny", "flag"],
    ["string", "bigint", "int", "smallint", "tinyint", "boolean"])
OR_NUMS_RAW = Mapping.parse(
    ":key,b:big,b:int,b:small,b:tiny,b:flag",
    ["order_key", "big", "int_v", "small", "tiny", "flag"],
    ["string", "binary", "binary", "binary", "binary", "binary"])


def _or_nums(spark, sf_dir):
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(
        tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("order_key"),
        (F.col("o_orderkey") * 1000003 - 7000000).alias("big"),
        (F.col("o_custkey") - 750).cast("int").alias("int_v"),
        (F.col("o_custkey") % 60000 - 30000).cast("smallint").alias("small"),
        (F.col("o_custkey") % 250 - 125).cast("tinyint").alias("tiny"),
        (F.col("o_orderstatus") == "F").alias("flag"))
    return table_to_cells(rows, OR_NUMS, ts=tc.CU_WRITE_TS)


_NUMS_SQL = """
  o_orderkey * 1000003 - 7000000 AS big, CAST(o_custkey - 750 AS INTEGER) AS int_v,
  CAST(o_custkey % 60000 - 30000 AS SMALLINT) AS small,
  CAST(o_custkey % 250 - 125 AS TINYINT) AS tiny, o_orderstatus = 'F' AS flag"""


@query("i2_binary_int_roundtrip", f"""
SELECT {_OKEY} AS order_key, {_NUMS_SQL},
  printf('%016X', o_orderkey * 1000003 - 7000000) AS big_hex,
  printf('%08X', (o_custkey - 750) & 4294967295) AS int_hex,
  printf('%04X', (o_custkey % 60000 - 30000) & 65535) AS small_hex,
  printf('%02X', (o_custkey % 250 - 125) & 255) AS tiny_hex,
  CASE WHEN o_orderstatus = 'F' THEN 'FF' ELSE '00' END AS flag_hex
FROM orders
""")
def i2_binary_int_roundtrip(spark, sf_dir):
    """Big-endian fixed-width integers and booleans, with negatives; the
    stored bytes are shown as hex through a second, raw-binary mapping."""
    cells = _or_nums(spark, sf_dir)
    typed = scan.scan_table(cells, OR_NUMS)
    raw = scan.scan_table(cells, OR_NUMS_RAW).select(
        "order_key", *[F.hex(c).alias(f"{n}_hex") for c, n in
                       (("big", "big"), ("int_v", "int"), ("small", "small"), ("tiny", "tiny"),
                        ("flag", "flag"))])
    return typed.join(raw, "order_key")


OR_FLOATS = Mapping.parse(":key,f:dbl#b,f:flt#b,f:neg#b", ["order_key", "dbl", "flt", "neg"],
                          ["string", "double", "float", "double"])


@query("i3_binary_float_roundtrip", f"""
SELECT {_OKEY} AS order_key, o_totalprice AS dbl, CAST(o_totalprice AS FLOAT) AS flt,
       -o_totalprice / 7 AS neg
FROM orders
""")
def i3_binary_float_roundtrip(spark, sf_dir):
    """IEEE-754 float and double cells, bit-exact both ways."""
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("order_key"),
                    F.col("o_totalprice").alias("dbl"),
                    F.col("o_totalprice").cast("float").alias("flt"),
                    (-F.col("o_totalprice") / 7).alias("neg"))
    return scan.scan_table(table_to_cells(rows, OR_FLOATS, ts=tc.CU_WRITE_TS), OR_FLOATS)


# ------------------------------------------------------------ map codecs
@query("i4_map_codec", f"""
SELECT {_CKEY.replace('c_custkey', 'o_custkey')} AS cust_key, count(*) AS n_orders,
       string_agg(CAST(o_orderkey AS VARCHAR) || '=' || printf('%.2f', o_totalprice), ','
                  ORDER BY o_orderkey) AS entries
FROM orders GROUP BY o_custkey
""")
def i4_map_codec(spark, sf_dir):
    """I4: a family whose qualifiers are text order keys (decoded to bigint)
    and whose values are binary doubles: map<bigint,double>."""
    o = tc.load(spark, sf_dir, "orders")
    cells = o.select(
        tc.padded("o_custkey", tc.CUST_KEY_WIDTH).alias("row_key"), F.lit("k").alias("family"),
        F.col("o_orderkey").cast("string").alias("qualifier"),
        F.lit(tc.CU_WRITE_TS).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"),
        codec.encode_binary(F.col("o_totalprice"), "double").alias("value"))
    m = scan.scan_family_map(cells, "k", "bigint", "double", value_storage="binary",
                             name="orders")
    return m.select(F.col("row_key").alias("cust_key"), F.size("orders").alias("n_orders"),
                    map_text(F.col("orders"), lambda v: F.format_string("%.2f", v))
                    .alias("entries"))


# ----------------------------------------------------- delimited complex
PART_COMPLEX = Mapping(
    (Field("part_key", "string", "key"),
     Field("words", "array<string>", "column", "x", "words"),
     Field("attrs", "map<string,string>", "column", "x", "attrs"),
     Field("info", "struct<size:int,price:double,brand:string>", "column", "x", "info")))


@query("i5_delimited", f"""
SELECT {_PKEY} AS part_key, array_to_string(string_split(p_name, ' '), '|') AS words,
       len(string_split(p_name, ' ')) AS n_words,
       'brand=' || p_brand || ',type=' || p_type AS attrs,
       p_size AS size, p_retailprice AS price, p_brand AS brand
FROM part
""")
def i5_delimited(spark, sf_dir):
    """Array, map and struct values in one cell each, with the per-level
    separators; decoded back to typed values."""
    p = tc.load(spark, sf_dir, "part")
    rows = p.select(
        tc.padded("p_partkey", 10).alias("part_key"),
        F.split("p_name", " ").alias("words"),
        F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")).alias("attrs"),
        F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
                 F.col("p_brand").alias("brand")).alias("info"))
    t = scan.scan_table(table_to_cells(rows, PART_COMPLEX, ts=tc.CU_WRITE_TS), PART_COMPLEX)
    return t.select("part_key", F.array_join("words", "|").alias("words"),
                    F.size("words").alias("n_words"), map_text(F.col("attrs")).alias("attrs"),
                    "info.size", "info.price", "info.brand")


# ------------------------------------------------- escapes in delimited text
PART_ESCAPED = Mapping(
    (Field("part_key", "string", "key"),
     Field("words", "array<string>", "column", "x", "words"),
     Field("attrs", "map<string,string>", "column", "x", "attrs"),
     Field("nested", "array<array<string>>", "column", "x", "nested"),
     Field("info", "struct<a:string,b:array<string>,n:int>", "column", "x", "info"),
     Field("plain", "string", "column", "x", "plain")),
    escape="\\")


@query("i5_escaped", f"""
SELECT {_PKEY} AS part_key, p_name || chr(2) || p_brand || '|' || chr(92) || '|' || chr(92) || chr(92) || chr(2) || p_type || '|' || '' || '|' || chr(92) || 'N' AS words,
       5 AS n_words,
       'k' || chr(3) || p_brand || '=' || p_type || chr(2) || chr(92) || ',z=' || chr(4) AS attrs,
       'a' || chr(3) || p_size || '/' || chr(92) || 'b' || '|' || chr(2) || chr(92) AS nested,
       p_name || chr(2) AS info_a, chr(3) || '|' || chr(92) || chr(3) || p_brand AS info_b, p_size AS info_n,
       chr(1) || chr(92) || 'x' || chr(2) || p_name AS plain
FROM part
""")
def i5_escaped(spark, sf_dir):
    """Text that holds separators, escapes and the null sequence, in arrays,
    maps, nested arrays and structs, reads back as it was written."""
    p = tc.load(spark, sf_dir, "part")
    esc, s2, s3 = F.lit("\\"), F.lit("\x02"), F.lit("\x03")
    rows = p.select(
        tc.padded("p_partkey", 10).alias("part_key"),
        F.array(F.concat("p_name", s2, "p_brand"), esc, F.concat(esc, esc, s2, "p_type"), F.lit(""), F.lit("\\N")).alias("words"),
        F.create_map(F.concat(F.lit("k"), s3, "p_brand"), F.concat("p_type", s2, esc), F.lit("z"), F.lit("\x04")).alias("attrs"),
        F.array(F.array(F.concat(F.lit("a"), s3, F.col("p_size").cast("string")), F.concat(esc, F.lit("b"))),
                F.array(F.concat(s2, esc))).alias("nested"),
        F.struct(F.concat("p_name", s2).alias("a"), F.array(s3, F.concat(esc, s3, "p_brand")).alias("b"),
                 F.col("p_size").cast("int").alias("n")).alias("info"),
        F.concat(F.lit("\x01"), esc, F.lit("x"), s2, "p_name").alias("plain"))
    t = scan.scan_table(table_to_cells(rows, PART_ESCAPED, ts=tc.CU_WRITE_TS), PART_ESCAPED)
    return t.select("part_key", F.array_join("words", "|").alias("words"), F.size("words").alias("n_words"),
                    map_text(F.col("attrs")).alias("attrs"),
                    F.array_join(F.transform("nested", lambda a: F.array_join(a, "/")), "|").alias("nested"),
                    F.col("info.a").alias("info_a"), F.array_join("info.b", "|").alias("info_b"), F.col("info.n").alias("info_n"), "plain")


PART_JSON = Mapping.parse(":key,x:info", ["part_key", "info"], ["string", "string"])


@query("i6_json_fallback", f"""
SELECT {_PKEY} AS part_key,
       CAST(to_json({{'size': p_size, 'brand': p_brand, 'container': NULL::VARCHAR}}) AS VARCHAR)
         AS info
FROM part
""")
def i6_json_fallback(spark, sf_dir):
    """A struct written into a string column is stored as JSON text,
    NULL fields kept."""
    p = tc.load(spark, sf_dir, "part")
    rows = p.select(tc.padded("p_partkey", 10).alias("part_key"),
                    F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"),
                             F.lit(None).cast("string").alias("container")).alias("info"))
    return scan.scan_table(table_to_cells(rows, PART_JSON, ts=tc.CU_WRITE_TS), PART_JSON)


# -------------------------------------------------------------- null format
CU_SEG = Mapping.parse(":key,p:segment", ["cust_key", "segment"], ["string", "string"])


def _cu_planted(spark, sf_dir):
    """Customer segment cells where HOUSEHOLD is stored as the null sequence
    and BUILDING as the empty string."""
    c = tc.load(spark, sf_dir, "customer")
    seg = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("\\N"))
           .when(F.col("c_mktsegment") == "BUILDING", F.lit(""))
           .otherwise(F.col("c_mktsegment")))
    return c.select(tc.padded("c_custkey", 10).alias("row_key"), F.lit("p").alias("family"),
                    F.lit("segment").alias("qualifier"),
                    F.lit(tc.CU_WRITE_TS).cast("bigint").alias("ts"),
                    F.lit(0).cast("bigint").alias("seq"), seg.cast("binary").alias("value"))


@query("i7_null_format", f"""
SELECT {_CKEY} AS cust_key,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN ''
       ELSE c_mktsegment END AS segment,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '\\N' WHEN c_mktsegment = 'BUILDING' THEN NULL
       ELSE c_mktsegment END AS segment_empty_null
FROM customer
""")
def i7_null_format(spark, sf_dir):
    """The default null sequence reads NULL; a per-table override (here
    the empty string) changes which text is NULL."""
    from dataclasses import replace
    cells = _cu_planted(spark, sf_dir)
    a = scan.scan_table(cells, CU_SEG)
    alt = replace(CU_SEG, fields=(CU_SEG.fields[0],
                                  Field("segment_empty_null", "string", "column", "p", "segment")),
                  null_format="")
    b = scan.scan_table(cells, alt)
    return a.join(b, "cust_key")


# ------------------------------------------------------------ timestamp text
OR_TEXT_TS = Mapping.parse(":key,o:when,o:plain", ["order_key", "when_ts", "plain_ts"],
                           ["string", "timestamp_ntz", "timestamp_ntz"],
                           timestamp_formats=("yyyy-MM-dd-HH.mm.ss",))


@query("i8_timestamp_formats", f"""
SELECT {_OKEY} AS order_key, o_orderdate AS when_ts, o_orderdate AS plain_ts FROM orders
""")
def i8_timestamp_formats(spark, sf_dir):
    """I8: timestamp text in a custom pattern, tried before the default."""
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("order_key"),
                    F.date_format("o_orderdate", "yyyy-MM-dd-HH.mm.ss").alias("when_ts"),
                    F.col("o_orderdate").cast("string").alias("plain_ts"))
    text = Mapping.parse(":key,o:when,o:plain", ["order_key", "when_ts", "plain_ts"])
    cells = table_to_cells(rows, text, ts=tc.CU_WRITE_TS)
    return scan.scan_table(cells, OR_TEXT_TS)


# ------------------------------------------------------------ composite keys
LI_FIELDS = [("orderkey", "string"), ("linenumber", "int")]
LI_ONE_BYTE = keys.one_byte_fields([("flag", "string"), ("status", "string"), ("line", "int")])


@query("i9_composite_keys", f"""
SELECT k_delim, hex(k_fixed) AS k_fixed_hex, k_coll_hex, k_one,
       orderkey AS d_orderkey, linenumber AS d_linenumber,
       orderkey AS f_orderkey, linenumber AS f_linenumber,
       orderkey AS c_orderkey, linenumber AS c_linenumber,
       flag AS o_flag, status AS o_status, linenumber AS o_line
FROM (SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS orderkey, l_linenumber AS linenumber,
        l_returnflag AS flag, l_linestatus AS status,
        lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$' || CAST(l_linenumber AS VARCHAR) AS k_delim,
        rpad(lpad(CAST(l_orderkey AS VARCHAR), 10, '0'), 11, chr(0))
          || rpad(CAST(l_linenumber AS VARCHAR), 11, chr(0)) AS k_fixed,
        hex(lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || chr(2) || CAST(l_linenumber AS VARCHAR))
          AS k_coll_hex,
        l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS k_one
      FROM lineitem)
""")
def i9_composite_keys(spark, sf_dir):
    """The four composite-key layouts, encoded and decoded per row."""
    li = tc.load(spark, sf_dir, "lineitem")
    s = F.struct(tc.padded("l_orderkey", 10).alias("orderkey"),
                 F.col("l_linenumber").alias("linenumber"))
    s1 = F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
                  F.col("l_linenumber").alias("line"))
    d, fw, co = keys.delimited(LI_FIELDS), keys.fixed_width(LI_FIELDS), \
        keys.collection_delimited(LI_FIELDS)
    enc = li.select(d.encode(s).alias("k_delim"), fw.encode(s).alias("k_fixed"),
                    co.encode(s).alias("k_coll"), LI_ONE_BYTE.encode(s1).alias("k_one"))
    dd, ff, cc, oo = d.decode(F.col("k_delim")), fw.decode(F.col("k_fixed")), \
        co.decode(F.col("k_coll")), LI_ONE_BYTE.decode(F.col("k_one"))
    return enc.select(
        "k_delim", F.hex("k_fixed").alias("k_fixed_hex"), F.hex("k_coll").alias("k_coll_hex"),
        "k_one",
        dd["orderkey"].alias("d_orderkey"), dd["linenumber"].alias("d_linenumber"),
        ff["orderkey"].alias("f_orderkey"), ff["linenumber"].alias("f_linenumber"),
        cc["orderkey"].alias("c_orderkey"), cc["linenumber"].alias("c_linenumber"),
        oo["flag"].alias("o_flag"), oo["status"].alias("o_status"), oo["line"].alias("o_line"))


# ------------------------------------------------------------ decode audit
CU_AUDIT = Mapping.parse(":key,n:nation,n:acctbal,p:segment,b:bal#b",
                         ["cust_key", "nation", "acctbal", "segment", "bal"],
                         ["string", "int", "double", "string", "double"])


def _cu_audit_cells(spark, sf_dir):
    """Customer cells with planted faults: nation 3 stored as 'x3', acctbal of
    MACHINERY customers empty, the null sequence for nation 7, and a 4-byte
    value in the 8-byte binary column for FURNITURE."""
    c = tc.load(spark, sf_dir, "customer")
    key = tc.padded("c_custkey", 10)
    nation = (F.when(F.col("c_nationkey") == 3, F.lit("x3"))
              .when(F.col("c_nationkey") == 7, F.lit("\\N"))
              .otherwise(F.col("c_nationkey").cast("string"))).cast("binary")
    bal_txt = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")) \
        .otherwise(F.col("c_acctbal").cast("string")).cast("binary")
    bal_bin = F.when(F.col("c_mktsegment") == "FURNITURE",
                     codec.encode_binary(F.col("c_acctbal"), "float")) \
        .otherwise(codec.encode_binary(F.col("c_acctbal"), "double"))
    arr = F.array(
        F.struct(F.lit("n").alias("family"), F.lit("nation").alias("qualifier"), nation.alias("value")),
        F.struct(F.lit("n").alias("family"), F.lit("acctbal").alias("qualifier"), bal_txt.alias("value")),
        F.struct(F.lit("p").alias("family"), F.lit("segment").alias("qualifier"),
                 F.col("c_mktsegment").cast("binary").alias("value")),
        F.struct(F.lit("b").alias("family"), F.lit("bal").alias("qualifier"), bal_bin.alias("value")))
    return c.select(key.alias("row_key"), F.lit(tc.CU_WRITE_TS).cast("bigint").alias("ts"),
                    F.lit(0).cast("bigint").alias("seq"), F.inline(arr)) \
        .select("row_key", "family", "qualifier", "ts", "seq", "value")


@query("i12_decode_audit", """
SELECT 'nation' AS "column", 'n' AS family, 'nation' AS qualifier, count(*) AS cells,
       count(*) FILTER (WHERE c_nationkey = 7) AS null_seq, 0::BIGINT AS empty,
       count(*) FILTER (WHERE c_nationkey = 3) AS undecodable, 0::BIGINT AS wrong_width
FROM customer
UNION ALL
SELECT 'acctbal', 'n', 'acctbal', count(*), 0, count(*) FILTER (WHERE c_mktsegment = 'MACHINERY'),
       0, 0 FROM customer
UNION ALL
SELECT 'segment', 'p', 'segment', count(*), 0, 0, 0, 0 FROM customer
UNION ALL
SELECT 'bal', 'b', 'bal', count(*), 0, 0, count(*) FILTER (WHERE c_mktsegment = 'FURNITURE'),
       count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') FROM customer
""")
def i12_decode_audit(spark, sf_dir):
    """Per column, the faults a read would silently turn into NULL."""
    return quality.decode_audit(_cu_audit_cells(spark, sf_dir), CU_AUDIT).drop("bad_keys")


# ------------------------------------------------------------- plug-ins
OR_SALTED = Mapping(
    (Field("order", "struct<id:string>", "key"), Field("status", "string", "column", "o", "status")),
    key_codec=keys.salted())


@query("k1_salted_key", f"""
SELECT substr(md5({_OKEY}), 1, 2) || '|' || {_OKEY} AS row_key, {_OKEY} AS order_id,
       o_orderstatus AS status
FROM orders
""")
def k1_salted_key(spark, sf_dir):
    """K1: a user key codec (hash-salted keys spread a growing key over all
    regions); encode on write, decode on read."""
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(F.struct(tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("id")).alias("order"),
                    F.col("o_orderstatus").alias("status"))
    cells = table_to_cells(rows, OR_SALTED, ts=tc.CU_WRITE_TS)
    t = scan.scan_table(cells, OR_SALTED, raw_key=True)
    return t.select(F.col("order").alias("row_key"),
                    OR_SALTED.key_codec.decode(F.col("order"))["id"].alias("order_id"), "status")


# a user value codec: money as whole cents in 8 big-endian bytes
register_codec(
    "cents",
    lambda c: codec.encode_int_bytes(F.round(c * 100).cast("bigint"), 8),
    lambda b: (codec.decode_int_bytes(b, 8) / 100).cast("decimal(18,2)"),
)
OR_CENTS = Mapping((Field("order_key", "string", "key"),
                    Field("total", "decimal(18,2)", "column", "o", "total", codec="cents")))


@query("k2_value_codec", f"""
SELECT {_OKEY} AS order_key,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS DECIMAL(18, 2)) AS total
FROM orders
""")
def k2_value_codec(spark, sf_dir):
    """K2: a registered value codec used by a mapping column."""
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("order_key"),
                    F.col("o_totalprice").alias("total"))
    return scan.scan_table(table_to_cells(rows, OR_CENTS, ts=tc.CU_WRITE_TS), OR_CENTS)



CU_AS_NUMBERS = Mapping.parse(
    ":key,p:name,p:name,p:name,p:segment,n:nation,n:acctbal",
    ["cust_key", "name_int", "name_bool", "name_date", "segment_double", "nation", "acctbal"],
    ["string", "int", "boolean", "date", "double", "bigint", "double"])


@query("i1_text_decode", f"""
SELECT {_CKEY} AS cust_key, CAST(NULL AS INTEGER) AS name_int, CAST(NULL AS BOOLEAN) AS name_bool,
       CAST(NULL AS DATE) AS name_date, CAST(NULL AS DOUBLE) AS segment_double,
       CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS acctbal
FROM customer
""")
def i1_text_decode(spark, sf_dir):
    """Text cells decoded to other types: text that is not a number,
    boolean or date reads NULL, never an error; numbers widen."""
    return scan.scan_table(tc.cu_cells(spark, sf_dir), CU_AS_NUMBERS)


B2_TS = Mapping.parse(":key,o:status,:timestamp", ["order_key", "status", "order_ts"],
                      ["string", "string", "timestamp_ntz"])


@query("b2_write_timestamp", f"""
SELECT {_OKEY} AS row_key, 'o' AS family, 'status' AS qualifier,
       epoch_us(o_orderdate) // 1000 AS ts_from_column, 1234567890123 AS ts_fixed
FROM orders
""")
def b2_write_timestamp(spark, sf_dir):
    """B2: the write timestamp of a cell comes from the row's :timestamp
    column, or from a fixed value given for the whole write."""
    rows = tc.or_rows(spark, sf_dir).select("order_key", "status", "order_ts")
    a = table_to_cells(rows, B2_TS).select("row_key", "family", "qualifier",
                                           F.col("ts").alias("ts_from_column"))
    b = table_to_cells(rows, B2_TS, ts=1234567890123).select(
        "row_key", F.col("ts").alias("ts_fixed"))
    return a.join(b, "row_key")


OR_MAPCOL = Mapping.parse(":key,m:#s:b,o:status", ["order_key", "nums", "status"],
                          ["string", "map<string,double>", "string"])


@query("b1_map_column_write", f"""
SELECT {_OKEY} AS order_key, o_orderstatus AS status,
       'cust=' || printf('%.2f', CAST(o_custkey AS DOUBLE)) || ',total='
         || printf('%.2f', o_totalprice) AS nums
FROM orders
""")
def b1_map_column_write(spark, sf_dir):
    """B1 with a map column: each entry becomes one cell of family ``m``
    (text qualifier, binary double value), read back as a family map."""
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("order_key"),
                    F.create_map(F.lit("cust"), F.col("o_custkey").cast("double"),
                                 F.lit("total"), F.col("o_totalprice")).alias("nums"),
                    F.col("o_orderstatus").alias("status"))
    t = scan.scan_table(table_to_cells(rows, OR_MAPCOL, ts=tc.CU_WRITE_TS), OR_MAPCOL)
    return t.select("order_key", "status",
                    map_text(F.col("nums"), lambda v: F.format_string("%.2f", v)).alias("nums"))
