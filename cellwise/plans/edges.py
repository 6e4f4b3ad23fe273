"""Queries for stores whose layout changes, planted faults and key bounds."""
from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..functions.keys import fixed_width
from ..functions.records import decode_records, malformed_records
from ..mapping import Field, Mapping
from ..operators import predicates as P
from ..operators import quality, scan
from ..operators.encode import table_to_cells
from ..session import scratch_path
from ..sources.store import CellStore
from ..sources.text import line_rejects, lines_to_cells
from . import testcells as tc
from .filters import OR_BINARY, or_binary_cells
from .reads import LI_NEWEST
from .registry import query

_OKEY = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"
_OR = Mapping.parse(":key,o:status,o:total", ["order_key", "status", "total"], ["string", "string", "double"])


def _two_layouts(spark, sf_dir, name):
    """Orders written under one list of split points, then the F orders again,
    with a new total, under another."""
    store = CellStore(spark, scratch_path(spark, name))
    rows = tc.or_rows(spark, sf_dir).select("order_key", "status", "total")
    store.write_table(rows, _OR, ts=1, points=["000000008000"])
    store.snapshot_create("first")
    store.write_table(rows.where("status = 'F'").withColumn("total", F.col("total") * 2), _OR, ts=2,
                      points=["000000001000", "000000003000", "000000006000"])
    return store


@query("c2_range_after_new_points", f"""
SELECT {_OKEY} AS order_key, o_orderstatus AS status,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS total
FROM orders WHERE {_OKEY} BETWEEN '000000002000' AND '000000009000'
""")
def c2_range_after_new_points(spark, sf_dir):
    """A key range over two versions with different split points."""
    store = _two_layouts(spark, sf_dir, "c2-points")
    return scan.scan_table(store.read(key_lo="000000002000", key_hi="000000009000"), _OR)


@query("a7_snapshot_range_after_new_points", f"""
SELECT {_OKEY} AS order_key, o_orderstatus AS status, o_totalprice AS total
FROM orders WHERE {_OKEY} BETWEEN '000000002000' AND '000000009000'
""")
def a7_snapshot_range_after_new_points(spark, sf_dir):
    """The same range through the snapshot taken before the points changed."""
    store = _two_layouts(spark, sf_dir, "a7-points")
    return scan.scan_table(store.read(snapshot="first", key_lo="000000002000", key_hi="000000009000"), _OR)


@query("c3_binary_store_range", """
SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS total
FROM orders WHERE o_orderkey > 1500 AND o_orderkey < 7000
""")
def c3_binary_store_range(spark, sf_dir):
    """A store with binary keys in regions, written twice with different
    points and read by a typed key range whose byte bounds prune regions."""
    store = CellStore(spark, scratch_path(spark, "c3-store"))
    key = lambda n: n.to_bytes(8, "big")
    cells = or_binary_cells(spark, sf_dir)
    store.write(cells.where(F.col("row_key") < key(4000)), points=[key(1000), key(3000)])
    store.write(cells.where(F.col("row_key") >= key(4000)), points=[key(6000)])
    read = store.read(key_lo=key(1500), key_hi=key(7000))
    return scan.scan_table(P.binary_key_range(read, OR_BINARY.key.dtype, 1500, 7000), OR_BINARY)


@query("c5_as_of_after_compact", f"""
SELECT {_OKEY} AS order_key, o_orderstatus AS status, o_totalprice AS total FROM orders
""")
def c5_as_of_after_compact(spark, sf_dir):
    """A read as of a time before the second write, after compaction."""
    store = _two_layouts(spark, sf_dir, "c5-compact")
    store.compact()
    return scan.scan_table(P.as_of(store.read(), 1), _OR)


def _null_newest(spark, sf_dir, n):
    """n text columns per customer; for every third nation the newest version
    of column 3 holds NULL."""
    m = Mapping((Field("k", "string", "key"),) + tuple(Field(f"c{i}", "string", "column", "f", f"c{i}") for i in range(n)))
    rows = tc.cu_rows(spark, sf_dir)
    old = table_to_cells(tc.dealt(rows, n, "cust_key", "name").select(F.col("cust_key").alias("k"), *[F.concat("name", F.lit(f"/{i}")).alias(f"c{i}")
                                                                     for i in range(n)]), m, ts=1)
    new = rows.where("nation % 3 = 0").select(
        F.col("cust_key").alias("row_key"), F.lit("f").alias("family"), F.lit("c3").alias("qualifier"),
        F.lit(2).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"), F.lit(None).cast("binary").alias("value"))
    return scan.scan_table(old.unionByName(new), m).select("k", "c0", "c3", f"c{n - 1}")


def _null_newest_sql(n):
    return f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS k, c_name || '/0' AS c0,
       CASE WHEN c_nationkey % 3 <> 0 THEN c_name || '/3' END AS c3, c_name || '/{n - 1}' AS c{n - 1} FROM customer"""


for _n in (10, 60):
    query(f"a1_null_newest_{_n}_columns", _null_newest_sql(_n))(functools.partial(_null_newest, n=_n))


@query("a8_text_rejects", """
WITH t AS (SELECT CASE WHEN c_nationkey = 3 THEN '' ELSE c_name END AS k, c_nationkey = 4 AS wide FROM customer)
SELECT CASE WHEN k = '' THEN 'empty key' WHEN wide THEN 'too many fields' ELSE 'loaded' END AS outcome,
       count(*) AS lines FROM t GROUP BY 1
""")
def a8_text_rejects(spark, sf_dir):
    """Lines with an empty key or too many fields are returned, not lost."""
    c = tc.load(spark, sf_dir, "customer")
    lines = c.select(F.concat_ws(
        "|", F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_name")), "c_mktsegment",
        F.when(F.col("c_nationkey") == 4, "extra")).alias("value"))
    bad = line_rejects(lines, ["segment"], sep="|").groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("lines"))
    good = lines_to_cells(lines, "p", ["segment"], sep="|", strict=False)
    return bad.union(good.agg(F.count("*").alias("lines")).select(F.lit("loaded"), "lines").where("lines > 0"))


_LI_ROW = f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS orderkey, l_linenumber AS linenumber,
       CAST(l_quantity AS INTEGER) AS qty, l_linestatus AS status
FROM {LI_NEWEST}
WHERE """


def _li_filtered(spark, sf_dir, **kw):
    cells = P.composite_key_filter(tc.li_cells(spark, sf_dir), tc.LI_KEY, **kw)
    t = scan.scan_table(cells, tc.LI_MAPPING.select(["qty", "status"]))
    return t.select(F.col("li_key.orderkey").alias("orderkey"), F.col("li_key.linenumber").alias("linenumber"), "qty", "status")


@query("c6_composite_range", _LI_ROW + """lpad(CAST(l_orderkey AS VARCHAR), 10, '0') >= '0000001000'
  AND lpad(CAST(l_orderkey AS VARCHAR), 10, '0') < '0000003000'""")
def c6_composite_range(spark, sf_dir):
    """A range on the first key field becomes row-key bounds."""
    return _li_filtered(spark, sf_dir, ranges=[("orderkey", ">=", "0000001000"), ("orderkey", "<", "0000003000")])


@query("c6_composite_two_ranges", _LI_ROW + """lpad(CAST(l_orderkey AS VARCHAR), 10, '0') > '0000009000'
  AND l_linenumber >= 3""")
def c6_composite_two_ranges(spark, sf_dir):
    """The first field above a bound (pruned), the second at or above one."""
    return _li_filtered(spark, sf_dir, ranges=[("orderkey", ">", "0000009000"), ("linenumber", ">=", 3)])


_BAL = Mapping.parse(":key,n:acctbal", ["cust_key", "acctbal"], ["string", "double"])
_BAL_B = Mapping.parse(":key,n:acctbal#b", ["cust_key", "acctbal"], ["string", "double"])


def _bal_cells(spark, sf_dir):
    c = tc.cu_rows(spark, sf_dir)
    text = F.when(F.col("nation") == 2, "oops").when(F.col("nation") == 5, "\\N").otherwise(F.col("acctbal").cast("string"))
    return c.select(F.col("cust_key").alias("row_key"), F.lit("n").alias("family"), F.lit("acctbal").alias("qualifier"),
                    F.lit(1).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"), text.cast("binary").alias("value"))


@query("i11_migrate_faults", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cust_key,
       CASE WHEN c_nationkey NOT IN (2, 5) THEN c_acctbal END AS acctbal,
       CASE WHEN c_nationkey = 2 THEN 'value' END AS fault FROM customer
""")
def i11_migrate_faults(spark, sf_dir):
    """Text to binary with planted faults: cells that do not decode are
    returned, the null sequence stays NULL."""
    cells = _bal_cells(spark, sf_dir)
    moved = scan.scan_table(quality.migrate_storage(cells, _BAL, _BAL_B, strict=False), _BAL_B)
    bad = quality.migrate_rejects(cells, _BAL, _BAL_B).select(F.col("row_key").alias("cust_key"),
                                                             F.lit(None).cast("double").alias("acctbal"), "fault")
    return moved.select("cust_key", "acctbal", F.lit(None).cast("string").alias("fault")).unionByName(bad)


_LI_FIXED = Mapping((Field("li_key", "struct<orderkey:string,linenumber:int>", "key"),
                     Field("status", "string", "column", "l", "status")),
                    key_codec=fixed_width([("orderkey", "string"), ("linenumber", "int")]))


@query("i11_key_migration", f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS orderkey, l_linenumber AS linenumber,
       l_linestatus AS status, 22 AS key_bytes FROM {LI_NEWEST}
""")
def i11_key_migration(spark, sf_dir):
    """Row keys moved from one key codec to another, cell by cell."""
    moved = quality.migrate_storage(tc.li_cells(spark, sf_dir).where("qualifier = 'status'"),
                                    tc.LI_MAPPING.select(["status"]), _LI_FIXED)
    width = moved.groupBy("row_key").agg(F.max(F.octet_length("row_key")).alias("key_bytes"))
    t = scan.scan_table(moved, _LI_FIXED, raw_key=True).join(width, F.col("li_key") == F.col("row_key"))
    key = _LI_FIXED.key_codec.decode(F.col("li_key"))
    return t.select(key["orderkey"].alias("orderkey"), key["linenumber"].alias("linenumber"), "status", "key_bytes")


@query("i12_map_audit", """
SELECT 'orders' AS "column", 'k' AS family, '' AS qualifier, count(*) AS cells,
       0::BIGINT AS null_seq, 0::BIGINT AS empty, count(*) FILTER (WHERE o_orderstatus = 'P') AS undecodable,
       0::BIGINT AS wrong_width, count(*) FILTER (WHERE o_orderkey % 11 = 0) AS bad_keys FROM orders
""")
def i12_map_audit(spark, sf_dir):
    """A family map with planted faults in keys and in values."""
    o = tc.load(spark, sf_dir, "orders")
    cells = o.select(
        tc.padded("o_custkey", 10).alias("row_key"), F.lit("k").alias("family"),
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("x"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("qualifier"),
        F.lit(1).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_totalprice").cast("string"))
        .cast("binary").alias("value"))
    m = Mapping((Field("cust", "string", "key"), Field("orders", "map<bigint,double>", "family", "k")))
    return quality.decode_audit(cells, m)


@query("i10_record_faults", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS row_key, c_nationkey % 4 <> 0 AS readable,
       CASE WHEN c_nationkey % 4 <> 0 THEN c_name END AS name,
       CASE c_nationkey % 4 WHEN 1 THEN 'basic' WHEN 3 THEN 'gold' END AS tier,
       (SELECT count(*) FROM customer WHERE c_nationkey % 4 = 0) AS malformed FROM customer
""")
def i10_record_faults(spark, sf_dir):
    """Records with a missing field (default), an explicit null (kept) and
    malformed text (a NULL record, counted)."""
    c = tc.cu_rows(spark, sf_dir)
    kind = F.col("nation") % 4
    name = F.concat(F.lit('{"name": "'), F.col("name"), F.lit('"'))
    text = (F.when(kind == 0, F.concat(F.lit("{broken "), F.col("name"))).when(kind == 1, F.concat(name, F.lit("}")))
            .when(kind == 2, F.concat(name, F.lit(', "tier": null}'))).otherwise(F.concat(name, F.lit(', "tier": "gold"}'))))
    cells = c.select(F.col("cust_key").alias("row_key"), F.lit("r").alias("family"), F.lit("rec").alias("qualifier"),
                     F.lit(1).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"), text.cast("binary").alias("value"))
    ddl = "name string, tier string"
    bad = malformed_records(cells, "r", "rec", ddl).agg(F.count("*").alias("malformed"))
    r = decode_records(cells, "r", "rec", ddl, defaults={"tier": "basic"})
    return r.select("row_key", F.col("record").isNotNull().alias("readable"), "record.name", "record.tier") \
        .join(F.broadcast(bad))            # one row


@query("i7_null_key", """
SELECT count(*) AS rows, count(*) FILTER (WHERE c_nationkey = 3) AS null_keys FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT 1, 1
""")
def i7_null_key(spark, sf_dir):
    """A row key that is the null sequence reads NULL (customers of nation 3
    share it); all others read as they are."""
    rows = tc.cu_rows(spark, sf_dir).select(
        F.when(F.col("nation") == 3, "\\N").otherwise(F.col("cust_key")).alias("k"), "name", "nation")
    m = Mapping.parse(":key,p:name,p:nation", ["k", "name", "nation"], ["string", "string", "int"])
    t = scan.scan_table(table_to_cells(rows, m, ts=1), m)
    return t.groupBy(F.col("k").isNull().alias("is_null")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("k").isNull()).alias("null_keys")).drop("is_null")


_SUMS = Mapping.parse(":key,n:dbl#b,n:flt#b", ["k", "dbl", "flt"], ["string", "double", "float"])


@query("e2_float_sums", """
SELECT sum(CAST(o_totalprice * 4 AS BIGINT) / 4.0)::DOUBLE AS sum_dbl,
       sum(CAST(CAST(o_custkey AS BIGINT) / 4.0 AS FLOAT)::DOUBLE)::DOUBLE AS sum_flt,
       count(*) AS n FROM orders
""")
def e2_float_sums(spark, sf_dir):
    """Sums over doubles and floats decoded from binary cells; quarters, so
    that a sum does not depend on its order."""
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(tc.padded("o_orderkey", 12).alias("k"), (F.round(F.col("o_totalprice") * 4).cast("bigint") / 4.0).alias("dbl"),
                    (F.col("o_custkey") / 4.0).cast("float").alias("flt"))
    t = scan.scan_table(table_to_cells(rows, _SUMS, ts=1), _SUMS)
    return t.agg(F.sum("dbl").alias("sum_dbl"), F.sum(F.col("flt").cast("double")).alias("sum_flt"), F.count("*").alias("n"))


@query("i3_float_specials", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS k,
       CASE o_orderkey % 6 WHEN 0 THEN 'fff0000000000000' WHEN 1 THEN '7ff0000000000000'
            WHEN 2 THEN '0000000000000001' WHEN 3 THEN '8000000000000000'
            WHEN 4 THEN '3fe0000000000000' ELSE '7ff8000000000000' END AS bits FROM orders
""")
def i3_float_specials(spark, sf_dir):
    """The stored bytes of infinities, the least subnormal, -0.0, a power of
    two and NaN."""
    o = tc.load(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 6
    v = (F.when(kind == 0, float("-inf")).when(kind == 1, float("inf")).when(kind == 2, 5e-324).when(kind == 3, F.lit(-0.0))
         .when(kind == 4, 0.5).otherwise(float("nan")))
    m = Mapping.parse(":key,n:dbl#b", ["k", "dbl"], ["string", "double"])
    cells = table_to_cells(o.select(tc.padded("o_orderkey", 12).alias("k"), v.alias("dbl")), m, ts=1)
    return cells.select(F.col("row_key").alias("k"), F.lower(F.hex("value")).alias("bits"))
