"""Queries for key, time-range and residual predicates."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import keys
from ..mapping import Field, Mapping
from ..operators import predicates as P
from ..operators import scan
from ..operators.encode import table_to_cells
from ..session import scratch_path
from ..sources.store import CellStore
from . import testcells as tc
from .reads import LI_NEWEST, _EV_RANKED
from .registry import query

_OR_ROW = """lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_custkey AS cust,
       o_orderstatus AS status, o_totalprice AS total, o_orderpriority AS prio,
       o_orderdate AS order_ts"""
_OKEY = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"


def _or_scan(cells):
    return scan.scan_table(cells, tc.OR_MAPPING)


@query("c1_point_lookup", f"SELECT {_OR_ROW} FROM orders WHERE {_OKEY} = '000000000042'")
def c1_point_lookup(spark, sf_dir):
    """One row by key; the equality reaches the Parquet scan."""
    return _or_scan(P.key_eq(tc.or_cells(spark, sf_dir), "000000000042"))


def _two_version_orders(spark, sf_dir):
    """Orders in a store: the even keys, cut into 4 regions, then the others, cut into 9."""
    store = CellStore(spark, scratch_path(spark, "c1"))
    cells = tc.or_cells(spark, sf_dir)
    even = F.substring("row_key", -1, 1).cast("int") % 2 == 0
    layout = {"parquet.bloom.filter.enabled#row_key": "true"}
    store.write(cells.where(even), regions=4, layout=layout)
    store.write(cells.where(~even), regions=9, layout=layout)
    return store


C1_KEYS = ["000000000007", "000000000042", "000000000043", "000000000999", "000000001200", "no such key"]


@query("c1_store_lookup", f"SELECT {_OR_ROW} FROM orders WHERE {_OKEY} IN ({', '.join(repr(k) for k in C1_KEYS)})")
def c1_store_lookup(spark, sf_dir):
    """C1 on a store: several keys at once; only the regions that can hold one of
    them are listed, in each version by its own split points."""
    return scan.scan_table(_two_version_orders(spark, sf_dir).read(keys=C1_KEYS), tc.OR_MAPPING)


@query("c1_store_semi_join", f"SELECT {_OR_ROW} FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def c1_store_semi_join(spark, sf_dir):
    """C1 with the keys in a table: the orders of one nation's customers."""
    c = tc.load(spark, sf_dir, "customer").where("c_nationkey = 3")
    o = tc.load(spark, sf_dir, "orders")
    wanted = o.join(c, o.o_custkey == c.c_custkey).select(tc.padded("o_orderkey", tc.ORDER_KEY_WIDTH).alias("k"))
    return scan.scan_table(_two_version_orders(spark, sf_dir).lookup(wanted, "k"), tc.OR_MAPPING)


@query("c2_key_range", f"""
SELECT {_OR_ROW} FROM orders
WHERE {_OKEY} >= '000000001000' AND {_OKEY} < '000000002000'
""")
def c2_key_range(spark, sf_dir):
    """Two bounds, lower inclusive, upper exclusive."""
    return _or_scan(P.key_range(tc.or_cells(spark, sf_dir), "000000001000", "000000002000"))


_OPS = (("=", "eq"), ("<", "lt"), ("<=", "le"), (">", "gt"), (">=", "ge"))


@query("c2_key_ops", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS op, count(*) AS rows, min({_OKEY}) AS min_key, max({_OKEY}) AS max_key "
    f"FROM orders WHERE {_OKEY} {op} '000000007500'" for op, name in _OPS))
def c2_key_ops(spark, sf_dir):
    """Each of the five operators alone, against one bound."""
    cells = tc.or_cells(spark, sf_dir)
    parts = [
        scan.scan_keys(P.key_op(cells, op, "000000007500"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("row_key").alias("min_key"),
             F.max("row_key").alias("max_key"))
        .select(F.lit(name).alias("op"), "rows", "min_key", "max_key")
        for op, name in _OPS
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("c2_empty_range", f"""
SELECT {_OR_ROW} FROM orders WHERE {_OKEY} >= '000000005000' AND {_OKEY} < '000000004000'
""")
def c2_empty_range(spark, sf_dir):
    """Contradictory bounds give no rows."""
    return _or_scan(P.key_range(tc.or_cells(spark, sf_dir), "000000005000", "000000004000"))


@query("c2_expr_bound", f"""
SELECT {_OR_ROW} FROM orders WHERE {_OKEY} > lpad(CAST(100 * 120 AS VARCHAR), 12, '0')
""")
def c2_expr_bound(spark, sf_dir):
    """A bound given as an expression (folded to a constant by Catalyst)."""
    bound = F.lpad((F.lit(100) * F.lit(120)).cast("string"), 12, "0")
    return _or_scan(P.key_range(tc.or_cells(spark, sf_dir), lo=bound, lo_inclusive=False))


OR_BINARY = Mapping.parse(":key#b,o:status,o:total", ["order_key", "status", "total"],
                          ["bigint", "string", "double"])


def or_binary_cells(spark, sf_dir):
    o = tc.load(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("total"))
    return table_to_cells(rows, OR_BINARY, ts=tc.CU_WRITE_TS)


@query("c3_binary_key_range", """
SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS total
FROM orders WHERE o_orderkey > 8 AND o_orderkey < 2100
""")
def c3_binary_key_range(spark, sf_dir):
    """Key stored as 8 big-endian bytes; typed range plus byte bounds."""
    cells = P.binary_key_range(or_binary_cells(spark, sf_dir), OR_BINARY.key.dtype, 8, 2100)
    return scan.scan_table(cells, OR_BINARY)


# 2024-01-10 00:00:00 and 2024-01-20 00:00:00 UTC in ms
T_JAN10 = 1704844800000
T_JAN15_NOON = 1705320000000
T_JAN20 = 1705708800000


def _ev_state_sql(where: str) -> str:
    ranked = _EV_RANKED.replace("FROM events", f"FROM events WHERE {where}")
    cols = ",\n  ".join(f"max(CASE WHEN rn = 1 AND event_type = '{t}' THEN value END) AS {t}"
                        for t in tc.EVENT_TYPES)
    return f"""
WITH c AS ({ranked})
SELECT user_key,
  {cols},
  make_timestamp(max(ms) * 1000) AS row_ts
FROM c GROUP BY user_key
"""


@query("c4_time_range", _ev_state_sql(
    f"epoch_us(ts) // 1000 >= {T_JAN10} AND epoch_us(ts) // 1000 < {T_JAN20}"))
def c4_time_range(spark, sf_dir):
    """C4: time range applied to cells before versions are chosen."""
    cells = P.time_range(tc.ev_cells(spark, sf_dir), T_JAN10, T_JAN20)
    return scan.scan_table(cells, tc.EV_MAPPING)


_TOPS = (("=", "eq"), ("<", "lt"), ("<=", "le"), (">", "gt"), (">=", "ge"))
_T_OP = 1704067798778   # the ms of one event at sf0.01; any instant works


@query("c4_time_ops", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS op, count(*) AS cells FROM events WHERE "
    + {"=": f"epoch_us(ts) // 1000 = {_T_OP}", "<": f"epoch_us(ts) // 1000 < {_T_OP}",
       "<=": f"epoch_us(ts) // 1000 <= {_T_OP}", ">": f"epoch_us(ts) // 1000 > {_T_OP}",
       ">=": f"epoch_us(ts) // 1000 >= {_T_OP}"}[op]
    for op, n in _TOPS))
def c4_time_ops(spark, sf_dir):
    """C4: the five time operators as half-open millisecond ranges."""
    cells = tc.ev_cells(spark, sf_dir)
    parts = [P.time_op(cells, op, _T_OP).agg(F.count(F.lit(1)).alias("cells"))
             .select(F.lit(n).alias("op"), "cells") for op, n in _TOPS]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("c5_as_of", _ev_state_sql(f"epoch_us(ts) // 1000 <= {T_JAN15_NOON}"))
def c5_as_of(spark, sf_dir):
    """The table as of 2024-01-15 12:00 UTC."""
    return scan.scan_table(P.as_of(tc.ev_cells(spark, sf_dir), T_JAN15_NOON), tc.EV_MAPPING)


@query("c6_composite_key_filter", f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS orderkey, l_linenumber AS linenumber,
       CAST(l_quantity AS INTEGER) AS qty, l_linestatus AS status
FROM {LI_NEWEST}
WHERE lpad(CAST(l_orderkey AS VARCHAR), 10, '0') >= '0000001000'
  AND lpad(CAST(l_orderkey AS VARCHAR), 10, '0') < '0000003000' AND l_linenumber >= 3
""")
def c6_composite_key_filter(spark, sf_dir):
    """Predicates on decoded composite-key fields."""
    k = F.col("key")
    cells = P.composite_key_filter(
        tc.li_cells(spark, sf_dir), tc.LI_KEY,
        residual=(k["orderkey"] >= "0000001000") & (k["orderkey"] < "0000003000")
        & (k["linenumber"] >= 3))
    t = scan.scan_table(cells, tc.LI_MAPPING.select(["qty", "status"]))
    return t.select(F.col("li_key.orderkey").alias("orderkey"),
                    F.col("li_key.linenumber").alias("linenumber"), "qty", "status")


@query("c6_composite_key_prefix", f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS orderkey, l_linenumber AS linenumber,
       CAST(l_quantity AS INTEGER) AS qty, l_linestatus AS status
FROM {LI_NEWEST}
WHERE lpad(CAST(l_orderkey AS VARCHAR), 10, '0') = '0000000042'
""")
def c6_composite_key_prefix(spark, sf_dir):
    """A leading-field equality becomes a row-key prefix (pushed down)."""
    cells = P.composite_key_filter(tc.li_cells(spark, sf_dir), tc.LI_KEY,
                                   equal=[("orderkey", "0000000042")])
    t = scan.scan_table(cells, tc.LI_MAPPING.select(["qty", "status"]))
    return t.select(F.col("li_key.orderkey").alias("orderkey"),
                    F.col("li_key.linenumber").alias("linenumber"), "qty", "status")


ORDERED_KEY = keys.ordered([("supp", "int"), ("price", "double"), ("flag", "string"), ("orderkey", "bigint"), ("line", "int")])
ORDERED_MAPPING = Mapping((Field("k", ORDERED_KEY.struct_type, "key"), Field("qty", "int", "column", "l", "qty")),
                          key_codec=ORDERED_KEY)


@query("c6_ordered_range", """
WITH r AS (SELECT l_suppkey - 5 AS supp, l_extendedprice - 20000 AS price, l_returnflag AS flag, l_orderkey AS orderkey,
                  l_linenumber AS line, max(CAST(l_quantity AS INTEGER)) AS qty
           FROM lineitem GROUP BY ALL)
SELECT CAST(supp AS INTEGER) AS supp, price, flag, orderkey, CAST(line AS INTEGER) AS line, qty FROM r
WHERE (supp = -2 AND price > -1500.5 AND price <= 12000) OR (supp < -3 AND supp >= -5)
""")
def c6_ordered_range(spark, sf_dir):
    """C6 on an order-preserving key in a store: an equal number and a range on a
    float after it, and a range on the leading number, negative values too; both
    as bounds on the stored key."""
    li = tc.load(spark, sf_dir, "lineitem")
    rows = li.select(
        F.struct((F.col("l_suppkey") - 5).cast("int").alias("supp"), (F.col("l_extendedprice") - 20000).alias("price"),
                 F.col("l_returnflag").alias("flag"), F.col("l_orderkey").cast("bigint").alias("orderkey"),
                 F.col("l_linenumber").cast("int").alias("line")).alias("k"),
        F.col("l_quantity").cast("int").alias("qty"))
    store = CellStore(spark, scratch_path(spark, "c6"))
    store.write_table(rows, ORDERED_MAPPING, ts=tc.CU_WRITE_TS, seq=F.col("qty"), regions=8)
    one = P.composite_key_filter(store.read(), ORDERED_KEY, [("supp", -2)], ranges=[("price", ">", -1500.5), ("price", "<=", 12000)])
    two = P.composite_key_filter(store.read(), ORDERED_KEY, ranges=[("supp", "<", -3), ("supp", ">=", -5)])
    return scan.scan_table(one.unionByName(two), ORDERED_MAPPING).select("k.*", "qty")


@query("c7_row_filter", f"""
SELECT {_OR_ROW} FROM orders
WHERE {_OKEY} LIKE '0000000%' AND NOT ({_OKEY} LIKE '%7') AND {_OKEY} >= '000000000100'
""")
def c7_row_filter(spark, sf_dir):
    """A list of row-key predicates, all of which must hold."""
    rk = F.col("row_key")
    cells = P.row_filter(tc.or_cells(spark, sf_dir),
                         [rk.like("0000000%"), ~rk.like("%7"), rk >= "000000000100"])
    return _or_scan(cells)


@query("c8_residual", f"""
SELECT order_key, status, total, prio_level FROM (
  SELECT {_OKEY} AS order_key, o_orderstatus AS status, o_totalprice AS total,
         CASE WHEN o_orderpriority LIKE '1-%' THEN 'urgent'
              WHEN o_orderpriority LIKE '2-%' THEN 'high' ELSE 'other' END AS prio_level,
         TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio_num
  FROM orders)
WHERE (status LIKE 'F%' OR (prio_level = 'urgent' AND total > 300000))
  AND prio_num IS NOT NULL AND prio_num <= 3
""")
def c8_residual(spark, sf_dir):
    """Predicates Spark keeps above the pivot (like, case, or, try_cast)."""
    t = _or_scan(tc.or_cells(spark, sf_dir))
    t = t.select(
        "order_key", "status", "total",
        F.when(F.col("prio").like("1-%"), "urgent").when(F.col("prio").like("2-%"), "high")
        .otherwise("other").alias("prio_level"),
        F.substring("prio", 1, 1).try_cast("int").alias("prio_num"))
    return (t.where((F.col("status").like("F%"))
                    | ((F.col("prio_level") == "urgent") & (F.col("total") > 300000)))
            .where(F.col("prio_num").isNotNull() & (F.col("prio_num") <= 3))
            .drop("prio_num"))


OR_KEY_MIDDLE = Mapping.parse("o:status,:key,o:total", ["status", "order_key", "total"],
                              ["string", "string", "double"])


@query("c9_nonkey_filter", f"""
SELECT o_orderstatus AS status, {_OKEY} AS order_key, o_totalprice AS total
FROM orders WHERE o_totalprice > 300000
""")
def c9_nonkey_filter(spark, sf_dir):
    """Filter on a typed non-key column; key mapped in the middle."""
    t = scan.scan_table(tc.or_cells(spark, sf_dir), OR_KEY_MIDDLE)
    return t.where(F.col("total") > 300000)
