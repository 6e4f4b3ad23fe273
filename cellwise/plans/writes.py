"""Queries for writes: key checks, upserts, table writes, multi-insert,
unions, distinct loads, cluster-by and sampling (B3–B5, B11, H1, H2, E5, G4, G5)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codec import decode_text
from ..mapping import Mapping
from ..operators import quality, scan
from ..operators.encode import table_to_cells
from ..operators.predicates import time_range
from ..operators.sorting import cluster_by, sample_rows
from ..operators.upsert import union_cells, upsert_cells
from ..session import scratch_path
from ..sources.store import CellStore, multi_insert
from . import testcells as tc
from .filters import T_JAN10, T_JAN20
from .reads import _EV_RANKED
from .registry import query

T_JAN15 = 1705276800000
LATE_SHIFT_MS = 20 * 86400 * 1000

_KEY_SQL = """CASE WHEN event_type = 'error' AND value < 5 THEN NULL
       WHEN event_type = 'error' AND value < 10 THEN ''
       WHEN event_type = 'view' THEN lpad(CAST(user_id AS VARCHAR), 8, '0')
       ELSE lpad(CAST(event_id AS VARCHAR), 10, '0') END"""


def _keyed_events(spark, sf_dir):
    """Events keyed for loading, with the faults a load must catch: NULL keys
    (errors below 5), empty keys (errors below 10) and duplicates (views keyed
    by user)."""
    e = tc.load(spark, sf_dir, "events")
    v = F.col("value")
    key = (F.when((F.col("event_type") == "error") & (v < 5), F.lit(None).cast("string"))
           .when((F.col("event_type") == "error") & (v < 10), F.lit(""))
           .when(F.col("event_type") == "view", tc.padded("user_id", 8))
           .otherwise(tc.padded("event_id", 10)))
    return e.select(key.alias("k"), "event_type", "value")


@query("b3_key_report", f"""
SELECT k AS key, CASE WHEN k IS NULL THEN 'null' WHEN k = '' THEN 'empty' ELSE 'duplicate' END
         AS reason, count(*) AS copies
FROM (SELECT {_KEY_SQL} AS k FROM events)
GROUP BY k HAVING k IS NULL OR k = '' OR count(*) > 1
""")
def b3_key_report(spark, sf_dir):
    """One row per bad key (NULL, empty, duplicated) with its copies."""
    return quality.key_report(_keyed_events(spark, sf_dir), "k")


@query("b3_validate_keys", f"""
WITH k AS (SELECT {_KEY_SQL} AS k FROM events),
     c AS (SELECT k, count(*) OVER (PARTITION BY k) AS n FROM k)
SELECT CASE WHEN k IS NULL THEN 'null' WHEN k = '' THEN 'empty'
            WHEN n > 1 THEN 'duplicate' ELSE 'good' END AS outcome, count(*) AS rows
FROM c GROUP BY 1
""")
def b3_validate_keys(spark, sf_dir):
    """Rows split into good and rejected, counted by outcome."""
    good, rejects = quality.validate_keys(_keyed_events(spark, sf_dir), "k")
    g = good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("good").alias("outcome"), "rows")
    r = rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
    return g.unionByName(r).where(F.col("rows") > 0)


@query("b4_upsert_late", f"""
WITH u AS (
  SELECT user_id, event_type, value, event_id, epoch_us(ts) // 1000 AS ms FROM events
  WHERE epoch_us(ts) // 1000 < {T_JAN15}
  UNION ALL
  SELECT user_id, event_type, value, event_id, epoch_us(ts) // 1000 - {LATE_SHIFT_MS} FROM events
  WHERE epoch_us(ts) // 1000 >= {T_JAN15}),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ms DESC, event_id DESC) AS rn FROM u)
SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS row_key, 'e' AS family, event_type AS qualifier,
       ms AS ts, event_id AS seq, value
FROM r WHERE rn = 1
""")
def b4_upsert_late(spark, sf_dir):
    """The second half of January arrives late, stamped 20 days early;
    per cell, a late version only wins over older ones."""
    cells = tc.ev_cells(spark, sf_dir)
    old = time_range(cells, hi_ms=T_JAN15)
    new = time_range(cells, lo_ms=T_JAN15).withColumn("ts", F.col("ts") - LATE_SHIFT_MS)
    out = upsert_cells(old, new)
    return out.withColumn("value", decode_text(F.col("value"), "double"))


@query("b5_write_table", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cust_key, c_name AS name,
       c_mktsegment AS segment, c_nationkey AS nation,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 1 ELSE c_acctbal END AS acctbal
FROM customer
""")
def b5_write_table(spark, sf_dir):
    """Write the customer table, then overwrite one column of some rows;
    the second write is an upsert, nothing else changes."""
    store = CellStore(spark, scratch_path(spark, "b5"))
    rows = tc.cu_rows(spark, sf_dir)
    store.write_table(rows, tc.CU_MAPPING, ts=1000, regions=None, points=[])
    bal = Mapping.parse(":key,n:acctbal", ["cust_key", "acctbal"], ["string", "double"])
    upd = rows.where(F.col("segment") == "AUTOMOBILE").select(
        "cust_key", (F.col("acctbal") + 1).alias("acctbal"))
    store.write_table(upd, bal, ts=2000, points=[])
    return scan.scan_table(store.read(), tc.CU_MAPPING)


@query("b11_multi_insert", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'open' END AS sink,
       lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_orderstatus AS status,
       o_totalprice AS total
FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def b11_multi_insert(spark, sf_dir):
    """One pass over orders feeds two tables with different filters."""
    m = Mapping.parse(":key,o:status,o:total", ["order_key", "status", "total"],
                      ["string", "string", "double"])
    a = CellStore(spark, scratch_path(spark, "b11-finished"))
    b = CellStore(spark, scratch_path(spark, "b11-open"))
    rows = tc.or_rows(spark, sf_dir).select("order_key", "status", "total")
    multi_insert(rows, [(F.col("status") == "F", lambda d: a.write_table(d, m, ts=1, points=[])),
                        (F.col("status") == "O", lambda d: b.write_table(d, m, ts=1, points=[]))])
    ra = scan.scan_table(a.read(), m).withColumn("sink", F.lit("finished"))
    rb = scan.scan_table(b.read(), m).withColumn("sink", F.lit("open"))
    return ra.unionByName(rb)


@query("h1_union_counts", """
SELECT 'empty' AS source, 0::BIGINT AS n
UNION ALL SELECT 'plain', count(*) FROM orders
UNION ALL SELECT 'cells', count(*) FROM orders
""")
def h1_union_counts(spark, sf_dir):
    """H1: UNION ALL of counts from an empty cell table, the plain table and
    the cell table."""
    cells = tc.or_cells(spark, sf_dir)
    empty = cells.where(F.col("family") == "no-such-family")
    e = scan.row_count(empty).select(F.lit("empty").alias("source"), F.col("rows").alias("n"))
    p = tc.load(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("plain").alias("source"), "n")
    c = scan.row_count(cells).select(F.lit("cells").alias("source"), F.col("rows").alias("n"))
    return e.unionByName(p).unionByName(c)


@query("h2_union_feeds", f"""
WITH c AS ({_EV_RANKED})
SELECT user_key AS row_key, 'e' AS family, event_type AS qualifier, ms AS ts,
       event_id AS seq, value
FROM c WHERE rn = 1
""")
def h2_union_feeds(spark, sf_dir):
    """H2: two overlapping timestamped feeds (to Jan 20, from Jan 10) unioned
    into one upsert; the overlap collapses."""
    cells = tc.ev_cells(spark, sf_dir)
    a = time_range(cells, hi_ms=T_JAN20)
    b = time_range(cells, lo_ms=T_JAN10)
    empty = cells.where(F.lit(False))
    out = upsert_cells(empty, union_cells(a, b))
    return out.withColumn("value", decode_text(F.col("value"), "double"))


@query("e5_distinct_load", """
SELECT DISTINCT o_orderstatus || '|' || o_orderpriority AS row_key, o_orderstatus AS status,
       o_orderpriority AS prio
FROM orders
""")
def e5_distinct_load(spark, sf_dir):
    """E5: SELECT DISTINCT before a load keyed by the distinct values."""
    m = Mapping.parse(":key,s:status,s:prio", ["row_key", "status", "prio"])
    rows = (tc.or_rows(spark, sf_dir).select("status", "prio").distinct()
            .withColumn("row_key", F.concat_ws("|", "status", "prio")))
    return scan.scan_table(table_to_cells(rows, m, ts=1), m)


@query("g4_cluster_by", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_orderstatus AS status FROM orders
""")
def g4_cluster_by(spark, sf_dir):
    """CLUSTER BY key (hash-distributed, sorted within each partition)."""
    return cluster_by(tc.or_rows(spark, sf_dir).select("order_key", "status"), "order_key")


@query("g5_sample_rows", """
SELECT order_key, status FROM (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_orderstatus AS status
  FROM orders)
ORDER BY md5(order_key), order_key LIMIT 100
""")
def g5_sample_rows(spark, sf_dir):
    """TABLESAMPLE (100 ROWS), made stable by a hash order."""
    t = scan.scan_table(tc.or_cells(spark, sf_dir), tc.OR_MAPPING, ["status"])
    return sample_rows(t, 100, "order_key")
