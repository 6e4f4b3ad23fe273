"""Queries for table profiles and schema work."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.records import decode_records
from ..mapping import Mapping
from ..operators import quality, scan
from ..operators.encode import table_to_cells
from ..session import scratch_path
from . import testcells as tc
from .registry import query


CU_TEXT = Mapping.parse(":key,p:name,p:segment,n:nation", ["cust_key", "name", "segment", "nation"],
                        ["string", "string", "string", "int"])


@query("e7_table_stats", """
WITH c AS (SELECT c_name AS name, c_nationkey AS nation,
             CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer)
SELECT count(*) AS rows, count(name) + count(segment) + count(nation) AS cells,
       sum(strlen(name) + 14) + sum(strlen(segment) + 17) + sum(strlen(CAST(nation AS VARCHAR)) + 16) AS bytes,
       count(name) AS name_nonnull, count(segment) AS segment_nonnull, count(nation) AS nation_nonnull,
       0.0::DOUBLE AS name_null_rate,
       round(1 - count(segment)::DOUBLE / count(*), 6) AS segment_null_rate,
       0.0::DOUBLE AS nation_null_rate
FROM c
""")
def e7_table_stats(spark, sf_dir):
    """Rows, cells, bytes and per-column fill of customer cells, where
    BUILDING customers have no segment."""
    rows = tc.cu_rows(spark, sf_dir).withColumn(
        "segment", F.when(F.col("segment") != "BUILDING", F.col("segment")))
    return quality.table_stats(table_to_cells(rows.select("cust_key", "name", "segment", "nation"), CU_TEXT,
                                              ts=tc.CU_WRITE_TS), CU_TEXT)


@query("e7_table_stats_all", """
WITH c AS (SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal,
             CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer)
SELECT count(*) AS rows, count(name) + count(segment) + count(nation) + count(acctbal) AS cells,
       count(name) AS name_nonnull, count(segment) AS segment_nonnull, count(nation) AS nation_nonnull,
       count(acctbal) AS acctbal_nonnull,
       round(1 - count(name)::DOUBLE / count(*), 6) AS name_null_rate,
       round(1 - count(segment)::DOUBLE / count(*), 6) AS segment_null_rate,
       round(1 - count(nation)::DOUBLE / count(*), 6) AS nation_null_rate,
       round(1 - count(acctbal)::DOUBLE / count(*), 6) AS acctbal_null_rate
FROM c
""")
def e7_table_stats_all(spark, sf_dir):
    """Rows, cells and per-column fill over all columns; e7_table_stats checks
    the bytes, without the doubles."""
    rows = tc.cu_rows(spark, sf_dir).withColumn(
        "segment", F.when(F.col("segment") != "BUILDING", F.col("segment")))
    return quality.table_stats(table_to_cells(rows, tc.CU_MAPPING, ts=tc.CU_WRITE_TS), tc.CU_MAPPING).drop("bytes")


@query("e8_qualifier_profile", """
SELECT 'p' AS family, 'name' AS qualifier, count(*) AS rows, count(*) AS cells, 1700000000000 AS first_ts,
       1700000000000 AS last_ts, sum(strlen(c_name)) AS bytes FROM customer
UNION ALL
SELECT 'p', 'segment', count(*), count(*), 1700000000000, 1700000000000, sum(strlen(c_mktsegment)) FROM customer
UNION ALL
SELECT 'n', 'nation', count(*), count(*), 1700000000000, 1700000000000,
       sum(strlen(CAST(c_nationkey AS VARCHAR))) FROM customer
""")
def e8_qualifier_profile(spark, sf_dir):
    """Qualifier census of the customer cells, with their bytes."""
    return quality.qualifier_profile(table_to_cells(
        tc.cu_rows(spark, sf_dir).select("cust_key", "name", "segment", "nation"), CU_TEXT, ts=tc.CU_WRITE_TS))


@query("e8_qualifier_profile_all", "\nUNION ALL\n".join(
    f"SELECT '{fam}' AS family, '{q}' AS qualifier, count({c}) AS rows, count({c}) AS cells, 1700000000000 AS first_ts, "
    f"1700000000000 AS last_ts FROM customer"
    for fam, q, c in (("p", "name", "c_name"), ("p", "segment", "c_mktsegment"), ("n", "nation", "c_nationkey"), ("n", "acctbal", "c_acctbal"))))
def e8_qualifier_profile_all(spark, sf_dir):
    """Qualifier census of all customer cells (the bytes of doubles depend on
    how they are printed; e8_qualifier_profile compares those of the others)."""
    return quality.qualifier_profile(tc.cu_cells(spark, sf_dir)).drop("bytes")


@query("e8_event_profile", """
SELECT 'e' AS family, event_type AS qualifier, count(DISTINCT user_id) AS rows,
       count(*) AS cells, min(epoch_us(ts) // 1000) AS first_ts, max(epoch_us(ts) // 1000) AS last_ts
FROM events GROUP BY event_type
""")
def e8_event_profile(spark, sf_dir):
    """Qualifier census of the events cells (their values are doubles, whose
    text length is not compared)."""
    return quality.qualifier_profile(tc.ev_cells(spark, sf_dir)).drop("bytes")


CU_CHECK = Mapping.parse(":key,p:name,p:segment,n:nation,n:acctbal,n:region",
                         ["cust_key", "name", "segment", "nation", "acctbal", "region"])


@query("e9_mapping_check", """
SELECT 'unmapped' AS problem, NULL::VARCHAR AS "column", 'p' AS family, 'phone' AS qualifier,
       count(*) AS cells
FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL
SELECT 'no_cells', 'region', 'n', 'region', 0
""")
def e9_mapping_check(spark, sf_dir):
    """The mapping names n:region, which no cell has; AUTOMOBILE
    customers carry a p:phone cell no column maps."""
    cells = tc.cu_cells(spark, sf_dir)
    rows = tc.cu_rows(spark, sf_dir).where(F.col("segment") == "AUTOMOBILE")
    phone = rows.select(F.col("cust_key").alias("row_key"), F.lit("p").alias("family"),
                        F.lit("phone").alias("qualifier"), F.lit(1).cast("bigint").alias("ts"),
                        F.lit(0).cast("bigint").alias("seq"),
                        F.reverse("name").cast("binary").alias("value"))
    return quality.mapping_check(cells.unionByName(phone), CU_CHECK)


def _props_cells(spark, sf_dir):
    e = tc.load(spark, sf_dir, "events")
    return e.select(tc.padded("user_id", 8).alias("row_key"), F.lit("r").alias("family"),
                    F.lit("props").alias("qualifier"),
                    F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                                     F.col("ts")).alias("ts"),
                    F.col("event_id").alias("seq"), F.col("props").cast("binary").alias("value"))


_PROPS_SQL = """
WITH r AS (SELECT user_id, props, row_number() OVER (PARTITION BY user_id
             ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events)
SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS row_key,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k, {extra} AS extra
FROM r WHERE rn = 1
"""


@query("i10_records", _PROPS_SQL.format(extra="'test'"))
def i10_records(spark, sf_dir):
    """JSON record cells read with an evolved reader schema: the new
    field takes its default."""
    r = decode_records(_props_cells(spark, sf_dir), "r", "props", "k int, extra string",
                       defaults={"extra": "test"})
    return r.select("row_key", "record.k", "record.extra")


@query("k3_schema_lookup", _PROPS_SQL.format(extra="NULL::VARCHAR"))
def k3_schema_lookup(spark, sf_dir):
    """K3: the reader schema is looked up from a schema file of two lines, once, on the
    driver; no default for the new field, so it reads NULL."""
    path = scratch_path(spark, "k3-schema")
    spark.createDataFrame([("k int,\n  extra string",)], "ddl string").coalesce(1).write.text(path)
    r = decode_records(_props_cells(spark, sf_dir), "r", "props", path)
    return r.select("row_key", "record.k", "record.extra")


CU_BINARY = Mapping.parse(":key,p:name,p:segment,n:nation#b,n:acctbal#b",
                          ["cust_key", "name", "segment", "nation", "acctbal"],
                          ["string", "string", "string", "int", "double"])


@query("i11_migrate_storage", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cust_key, c_name AS name,
       c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS acctbal,
       8 AS acctbal_bytes
FROM customer
""")
def i11_migrate_storage(spark, sf_dir):
    """Text cells re-encoded cell by cell to binary storage (no pivot,
    no shuffle); read through the binary mapping they equal the source."""
    moved = quality.migrate_storage(tc.cu_cells(spark, sf_dir), tc.CU_MAPPING, CU_BINARY)
    t = scan.scan_table(moved, CU_BINARY)
    raw = Mapping.parse(":key,n:acctbal", ["cust_key", "raw"], ["string", "binary"])
    w = scan.scan_table(moved, raw).select("cust_key", F.length("raw").alias("acctbal_bytes"))
    return t.join(w, "cust_key")



