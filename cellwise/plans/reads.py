"""Queries for the read side: pivot, projection, keys, maps, row time, views,
versions (A1–A6, A9, A10, E6)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scan
from . import testcells as tc
from .registry import query

_EV_RANKED = """
  SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS user_key, event_type, value,
         epoch_us(ts) // 1000 AS ms, event_id,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn
  FROM events
"""


@query("latest_user_state", f"""
WITH c AS ({_EV_RANKED})
SELECT user_key,
  max(CASE WHEN rn = 1 AND event_type = 'click' THEN value END) AS click,
  max(CASE WHEN rn = 1 AND event_type = 'view' THEN value END) AS view,
  max(CASE WHEN rn = 1 AND event_type = 'purchase' THEN value END) AS purchase,
  max(CASE WHEN rn = 1 AND event_type = 'signup' THEN value END) AS signup,
  max(CASE WHEN rn = 1 AND event_type = 'error' THEN value END) AS error,
  make_timestamp(max(ms) * 1000) AS row_ts
FROM c GROUP BY user_key
""")
def latest_user_state(spark, sf_dir):
    """Flagship (A1 + E6 + A6): newest value per (user, event type), one row
    per user, row time = newest cell."""
    return scan.scan_table(tc.ev_cells(spark, sf_dir), tc.EV_MAPPING)


def _user_newest(cols: list[str], any_type: bool) -> str:
    sel = ",\n  ".join(
        f"max(CASE WHEN rn = 1 AND event_type = '{c}' THEN value END) AS {c}" for c in cols)
    where = "" if any_type else "WHERE event_type IN (" + ", ".join(f"'{c}'" for c in cols) + ")"
    return f"""
WITH c AS ({_EV_RANKED})
SELECT user_key,
  {sel}
FROM c {where} GROUP BY user_key
"""


@query("a2_projected_read", _user_newest(["click", "purchase"], any_type=False))
def a2_projected_read(spark, sf_dir):
    """A2 with the store's row rule: only users with a click or purchase cell;
    only those two qualifiers are read."""
    return scan.scan_table(tc.ev_cells(spark, sf_dir), tc.EV_MAPPING, ["click", "purchase"],
                           projected_only=True)


@query("a2_projected_all_rows", _user_newest(["click", "purchase"], any_type=True))
def a2_projected_all_rows(spark, sf_dir):
    """A2 with the relational row rule: every user with any mapped cell."""
    return scan.scan_table(tc.ev_cells(spark, sf_dir), tc.EV_MAPPING, ["click", "purchase"])


@query("e6_latest_cells", f"""
WITH c AS ({_EV_RANKED})
SELECT user_key AS row_key, 'e' AS family, event_type AS qualifier, ms AS ts,
       event_id AS seq, value
FROM c WHERE rn = 1
""")
def e6_latest_cells(spark, sf_dir):
    """Newest version of every cell, value decoded."""
    from ..functions.codec import decode_text
    cells = scan.latest(tc.ev_cells(spark, sf_dir))
    return cells.withColumn("value", decode_text(F.col("value"), "double"))


@query("a3_row_count", """
SELECT count(*) AS rows,
       count(o_custkey) + count(o_orderstatus) + count(o_totalprice)
         + count(o_orderpriority) AS cells
FROM orders
""")
def a3_row_count(spark, sf_dir):
    """A3: row and cell count without decoding any value."""
    return scan.row_count(tc.or_cells(spark, sf_dir))


@query("a3_scan_keys", """
SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 8, '0') AS row_key FROM events
""")
def a3_scan_keys(spark, sf_dir):
    """A3: key-only read."""
    return scan.scan_keys(tc.ev_cells(spark, sf_dir))


@query("a4_family_map", f"""
WITH c AS ({_EV_RANKED})
SELECT user_key AS row_key, count(*) AS n_entries,
       string_agg(event_type || '=' || printf('%.2f', value), ',' ORDER BY event_type) AS entries
FROM c WHERE rn = 1 GROUP BY user_key
""")
def a4_family_map(spark, sf_dir):
    """A4: family ``e`` as map<string,double> of the newest value per event type."""
    m = scan.scan_family_map(tc.ev_cells(spark, sf_dir), "e", "string", "double", name="events")
    return m.select(
        "row_key", F.size("events").alias("n_entries"),
        map_text(F.col("events"), lambda v: F.format_string("%.2f", v)).alias("entries"))


def map_text(m, fmt=lambda v: v):
    """A map as ``k=v`` entries sorted by key, comma-joined (for comparing)."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"].cast("string"), F.lit("="),
                                                       fmt(e["value"]).cast("string"))), ",")


_HOT_KEY_SQL = "CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE lpad(CAST(l_orderkey AS VARCHAR), 10, '0') END"


@query("a4_hot_row_map", f"""
WITH c AS (
  SELECT {_HOT_KEY_SQL} AS row_key, l_partkey AS part, l_orderkey AS o,
         row_number() OVER (PARTITION BY {_HOT_KEY_SQL}, l_partkey
                            ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey * 10 + l_linenumber DESC) AS rn
  FROM lineitem)
SELECT row_key, count(*) AS n_entries, CAST(sum(part) AS BIGINT) AS sum_parts,
       CAST(sum(part * 7 + o) AS BIGINT) AS sum_pairs
FROM c WHERE rn = 1 GROUP BY row_key
""")
def a4_hot_row_map(spark, sf_dir):
    """A4: family maps where one row holds a third of all cells; rows of more than
    1,000 cells are put together from pieces."""
    li = tc.load(spark, sf_dir, "lineitem")
    cells = li.select(
        F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(tc.padded("l_orderkey", tc.CUST_KEY_WIDTH)).alias("row_key"),
        F.lit("o").alias("family"), F.col("l_partkey").cast("string").alias("qualifier"),
        (F.unix_date(F.col("l_shipdate").cast("date")).cast("long") * 86_400_000).alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_orderkey").cast("string").cast("binary").alias("value"))
    m = scan.scan_family_map(cells, "o", "bigint", "bigint", name="orders", hot_cells=1_000)
    total = lambda of: F.aggregate(F.map_entries("orders"), F.lit(0).cast("long"), lambda a, e: a + of(e))
    return m.select("row_key", F.size("orders").alias("n_entries"),
                    total(lambda e: e["key"]).alias("sum_parts"),
                    total(lambda e: e["key"] * 7 + e["value"]).alias("sum_pairs"))


_LI_KEY_SQL = "lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$' || CAST(l_linenumber AS VARCHAR)"
# lineitem as stored: of copies sharing (orderkey, linenumber) the newest wins
LI_NEWEST = """(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY (l_partkey * 1000000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) DESC) AS li_rn
  FROM lineitem) WHERE li_rn = 1)"""


@query("a5_prefix_map", f"""
SELECT {_LI_KEY_SQL} AS row_key,
       'ship=' || strftime(l_shipdate, '%Y-%m-%d') || ',status=' || l_linestatus AS shown,
       'hip=' || strftime(l_shipdate, '%Y-%m-%d') || ',tatus=' || l_linestatus AS hidden
FROM {LI_NEWEST}
""")
def a5_prefix_map(spark, sf_dir):
    """A5: qualifiers starting with ``s`` as a map, with and without the prefix."""
    from ..mapping import Field, Mapping
    both = Mapping((Field("row_key", "string", "key"),
                    Field("shown", "map<string,string>", "prefix", "l", "s"),
                    Field("hidden", "map<string,string>", "prefix", "l", "s", hide_prefix=True)))
    t = scan.scan_table(tc.li_cells(spark, sf_dir), both, raw_key=True)
    return t.select("row_key", map_text(F.col("shown")).alias("shown"),
                    map_text(F.col("hidden")).alias("hidden"))


@query("a6_row_timestamp", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_orderstatus AS status,
       o_orderdate AS order_ts, epoch_us(o_orderdate) // 1000 AS order_ms
FROM orders
""")
def a6_row_timestamp(spark, sf_dir):
    """Row timestamp pseudo-column, as timestamp and as bigint."""
    from ..mapping import Mapping
    m = Mapping.parse(":key,o:status,:timestamp", ["order_key", "status", "order_ts"],
                      ["string", "string", "timestamp_ntz"])
    cells = tc.or_cells(spark, sf_dir)
    t = scan.scan_table(cells, m)
    from ..functions.time import epoch_millis
    from pyspark.sql import types as T
    return t.withColumn("order_ms", epoch_millis("order_ts", T.TimestampNTZType()))


@query("a9_two_views", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cust_key,
       CAST(c_nationkey AS VARCHAR) AS nation_text,
       CAST(c_acctbal AS DECIMAL(12, 2)) AS acctbal_dec,
       CAST(NULL AS INTEGER) AS name_as_int,
       c_name AS name, c_mktsegment AS segment
FROM customer
""")
def a9_two_views(spark, sf_dir):
    """A second mapping over the same customer cells, other types: text
    that is not a number reads NULL instead of failing."""
    from ..mapping import Mapping
    v2 = Mapping.parse(":key,n:nation,n:acctbal,p:name,p:name,p:segment",
                       ["cust_key", "nation_text", "acctbal_dec", "name_as_int", "name", "segment"],
                       ["string", "string", "decimal(12,2)", "int", "string", "string"])
    return scan.scan_table(tc.cu_cells(spark, sf_dir), v2)


@query("a10_versions", f"""
WITH c AS ({_EV_RANKED})
SELECT user_key AS row_key, 'e' AS family, event_type AS qualifier, ms AS ts, event_id AS seq,
       value, CAST(rn AS INTEGER) AS version
FROM c WHERE rn <= 3
""")
def a10_versions(spark, sf_dir):
    """A10: the three newest versions of every cell."""
    from ..functions.codec import decode_text
    v = scan.scan_versions(tc.ev_cells(spark, sf_dir), 3)
    return v.withColumn("value", decode_text(F.col("value"), "double"))


def _wide_sql() -> str:
    base = ("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
            "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))")
    h = f"(md5({base}) || md5({base} || '#'))"
    cols = ",\n  ".join(
        f"substr({h}, {1 + i % 14}, CAST((l_orderkey + l_linenumber + {i * 7}) % 50 + 1 AS INTEGER))"
        f" AS c{i:02d}" for i in range(1, tc.WIDE_COLUMNS + 1))
    return f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '$$' || CAST(l_linenumber AS VARCHAR) AS li_key,
  {cols}
FROM {LI_NEWEST}
"""


@query("a1_wide_50_columns", _wide_sql())
def a1_wide_50_columns(spark, sf_dir):
    """A1 on the reference's benchmark shape: 50 text columns per row, one
    cell each, pivoted back into rows."""
    return scan.scan_table(tc.wide_cells(spark, sf_dir), tc.WIDE_MAPPING)


def _very_wide_sql() -> str:
    cols = ",\n  ".join(
        f"CASE WHEN c_custkey % 11 = 0 OR (c_custkey + {i}) % 7 <> 0 THEN "
        f"substr(h, {1 + i % 20}, CAST((c_custkey + {i * 3}) % 12 + 1 AS INTEGER)) END AS q{i:03d}"
        for i in range(tc.VERY_WIDE_COLUMNS))
    return f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cust_key,
  {cols}
FROM (SELECT c_custkey, md5(concat_ws('|', c_name, CAST(c_custkey AS VARCHAR))) AS h FROM customer)
"""


@query("a1_wide_500_columns", _very_wide_sql())
def a1_wide_500_columns(spark, sf_dir):
    """A1 at 500 columns: every customer as a row of 500 text cells with gaps,
    unpivoted and pivoted back."""
    from ..operators.encode import table_to_cells
    # the keys were checked before the rows were dealt by them
    cells = table_to_cells(tc.very_wide_rows(spark, sf_dir), tc.VERY_WIDE_MAPPING, ts=tc.CU_WRITE_TS, strict_keys=False)
    return scan.scan_table(cells, tc.VERY_WIDE_MAPPING)


def _sparse_sql() -> str:
    cols = ",\n  ".join(f"max(CASE WHEN q = {i} THEN l_orderkey END) AS q{i:03d}" for i in range(tc.VERY_WIDE_COLUMNS))
    return f"""
WITH c AS (SELECT o_custkey, l_partkey % 500 AS q, l_orderkey, CAST(l_shipdate AS DATE) AS d,
  max(CAST(l_shipdate AS DATE)) OVER (PARTITION BY o_custkey) AS newest,
  row_number() OVER (PARTITION BY o_custkey, l_partkey % 500
                     ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey * 10 + l_linenumber DESC, CAST(l_orderkey AS VARCHAR) DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cust_key,
  {cols},
  CAST(any_value(newest) AS TIMESTAMP) AS row_ts
FROM c WHERE rn = 1 GROUP BY o_custkey
"""


@query("a1_sparse_500_columns", _sparse_sql())
def a1_sparse_500_columns(spark, sf_dir):
    """A1 at 500 columns, most of them empty, with several versions per cell."""
    return scan.scan_table(tc.sparse_cells(spark, sf_dir), tc.SPARSE_MAPPING)
