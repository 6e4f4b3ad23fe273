"""Cell tables derived from the driver's test tables.

Each is a lazy job over the whole source table: events, customer, orders and
lineitem re-shaped into (row_key, family, qualifier, ts, seq, value) cells.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..functions.keys import delimited
from ..functions.time import df_epoch_millis
from ..mapping import Field, Mapping
from ..operators.encode import strict_key, table_to_cells
from ..operators.scan import COUNT_BUCKETS, HOT_ROW_CELLS

# Fixed values of the test layouts.
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")
USER_KEY_WIDTH = 8
CUST_KEY_WIDTH = 10
ORDER_KEY_WIDTH = 12
CU_WRITE_TS = 1_700_000_000_000   # one write time for the customer table
LI_SEQ_SCALE = 1_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, as it lies on disk."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: cells that one task makes of its rows
TASK_CELLS = 1_000_000


def dealt(rows: DataFrame, cells: int, *by: str) -> DataFrame:
    """``rows``, each of which becomes ``cells`` cells, dealt to tasks by the hash of the
    columns ``by``: a small file may hold the rows of very many cells, and is read by
    one task or a few. Rows of few cells in all stay where they are; the count reads
    the file's footers only."""
    tasks = -(-rows.count() * cells // TASK_CELLS)
    return rows.repartition(tasks, *by) if tasks > 1 else rows


def dealt_by_key(rows: DataFrame, cells: int, key: str, *by: str) -> DataFrame:
    """As :func:`dealt`, by the row key: the rows' cells need not be dealt again to be put
    together. Only where a key has the rows of more than ``HOT_ROW_CELLS`` cells, too many
    for one task, they are dealt by the columns ``by``. Keys are counted by one of
    ``COUNT_BUCKETS`` hash values first, by key only where that finds so many rows."""
    most = max(1, HOT_ROW_CELLS // cells)
    keys = rows.select(key, F.pmod(F.xxhash64(key), F.lit(COUNT_BUCKETS)).alias("_bucket"))
    many = lambda df, *of: df.groupBy(*of).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).drop("_n")
    hot = many(keys.join(F.broadcast(many(keys, "_bucket")), "_bucket", "left_semi"), key)
    return dealt(rows, cells, key) if hot.isEmpty() else dealt(rows, cells, *by)


def padded(col: str, width: int):
    return F.lpad(F.col(col).cast("string"), width, "0")


# ---------------------------------------------------------------- EV: events
EV_MAPPING = Mapping(
    (Field("user_key", "string", "key"),)
    + tuple(Field(t, "double", "column", "e", t) for t in EVENT_TYPES)
    + (Field("row_ts", "timestamp_ntz", "timestamp"),)
)


def ev_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell per event: key = user, qualifier = event type, version = ts
    (ms), tie break = event_id, value = text of the double."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        padded("user_id", USER_KEY_WIDTH).alias("row_key"),
        F.lit("e").alias("family"),
        F.col("event_type").alias("qualifier"),
        df_epoch_millis(ev, "ts").alias("ts"),
        F.col("event_id").alias("seq"),
        codec.encode_text(F.col("value"), "double").alias("value"),
    )


# -------------------------------------------------------------- CU: customer
CU_MAPPING = Mapping.parse(
    ":key,p:name,p:segment,n:nation,n:acctbal",
    ["cust_key", "name", "segment", "nation", "acctbal"],
    ["string", "string", "string", "int", "double"],
)


def cu_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(padded("c_custkey", CUST_KEY_WIDTH).alias("cust_key"),
                    F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("acctbal"))


def cu_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_to_cells(cu_rows(spark, sf_dir), CU_MAPPING, ts=CU_WRITE_TS)


# ---------------------------------------------------------------- OR: orders
OR_MAPPING = Mapping.parse(
    ":key,o:cust,o:status,o:total,o:prio,:timestamp",
    ["order_key", "cust", "status", "total", "prio", "order_ts"],
    ["string", "bigint", "string", "double", "string", "timestamp_ntz"],
)


def or_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(padded("o_orderkey", ORDER_KEY_WIDTH).alias("order_key"),
                    F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("prio"),
                    F.col("o_orderdate").alias("order_ts"))


def or_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_to_cells(or_rows(spark, sf_dir), OR_MAPPING)


# -------------------------------------------------------------- LI: lineitem
LI_KEY = delimited([("orderkey", "string"), ("linenumber", "int")])
LI_MAPPING = Mapping(
    (Field("li_key", "struct<orderkey:string,linenumber:int>", "key"),
     Field("qty", "int", "column", "l", "qty"),
     Field("price", "double", "column", "l", "price"),
     Field("disc", "double", "column", "l", "disc"),
     Field("flag", "string", "column", "l", "flag"),
     Field("status", "string", "column", "l", "status"),
     Field("ship", "date", "column", "l", "ship")),
    key_codec=LI_KEY,
)


def li_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.struct(padded("l_orderkey", CUST_KEY_WIDTH).alias("orderkey"),
                 F.col("l_linenumber").alias("linenumber")).alias("li_key"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").cast("date").alias("ship"),
        li_seq().alias("li_seq"),
    )


def li_seq():
    """Version order of lineitem copies sharing (orderkey, linenumber):
    part, then supplier, then quantity (whole numbers 1-50)."""
    return (F.col("l_partkey") * LI_SEQ_SCALE + F.col("l_suppkey")) * 100 \
        + F.col("l_quantity").cast("bigint")


def li_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_to_cells(li_rows(spark, sf_dir), LI_MAPPING, ts=CU_WRITE_TS,
                          seq=F.col("li_seq"))


# ------------------------------------------- W: 50 text columns per row
WIDE_COLUMNS = 50
WIDE_MAPPING = Mapping(
    (Field("li_key", "string", "key"),)
    + tuple(Field(f"c{i:02d}", "string", "column", "f", f"c{i:02d}")
            for i in range(1, WIDE_COLUMNS + 1))
)


def wide_text(i: int):
    """Column i of the wide table: 1–50 characters of the row's 64-character
    digest ``_h`` (offset and length vary by column and row)."""
    length = (F.col("l_orderkey") + F.col("l_linenumber") + i * 7) % 50 + 1
    return F.substring(F.col("_h"), F.lit(1 + i % 14), length.cast("int"))


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's benchmark shape (a key and 50 columns of 1–50 letters
    and digits), derived row by row from lineitem."""
    key = F.concat_ws("$$", padded("l_orderkey", CUST_KEY_WIDTH), F.col("l_linenumber").cast("string"))
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                strict_key(key, WIDE_MAPPING).alias("li_key"))
    li = dealt_by_key(li, WIDE_COLUMNS, "li_key", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    base = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    # the digest is computed once per row, in its own projection
    hashed = li.select("li_key", "l_orderkey", "l_linenumber", li_seq().alias("li_seq"),
                       F.concat(F.md5(base), F.md5(F.concat(base, F.lit("#")))).alias("_h"))
    return hashed.select(
        "li_key", *[wide_text(i).alias(f"c{i:02d}") for i in range(1, WIDE_COLUMNS + 1)],
        "li_seq")


def wide_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the keys were checked before the rows were dealt by them
    return table_to_cells(wide_rows(spark, sf_dir), WIDE_MAPPING, ts=CU_WRITE_TS,
                          seq=F.col("li_seq"), strict_keys=False)


# ------------------------------------------- V: 500 text columns per row
VERY_WIDE_COLUMNS = 500
VERY_WIDE_MAPPING = Mapping(
    (Field("cust_key", "string", "key"),)
    + tuple(Field(f"q{i:03d}", "string", "column", "a" if i % 2 else "b", f"q{i:03d}") for i in range(VERY_WIDE_COLUMNS))
)


def very_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key and 500 text columns per customer, every seventh one NULL (which one
    varies by row; every eleventh row has all of them)."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", strict_key(padded("c_custkey", CUST_KEY_WIDTH), VERY_WIDE_MAPPING).alias("cust_key"))
    c = dealt_by_key(c, VERY_WIDE_COLUMNS, "cust_key", "c_custkey", "c_name")
    hashed = c.select("cust_key", "c_custkey", F.md5(F.concat_ws("|", "c_name", "c_custkey")).alias("_h"))

    return hashed.select("cust_key", *[
        F.expr(f"IF(c_custkey % 11 = 0 OR (c_custkey + {i}) % 7 <> 0, "
               f"substring(_h, {1 + i % 20}, CAST((c_custkey + {i * 3}) % 12 + 1 AS INT)), NULL) AS q{i:03d}")
        for i in range(VERY_WIDE_COLUMNS)])


SPARSE_MAPPING = Mapping(
    (Field("cust_key", "string", "key"),)
    + tuple(Field(f"q{i:03d}", "bigint", "column", "o", f"q{i:03d}") for i in range(VERY_WIDE_COLUMNS))
    + (Field("row_ts", "timestamp_ntz", "timestamp"),)
)


def sparse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell per lineitem: key = the order's customer, one of 500 qualifiers by
    part, version = ship date, then order and line; value = order key as text."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = load(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate").cast("date")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        padded("o_custkey", CUST_KEY_WIDTH).alias("row_key"), F.lit("o").alias("family"),
        F.format_string("q%03d", F.col("l_partkey") % VERY_WIDE_COLUMNS).alias("qualifier"),
        (F.unix_date(shipped).cast("long") * 86_400_000).alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_orderkey").cast("string").cast("binary").alias("value"))
