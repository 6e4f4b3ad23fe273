"""Value semantics checked against outputs the reference's own end-to-end
tests print (rebuilt here as literal fixtures; the shared source table of
those tests is not available, so only the rows the outputs show are used)."""
import datetime as dt

from helpers import cells, rows
from pyspark.sql import functions as F

from cellwise.mapping import Mapping
from cellwise.operators import scan
from cellwise.operators.encode import table_to_cells
from cellwise.operators.predicates import time_op
from cellwise.operators.upsert import union_cells

TS_TABLE = Mapping.parse(":key,cf:string,:timestamp", ["key", "value", "time"],
                         ["string", "string", "bigint"])


def _union_feed(spark):
    """Keys that are multiples of 33 stamped 1e11 ms, of 37 stamped 2e11 ms."""
    k33 = [0, 33, 66, 165, 396, 462]
    k37 = [37, 74, 111, 222, 296, 333, 407, 444]
    df = spark.createDataFrame(
        [(str(k), f"val_{k}", 100000000000) for k in k33]
        + [(str(k), f"val_{k}", 200000000000) for k in k37],
        "key string, value string, time bigint")
    return table_to_cells(df, TS_TABLE)


def _q(spark, op, t):
    c = time_op(_union_feed(spark), op, t)
    out = scan.scan_table(c, TS_TABLE)
    key_num = F.col("key").cast("int")
    return sorted((r.key, r.value, r.time) for r in
                  out.where((key_num > 100) & (key_num < 400)).collect())


def test_time_range_pushdown_matches_golden(spark):
    old = [("165", "val_165", 100000000000), ("396", "val_396", 100000000000)]
    new = [(str(k), f"val_{k}", 200000000000) for k in (111, 222, 296, 333)]
    assert _q(spark, "<", 200000000000) == old
    assert _q(spark, "<=", 100000000000) == old
    assert _q(spark, ">", 100000000000) == new
    assert _q(spark, ">=", 200000000000) == new
    # the golden renders 1e11 ms as 1973-03-03 09:46:40
    got = spark.range(1).select(F.timestamp_millis(F.lit(100000000000)).cast("timestamp_ntz")
                                .alias("t")).first().t
    assert got == dt.datetime(1973, 3, 3, 9, 46, 40)


def test_family_map_versions_match_golden(spark):
    m = Mapping.parse(":key,cf:,:timestamp", ["key", "value", "time"],
                      ["string", "map<string,string>", "timestamp_ntz"])
    keys = ["0", "17", "119"]

    def feed(values, stamp):
        df = spark.createDataFrame([(k, values(k), stamp) for k in keys],
                                   "key string, value map<string,string>, time timestamp_ntz")
        return table_to_cells(df, m)

    c = union_cells(
        feed(lambda k: {"name": f"val_{k} Jr"}, dt.datetime(2012, 2, 23, 10, 14, 52)),
        feed(lambda k: {"age": "40"}, dt.datetime(2015, 12, 12, 12, 12, 12)),
        feed(lambda k: {"name": f"val_{k}"}, dt.datetime(2000, 1, 1, 1, 1, 1)))
    got = {r.key: (r.value, r.time) for r in scan.scan_table(c, m).collect()}
    assert got["0"] == ({"age": "40", "name": "val_0 Jr"}, dt.datetime(2015, 12, 12, 12, 12, 12))
    assert got["119"][0] == {"age": "40", "name": "val_119 Jr"}


def test_string_key_range_matches_golden(spark):
    keys = ["0", "10", "100", "2", "20", "90", "92", "95", "96", "97", "98", "9"]
    c = cells(spark, [(k, "cf", "string", 1, f"val_{k}") for k in keys])
    m = Mapping.parse(":key,cf:string", ["key", "value"])
    out = scan.scan_table(c.where(F.col("row_key") > "90"), m)
    assert [r[0] for r in rows(out)] == ["92", "95", "96", "97", "98"]


def test_custom_timestamp_format_matches_golden(spark):
    m = Mapping.parse("m:mytime,m:mystr", ["rowkey", "mytime", "mystr"],
                      ["string", "timestamp_ntz", "string"],
                      timestamp_formats=("yyyy-MM-dd-HH.mm.ss.SSSSSS",))
    c = cells(spark, [(k, "m", q, 1, v) for k in ("238", "311", "86")
                      for q, v in (("mytime", "2001-02-03-04.05.06.123456"), ("mystr", f"val_{k}"))])
    got = {r.rowkey: r for r in scan.scan_table(c, m).collect()}
    # the golden prints milliseconds (2001-02-03 04:05:06.123); Spark keeps microseconds
    assert got["86"].mytime == dt.datetime(2001, 2, 3, 4, 5, 6, 123456)
    assert got["311"].mystr == "val_311"


def test_sparse_rows_still_counted(spark):
    m = Mapping.parse(":key,cf1:c1,cf1:c2", ["key", "col1", "col2"])
    df = spark.createDataFrame(
        [(str(i), None if i in (5, 6) else "1.0", "same") for i in range(10)],
        "key string, col1 string, col2 string")
    t = scan.scan_table(table_to_cells(df, m, ts=1), m)
    assert t.agg(F.count("key"), F.count(F.lit(1)), F.count("col1")).first() == (10, 10, 8)
