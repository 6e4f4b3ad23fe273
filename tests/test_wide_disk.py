"""Wide rows are dealt by row key while they are narrow: no cell of them crosses the network."""
import pytest
from pyspark.sql import functions as F

from cellwise.plans import reads
from cellwise.plans import testcells as tc


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lineitem(spark, path, keys, lines=4):
    """2,000 rows, ``keys`` order keys: copies of a key differ in part."""
    spark.range(2000).select(
        (F.col("id") % keys).alias("l_orderkey"), (F.col("id") % lines + 1).cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 9).otherwise(0).alias("l_suppkey"), F.lit(1.0).alias("l_quantity")).coalesce(1).write.parquet(
        f"{path}/lineitem.parquet")


def _newest(rows):
    """The newest copy of each key, as text of all its columns."""
    out = {}
    for r in rows.collect():
        out[r.li_key] = max(out.get(r.li_key, (-1,)), (r.li_seq, *[r[f"c{i:02d}"] for i in range(1, 51)]))
    return {k: v[1:] for k, v in out.items()}


def _got(df):
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_wide_cells_are_put_together_where_they_are(spark, monkeypatch, tmp_path):
    _lineitem(spark, tmp_path, 700)
    want = _newest(tc.wide_rows(spark, str(tmp_path)))
    assert 700 <= len(want) < 2000
    monkeypatch.setattr(tc, "TASK_CELLS", 10_000)
    t = reads.a1_wide_50_columns(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in _plan(t) and "ENSURE_REQUIREMENTS" not in _plan(t)
    assert _got(t) == want


def test_wide_rows_of_a_key_with_many_copies_are_spread(spark, monkeypatch, tmp_path):
    """Rows of one key are too many for one task: dealt by their other columns."""
    _lineitem(spark, tmp_path, 3, 1)
    monkeypatch.setattr(tc, "TASK_CELLS", 10_000)
    want = _newest(tc.wide_rows(spark, str(tmp_path)))
    assert len(want) == 3
    monkeypatch.setattr(tc, "HOT_ROW_CELLS", 2_000)
    assert tc.wide_rows(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 3
    t = reads.a1_wide_50_columns(spark, str(tmp_path))
    assert "ENSURE_REQUIREMENTS" in _plan(t)
    assert _got(t) == want


def test_wide_rows_without_a_key_raise(spark, tmp_path):
    spark.createDataFrame([(1, 1, 1, 1, 1.0), (None, None, 1, 1, 1.0)], "l_orderkey bigint, l_linenumber int, l_partkey bigint, "
                          "l_suppkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    with pytest.raises(Exception, match="empty row key"):
        reads.a1_wide_50_columns(spark, str(tmp_path)).collect()


def test_very_wide_cells_are_put_together_where_they_are(spark, monkeypatch, tmp_path):
    spark.range(60).select(F.col("id").alias("c_custkey"), F.format_string("Customer#%d", "id").alias("c_name")).coalesce(1).write.parquet(
        f"{tmp_path}/customer.parquet")
    rows = tc.very_wide_rows(spark, str(tmp_path)).collect()
    want = {r[0]: tuple(r)[1:] for r in rows}
    assert len(want) == 60 and any(None in v for v in want.values()) and any(None not in v for v in want.values())
    monkeypatch.setattr(tc, "TASK_CELLS", 4_000)
    t = reads.a1_wide_500_columns(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in _plan(t) and "ENSURE_REQUIREMENTS" not in _plan(t)
    assert _got(t) == want
