"""Wide and hot rows: the pivot spreads a row once, rows of many cells are dealt to tasks."""
from pyspark.sql import functions as F

from cellwise.mapping import Field, Mapping
from cellwise.operators import scan
from cellwise.plans import testcells as tc


def _wide(n):
    return Mapping((Field("k", "string", "key"),) + tuple(Field(f"c{i}", "bigint", "column", "f", f"c{i}") for i in range(n))
                   + (Field("at", "timestamp_ntz", "timestamp"),))


def test_sparse_wide_rows_spread_once(spark):
    """A row's cells lie in many tasks: newest values by brute force, and no aggregate for each column."""
    n = 40
    cells = spark.range(4000).repartition(16, "id").select(
        F.format_string("k%02d", F.col("id") % 30).alias("row_key"), F.lit("f").alias("family"),
        F.format_string("c%d", F.col("id") * 7 % 53).alias("qualifier"),          # c40 and above are not mapped
        (F.col("id") * 7919 % 97).alias("ts"), (F.col("id") % 3).cast("bigint").alias("seq"),
        F.when(F.col("id") % 13 != 0, F.col("id").cast("string").cast("binary")).alias("value"))
    newest, at = {}, {}
    mapped = {f"c{i}" for i in range(n)}
    for r in cells.where(F.col("qualifier").isin(list(mapped))).collect():
        key = (r.ts, r.seq, r.value is not None, bytes(r.value or b""))
        cell = newest.setdefault(r.row_key, {})
        cell[r.qualifier] = max(cell.get(r.qualifier, (-1, 0, False, b"")), key)
        at[r.row_key] = max(at.get(r.row_key, -1), r.ts)
    t = scan.scan_table(cells, _wide(n)).withColumn("ms", F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', at)"))
    got = {r.k: r for r in t.collect()}
    assert set(got) == set(newest)
    for k, cell in newest.items():
        assert got[k].ms == at[k]
        for q in mapped:
            want = cell.get(q)
            assert got[k][q] == (int(want[3]) if want and want[2] else None), (k, q)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "max(_s" not in plan


def test_rows_of_many_cells_are_dealt(spark, monkeypatch, tmp_path):
    """One file, one task: the rows of a wide table go to as many tasks as their cells need."""
    spark.range(3000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 70).alias("l_partkey"),
        (F.col("id") % 9).alias("l_suppkey"), (F.col("id") % 50 + 1).cast("double").alias("l_quantity")).coalesce(1).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    few = tc.wide_rows(spark, str(tmp_path))
    monkeypatch.setattr(tc, "TASK_CELLS", 10_000)
    many = tc.wide_rows(spark, str(tmp_path))
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 15
    assert sorted(few.collect()) == sorted(many.collect())


def test_wide_customer_cells_come_from_many_tasks(spark, monkeypatch, tmp_path):
    """Cells of few bytes on disk are not made and sorted by one task."""
    from cellwise.plans import edges
    spark.range(2000).select(
        F.col("id").alias("c_custkey"), F.format_string("Customer#%d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        F.col("id").cast("double").alias("c_acctbal"), F.lit("X").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(tc, "TASK_CELLS", 4_000)
    t = edges._null_newest(spark, str(tmp_path), 10)
    assert "REPARTITION_BY_NUM" in t._jdf.queryExecution().executedPlan().toString()
    got = {r.k: (r.c0, r.c3, r.c9) for r in t.collect()}
    assert got == {f"{i:010d}": (f"Customer#{i}/0", None if i % 25 % 3 == 0 else f"Customer#{i}/3", f"Customer#{i}/9") for i in range(2000)}


def test_hot_row_takes_each_cell_once(spark):
    """Versions of one cell in several pieces meet before the row is put together; scalars
    and rows without map cells stay."""
    cells = spark.range(6000).repartition(6, "id").select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise("only").alias("row_key"),
        F.when(F.col("id") % 2 == 0, "m").otherwise("s").alias("family"),
        F.when(F.col("id") % 2 == 0, F.format_string("q%d", F.col("id") % 14)).otherwise(F.lit("x")).alias("qualifier"),
        F.col("id").alias("ts"), F.lit(0).cast("bigint").alias("seq"), F.col("id").cast("string").cast("binary").alias("value"))
    m = Mapping.parse(":key,m:,s:x", ["key", "all", "x"], ["string", "map<string,bigint>", "bigint"])
    t = scan.scan_table(cells, m, hot_cells=100)
    got = {r.key: (r["all"], r.x) for r in t.collect()}
    want = {}
    for i in range(0, 6000, 2):
        want[f"q{i % 14}"] = i
    assert got == {"hot": (want, None), "only": ({}, 5999)}
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "max(_c" in plan


def test_write_tasks_and_buckets_grow_with_cells(spark, monkeypatch, tmp_path):
    """Files of cells are small on disk: tasks and buckets go by the number of cells."""
    from cellwise.sources import store as st
    monkeypatch.setattr(st, "TASK_CELLS", 500)
    assert st.buckets_for(100) == 8 and st.buckets_for(500 * 20 + 1) == 21
    rows = spark.range(4000).select(F.format_string("k%05d", "id").alias("key"), F.col("id").alias("a"), (F.col("id") * 2).alias("b"))
    m = Mapping.parse(":key,f:a,f:b", ["key", "a", "b"], ["string", "bigint", "bigint"])
    for mode in ("split", "range"):
        store = st.CellStore(spark, f"{tmp_path}/{mode}")
        store.write_table(rows, m, ts=1, points=[], mode=mode)
        files = store.read().select(F.input_file_name().alias("f")).groupBy("f").count().collect()
        assert len(files) >= 14 and max(r["count"] for r in files) <= 1000
        assert sorted((r.key, r.a, r.b) for r in scan.scan_table(store.read(), m).collect()) == [(f"k{i:05d}", i, 2 * i) for i in range(4000)]
