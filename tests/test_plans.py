"""Physical plan checks: pruning and pushdown reach the scan, pivots use
partial aggregation, version top-n is limited before the shuffle."""
from cellwise.operators import scan
from cellwise.operators.predicates import key_range
from cellwise.plans import testcells as tc
from conftest import SF_SMALL


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_becomes_pushed_cell_filter(spark, tmp_path):
    path = str(tmp_path / "cells")
    tc.or_cells(spark, SF_SMALL).write.parquet(path)
    cells = spark.read.parquet(path)
    p = plan(scan.scan_table(cells, tc.OR_MAPPING, ["status"], projected_only=True))
    pushed = p.split("PushedFilters")[1][:400]
    assert "family" in pushed and "qualifier" in pushed


def test_key_range_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "cells")
    tc.or_cells(spark, SF_SMALL).write.parquet(path)
    p = plan(scan.scan_table(key_range(spark.read.parquet(path), "000000000100", "000000000200"),
                             tc.OR_MAPPING))
    pushed = p.split("PushedFilters")[1][:400]
    assert "GreaterThanOrEqual(row_key,000000000100)" in pushed
    assert "LessThan(row_key,000000000200)" in pushed


def test_pivot_is_partial_then_final(spark):
    p = plan(scan.scan_table(tc.ev_cells(spark, SF_SMALL), tc.EV_MAPPING))
    assert p.count("Exchange hashpartitioning(row_key") == 1
    assert "partial_max(" in p


def test_versions_group_limit_before_shuffle(spark):
    p = plan(scan.scan_versions(tc.ev_cells(spark, SF_SMALL), 3))
    before_exchange = p.split("Exchange")[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_composite_prefix_pushed_to_parquet(spark, tmp_path):
    from cellwise.operators.predicates import composite_key_filter
    path = str(tmp_path / "li")
    tc.li_cells(spark, SF_SMALL).write.parquet(path)
    df = composite_key_filter(spark.read.parquet(path), tc.LI_KEY, equal=[("orderkey", "0000000042")])
    pushed = plan(df).split("PushedFilters")[1][:500]
    assert "StringStartsWith(row_key,0000000042$$)" in pushed


def test_d4_broadcasts_only_under_the_session_bound(spark):
    from cellwise.plans.relational import d4_join_strategies
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(d4_join_strategies(spark, SF_SMALL))
        assert "BroadcastHashJoin" not in p and p.count("SortMergeJoin") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_map_cells_cross_one_exchange(spark):
    def final(df):
        df.collect()
        return plan(df).split("Initial Plan")[0]

    ev = tc.ev_cells(spark, SF_SMALL)
    p = final(scan.scan_family_map(ev, "e", "string", "double"))
    assert p.count("Exchange hashpartitioning") == 1 and "partial_collect_list(_cell" in p
    # with rows above the bound, both ways read the same exchange of packed cells
    p = final(scan.scan_family_map(ev, "e", "string", "double", hot_cells=5))
    assert "ReusedExchange" in p and p.count("partial_collect_list(_cell") == 1
