"""Write PLANS.md: the physical plans of the hot paths, so pushdown, pruning,
partial aggregation and shuffles can be read without running anything.

    python tools/show_plans.py [sf_dir]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cellwise.operators import scan  # noqa: E402
from cellwise.operators.predicates import composite_key_filter, time_range  # noqa: E402
from cellwise.operators.upsert import upsert_cells  # noqa: E402
from cellwise.plans import QUERIES  # noqa: E402
from cellwise.plans import testcells as tc  # noqa: E402
from cellwise.plans.storage import li_points  # noqa: E402
from cellwise.session import get_spark, scratch_path  # noqa: E402
from cellwise.sources.store import CellStore  # noqa: E402


def physical(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "400")
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", "cellwise-plans", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    st = CellStore(spark, scratch_path(spark, "plans-region"))
    st.write(tc.li_cells(spark, sf), points=li_points(spark, sf))
    stb = CellStore(spark, scratch_path(spark, "plans-bucketed"), buckets=8)
    stb.write(tc.li_cells(spark, sf))
    pts = li_points(spark, sf)
    ev = tc.ev_cells(spark, sf)
    cases = [
        ("Flagship: pivot of the events cells (A1/E6/A6)",
         "One exchange on row_key; partial aggregation before it.",
         QUERIES["latest_user_state"](spark, sf)),
        ("Projected read from the region store (A2)",
         "family= directory pruning (PartitionFilters) and qualifier IN pushed to Parquet.",
         scan.scan_table(st.read(), tc.LI_MAPPING, ["qty", "status"], projected_only=True)),
        ("Key-range read from the region store (C2)",
         "Region pruning from the split points plus row_key bounds pushed to Parquet.",
         scan.scan_table(st.read(key_lo=pts[2], key_hi=pts[3]), tc.LI_MAPPING)),
        ("Full read from the bucketed store (A1, bucketed layout)",
         "Bucketed scan: partial and final aggregation in one stage, no Exchange.",
         scan.scan_table(stb.read(bucketed=True), tc.LI_MAPPING)),
        ("Composite-key prefix (C6)",
         "Leading-field equality becomes StringStartsWith on row_key in PushedFilters.",
         composite_key_filter(st.read(), tc.LI_KEY, equal=[("orderkey", "0000000042")])),
        ("Composite-key range (C6, K1)",
         "Comparisons on the first key field become row_key bounds in PushedFilters.",
         composite_key_filter(st.read(), tc.LI_KEY, ranges=[("orderkey", ">=", "0000001000"),
                                                            ("orderkey", "<", "0000003000")])),
        ("Newest 3 versions per cell (A10)",
         "WindowGroupLimit Partial runs before the exchange: at most 3 rows per cell per task.",
         scan.scan_versions(ev, 3)),
        ("Time range before the version choice, then upsert (C4, B4)",
         "The ts filter sits below the aggregate; the upsert is one partial + final aggregate.",
         upsert_cells(time_range(ev, hi_ms=1705276800000), time_range(ev, lo_ms=1705276800000))),
        ("Bulk-write exchange, split mode (B8)",
         "repartitionById on region*k + hash(cell) % k, then a sort the writer reuses.",
         tc.li_cells(spark, sf).withColumn("region", F.lit(0))
         .repartitionById(16, (F.col("region") * 2 + F.pmod(F.xxhash64("row_key", "qualifier"),
                                                            F.lit(2))).cast("int"))
         .sortWithinPartitions("family", "region", "row_key", "qualifier", F.col("ts").desc())),
    ]
    out = ["# Physical plans of the hot paths",
           "",
           f"Generated by `python tools/show_plans.py` on `{sf}` (local[8], AQE on; the",
           "plans are the initial adaptive plans).", ""]
    for title, note, df in cases:
        out += [f"## {title}", "", note, "", "```", physical(df).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
