"""Benchmark: bulk writes and reads of the cell store, plus headline queries.

Prints one JSON line.  Times are the better of two runs; ``cold`` holds the first
run of each.  Inputs are read from Parquet in every run, nothing is cached; reads
end in a sink that drops the rows, except ``export_orc_wide``, which writes the
50-column table as ORC.  ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
``BENCH_CPUS`` (default 8) pick the data and ``local[N]``.  Ratios worth
full read vs column subset vs key range.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))



from pyspark.sql import functions as F  # noqa: E402

from cellwise.operators import scan  # noqa: E402
from cellwise.operators.predicates import time_range  # noqa: E402
from cellwise.operators.regions import uniform_split_points  # noqa: E402
from cellwise.operators.upsert import upsert_cells  # noqa: E402
from cellwise.plans import QUERIES  # noqa: E402
from cellwise.plans import testcells as tc  # noqa: E402
from cellwise.plans.storage import li_points  # noqa: E402
from cellwise.session import get_spark, scratch_path  # noqa: E402
from cellwise.sources.store import CellStore, export_table  # noqa: E402


def run(df) -> None:
    """Execute fully without collecting (noop sink)."""
    df.write.format("noop").mode("overwrite").save()


class Times(dict):
    """Seconds by name: the best of two runs, and in ``cold`` the first of them."""

    def __init__(self):
        super().__init__()
        self.cold = {}

    def timed(self, name, fn, repeat: int = 2):
        runs, out = [], None
        for _ in range(repeat):
            t = time.perf_counter()
            out = fn()
            runs.append(time.perf_counter() - t)
        self[name], self.cold[name] = min(runs), runs[0]
        return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", "cellwise-bench",
                      **{"spark.sql.shuffle.partitions": str(max(8, cpus)),
                         "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf = sf_dir.rsplit("sf", 1)[-1]

    # warm the JVM on the smallest data set (not timed)
    run(QUERIES["latest_user_state"](spark, "/root/testdata/sf0.001"))

    q = Times()
    n_cells = tc.li_cells(spark, sf_dir).count()
    pts8 = li_points(spark, sf_dir)
    pts32 = uniform_split_points(tc.load(spark, sf_dir, "lineitem"), "l_orderkey", 32, 10)

    def write_li(name, buckets=None, **kw):
        st = CellStore(spark, scratch_path(spark, f"bench-{name}"), buckets=buckets)
        st.write_table(tc.li_rows(spark, sf_dir), tc.LI_MAPPING, ts=tc.CU_WRITE_TS,
                       seq=F.col("li_seq"), **kw)
        return st                                          # a fresh table per run

    stores = {name: q.timed(name, lambda name=name, kw=kw: write_li(name, **kw)) for name, kw in (
        ("write_exact_1region", dict(points=[], mode="exact")),
        ("write_exact_8regions", dict(points=pts8, mode="exact")),
        ("write_split_8regions", dict(points=pts8, mode="split")),
        ("write_range_8regions", dict(points=pts8, mode="range")),
        ("write_split_32regions", dict(points=pts32, mode="split")),
        ("write_hash_8regions", dict(points=pts8, mode="hash")),
        ("write_bucketed_8", dict(buckets=8)))}

    st = stores["write_split_8regions"]
    q.timed("read_full", lambda: run(scan.scan_table(st.read(), tc.LI_MAPPING)))
    q.timed("read_2_columns", lambda: run(
        scan.scan_table(st.read(), tc.LI_MAPPING, ["qty", "status"], projected_only=True)))
    lo, hi = pts8[2], pts8[3]
    q.timed("read_key_range", lambda: run(scan.scan_table(st.read(key_lo=lo, key_hi=hi), tc.LI_MAPPING)))
    q.timed("read_keys_only", lambda: run(scan.scan_keys(st.read())))
    stb = stores["write_bucketed_8"]
    q.timed("read_full_bucketed", lambda: run(scan.scan_table(stb.read(bucketed=True), tc.LI_MAPPING)))

    # the reference's own benchmark shape: 50 text columns of 1-50 characters
    n_wide = tc.load(spark, sf_dir, "lineitem").count()

    def write_wide():
        stw = CellStore(spark, scratch_path(spark, "bench-wide"))
        stw.write_table(tc.wide_rows(spark, sf_dir), tc.WIDE_MAPPING, ts=tc.CU_WRITE_TS,
                        seq=F.col("li_seq"), points=pts8)
        return stw
    stw = q.timed("write_wide_50cols_split8", write_wide)
    q.timed("read_wide_50cols_full", lambda: run(scan.scan_table(stw.read(), tc.WIDE_MAPPING)))
    q.timed("read_wide_2cols", lambda: run(
        scan.scan_table(stw.read(), tc.WIDE_MAPPING, ["c01", "c02"], projected_only=True)))
    q.timed("export_orc_wide", lambda: export_table(
        stw.read(), tc.WIDE_MAPPING, scratch_path(spark, "bench-orc"), fmt="orc"), repeat=1)

    q.timed("flagship_latest_user_state", lambda: run(QUERIES["latest_user_state"](spark, sf_dir)))
    ev = tc.ev_cells(spark, sf_dir)
    q.timed("upsert_events", lambda: run(upsert_cells(
        time_range(ev, hi_ms=1705276800000), time_range(ev, lo_ms=1705276800000))))
    q.timed("versions_top3", lambda: run(scan.scan_versions(ev, 3)))
    q.timed("family_map", lambda: run(scan.scan_family_map(ev, "e", "string", "double")))

    total = sum(q.values())
    out = {
        "metric": "cellwise_bench_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "cold": {k: round(v, 3) for k, v in q.cold.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cells_written": n_cells,
        "write_cells_per_sec_split8": round(n_cells / q["write_split_8regions"]),
        "read_cells_per_sec_full": round(n_cells / q["read_full"]),
        "wide_rows": n_wide,
        "wide_write_rows_per_sec": round(n_wide / q["write_wide_50cols_split8"]),
        "wide_read_rows_per_sec": round(n_wide / q["read_wide_50cols_full"]),
        "ratios": {
            "hash_over_split_write": round(q["write_hash_8regions"] / q["write_split_8regions"], 3),
            "range_over_split_write": round(q["write_range_8regions"] / q["write_split_8regions"], 3),
            "exact8_over_exact1_write": round(q["write_exact_8regions"] / q["write_exact_1region"], 3),
            "two_columns_over_full_read": round(q["read_2_columns"] / q["read_full"], 3),
            "key_range_over_full_read": round(q["read_key_range"] / q["read_full"], 3),
            "bucketed_over_region_full_read": round(q["read_full_bucketed"] / q["read_full"], 3),
        },
        "cpus": cpus,
    }
    print(json.dumps(out))



if __name__ == "__main__":
    main()
