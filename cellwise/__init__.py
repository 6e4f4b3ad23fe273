"""cellwise — versioned wide-column cell tables on Spark DataFrames.

Cells ``(row_key, family, qualifier, ts, seq, value)`` ⇄ typed rows, key and
time-range reads, region-partitioned bulk writes with an atomic publish,
snapshots and data-quality reports.  Joins, aggregates, sorts and SQL on top
are Spark's own.
"""
from .mapping import CELL_DDL, Field, Mapping, MappingError
from .operators.encode import table_to_cells
from .operators.predicates import (as_of, binary_key_range, composite_key_filter, key_eq,
                                   key_range, row_filter, time_range)
from .operators.scan import (latest, row_count, scan_family_map, scan_keys, scan_prefix_map,
                             scan_table, scan_versions)
from .operators.upsert import upsert_cells
from .sources.store import CellStore, export_table, multi_insert

__all__ = [
    "CELL_DDL", "Field", "Mapping", "MappingError", "table_to_cells", "as_of",
    "binary_key_range", "composite_key_filter", "key_eq", "key_range", "row_filter", "time_range",
    "latest", "row_count", "scan_family_map", "scan_keys", "scan_prefix_map", "scan_table",
    "scan_versions", "upsert_cells", "CellStore", "export_table", "multi_insert",
]
