"""Writes, second half: merging cells.  A put never deletes: the newest
version of each cell wins, by (ts, seq)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from .scan import latest

CELL_ORDER = ("row_key", "family", "qualifier", "ts", "seq", "value")


def union_cells(*frames: DataFrame) -> DataFrame:
    frames = [f.select(*CELL_ORDER) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), frames)


def upsert_cells(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new cells merged into one version per cell.

    A new cell with an older timestamp than the stored one loses (late data);
    a cell the new batch does not carry is kept (an overwrite never truncates).
    """
    return latest(union_cells(old, new)).select(*CELL_ORDER)


__all__ = ["upsert_cells", "union_cells", "CELL_ORDER"]
