"""Delimited text rows → cells.

Each line is ``key<sep>v1<sep>v2...`` for a given list of qualifiers: a
missing trailing field is written as the empty string, a field equal to the
null sequence writes no cell.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..mapping import DEFAULT_NULL_FORMAT


def _reason(parts, qualifiers: Sequence[str]):
    """Why a line is not loaded: NULL for a good one."""
    return (F.when(parts.isNull() | (F.element_at(parts, 1) == ""), "empty key")
            .when(F.size(parts) > len(qualifiers) + 1, "too many fields"))


def lines_to_cells(lines: DataFrame, family: str, qualifiers: Sequence[str], *,
                   sep: str = "\x01", ts: int = 0, seq: int = 0,
                   null_format: str = DEFAULT_NULL_FORMAT, line_col: str = "value",
                   strict: bool = True) -> DataFrame:
    """``lines`` has one string column of text rows (as ``spark.read.text``).
    A line with an empty key or more fields than qualifiers raises, or with
    ``strict=False`` is left out and returned by :func:`line_rejects`."""
    if not family:
        raise ValueError("a column family is required")
    parts = F.split(F.col(line_col), _re(sep), -1)
    reason = _reason(parts, qualifiers)
    cells = F.array(*[
        F.struct(F.lit(q).alias("qualifier"),
                 F.coalesce(F.try_element_at(parts, F.lit(i + 2)), F.lit("")).alias("text"))
        for i, q in enumerate(qualifiers)
    ])
    key = F.element_at(parts, 1)
    if strict:
        key = F.when(reason.isNull(), key).otherwise(F.raise_error(
            F.concat(F.lit("bad line, "), reason, F.lit(": "), F.coalesce(F.col(line_col), F.lit("NULL")))).cast("string"))
    else:
        lines = lines.where(reason.isNull())
    out = lines.select(key.alias("row_key"), F.inline(cells))
    return (out.where(F.col("text") != F.lit(null_format))
            .select("row_key", F.lit(family).alias("family"), "qualifier",
                    F.lit(int(ts)).cast("bigint").alias("ts"),
                    F.lit(int(seq)).cast("bigint").alias("seq"),
                    F.col("text").cast("binary").alias("value")))


def line_rejects(lines: DataFrame, qualifiers: Sequence[str], *, sep: str = "\x01",
                 line_col: str = "value") -> DataFrame:
    """The lines that are not loaded, with a ``reason``."""
    return (lines.withColumn("reason", _reason(F.split(F.col(line_col), _re(sep), -1), qualifiers))
            .where(F.col("reason").isNotNull()))


def text_to_cells(spark: SparkSession, path: str, family: str, qualifiers: Sequence[str],
                  **kw) -> DataFrame:
    return lines_to_cells(spark.read.text(path), family, qualifiers, **kw)


def cells_to_lines(rows: DataFrame, columns: Sequence[str], sep: str = "\x01",
                   null_format: str = DEFAULT_NULL_FORMAT) -> DataFrame:
    """Typed rows → text lines (NULL as the null sequence), e.g. to stage a
    text source."""
    return rows.select(F.concat_ws(sep, *[
        F.coalesce(F.col(c).cast("string"), F.lit(null_format)) for c in columns]).alias("value"))


def _re(sep: str) -> str:
    import re
    return re.escape(sep)


__all__ = ["lines_to_cells", "line_rejects", "text_to_cells", "cells_to_lines"]
