"""Row-key and time-range predicates on cells, applied before the pivot.

Key predicates on ``row_key`` pass straight into the Parquet scan
(``PushedFilters``) and, for stores written by region, prune region
directories (``PartitionFilters``).  Time ranges act on cells before versions
are chosen, so they change *which* version a read sees.
"""
from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KeyCodec

_OPS = ("=", "<", "<=", ">", ">=")


def key_predicate(op: str, value, col: str = "row_key") -> Column:
    c = F.col(col)
    v = value if isinstance(value, Column) else F.lit(value)
    return {"=": c == v, "<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[op]


def key_eq(cells: DataFrame, key) -> DataFrame:
    """Point lookup."""
    return cells.where(F.col("row_key") == (key if isinstance(key, Column) else F.lit(key)))


def key_range(cells: DataFrame, lo=None, hi=None, lo_inclusive: bool = True,
              hi_inclusive: bool = False) -> DataFrame:
    """Row keys between ``lo`` and ``hi`` in unsigned byte order.
    Either bound may be ``None`` or a Column expression; lo > hi yields nothing."""
    conds = []
    if lo is not None:
        conds.append(key_predicate(">=" if lo_inclusive else ">", lo))
    if hi is not None:
        conds.append(key_predicate("<=" if hi_inclusive else "<", hi))
    return cells.where(reduce(and_, conds)) if conds else cells


def key_op(cells: DataFrame, op: str, value) -> DataFrame:
    if op not in _OPS:
        raise ValueError(f"operator must be one of {_OPS}")
    return cells.where(key_predicate(op, value))


def binary_key_range(cells: DataFrame, dtype, lo=None, hi=None, lo_inclusive: bool = False,
                     hi_inclusive: bool = False, decoded: str = "_key") -> DataFrame:
    """Range on a binary-stored numeric key.

    The typed predicate on the decoded key is always applied.  Byte bounds on
    ``row_key`` are added only when both bounds have the same sign: two's
    complement bytes sort negatives after positives, so a mixed-sign byte range
    would be wrong.
    """
    from ..functions.codec import decode_binary, encode_binary
    key = decode_binary(F.col("row_key").cast("binary"), dtype)
    conds = []
    if lo is not None:
        conds.append(key >= lo if lo_inclusive else key > lo)
    if hi is not None:
        conds.append(key <= hi if hi_inclusive else key < hi)
    same_sign = lo is not None and hi is not None and (lo >= 0) == (hi >= 0)
    if same_sign:
        rk = F.col("row_key").cast("binary")
        conds.append(rk >= encode_binary(F.lit(lo), dtype))
        conds.append(rk <= encode_binary(F.lit(hi), dtype))
    return cells.where(reduce(and_, conds)) if conds else cells


def time_predicate(op: str, t_ms: int, col: str = "ts") -> Column:
    """Half-open millisecond ranges: ``=`` → [t, t+1), ``<`` → [0, t),
    ``<=`` → [0, t+1), ``>`` → [t+1, ∞), ``>=`` → [t, ∞)."""
    c = F.col(col)
    t = int(t_ms)
    return {
        "=": (c >= t) & (c < t + 1),
        "<": (c >= 0) & (c < t),
        "<=": (c >= 0) & (c < t + 1),
        ">": c >= t + 1,
        ">=": c >= t,
    }[op]


def time_range(cells: DataFrame, lo_ms: int | None = None, hi_ms: int | None = None) -> DataFrame:
    """Cells with lo ≤ ts < hi (C4), before versions are chosen."""
    conds = []
    if lo_ms is not None:
        conds.append(F.col("ts") >= int(lo_ms))
    if hi_ms is not None:
        conds.append(F.col("ts") < int(hi_ms))
    return cells.where(reduce(and_, conds)) if conds else cells


def time_op(cells: DataFrame, op: str, t_ms: int) -> DataFrame:
    return cells.where(time_predicate(op, t_ms))


def as_of(cells: DataFrame, t_ms: int) -> DataFrame:
    """The table as it was at ``t_ms`` (C5): cells written at or before it."""
    return cells.where(time_predicate("<=", t_ms))


def row_filter(cells: DataFrame, preds: Sequence[Column]) -> DataFrame:
    """All of ``preds`` must hold."""
    return cells.where(reduce(and_, preds)) if preds else cells


def composite_key_filter(cells: DataFrame, key_codec: KeyCodec,
                         equal: Sequence[tuple[str, object]] = (),
                         residual: Column | None = None,
                         ranges: Sequence[tuple[str, str, object]] = ()) -> DataFrame:
    """Filter on decoded composite-key fields.

    ``equal`` lists leading fields compared with ``=``, in key order; they
    become a row-key prefix filter (pushed into the scan).  ``ranges`` lists
    ``(field, op, value)`` comparisons with ``=, <, <=, >, >=`` on any field;
    those on the field after the equal ones become row-key bounds where the
    codec has them.  ``residual`` is any predicate on the decoded struct,
    referenced as column ``key``.  The decoded predicates are always kept, so
    prefix and bounds are only extras that prune.
    """
    names = [f.name for f in key_codec.struct_type.fields]
    for i, (n, _) in enumerate(equal):
        if i >= len(names) or names[i] != n:
            raise ValueError("equal fields must be the leading key fields, in order")
    for n, op, _ in ranges:
        if n not in names or op not in _OPS:
            raise ValueError(f"cannot compare key field {n!r} with {op!r}")
    out = cells
    values = [v for _, v in equal]
    if equal and key_codec.prefix is not None:
        p = key_codec.prefix(values)
        if p is not None:
            out = out.where(F.col("row_key").startswith(p))
    following = names[len(equal)] if len(equal) < len(names) else None
    ops = [(op, v) for n, op, v in ranges if n == following]
    if (ops or equal) and key_codec.bounds is not None:
        lo, hi = key_codec.bounds(values, ops)
        if lo is not None:
            out = out.where(F.col("row_key") >= lo)
        if hi is not None:
            out = out.where(F.col("row_key") <= hi)
    decoded = key_codec.decode(F.col("row_key"))
    conds = [decoded[n] == F.lit(v) for n, v in equal] + [_compare(decoded[n], op, v) for n, op, v in ranges]
    if residual is not None:
        return out.withColumn("key", decoded).where(reduce(and_, [*conds, residual])).drop("key")
    return out.where(reduce(and_, conds)) if conds else out


def _compare(c: Column, op: str, value) -> Column:
    return {"=": c == value, "<": c < value, "<=": c <= value, ">": c > value, ">=": c >= value}[op]


__all__ = ["binary_key_range", "key_eq", "key_range", "key_op", "key_predicate", "time_range", "time_op",
           "time_predicate", "as_of", "row_filter", "composite_key_filter"]
