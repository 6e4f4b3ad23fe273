"""Epoch-millisecond conversions that do not depend on the session time zone
for ``timestamp_ntz`` input."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(col: str | Column, dtype: T.DataType) -> Column:
    """ms since the epoch of a ``timestamp``, ``timestamp_ntz``, ``date`` or integer."""
    c = _col(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.expr(_NTZ_EPOCH), c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(dtype, T.DateType):
        return F.timestamp_diff("MILLISECOND", F.expr(_NTZ_EPOCH), c.cast("timestamp_ntz"))
    return c.cast("bigint")


def millis_to_ntz(col: str | Column) -> Column:
    """Epoch ms → ``timestamp_ntz`` (wall clock in UTC, no session-zone shift)."""
    return F.timestamp_add("MILLISECOND", _col(col), F.expr(_NTZ_EPOCH))


def millis_to_timestamp(col: str | Column, dtype: T.DataType) -> Column:
    c = _col(col)
    if isinstance(dtype, T.LongType):
        return c
    if isinstance(dtype, T.TimestampNTZType):
        return millis_to_ntz(c)
    return F.timestamp_millis(c)


def df_epoch_millis(df, name: str) -> Column:
    return epoch_millis(name, df.schema[name].dataType)


__all__ = ["epoch_millis", "millis_to_ntz", "millis_to_timestamp", "df_epoch_millis"]
