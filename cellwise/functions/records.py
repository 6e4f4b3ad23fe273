"""Structured (record) cells with a reader schema.

Cells hold JSON records.  They are read with a *reader* schema: a field the
writer did not know takes the reader's default, a field the reader does not
know is dropped.  The schema may be given directly, by a callable, or by a
path holding its DDL text; it is resolved once, on the driver.
"""
from __future__ import annotations

from typing import Mapping as TMapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..mapping import as_type


def resolve_schema(spark: SparkSession, schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    if callable(schema):
        return resolve_schema(spark, schema())
    if isinstance(schema, str) and (schema.startswith("/") or "://" in schema
                                    or schema.startswith("file:")):
        ddl = " ".join(r[0] for r in spark.read.text(schema, wholetext=True).collect())
        return resolve_schema(spark, " ".join(ddl.split()))
    if isinstance(schema, str):
        return as_type(schema if schema.lower().startswith("struct<") else f"struct<{schema}>")
    raise TypeError(f"cannot resolve a schema from {schema!r}")


_CORRUPT = "_cw_corrupt"


def _parsed(value: Column, schema: T.StructType) -> Column:
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(value.cast("string"), with_corrupt,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def decode_record(value: Column, schema: T.StructType,
                  defaults: TMapping[str, object] | None = None) -> Column:
    """JSON text → struct under ``schema``; fields the text lacks take
    ``defaults``, an explicit null stays NULL, and text that is not a JSON
    object, or does not fit the schema, reads as a NULL record."""
    text = value.cast("string")
    parsed = _parsed(value, schema)
    present = F.json_object_keys(text)
    fields = []
    for f in schema.fields:
        c = parsed[f.name]
        if f.name in (defaults or {}):
            c = F.when(F.array_contains(present, F.lit(f.name)), c).otherwise(
                F.lit(defaults[f.name]).cast(f.dataType))
        fields.append(c.alias(f.name))
    return F.when(parsed[_CORRUPT].isNull() & present.isNotNull(), F.struct(*fields))


def malformed_records(cells: DataFrame, family: str, qualifier: str, schema) -> DataFrame:
    """The cells whose text :func:`decode_record` reads as a NULL record."""
    st = resolve_schema(cells.sparkSession, schema)
    mine = cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier) & F.col("value").isNotNull())
    return mine.where(decode_record(F.col("value"), st).isNull())


def decode_records(cells: DataFrame, family: str, qualifier: str, schema,
                   defaults: TMapping[str, object] | None = None,
                   name: str = "record") -> DataFrame:
    """(row_key, record) from the newest ``family:qualifier`` cell per row."""
    from ..operators.scan import latest
    st = resolve_schema(cells.sparkSession, schema)
    newest = latest(cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier)))
    return newest.select("row_key", decode_record(F.col("value"), st, defaults).alias(name))


def encode_record(col: Column) -> Column:
    return F.to_json(col, {"ignoreNullFields": "false"}).cast("binary")


__all__ = ["resolve_schema", "decode_record", "malformed_records", "decode_records", "encode_record"]

