"""Writes, first half: typed rows → cells (encode + unpivot).

One narrow job: every input row becomes its non-NULL cells through
``inline`` over an array of (family, qualifier, value) structs, no shuffle.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec
from ..functions.registry import get_codec
from ..functions.time import epoch_millis
from ..mapping import Field, Mapping

_COMPLEX = (T.ArrayType, T.MapType, T.StructType)


def encode_field(col: Column, f: Field, m: Mapping, src_type: T.DataType | None = None) -> Column:
    """One column value → cell bytes (NULL stays NULL)."""
    if f.codec:
        return get_codec(f.codec).encode(col)
    if src_type is not None and isinstance(src_type, _COMPLEX) and not isinstance(f.dtype, _COMPLEX):
        return codec.encode_json(col)          # complex value into a primitive column
    return codec.encode_value(col, f.dtype, f.storage,
                              null_format=m.null_format, separators=m.separators, escape=m.escape)


def encode_key(col: Column, m: Mapping) -> Column:
    k = m.key
    if m.key_codec is not None:
        return m.key_codec.encode(col)
    if k.storage == "binary" and not isinstance(k.dtype, T.StringType):
        return codec.encode_binary(col, k.dtype)
    if isinstance(k.dtype, T.BinaryType):
        return col
    return col.cast("string")


def strict_key(col: Column, m: Mapping) -> Column:
    """The row key; raises where it is NULL or empty."""
    key = encode_key(col, m)
    return (F.when(F.octet_length(key) > 0, key)
            .otherwise(F.raise_error(F.when(key.isNull(), "NULL row key").otherwise("empty row key"))
                       .cast(key_type(m))))


def _map_key_text(k: Column, f: Field) -> Column:
    kt = f.dtype.keyType
    if f.key_storage == "binary":
        q = codec.encode_binary(k, kt).cast("string")
    else:
        q = k.cast("string")
    if f.role == "prefix" and f.hide_prefix:
        q = F.concat(F.lit(f.qualifier), q)
    return q


def _entry_to_cell(f: Field, m: Mapping):
    """Map entry → (family, qualifier, value) struct; a one-argument lambda,
    as ``transform`` reads a second argument as the element index."""
    vf = Field("v", f.dtype.valueType, "column", f.family, "v", storage=f.storage)

    def cell(e: Column) -> Column:
        return F.struct(F.lit(f.family).alias("family"),
                        _map_key_text(e["key"], f).alias("qualifier"),
                        encode_field(e["value"], vf, m).alias("value"))
    return cell


def table_to_cells(
    df: DataFrame,
    m: Mapping,
    ts: int | Column | None = None,
    seq: int | Column = 0,
    *,
    strict_keys: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Cells of every mapped, non-NULL value of ``df`` (B1) with a write
    timestamp (B2): ``ts`` if given (ms or a Column), else the mapping's
    ``:timestamp`` column, else the current time.

    A NULL or empty row key raises (``strict_keys``) or leaves the row out;
    :func:`key_rejects` returns the rows that are left out.  ``carry`` names
    columns of ``df`` that every cell of a row takes along.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    key = strict_key(F.col(m.key.name), m) if strict_keys else encode_key(F.col(m.key.name), m)
    tsf = m.timestamp
    if ts is not None:
        ts_col = ts if isinstance(ts, Column) else F.lit(int(ts))
    elif tsf is not None and tsf.name in schema:
        ts_col = F.coalesce(epoch_millis(tsf.name, schema[tsf.name]),
                            F.unix_millis(F.current_timestamp()))
    else:
        ts_col = F.unix_millis(F.current_timestamp())
    seq_col = seq if isinstance(seq, Column) else F.lit(int(seq))

    scalar_fields = [f for f in m.cell_fields if f.name in schema]
    map_fields = [f for f in m.map_fields if f.name in schema]
    if scalar_fields and not map_fields:
        return _unpivot_cells(df, m, scalar_fields, key, ts_col, seq_col, schema, strict_keys, carry)

    arrays = []
    scalars = [
        F.struct(F.lit(f.family).alias("family"), F.lit(f.qualifier).alias("qualifier"),
                 encode_field(F.col(f.name), f, m, schema.get(f.name)).alias("value"))
        for f in m.cell_fields if f.name in schema
    ]
    if scalars:
        arrays.append(F.array(*scalars))
    for f in m.map_fields:
        if f.name not in schema:
            continue
        arrays.append(F.transform(F.map_entries(F.col(f.name)), _entry_to_cell(f, m)))
    allc = arrays[0] if len(arrays) == 1 else F.concat(*[F.coalesce(a, F.array().cast(
        "array<struct<family:string,qualifier:string,value:binary>>")) for a in arrays])
    # key, ts and seq are computed once per row, before the rows fan out to cells
    pre = df.select(key.alias("row_key"), ts_col.cast("bigint").alias("ts"),
                    seq_col.cast("bigint").alias("seq"), allc.alias("_cells"), *carry)
    out = (pre.select("row_key", "ts", "seq", *carry, F.inline("_cells"))
           .where(F.col("value").isNotNull()))
    if not strict_keys:
        out = out.where(F.octet_length("row_key") > 0)
    return out.select("row_key", "family", "qualifier", "ts", "seq", "value", *carry)


def key_rejects(df: DataFrame, m: Mapping) -> DataFrame:
    """The rows of ``df`` whose row key is NULL or empty, with a ``reason``:
    those that ``table_to_cells(strict_keys=False)`` leaves out."""
    key = encode_key(F.col(m.key.name), m)
    return (df.withColumn("reason", F.when(key.isNull(), "null").when(F.octet_length(key) == 0, "empty"))
            .where(F.col("reason").isNotNull()))


def _unpivot_cells(df, m, fields, key, ts_col, seq_col, schema, strict_keys, carry) -> DataFrame:
    """Scalar columns only: encode each column once, then one cell for each element of
    the array of them. Rows that lie in tasks by row key still do as cells, which an
    ``unpivot`` would not let Spark know."""
    if len(fields) <= FEW_FIELDS and all(_keeps_nulls(f, schema[f.name]) for f in fields):
        return _few_cells(df, m, fields, key, ts_col, seq_col, schema, strict_keys, carry)
    enc = [encode_field(F.col(f.name), f, m, schema.get(f.name)) for f in fields]
    # let: a row's columns are not compiled into one method with its cells, which Java
    # would not compile; outer: Spark adds no filter that makes the array once more
    pre = df.select(key.alias("row_key"), ts_col.cast("bigint").alias("ts"), seq_col.cast("bigint").alias("seq"), *carry,
                    codec.let(F.array(*enc), lambda a: a).alias("_a"))
    out = (pre.select("row_key", "ts", "seq", *carry, F.posexplode_outer("_a").alias("_at", "value"))
           .where(F.col("value").isNotNull()))
    if not strict_keys:
        out = out.where(F.octet_length("row_key") > 0)
    name = lambda of: F.element_at(F.array(*[F.lit(of(f)) for f in fields]), F.col("_at") + 1)
    return out.select("row_key", name(lambda f: f.family).alias("family"),
                      name(lambda f: f.qualifier).alias("qualifier"), "ts", "seq", "value", *carry)


#: rows of up to so many columns become cells by number, see :func:`_few_cells`
FEW_FIELDS = 16


def _keeps_nulls(f: Field, src_type: T.DataType) -> bool:
    """Whether a value of the column that is not NULL always makes a cell."""
    return (f.codec is None and f.storage == "string" and not isinstance(f.dtype, _COMPLEX) and isinstance(
        src_type, (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)))


def _few_cells(df, m, fields, key, ts_col, seq_col, schema, strict_keys, carry) -> DataFrame:
    """A row's cells by the number of their column. A value is encoded in the cell, so
    that cells which a filter leaves out are not, and reads of keys encode none."""
    pre = df.select(key.alias("row_key"), ts_col.cast("bigint").alias("ts"), seq_col.cast("bigint").alias("seq"),
                    *carry, *[F.col(f.name).alias(f"_c{i}") for i, f in enumerate(fields)])

    def own(of) -> Column:
        out = F.when(F.col("_at") == 0, of(0))
        for i in range(1, len(fields)):
            out = out.when(F.col("_at") == i, of(i))
        return out

    out = (pre.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(fields))])).alias("_at"))
           .where(own(lambda i: F.col(f"_c{i}").isNotNull())))
    if not strict_keys:
        out = out.where(F.octet_length("row_key") > 0)
    name = lambda of: F.element_at(F.array(*[F.lit(of(f)) for f in fields]), F.col("_at") + 1)
    return out.select("row_key", name(lambda f: f.family).alias("family"), name(lambda f: f.qualifier).alias("qualifier"), "ts", "seq",
                      own(lambda i: encode_field(F.col(f"_c{i}"), fields[i], m, schema[fields[i].name])).alias("value"), *carry)


def key_type(m: Mapping) -> str:
    k = m.key
    if m.key_codec is not None:
        return m.key_codec.key_type
    if (k.storage == "binary" and not isinstance(k.dtype, T.StringType)) or isinstance(k.dtype, T.BinaryType):
        return "binary"
    return "string"


__all__ = ["table_to_cells", "key_rejects", "encode_field", "encode_key", "strict_key", "key_type"]
