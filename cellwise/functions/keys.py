"""Row-key codecs (the pluggable key plug-in point) as Column expressions.

A ``KeyCodec`` turns a struct column into a row key and back, and tells which
row-key bounds a set of leading-field equalities implies, so that a filter on
decoded key fields can also prune on the stored key.
"""
from __future__ import annotations

import math
import re
import struct
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..mapping import as_type
from .codec import (INT_WIDTH, decode_float_bytes, decode_int_bytes, encode_int_bytes, float_bits, let,
                    width_of)

# Fixed values of the sample key layouts.
DOLLAR_DELIMITER = "$$"          # delimited composite key
FIXED_FIELD_WIDTH = 10           # fixed-width composite key: 10 bytes + 1 pad byte
COLLECTION_DELIMITER = "\x02"    # struct key written with the collection separator


# Above every character a key can hold, for the upper end of a key range.
TOP = "\U0010ffff"


@dataclass(frozen=True)
class KeyCodec:
    """``encode``: struct Column → row-key Column; ``decode``: row key → struct.

    ``prefix`` maps the values of the leading key fields (all compared with
    ``=``) to the row-key prefix every matching key starts with, as a constant
    Column made by the codec's own field encoding, or ``None`` when the layout
    allows no such prefix.  ``bounds`` maps leading equal values and the
    comparisons ``(op, value)`` on the next field to inclusive row-key bounds
    ``(lo, hi)`` (constant Columns or ``None``) that hold every matching key;
    it may give bounds that are too wide, never too narrow.  ``key_type`` is
    the row key's type, "string" or "binary".
    """
    struct_type: T.StructType
    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]
    prefix: Callable[[Sequence[object]], Column | None] | None = None
    name: str = "custom"
    bounds: Callable[[Sequence[object], Sequence[tuple[str, object]]],
                     tuple[Column | None, Column | None]] | None = None
    key_type: str = "string"


def _text(value, dtype: T.DataType) -> Column:
    """A constant as its field's text, cast by Spark as ``encode`` does."""
    return F.lit(value).cast(dtype).cast("string")


def _needed(c: Column, name: str, reserved: str | None = None) -> Column:
    """A key field's text; NULL raises, and so does the codec's separator inside it."""
    c = F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"NULL key field {name}")).cast("string"))
    if reserved:
        c = F.when(~c.contains(reserved), c).otherwise(
            F.raise_error(F.concat(F.lit(f"key field {name} holds the separator: "), c)).cast("string"))
    return c


def _struct_type(fields) -> T.StructType:
    if isinstance(fields, T.StructType):
        return fields
    if isinstance(fields, str):
        return as_type(fields)
    return T.StructType([T.StructField(n, as_type(t)) for n, t in fields])


def _cast_fields(parts: Callable[[int], Column], st: T.StructType) -> Column:
    return F.struct(*[
        (parts(i) if isinstance(f.dataType, T.StringType) else parts(i).try_cast(f.dataType))
        .alias(f.name)
        for i, f in enumerate(st.fields)
    ])


def delimited(fields, sep: str = DOLLAR_DELIMITER) -> KeyCodec:
    """Fields joined by ``sep`` (``1000$$2000$$3000``).  A NULL field, and a field
    that holds the separator or could run into it, raise on encode."""
    st = _struct_type(fields)
    last = len(st.fields) - 1

    def enc(c: Column) -> Column:
        # a field may not end with the separator's first character: "a$" + "$$"
        out = []
        for i, f in enumerate(st.fields):
            t = _needed(c[f.name].cast("string"), f.name, sep)
            if i < last and len(sep) > 1:
                t = F.when(~t.endswith(sep[0]), t).otherwise(F.raise_error(
                    F.concat(F.lit(f"key field {f.name} runs into the separator: "), t)).cast("string"))
            out.append(t)
        return F.concat_ws(sep, *out)

    def dec(k: Column) -> Column:
        parts = F.split(k.cast("string"), re.escape(sep), -1)
        return _cast_fields(lambda i: F.try_element_at(parts, F.lit(i + 1)), st)

    def prefix(vals):
        texts = [_text(v, f.dataType) for v, f in zip(vals, st.fields)]
        return F.concat(F.concat_ws(sep, *texts), F.lit(sep if len(vals) <= last else ""))

    def bounds(equal, ops):
        i = len(equal)
        if i > last or not isinstance(st.fields[i].dataType, T.StringType):
            return None, None                    # the text order of numbers is not theirs
        head = prefix(equal) if equal else F.lit("")
        lows = [F.concat(head, F.lit(v)) for op, v in ops if op in (">", ">=", "=")]
        # a smaller value may be a prefix of v, with the separator after it
        highs = [F.concat(head, F.lit(max(v + sep + TOP if op != "<" else v,
                                          *(v[:n] + sep + TOP for n in range(len(v)))) if v else v + sep + TOP))
                 for op, v in ops if op in ("<", "<=", "=")]
        return _extreme(lows, F.greatest), _extreme(highs, F.least)

    return KeyCodec(st, enc, dec, prefix, "delimited", bounds)


def _extreme(cols: list, pick) -> Column | None:
    return None if not cols else cols[0] if len(cols) == 1 else pick(*cols)


def collection_delimited(fields) -> KeyCodec:
    """Struct key written like a text struct: fields split by the level-1
    collection separator."""
    codec = delimited(fields, COLLECTION_DELIMITER)
    return KeyCodec(codec.struct_type, codec.encode, codec.decode, codec.prefix, "collection", codec.bounds)


def fixed_width(fields, width: int = FIXED_FIELD_WIDTH) -> KeyCodec:
    """Every field cut / padded with NUL to ``width`` characters, plus one NUL.
    A NULL field, and a field that holds a NUL, raise on encode."""
    st = _struct_type(fields)
    nul = "\x00"
    step = width + 1

    def padded(t: Column) -> Column:
        return F.rpad(F.substring(t, 1, width), step, nul)

    def enc(c: Column) -> Column:
        return F.concat(*[padded(_needed(c[f.name].cast("string"), f.name, nul)) for f in st.fields])

    def dec(k: Column) -> Column:
        s = k.cast("string")
        return _cast_fields(
            lambda i: F.trim(F.substring(s, i * step + 1, width), F.lit(nul)), st)

    def prefix(vals):
        return F.concat(*[padded(_text(v, f.dataType)) for v, f in zip(vals, st.fields)])

    def bounds(equal, ops):
        i = len(equal)
        if i >= len(st.fields) or not isinstance(st.fields[i].dataType, T.StringType):
            return None, None
        head = prefix(equal) if equal else F.lit("")
        lows = [F.concat(head, padded(F.lit(v))) for op, v in ops if op in (">", ">=", "=")]
        highs = [F.concat(head, padded(F.lit(v)), F.lit(TOP)) for op, v in ops if op in ("<", "<=", "=")]
        return _extreme(lows, F.greatest), _extreme(highs, F.least)

    return KeyCodec(st, enc, dec, prefix, "fixed_width", bounds)


def one_byte_fields(fields) -> KeyCodec:
    """Field *i* is the *i*-th character of the key; a NULL or empty field raises
    on encode."""
    st = _struct_type(fields)

    def enc(c: Column) -> Column:
        return F.concat(*[F.substring(_needed(F.when(c[f.name].cast("string") != "", c[f.name].cast("string")),
                                              f.name), 1, 1) for f in st.fields])

    def dec(k: Column) -> Column:
        s = k.cast("string")
        return _cast_fields(lambda i: F.substring(s, i + 1, 1), st)

    def prefix(vals):
        return F.concat(*[F.substring(_text(v, f.dataType), 1, 1) for v, f in zip(vals, st.fields)])

    return KeyCodec(st, enc, dec, prefix, "one_byte")


def salted(inner_width: int = 12, buckets_hex: int = 2) -> KeyCodec:
    """A plain key with a hash prefix (``md5(k)[0:n] + '|' + k``): the usual way
    to spread a monotonically growing key over all regions.  The struct has one
    field ``id`` (string), which may hold any text; NULL raises on encode."""
    st = T.StructType([T.StructField("id", T.StringType())])

    def salt(k: Column) -> Column:
        return F.concat(F.substring(F.md5(k.cast("binary")), 1, buckets_hex), F.lit("|"), k)

    def enc(c: Column) -> Column:
        return salt(_needed(c["id"].cast("string"), "id"))

    def dec(k: Column) -> Column:
        return F.struct(F.substring(k.cast("string"), buckets_hex + 2, 1 << 30).alias("id"))

    def prefix(vals):
        return salt(_text(vals[0], T.StringType()))

    return KeyCodec(st, enc, dec, prefix, "salted")


# ------------------------------------------------------------- ordered fields
# End of a text field and the mark of a NUL inside one: U+0000 is always followed
# by one of the two, and the end sorts first.
_END, _INNER = "\x00\x01", "\x00\x02"
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.FloatType, T.DoubleType,
            T.BooleanType, T.StringType)
_SIGN64 = -(1 << 63)


def _width(dt: T.DataType) -> int:
    """Bytes of a field that is not text."""
    return 8 if isinstance(dt, T.TimestampType) else 4 if isinstance(dt, T.DateType) else width_of(dt)


def _ordered_bytes(c: Column, dt: T.DataType) -> Column:
    """Bytes whose unsigned order is that of the values: integers with the sign
    bit flipped; floats by their bits, all of them flipped below zero (-0.0 is
    0.0, NaN comes last); text with its NULs marked and an end."""
    if isinstance(dt, T.StringType):
        return F.concat(F.replace(c, F.lit("\x00"), F.lit(_INNER)), F.lit(_END)).cast("binary")
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return let(float_bits(c.cast("double") + F.lit(0.0), True), lambda bits: encode_int_bytes(
            F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(_SIGN64))), 8))
    if isinstance(dt, T.BooleanType):
        return encode_int_bytes(c.cast("int"), 1)
    w = _width(dt)
    n = F.unix_date(c) if isinstance(dt, T.DateType) else F.unix_micros(c) if isinstance(dt, T.TimestampType) else c
    n = n.cast("bigint")
    return encode_int_bytes(n.bitwiseXOR(F.lit(_SIGN64 if w == 8 else 1 << (8 * w - 1)).cast("bigint")), w)


def _ordered_value(h: Column, dt: T.DataType) -> Column:
    """Inverse of :func:`_ordered_bytes`, from hexadecimal digits (text: without its end)."""
    b = F.unhex(h)
    if isinstance(dt, T.StringType):
        return F.replace(b.cast("string"), F.lit(_INNER), F.lit("\x00"))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        flip = lambda bits: encode_int_bytes(
            F.when(bits < 0, bits.bitwiseXOR(F.lit(_SIGN64))).otherwise(F.bitwise_not(bits)), 8)
        return let(let(decode_int_bytes(b, 8), flip), lambda x: decode_float_bytes(x, True)).cast(dt)
    if isinstance(dt, T.BooleanType):
        return decode_int_bytes(b, 1).cast("boolean")
    w = _width(dt)
    n = decode_int_bytes(b, w).cast("bigint")
    # the flipped sign bit is back after an addition of half the range, modulo the range
    n = n.bitwiseXOR(F.lit(_SIGN64)) if w == 8 else F.when(n < 0, n + (1 << (8 * w - 1))).otherwise(n - (1 << (8 * w - 1)))
    if isinstance(dt, T.DateType):
        return F.date_from_unix_date(n.cast("int"))
    return F.timestamp_micros(n) if isinstance(dt, T.TimestampType) else n.cast(dt)


def _within(value, dt: T.DataType):
    """A bound for an integer field, moved into its range."""
    w = INT_WIDTH.get(type(dt))
    if w is None or isinstance(value, bool) or value != value:
        return value
    half = 1 << (8 * w - 1)
    return int(min(max(value, -half), half - 1))


def ordered(fields) -> KeyCodec:
    """Binary keys whose byte order is the order of the fields' values: integers,
    dates, timestamps, floats, booleans and text, in any order. Equal leading
    fields and a range on the next one become bounds on the stored key. A NULL
    field raises on encode; a key that does not parse decodes to NULL fields."""
    st = _struct_type(fields)
    for f in st.fields:
        if not isinstance(f.dataType, _ORDERED):
            raise TypeError(f"no ordered form for key field {f.name}: {f.dataType.simpleString()}")
    # longer than any run of FF bytes in a key: above every key that starts with what comes before it
    above = b"\xff" * (8 * len(st.fields) + 1)

    def present(c: Column, f: T.StructField) -> Column:
        null = F.raise_error(F.lit(f"NULL key field {f.name}")).cast(f.dataType)
        return F.when(c.isNotNull(), c).otherwise(null)

    def enc(c: Column) -> Column:
        return F.concat(*[_ordered_bytes(present(c[f.name], f), f.dataType) for f in st.fields])

    def field(i: int, rest: Column, done: list) -> Column:
        if i == len(st.fields):
            return F.struct(*done)
        f, tail = st.fields[i], F.lit(1 << 30)

        def then(value: Column, at: Column) -> Column:
            return let(F.substring(rest, at, tail), lambda r: field(i + 1, r, [*done, _ordered_value(value, f.dataType).alias(f.name)]))

        if not isinstance(f.dataType, T.StringType):
            size = 16 if isinstance(f.dataType, T.FloatType) else 2 * _width(f.dataType)
            head = F.substring(rest, 1, size)
            return then(F.when(F.length(head) == size, head), F.lit(size + 1))
        # whole bytes up to the end mark; possessive, so that long text needs no stack
        return let(F.regexp_extract(rest, "^((?:(?!0001)[0-9A-F]{2})*+0001)", 1), lambda x: then(
            F.when(x != "", F.substring(x, F.lit(1), F.length(x) - 4)), F.length(x) + 1))

    def dec(k: Column) -> Column:
        return let(F.hex(k.cast("binary")), lambda h: field(0, h, []))

    def constant(value, f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):     # a literal, which the scan takes
            bits = int.from_bytes(struct.pack(">d", math.nan if value != value else float(value) + 0.0), "big")
            return F.lit((bits ^ ((1 << 64) - 1) if bits >> 63 else bits | 1 << 63).to_bytes(8, "big"))
        return _ordered_bytes(F.lit(_within(value, f.dataType)).cast(f.dataType), f.dataType)

    def prefix(vals):
        return F.concat(*[constant(v, f) for v, f in zip(vals, st.fields)])

    def bounds(equal, ops):
        i = len(equal)
        head = [prefix(equal)] if equal else []
        if i >= len(st.fields):
            ops = []
        lows = [F.concat(*head, constant(v, st.fields[i])) for op, v in ops if op in (">", ">=", "=")] or head
        highs = [F.concat(*head, constant(v, st.fields[i]), F.lit(above)) for op, v in ops if op in ("<", "<=", "=")]
        highs = highs or [F.concat(*head, F.lit(above)) for _ in head]
        return _extreme(lows, F.greatest), _extreme(highs, F.least)

    return KeyCodec(st, enc, dec, prefix, "ordered", bounds, "binary")


__all__ = ["KeyCodec", "ordered", "delimited", "collection_delimited", "fixed_width", "one_byte_fields",
           "salted"]
