"""Cell value codecs as Column expressions (JVM-side, inside whole-stage codegen
where Spark allows).  Nothing here runs Python per value.

Text storage: UTF-8 text of the value; undecodable text reads NULL.
Binary storage: fixed-width big-endian integers, IEEE-754 floats, one byte for
booleans; the wrong width reads NULL.
"""
from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..mapping import DEFAULT_NULL_FORMAT, DEFAULT_SEPARATORS, as_type

# Byte width of each binary-stored integral type.
INT_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_COMPLEX = (T.ArrayType, T.MapType, T.StructType)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_regex(sep: str) -> str:
    """Separator as a literal for ``split`` / ``str_to_map``, which take regexes."""
    return re.escape(sep)


def width_of(dt: T.DataType) -> int | None:
    for k, w in INT_WIDTH.items():
        if isinstance(dt, k):
            return w
    if isinstance(dt, T.FloatType):
        return 4
    if isinstance(dt, T.DoubleType):
        return 8
    if isinstance(dt, T.BooleanType):
        return 1
    return None


# ---------------------------------------------------------------- binary codecs
def encode_int_bytes(col, width: int) -> Column:
    """Two's-complement big-endian bytes of the low ``width`` bytes."""
    h = F.hex(_c(col).cast("bigint"))
    return F.unhex(F.substring(F.lpad(h, 16, "0"), 17 - 2 * width, 2 * width))


def decode_int_bytes(col, width: int) -> Column:
    """Inverse of :func:`encode_int_bytes`; NULL when the width is wrong."""
    b = _c(col)
    h = F.hex(b)
    if width == 8:
        v = F.conv(h, 16, -10).cast("bigint")
    else:
        u = F.conv(h, 16, 10).cast("bigint")
        half = 1 << (8 * width - 1)
        v = F.when(u >= F.lit(half), u - F.lit(1 << (8 * width))).otherwise(u)
    return F.when(F.length(b) == width, v)


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def float_bits(col, double: bool) -> Column:
    """Value → IEEE-754 bits as a bigint (of a float: the low 32), with arithmetic that
    is exact: all scaling is by powers of two.  NaN is the canonical NaN, -0.0 keeps its sign."""
    c = _c(col)
    ebits, mbits, bias = (11, 52, 1023) if double else (8, 23, 127)
    two = lambda e: F.pow(F.lit(2.0), e)
    low = (bias - 1 + mbits) // 2
    emax = F.lit(((1 << ebits) - 1) << mbits).cast("bigint")

    def with_exponent(size: Column, e: Column) -> Column:
        # in two steps, as a single factor may not be a double
        fraction = (size * two(-F.floor(e / 2)) * two(-(e - F.floor(e / 2))) - 1.0) * float(1 << mbits)
        return F.shiftleft((e + bias).cast("bigint"), mbits) + fraction.cast("bigint")

    def with_guess(size: Column, guess: Column) -> Column:
        # the logarithm may round across a power of two
        e = guess + F.when(size >= two(guess + 1), 1).when(size < two(guess), -1).otherwise(0)
        return let(e, lambda x: with_exponent(size, x))

    def signed(x: Column) -> Column:
        size = F.abs(x)
        subnormal = (size * float(2.0 ** low) * float(2.0 ** (bias - 1 + mbits - low))).cast("bigint")
        bits = (F.when(F.isnan(x), emax + (1 << (mbits - 1)))
                .when(size == float("inf"), emax)
                .when(size < float(2.0 ** (1 - bias)), subnormal)
                .otherwise(let(F.floor(F.log2(size)), lambda g: with_guess(size, g))))
        negative = (x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-")))
        return F.when(negative & ~F.isnan(x), bits.bitwiseOR(F.lit(-(1 << (ebits + mbits))).cast("bigint"))).otherwise(bits)

    x = (c if double else c.cast("float")).cast("double")
    return F.when(x.isNotNull(), let(x, signed))


def encode_float_bytes(col, double: bool) -> Column:
    """Big-endian bytes of :func:`float_bits`."""
    return encode_int_bytes(float_bits(col, double), 8 if double else 4)


def decode_float_bytes(col, double: bool) -> Column:
    """IEEE-754 bits → value with deterministic arithmetic (exact: the
    mantissa is an integer below 2^53 and the scale a power of two)."""
    if double:
        bits, ebits, mbits, bias = decode_int_bytes(col, 8), 11, 52, 1023
    else:
        bits, ebits, mbits, bias = decode_int_bytes(col, 4).cast("bigint"), 8, 23, 127
    emax = (1 << ebits) - 1
    exp = F.shiftright(bits, mbits).bitwiseAND(F.lit(emax))
    mant = bits.bitwiseAND(F.lit((1 << mbits) - 1))
    sign = F.when(bits < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    normal = (mant + F.lit(float(1 << mbits))) * F.pow(F.lit(2.0), exp - (bias + mbits))
    sub = mant * F.pow(F.lit(2.0), F.lit(1 - bias - mbits))
    v = (F.when(exp == emax, F.when(mant == 0, sign * F.lit(float("inf")))
                .otherwise(F.lit(float("nan"))))
         .when(exp == 0, sign * sub)
         .otherwise(sign * normal))
    v = F.when(bits.isNotNull(), v)
    return v if double else v.cast("float")


def encode_binary(col, dt: T.DataType) -> Column:
    """Binary storage of one value (NULL stays NULL, which writes no cell)."""
    dt = as_type(dt)
    c = _c(col)
    if isinstance(dt, T.BooleanType):
        return F.when(c.isNull(), F.lit(None).cast("binary")).when(c, F.unhex(F.lit("FF"))) \
            .otherwise(F.unhex(F.lit("00")))
    if isinstance(dt, T.FloatType):
        return encode_float_bytes(c, False)
    if isinstance(dt, T.DoubleType):
        return encode_float_bytes(c, True)
    w = width_of(dt)
    if w is not None:
        return encode_int_bytes(c, w)
    if isinstance(dt, T.BinaryType):
        return c
    # strings, dates, decimals, complex types: binary storage is not defined,
    # the text form is used (string columns ignore #b).
    return encode_text(c, dt)


def decode_binary(col, dt: T.DataType) -> Column:
    dt = as_type(dt)
    b = _c(col)
    if isinstance(dt, T.BooleanType):
        return F.when(F.length(b) == 1, b != F.unhex(F.lit("00")))
    if isinstance(dt, T.FloatType):
        return decode_float_bytes(b, False)
    if isinstance(dt, T.DoubleType):
        return decode_float_bytes(b, True)
    w = width_of(dt)
    if w is not None:
        return decode_int_bytes(b, w).cast(dt)
    if isinstance(dt, T.BinaryType):
        return b
    return decode_text(b, dt)


# ------------------------------------------------------------------ text codecs
def to_text(col) -> Column:
    """Cell bytes (or an already-string value) as a string, without validation."""
    return _c(col).cast("string")


def decode_text(
    col,
    dt: T.DataType,
    *,
    null_format: str | None = DEFAULT_NULL_FORMAT,
    timestamp_formats: Sequence[str] = (),
    separators: Sequence[str] = DEFAULT_SEPARATORS,
    level: int = 1,
    escape: str | None = None,
) -> Column:
    """Text cell → typed value; undecodable text → NULL (never an error).

    With ``escape``, a separator or an escape that follows the escape character is
    text. The null sequence is looked for before escapes are taken off, so that
    an escaped one is text too."""
    dt = as_type(dt)
    if isinstance(dt, T.BinaryType):
        return _c(col).cast("binary")
    s = to_text(col)
    if null_format is not None:
        s = F.when(s != F.lit(null_format), s)
    if escape:
        s = _guarded(s, escape, separators, null_format)
    return _text_value(s, dt, null_format, tuple(timestamp_formats), tuple(separators), level, escape)


# Escaped text on its way through the splits: each escaped character stands as the
# escape and a letter, so that all separators left are real ones. "a" is the escape
# itself, "b" the first separator, and so on.
def _escaped(escape: str, separators) -> list[tuple[str, str]]:
    return [(c, escape + chr(ord("a") + i)) for i, c in enumerate((escape, *separators))]


def _guarded(s: Column, escape: str, separators, null_format: str | None) -> Column:
    """Escaped characters behind their letters; an escape before any other
    character falls away, but for one that begins the null sequence."""
    keep = "".join((escape, *separators))
    if null_format and null_format[:1] == escape:
        keep += null_format[1:2]
    kept = "".join("\\" + c if not c.isalnum() else c for c in keep)
    s = F.regexp_replace(s, f"(?s)(\\{escape}[{kept}])|\\{escape}(.)", "$1$2")
    for c, mark in _escaped(escape, separators):
        s = F.replace(s, F.lit(escape + c), F.lit(mark))
    return s


def _unguarded(s: Column, escape: str, separators, null_format: str | None) -> Column:
    if null_format and null_format[:1] == escape and len(null_format) > 1:
        s = F.replace(s, F.lit(null_format[:2]), F.lit(null_format[1:2]))
    for c, mark in reversed(_escaped(escape, separators)):
        s = F.replace(s, F.lit(mark), F.lit(c))
    return s


def _with_escapes(s: Column, escape: str, separators) -> Column:
    for c in (escape, *separators):
        s = F.replace(s, F.lit(c), F.lit(escape + c))
    return s


def _text_value(s: Column, dt, null_format, ts_formats, seps, level, escape=None) -> Column:
    if escape and not isinstance(dt, _COMPLEX):
        s = _unguarded(s, escape, seps, null_format)
    if isinstance(dt, T.StringType):
        return s
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        tname = "timestamp_ntz" if isinstance(dt, T.TimestampNTZType) else "timestamp"
        tries = [F.try_to_timestamp(s, F.lit(f)).cast(tname) for f in ts_formats]
        tries.append(s.try_cast(tname))
        return F.coalesce(*tries) if len(tries) > 1 else tries[0]
    if isinstance(dt, T.BooleanType):
        low = F.lower(s)
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    if isinstance(dt, _COMPLEX):
        return _complex_from_text(s, dt, null_format, ts_formats, seps, level, escape)
    return s.try_cast(dt)


def _complex_from_text(s, dt, null_format, ts_formats, seps, level, escape=None) -> Column:
    if level + 1 >= len(seps):
        raise ValueError("nesting deeper than the separator list")
    sep = seps[level]

    def elem(x: Column, t, lvl):
        if null_format is not None:
            x = F.when(x != F.lit(null_format), x)
        return _text_value(x, t, null_format, ts_formats, seps, lvl, escape)

    if isinstance(dt, T.ArrayType):
        parts = F.split(s, _lit_regex(sep), -1)
        arr = F.transform(parts, lambda x: elem(x, dt.elementType, level + 1))
        return F.when(s.isNull(), F.lit(None)).when(s == "", F.array().cast(dt)).otherwise(arr.cast(dt))
    if isinstance(dt, T.MapType):
        kv = seps[level + 1]
        entries = F.transform(
            F.filter(F.split(s, _lit_regex(sep), -1), lambda e: e != ""),
            lambda e: F.struct(
                elem(F.split(e, _lit_regex(kv), 2).getItem(0), dt.keyType, level + 2).alias("key"),
                elem(F.try_element_at(F.split(e, _lit_regex(kv), 2), F.lit(2)), dt.valueType, level + 2)
                .alias("value"),
            ),
        )
        # later duplicates of a key are dropped, the first entry wins
        entries = F.filter(entries, lambda e: e["key"].isNotNull())
        m = F.map_from_entries(_first_per_key(entries))
        return F.when(s.isNull(), F.lit(None)).when(s == "", F.create_map().cast(dt)).otherwise(m.cast(dt))
    if isinstance(dt, T.StructType):
        parts = F.split(s, _lit_regex(sep), -1)
        fields = [
            elem(F.try_element_at(parts, F.lit(i + 1)), f.dataType, level + 1).alias(f.name)
            for i, f in enumerate(dt.fields)
        ]
        return F.when(s.isNull(), F.lit(None)).otherwise(F.struct(*fields).cast(dt))
    raise TypeError(dt)


def _first_per_key(entries: Column) -> Column:
    """Keep the first entry for every key of an array<struct<key,value>>: sorted
    by (key, place) once, then one pass over neighbours."""
    placed = F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value")))
    ordered = F.array_sort(placed, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1)
                           .otherwise(a["i"] - b["i"]))
    # bound to a name, so that the sort is not repeated for each entry
    kept = F.transform(F.array(ordered), lambda s: F.filter(
        s, lambda e, i: (i == 0) | (F.get(s, i - 1)["key"] != e["key"])))
    return F.transform(F.get(kept, F.lit(0)), lambda e: F.struct(e["key"], e["value"]))


def encode_text(
    col,
    dt: T.DataType,
    *,
    null_format: str = DEFAULT_NULL_FORMAT,
    separators: Sequence[str] = DEFAULT_SEPARATORS,
    level: int = 1,
    escape: str | None = None,
) -> Column:
    """Typed value → UTF-8 text bytes (NULL stays NULL: no cell is written).
    With ``escape``, separators and escapes inside text are written behind it."""
    dt = as_type(dt)
    c = _c(col)
    if isinstance(dt, T.BinaryType):
        return c
    return _value_text(c, dt, null_format, tuple(separators), level, escape).cast("binary")


def _value_text(c: Column, dt, null_format, seps, level, escape=None) -> Column:
    if isinstance(dt, T.BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    if not isinstance(dt, _COMPLEX):
        return _with_escapes(c.cast("string"), escape, seps) if escape else c.cast("string")
    sep = seps[level]
    if isinstance(dt, T.ArrayType):
        # a NULL element is written as the empty string
        return F.array_join(
            F.transform(c, lambda x: F.coalesce(_value_text(x, dt.elementType, null_format, seps,
                                                            level + 1, escape), F.lit(""))),
            sep,
        )
    if isinstance(dt, T.MapType):
        kv = seps[level + 1]
        return F.array_join(
            F.transform(
                F.map_entries(c),
                lambda e: F.concat(
                    _value_text(e["key"], dt.keyType, null_format, seps, level + 2, escape), F.lit(kv),
                    F.coalesce(_value_text(e["value"], dt.valueType, null_format, seps, level + 2, escape),
                               F.lit(null_format)),
                ),
            ),
            sep,
        )
    if isinstance(dt, T.StructType):
        parts = [
            F.coalesce(_value_text(c[f.name], f.dataType, null_format, seps, level + 1, escape),
                       F.lit(null_format))
            for f in dt.fields
        ]
        return F.when(c.isNull(), F.lit(None)).otherwise(F.concat_ws(sep, *parts))
    raise TypeError(dt)


def encode_json(col) -> Column:
    """A complex value written into a primitive (string) column: JSON text,
    NULL fields kept."""
    return F.to_json(_c(col), {"ignoreNullFields": "false"}).cast("binary")


# -------------------------------------------------------------- dispatch by field
def encode_value(col, dt, storage: str = "string", **kw) -> Column:
    if storage == "binary":
        return encode_binary(col, dt)
    return encode_text(col, dt, **kw)


def decode_value(col, dt, storage: str = "string", **kw) -> Column:
    if storage == "binary" and not isinstance(as_type(dt), (T.StringType,) + _COMPLEX):
        return decode_binary(col, dt)
    return decode_text(col, dt, **kw)


__all__ = [
    "encode_int_bytes", "decode_int_bytes", "encode_float_bytes", "decode_float_bytes",
    "encode_binary", "decode_binary", "encode_text", "decode_text", "encode_json",
    "encode_value", "decode_value", "to_text", "width_of",
]
