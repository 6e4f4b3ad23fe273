"""Named value codecs (the per-column value plug-in point).

A codec is a pair of Column → Column functions; it is applied inside the scan
and encode jobs like the built-in text and binary codecs.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column


@dataclass(frozen=True)
class ValueCodec:
    name: str
    encode: Callable[[Column], Column]   # typed value → binary cell
    decode: Callable[[Column], Column]   # binary cell → typed value


_CODECS: dict[str, ValueCodec] = {}


def register_codec(name: str, encode: Callable[[Column], Column],
                   decode: Callable[[Column], Column]) -> ValueCodec:
    c = ValueCodec(name, encode, decode)
    _CODECS[name] = c
    return c


def get_codec(name: str) -> ValueCodec:
    try:
        return _CODECS[name]
    except KeyError:
        raise KeyError(f"no value codec registered as {name!r}") from None


def registered() -> list[str]:
    return sorted(_CODECS)
