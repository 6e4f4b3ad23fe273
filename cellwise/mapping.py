"""Table mapping: how typed columns sit on (family, qualifier) cells.

A mapping is driver-side configuration.  It can be written as the familiar
comma-separated spec (``":key,cf:a,cf:b#b,cf:,cf:x_.*,:timestamp"``) together
with column names and Spark types, or built from ``Field`` objects directly.
"""
from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import types as T

# Fixed values of the data model.
KEY_TOKEN = ":key"
TIMESTAMP_TOKEN = ":timestamp"
DEFAULT_NULL_FORMAT = "\\N"
# Separators for delimited complex values, by nesting level (level 0 is the
# field separator of a text row; a cell value starts at level 1).
DEFAULT_SEPARATORS = ("\x01", "\x02", "\x03", "\x04", "\x05", "\x06", "\x07", "\x08")

CELL_DDL = "row_key string, family string, qualifier string, ts bigint, seq bigint, value binary"
CELL_COLUMNS = ("row_key", "family", "qualifier", "ts", "seq", "value")

ROLES = ("key", "column", "family", "prefix", "timestamp")


class MappingError(ValueError):
    pass


# Spark type names accepted in type strings.
_SIMPLE = {
    "string": T.StringType, "varchar": T.StringType, "binary": T.BinaryType,
    "boolean": T.BooleanType, "tinyint": T.ByteType, "byte": T.ByteType,
    "smallint": T.ShortType, "short": T.ShortType, "int": T.IntegerType,
    "integer": T.IntegerType, "bigint": T.LongType, "long": T.LongType,
    "float": T.FloatType, "double": T.DoubleType, "date": T.DateType,
    "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType,
}


def as_type(t: str | T.DataType) -> T.DataType:
    """Spark type from a DDL type string, without needing a session."""
    if isinstance(t, T.DataType):
        return t
    dt, rest = _read_type(t.strip())
    if rest.strip():
        raise MappingError(f"bad type string {t!r}")
    return dt


def _split_top(s: str) -> list[str]:
    out, depth, cur = [], 0, []
    for ch in s:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur).strip())
    return out


def _read_type(s: str):
    low = s.lower()
    for head in ("array<", "map<", "struct<"):
        if low.startswith(head):
            depth, i = 0, len(head) - 1
            for i in range(len(head) - 1, len(s)):
                depth += s[i] == "<"
                depth -= s[i] == ">"
                if depth == 0:
                    break
            inner, rest = s[len(head):i], s[i + 1:]
            parts = _split_top(inner)
            if head == "array<":
                return T.ArrayType(as_type(parts[0])), rest
            if head == "map<":
                return T.MapType(as_type(parts[0]), as_type(parts[1])), rest
            fields = []
            for p in parts:
                p = p.strip()
                cut = min([i for i in (p.find(":"), p.find(" ")) if i > 0] or [len(p)])
                fields.append(T.StructField(p[:cut].strip(), as_type(p[cut + 1:])))
            return T.StructType(fields), rest
    if low.startswith("decimal"):
        if "(" in s:
            j = s.index(")")
            p_, s_ = [int(x) for x in s[s.index("(") + 1:j].split(",")]
            return T.DecimalType(p_, s_), s[j + 1:]
        return T.DecimalType(10, 0), s[len("decimal"):]
    if low in _SIMPLE:
        return _SIMPLE[low](), ""
    raise MappingError(f"unknown type {s!r}")


def _storage(token: str, default: str) -> str:
    """``-`` → table default; any prefix of ``string`` / ``binary`` is accepted."""
    if token == "-":
        return default
    if token and "string".startswith(token):
        return "string"
    if token and "binary".startswith(token):
        return "binary"
    raise MappingError(f"bad storage specification {token!r}")


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType
    role: str = "column"              # key | column | family | prefix | timestamp
    family: str | None = None
    qualifier: str | None = None      # qualifier, or the prefix for role=prefix
    storage: str = "string"           # value storage (map value storage for maps)
    key_storage: str = "string"       # map-key storage (family / prefix maps)
    hide_prefix: bool = False
    codec: str | None = None          # name of a registered value codec (K2)

    def __post_init__(self):
        if self.role not in ROLES:
            raise MappingError(f"unknown role {self.role!r}")
        object.__setattr__(self, "dtype", as_type(self.dtype))
        if self.role in ("family", "prefix") and not isinstance(self.dtype, T.MapType):
            raise MappingError(f"{self.name}: a family or prefix column must be a map")
        if self.role in ("family", "prefix"):
            kt = self.dtype.keyType
            if isinstance(kt, (T.MapType, T.ArrayType, T.StructType)):
                raise MappingError(f"{self.name}: map key must be primitive")
        if self.role == "timestamp" and not isinstance(
            self.dtype, (T.TimestampType, T.TimestampNTZType, T.LongType)
        ):
            raise MappingError(f"{self.name}: :timestamp must be timestamp or bigint")

    @property
    def is_cell(self) -> bool:
        return self.role == "column"


@dataclass(frozen=True)
class Mapping:
    fields: tuple[Field, ...]
    null_format: str = DEFAULT_NULL_FORMAT
    timestamp_formats: tuple[str, ...] = ()
    separators: tuple[str, ...] = DEFAULT_SEPARATORS
    escape: str | None = None         # escape character of text storage; None: nothing is escaped
    key_codec: object | None = None   # functions.keys.KeyCodec
    default_storage: str = "string"

    def __post_init__(self):
        if self.escape is not None and (len(self.escape) != 1 or self.escape in self.separators or self.escape.isalnum()):
            raise MappingError("the escape is one character, no letter, digit or separator")
        keys = [f for f in self.fields if f.role == "key"]
        if len(keys) != 1:
            raise MappingError("a mapping needs exactly one :key column")
        if sum(f.role == "timestamp" for f in self.fields) > 1:
            raise MappingError("at most one :timestamp column")
        if len(self.cell_fields) + len(self.map_fields) == 0:
            raise MappingError("a mapping needs at least one column besides the key")
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise MappingError("duplicate column names")

    # -- views ------------------------------------------------------------
    @property
    def key(self) -> Field:
        return next(f for f in self.fields if f.role == "key")

    @property
    def timestamp(self) -> Field | None:
        return next((f for f in self.fields if f.role == "timestamp"), None)

    @property
    def cell_fields(self) -> list[Field]:
        return [f for f in self.fields if f.role == "column"]

    @property
    def map_fields(self) -> list[Field]:
        return [f for f in self.fields if f.role in ("family", "prefix")]

    @property
    def families(self) -> list[str]:
        out: list[str] = []
        for f in self.fields:
            if f.family is not None and f.family not in out:
                out.append(f.family)
        return out

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def select(self, names: Sequence[str]) -> "Mapping":
        """The same mapping restricted to ``names`` (the key is always kept)."""
        keep = set(names) | {self.key.name}
        return replace(self, fields=tuple(f for f in self.fields if f.name in keep))

    @property
    def schema(self) -> T.StructType:
        out = []
        for f in self.fields:
            dt = self.key_codec.struct_type if (f.role == "key" and self.key_codec) else f.dtype
            out.append(T.StructField(f.name, dt, True))
        return T.StructType(out)

    # -- spec string ------------------------------------------------------
    @classmethod
    def parse(
        cls,
        spec: str,
        names: Sequence[str] | None = None,
        types: Sequence[str | T.DataType] | None = None,
        *,
        default_storage: str = "string",
        hide_prefix: bool = False,
        **kw,
    ) -> "Mapping":
        """Read ``":key,cf:a#b,cf:,cf:p_.*,:timestamp"`` style specs.

        Entries are comma-separated and trimmed; each is ``family:qualifier``
        with an optional ``#storage`` (``#s``, ``#b``, ``#-``, or
        ``#key:value`` for maps).  The key may be implicit: when no entry is
        ``:key`` the first column is the key.  Without ``names`` they are made
        from the spec (:func:`generated_names`); a generated family or prefix
        column without a type is ``map<string,string>``, all others are strings.
        """
        if default_storage not in ("string", "binary"):
            raise MappingError("default storage must be string or binary")
        entries = [e.strip() for e in spec.split(",")]
        if not spec.strip() or any(not e for e in entries):
            raise MappingError("empty column mapping")
        if KEY_TOKEN not in [e.split("#")[0] for e in entries]:
            entries = [KEY_TOKEN] + entries
        if entries == [KEY_TOKEN]:
            raise MappingError("mapping with only the key")
        if names is None:
            names = generated_names(",".join(entries))
            if types is None:
                types = [_default_type(e) for e in entries]
        names = list(names)
        if len(names) != len(entries):
            raise MappingError(
                f"{len(names)} columns but {len(entries)} mapping entries (key included)"
            )
        types = list(types) if types is not None else [None] * len(names)
        fields = []
        for name, entry, t in zip(names, entries, types):
            body, _, storage = entry.partition("#")
            if body.count(":") != 1:
                raise MappingError(f"bad mapping entry {entry!r}: needs exactly one ':'")
            fam, qual = body.split(":")
            kstore = vstore = default_storage
            if storage:
                if ":" in storage:
                    ks, vs = storage.split(":", 1)
                    kstore, vstore = _storage(ks, default_storage), _storage(vs, default_storage)
                else:
                    kstore = vstore = _storage(storage, default_storage)
            if body == KEY_TOKEN:
                fields.append(Field(name, t or "string", "key", storage=vstore))
            elif body == TIMESTAMP_TOKEN:
                fields.append(Field(name, t or "timestamp", "timestamp"))
            elif fam == "":
                raise MappingError(f"bad mapping entry {entry!r}")
            elif qual == "":
                fields.append(Field(name, t or "map<string,string>", "family", fam,
                                    storage=vstore, key_storage=kstore))
            elif qual.endswith(".*"):
                fields.append(Field(name, t or "map<string,string>", "prefix", fam, qual[:-2],
                                    storage=vstore, key_storage=kstore, hide_prefix=hide_prefix))
            else:
                fields.append(Field(name, t or "string", "column", fam, qual, storage=vstore))
        return cls(tuple(fields), default_storage=default_storage, **kw)


def _default_type(entry: str) -> str:
    body = entry.split("#")[0]
    qual = body.partition(":")[2]
    if body == KEY_TOKEN:
        return "string"
    if body == TIMESTAMP_TOKEN:
        return "timestamp"
    return "map<string,string>" if qual == "" or qual.endswith(".*") else "string"


def generated_names(spec: str) -> list[str]:
    """Column names made from a spec: ``key``, ``family_qualifier``,
    ``family_prefix<i>``, ``family_col<i>``; lower case, alphanumerics only."""
    import re

    def clean(s: str) -> str:
        return re.sub(r"[^0-9a-z_]", "", s.lower())

    out = []
    for i, entry in enumerate(e.strip() for e in spec.split(",")):
        body = entry.split("#")[0]
        fam, _, qual = body.partition(":")
        if body == KEY_TOKEN:
            out.append("key")
        elif body == TIMESTAMP_TOKEN:
            out.append("timestamp")
        elif qual == "":
            out.append(clean(f"{fam}_col{i}"))
        elif qual.endswith(".*"):
            out.append(clean(f"{fam}_prefix{i}"))
        else:
            out.append(clean(f"{fam}_{qual}"))
    return out


__all__ = [
    "CELL_DDL", "CELL_COLUMNS", "Field", "Mapping", "MappingError", "generated_names", "as_type",
    "DEFAULT_NULL_FORMAT", "DEFAULT_SEPARATORS",
]
