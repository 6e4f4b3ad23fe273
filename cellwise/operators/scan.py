"""Reads: cells (long format) → typed rows, one per row key.

Every read is a lazy DataFrame job.  The pivot is a ``groupBy(row_key)`` whose
aggregates are all partial-aggregatable, so each map task collapses its cells
of a row key (however hot) to one buffer before the shuffle.
"""
from __future__ import annotations

import re
from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec
from ..functions.registry import get_codec
from ..functions.time import millis_to_timestamp
from ..mapping import Field, Mapping


# ----------------------------------------------------------------- selection
def _match(f: Field) -> Column:
    """Condition selecting the cells a field reads."""
    fam = F.col("family") == F.lit(f.family)
    if f.role == "column":
        return fam & (F.col("qualifier") == F.lit(f.qualifier))
    if f.role == "prefix":
        return fam & F.col("qualifier").startswith(f.qualifier)
    return fam


def cell_filter(fields: Sequence[Field]) -> Column | None:
    """One filter for all cells ``fields`` read, grouped per family so Parquet
    gets ``family = x AND qualifier IN (...)`` predicates it can push down."""
    conds = []
    quals: dict[str, list[str]] = {}
    for f in fields:
        if f.role == "column":
            quals.setdefault(f.family, [])
            if f.qualifier not in quals[f.family]:
                quals[f.family].append(f.qualifier)
    whole = {f.family for f in fields if f.role == "family"}
    for fam, qs in quals.items():
        if fam in whole:
            continue
        conds.append((F.col("family") == F.lit(fam)) & F.col("qualifier").isin(qs))
    for fam in sorted(whole):
        conds.append(F.col("family") == F.lit(fam))
    for f in fields:
        if f.role == "prefix" and f.family not in whole:
            conds.append(_match(f))
    return reduce(or_, conds) if conds else None


# ------------------------------------------------------------------ decoding
def decode_field(value: Column, f: Field, m: Mapping) -> Column:
    if f.codec:
        return get_codec(f.codec).decode(value)
    return codec.decode_value(
        value, f.dtype, f.storage,
        null_format=m.null_format,
        timestamp_formats=m.timestamp_formats,
        separators=m.separators,
        escape=m.escape,
    )


def decode_key(row_key: Column, m: Mapping) -> Column:
    k = m.key
    if m.key_codec is not None:
        return m.key_codec.decode(row_key)
    if k.storage == "binary" and not isinstance(k.dtype, T.StringType):
        return codec.decode_binary(row_key.cast("binary"), k.dtype)
    if isinstance(k.dtype, T.BinaryType):
        return row_key.cast("binary")
    return codec.decode_text(row_key, k.dtype, null_format=m.null_format)


def _map_key(q: Column, f: Field, m: Mapping) -> Column:
    if f.role == "prefix" and f.hide_prefix:
        q = F.substring(q, len(f.qualifier) + 1, 1 << 30)
    kt = f.dtype.keyType
    if f.key_storage == "binary":
        return codec.decode_binary(q.cast("binary"), kt)
    return codec.decode_text(q, kt, null_format=m.null_format)


def _map_value(v: Column, f: Field, m: Mapping) -> Column:
    vf = Field("v", f.dtype.valueType, "column", f.family, "v", storage=f.storage)
    return decode_field(v, vf, m)


# -------------------------------------------------------------------- slots
#: mappings of more columns pack a row's cells before they are spread over the columns
PACK_ABOVE = 16


def _with_slots(src: DataFrame, slots: dict[tuple[str, str], int]) -> DataFrame:
    """The cells with ``_slot``, the slot of their (family, qualifier), NULL if it has none:
    for few columns by bisection in byte order, for many by a broadcast table of them."""
    if len(slots) <= PACK_ABOVE:
        return src.select("row_key", "ts", "seq", "value", _bisected(slots, F.col("family"), F.col("qualifier")).alias("_slot"))
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), F.lit(j).alias("_slot")) for (f, q), j in slots.items()])
    table = src.sparkSession.range(1).select(F.inline(rows))
    return src.join(F.broadcast(table), ["family", "qualifier"], "left").select("row_key", "ts", "seq", "value", "_slot")


def _bisected(slots: dict[tuple[str, str], int], family: Column, qualifier: Column) -> Column:
    def find(pairs: list[tuple[str, int]]) -> Column:
        if len(pairs) == 1:
            return F.when(qualifier == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
        mid = len(pairs) // 2
        return F.when(qualifier < F.lit(pairs[mid][0]), find(pairs[:mid])).otherwise(find(pairs[mid:]))

    out = None
    for fam in sorted({f for f, _ in slots}):
        own = sorted(((q, j) for (f, q), j in slots.items() if f == fam), key=lambda p: p[0].encode())
        cond = family == F.lit(fam)
        out = F.when(cond, find(own)) if out is None else out.when(cond, find(own))
    return F.lit(None).cast("int") if out is None else out


def _newest_of_slots(e: str) -> Column:
    """Of cells sorted by slot and version, the newest of each slot."""
    last = F.filter(e, lambda x, i: F.coalesce(F.get(e, i + 1)["_slot"] != x["_slot"], F.lit(True)))
    return F.when(F.size(F.array_distinct(F.col(f"{e}._slot"))) == F.size(e), F.col(e)).otherwise(last)


def _lies_by_key(df: DataFrame) -> bool:
    """Whether all cells of a row key lie in one task already."""
    plan = df._jdf.queryExecution().sparkPlan()
    return re.match(r"hashpartitioning\(row_key#\d+, ", plan.outputPartitioning().toString()) is not None


def _packed_rows(pre: DataFrame, n: int) -> DataFrame:
    """``row_key, _d, _ts``: one row for each row key; ``_d`` holds the newest value of
    each of the ``n`` slots at the slot's place (NULL where there is none).

    Cells are packed into one array per row key and map task (grouped by the
    task's number, so an array never holds more than one input partition) and cut
    to the newest one of each slot; only these arrays are put together by row key,
    so that a row's array is bounded by the slots and tasks that hold its cells.
    Where the cells lie in tasks by row key, that is one array for each row, and no
    cell crosses the network.
    The cost of a cell does not depend on the number of columns, and the columns
    are spread once for each row, by position: an empty cell of every slot that a
    row has no cell of is sorted in.
    """
    cell = F.when(F.col("_slot").isNotNull(), F.struct("_slot", "ts", "seq", "value"))
    by = ["row_key"] if _lies_by_key(pre) else ["row_key", "_task"]
    rows = (pre.select("row_key", "ts", F.spark_partition_id().alias("_task"), cell.alias("_cell"))
            .groupBy(*by).agg(F.sort_array(F.collect_list("_cell")).alias("_e"), F.max("ts").alias("_ts"))
            .select("row_key", "_ts", _newest_of_slots("_e").alias("_e")))
    if len(by) > 1:
        rows = (rows.groupBy("row_key").agg(F.sort_array(F.flatten(F.collect_list("_e"))).alias("_e"), F.max("_ts").alias("_ts"))
                .select("row_key", "_ts", _newest_of_slots("_e").alias("_e")))
    placed = F.transform("_e", lambda x: F.struct(x["_slot"].alias("_slot"), x["value"].alias("value")))
    missing = F.array_except(F.array(*[F.lit(j) for j in range(n)]), F.col("_e._slot"))
    empty = F.transform(missing, lambda j: F.struct(j.alias("_slot"), F.lit(None).cast(pre.schema["value"].dataType).alias("value")))
    full = rows.select("row_key", "_ts", F.when(F.size("_e") == n, placed).otherwise(F.sort_array(F.concat(placed, empty))).alias("_f"))
    return full.select("row_key", "_ts", F.col("_f.value").alias("_d"))


#: rows of more cells (all versions) are put together from pieces of about this size
HOT_ROW_CELLS = 100_000
#: hash values that mark rows of many cells: the most rows of a broadcast
HOT_BUCKETS = 1 << 16
#: hash values by which cells are counted before rows are
COUNT_BUCKETS = 1 << 18


def _map_rows(src: DataFrame, scalars: Sequence[Field], maps: Sequence[Field], hot_cells: int) -> DataFrame:
    """``row_key, _e, _v0 ..., _ts``: the newest cells that the map fields read, as one
    array per row, and the newest value of each scalar field.

    Cells are packed by row within each map task and cross the network once. A row
    key of more than ``hot_cells`` cells would make one array of all its versions, so
    the cells are counted first (the key column only), by one of ``COUNT_BUCKETS`` hash values
    and only where that finds more than ``hot_cells`` by row key, and such a row is cut by
    a hash of the cell into pieces of about ``hot_cells``; every piece keeps its newest
    cells; of these the newest of each cell is taken by cell, and only that goes to
    the task that puts the row together. Rows with
    many cells are marked by one of ``HOT_BUCKETS`` hash values: that bounds the
    broadcast, and another row with the same mark only takes the longer way.
    """
    bucket = F.pmod(F.xxhash64("row_key"), F.lit(HOT_BUCKETS))
    fine = F.pmod(F.xxhash64("row_key"), F.lit(COUNT_BUCKETS))
    busy = (src.groupBy(fine.alias("_fine")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_cells).select("_fine"))
    counted = src.select("row_key", fine.alias("_fine")).join(F.broadcast(busy), "_fine", "left_semi")
    hot = (counted.groupBy("row_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_cells)
           .groupBy(bucket.alias("_bucket")).agg(F.max(F.ceil(F.col("_n") / hot_cells)).alias("_pieces")))
    rows = src.withColumn("_bucket", bucket)
    # the task's number spreads repeats of one and the same cell
    piece = F.pmod(F.xxhash64("family", "qualifier", "ts", "seq", "value", F.spark_partition_id()), F.col("_pieces"))
    cell = F.when(reduce(or_, [_match(f) for f in maps]), F.struct("family", "qualifier", "ts", "seq", "value"))
    slots = [F.when(_match(f), F.struct("ts", "seq", "value")).alias(f"_v{i}") for i, f in enumerate(scalars)]
    most = [F.max(f"_v{i}").alias(f"_v{i}") for i in range(len(scalars))] + [F.max("_ts").alias("_ts")]
    # both joins share the broadcast; rows of few cells take no part in the second
    few = rows.join(F.broadcast(hot), "_bucket", "left").where(F.col("_pieces").isNull())
    whole = _newest_entries(few.select("row_key", F.col("ts").alias("_ts"), cell.alias("_cell"), *slots)
                            .groupBy("row_key").agg(F.collect_list("_cell").alias("_e"), *most))
    many = rows.join(F.broadcast(hot), "_bucket")
    cut = _newest_entries(many.select("row_key", piece.alias("_piece"), F.col("ts").alias("_ts"), cell.alias("_cell"), *slots)
                          .groupBy("row_key", "_piece").agg(F.collect_list("_cell").alias("_e"), *most))
    # versions of one cell lie in several pieces: only the newest goes to the task that holds the row.
    # The first entry of a piece, without a cell, takes the scalars along
    entries = cut.select("row_key", "_ts", F.posexplode(F.concat(F.array(F.lit(None).cast(
        cut.schema["_e"].dataType.elementType)), "_e")).alias("_at", "_x"), *[f"_v{i}" for i in range(len(scalars))])
    entries = entries.select("row_key", "_ts", "_x.family", "_x.qualifier", F.when(F.col("_at") > 0, F.struct(
        "_x.ts", "_x.seq", "_x.value")).alias("_c"), *[F.when(F.col("_at") == 0, F.col(f"_v{i}")).alias(f"_v{i}") for i in range(len(scalars))])
    once = entries.groupBy("row_key", "family", "qualifier").agg(F.max("_c").alias("_c"), *most)
    joined = once.groupBy("row_key").agg(F.collect_list(F.when(F.col("_c").isNotNull(), F.struct(
        "family", "qualifier", "_c.ts", "_c.seq", "_c.value"))).alias("_e"), *most)
    rows = whole.unionByName(joined.withColumn("_e", F.sort_array("_e")))
    return rows.select("row_key", "_e", "_ts", *[F.col(f"_v{i}.value").alias(f"_v{i}") for i in range(len(scalars))])


def _newest_entries(rows: DataFrame) -> DataFrame:
    """``_e`` with the newest version of each cell only, in order of family and qualifier."""
    last = F.filter("_e", lambda x, i: F.coalesce(
        (F.get("_e", i + 1)["qualifier"] != x["qualifier"]) | (F.get("_e", i + 1)["family"] != x["family"]), F.lit(True)))
    return rows.withColumn("_e", F.sort_array("_e")).withColumn("_e", last)


def _entries(cells: Column, f: Field, m: Mapping) -> Column:
    """Decoded entries of map field ``f`` among a row's newest cells; empty values are dropped."""
    def read(x):
        mine = (x["family"] == F.lit(f.family)) & (F.length(x["value"]) > 0)
        return mine & x["qualifier"].startswith(f.qualifier) if f.role == "prefix" else mine

    return F.transform(F.filter(cells, read), lambda x: F.struct(
        _map_key(x["qualifier"], f, m).alias("key"), x["ts"].alias("ts"), x["seq"].alias("seq"),
        x["value"].alias("raw"), _map_value(x["value"], f, m).alias("value")))


# ---------------------------------------------------------------------- E6
def latest(cells: DataFrame, by: Sequence[str] = ("row_key", "family", "qualifier")) -> DataFrame:
    """Newest version of every cell: max of (ts, seq), value as last tie break."""
    return (cells.groupBy(*by)
            .agg(F.max(F.struct("ts", "seq", "value")).alias("_c"))
            .select(*by, "_c.ts", "_c.seq", "_c.value"))


# ---------------------------------------------------------------------- A10
def scan_versions(cells: DataFrame, n: int) -> DataFrame:
    """Up to ``n`` newest versions of each cell with their rank (1 = newest).

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a cell with millions of versions ships at most ``n`` rows
    per map task.
    """
    w = Window.partitionBy("row_key", "family", "qualifier").orderBy(
        F.col("ts").desc(), F.col("seq").desc(), F.col("value").desc())
    return (cells.withColumn("version", F.row_number().over(w))
            .where(F.col("version") <= n))


# ----------------------------------------------------------------- A1 – A6
def scan_table(
    cells: DataFrame,
    m: Mapping,
    columns: Sequence[str] | None = None,
    *,
    projected_only: bool = False,
    raw_key: bool = False,
    hot_cells: int = HOT_ROW_CELLS,
) -> DataFrame:
    """Typed rows from cells under mapping ``m``.

    ``columns`` projects (A2): only the cells those columns need are kept,
    ahead of the pivot, as a filter Parquet can push down.  A row is returned
    when it has a cell in any mapped column; with ``projected_only=True`` only
    when it has a cell in a *requested* column (the wide-column store's own
    rule, which reads fewer cells).  Mappings with map columns put the cells of a
    row together in arrays of about ``hot_cells`` cells (:func:`_map_rows`).
    """
    wanted = [f for f in m.fields if columns is None or f.name in columns or f.role == "key"]
    data_fields = [f for f in wanted if f.role in ("column", "family", "prefix")]
    presence = data_fields if (projected_only or columns is None) else \
        [f for f in m.fields if f.role in ("column", "family", "prefix")]
    if not presence:
        presence = [f for f in m.fields if f.role in ("column", "family", "prefix")]
    cond = cell_filter(presence)
    src = cells.where(cond) if cond is not None else cells

    maps = [f for f in data_fields if f.role != "column"]
    scalars = [f for f in data_fields if f.role == "column"]
    if not maps:
        # One slot per distinct (family, qualifier). Each slot keeps the max of the
        # (ts, seq, value) version order: the newest version, an exact (ts, seq)
        # tie decided by the value, so the result never depends on the order tasks
        # meet the cells. Few columns are aggregated cell by cell; for many, that
        # would evaluate every column for each cell, so rows are packed first.
        slots: dict[tuple, int] = {}
        for f in scalars:
            slots.setdefault((f.family, f.qualifier), len(slots))
        pre = _with_slots(src, slots)
        if len(slots) > PACK_ABOVE:
            grouped, at = _packed_rows(pre, len(slots)), "get(_d, {})"
        else:
            rows = pre.select("row_key", F.col("ts").alias("_ts"), "_slot", F.struct("ts", "seq", "value").alias("_o"))
            aggs = [F.max(F.when(F.col("_slot") == j, F.col("_o"))).alias(f"_s{j}") for j in range(len(slots))]
            grouped, at = rows.groupBy("row_key").agg(*aggs, F.max("_ts").alias("_ts")), "_s{}.value"
        grouped = grouped.select("row_key", "_ts", *[
            F.expr(f"{at.format(slots[(f.family, f.qualifier)])} AS _v{i}") for i, f in enumerate(scalars)])
        map_cols: dict[str, Column] = {}
    else:
        grouped = _map_rows(src, scalars, maps, hot_cells)
        for j, f in enumerate(maps):
            grouped = grouped.withColumn(f"_m{j}", _entries(F.col("_e"), f, m))
        # sort first in its own projection: the dedup below reads the sorted
        # array once per element and must not re-sort it each time
        for j, f in enumerate(maps):
            if _needs_dedup(f):
                grouped = grouped.withColumn(f"_m{j}", _sorted_entries(F.col(f"_m{j}")))
        map_cols = {f.name: _entries_to_map(F.col(f"_m{j}"), f) for j, f in enumerate(maps)}

    out = []
    for f in wanted:
        if f.role == "key":
            out.append((F.col("row_key") if raw_key else decode_key(F.col("row_key"), m))
                       .alias(f.name))
        elif f.role == "timestamp":
            out.append(millis_to_timestamp(F.col("_ts"), f.dtype).alias(f.name))
        elif f.role == "column":
            i = scalars.index(f)
            out.append(decode_field(F.col(f"_v{i}"), f, m).alias(f.name))
        else:
            out.append(map_cols[f.name].alias(f.name))
    return grouped.select(*out)


def _needs_dedup(f: Field) -> bool:
    """Decoding can fold two qualifiers onto one map key (prefix hiding,
    non-string or binary keys)."""
    return f.hide_prefix or not isinstance(f.dtype.keyType, T.StringType) \
        or f.key_storage == "binary"


def _sorted_entries(entries: Column) -> Column:
    """Entries by key, newest first within a key (ties: larger raw value
    first, as everywhere else); NULL keys removed."""
    e = F.filter(entries, lambda x: x["key"].isNotNull())
    return F.array_sort(e, lambda a, b: F.when(a["key"] < b["key"], -1)
                        .when(a["key"] > b["key"], 1)
                        .when(a["ts"] > b["ts"], -1).when(a["ts"] < b["ts"], 1)
                        .when(a["seq"] > b["seq"], -1).when(a["seq"] < b["seq"], 1)
                        .when(a["raw"] > b["raw"], -1).when(a["raw"] < b["raw"], 1)
                        .otherwise(0))


def _entries_to_map(entries: Column, f: Field) -> Column:
    """array<struct<key,ts,seq,value>> → map; for folded keys the newest wins
    (``entries`` is then already sorted by :func:`_sorted_entries`)."""
    if _needs_dedup(f):
        e = F.filter(entries, lambda x, i: (i == 0) | (
            F.element_at(entries, F.greatest(i, F.lit(1)))["key"] != x["key"]))
    else:
        e = F.filter(entries, lambda x: x["key"].isNotNull())
    m = F.map_from_entries(F.transform(e, lambda x: F.struct(x["key"], x["value"])))
    return m.cast(f.dtype)


# ---------------------------------------------------------------------- A3
def scan_keys(cells: DataFrame) -> DataFrame:
    """Distinct row keys, values untouched (Parquet reads one column)."""
    return cells.select("row_key").distinct()


def row_count(cells: DataFrame) -> DataFrame:
    """One row: number of distinct row keys and of cells."""
    return cells.agg(F.count_distinct("row_key").alias("rows"), F.count(F.lit(1)).alias("cells"))


# ---------------------------------------------------------------- A4 / A5
def scan_family_map(cells: DataFrame, family: str, key_type="string", value_type="string",
                    *, key_storage="string", value_storage="string", name="value",
                    m: Mapping | None = None, hot_cells: int = HOT_ROW_CELLS) -> DataFrame:
    """(row_key, map) of the newest cell per qualifier of ``family``."""
    f = Field(name, f"map<{_tn(key_type)},{_tn(value_type)}>", "family", family,
              storage=value_storage, key_storage=key_storage)
    mm = Mapping((Field("row_key", "string", "key"), f),
                 null_format=m.null_format if m else "\\N")
    return scan_table(cells, mm, raw_key=True, hot_cells=hot_cells)


def scan_prefix_map(cells: DataFrame, family: str, prefix: str, hide: bool = False,
                    value_type="string", name="value") -> DataFrame:
    f = Field(name, f"map<string,{_tn(value_type)}>", "prefix", family, prefix, hide_prefix=hide)
    mm = Mapping((Field("row_key", "string", "key"), f))
    return scan_table(cells, mm, raw_key=True)


def _tn(t) -> str:
    return t if isinstance(t, str) else t.simpleString()


__all__ = ["latest", "scan_versions", "scan_table", "scan_keys", "row_count",
           "scan_family_map", "scan_prefix_map", "cell_filter", "decode_field", "decode_key"]
