"""Data-quality jobs: key validation, table statistics, qualifier census,
mapping check, decode audit and storage migration.

All are grouped aggregations with partial (map-side) aggregation; the only
results that reach the driver are report-sized.
"""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..mapping import Field, Mapping
from .encode import _map_key_text, encode_field, encode_key
from .scan import _map_key, _map_value, _match, cell_filter, decode_field, decode_key


# ---------------------------------------------------------------------- B3
def key_report(df: DataFrame, key: str) -> DataFrame:
    """One row per problem key: reason (null | empty | duplicate) and copies.

    A plain grouped count: map-side partial counts keep a hot key to one row
    per task before the shuffle.
    """
    k = F.col(key)
    counts = df.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    reason = (F.when(F.col("key").isNull(), "null")
              .when(F.col("key").cast("string") == "", "empty")
              .when(F.col("copies") > 1, "duplicate"))
    return counts.select("key", reason.alias("reason"), "copies").where(F.col("reason").isNotNull())


def tag_keys(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a ``reason``: null, empty, duplicate, or NULL for a good key.

    Two scans: a grouped count, which reads the key column only, and the rows,
    joined with the duplicate keys once. Rows without a key go through that
    join too, spread by a salt that no duplicate key has, so that they do not
    meet in one task; AQE's skew join splits a hot key's partition.
    """
    k = F.col(key)
    keyed = F.coalesce(k.isNotNull() & (k.cast("string") != ""), F.lit(False))
    # the salt depends on the count, so that it is a join key and no constant
    dup = (df.where(keyed).groupBy(k.alias("_cw_k")).agg(F.count(F.lit(1)).alias("_cw_n"))
           .where(F.col("_cw_n") > 1).withColumn("_cw_z", F.when(F.col("_cw_n") > 0, F.lit(0))))
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.when(keyed, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*plain), F.lit(1 << 20)).cast("int"))
    joined = df.withColumn("_cw_salt", salt).join(dup, (k == F.col("_cw_k")) & (F.col("_cw_salt") == F.col("_cw_z")), "left")
    reason = F.when(F.col("_cw_n").isNotNull(), "duplicate").when(k.isNull(), "null").when(~keyed, "empty")
    return joined.withColumn("reason", reason).drop("_cw_k", "_cw_n", "_cw_z", "_cw_salt")


def validate_keys(df: DataFrame, key: str, *, strict: bool = False):
    """Split ``df`` into rows with a good key (non-null, non-empty, unique)
    and rejected rows with a ``reason`` column.

    The tagged rows are written once below the shared checkpoint folder, split
    by outcome, and each returned frame reads its part.  ``strict`` raises on
    the first bad row instead (inside the job, no driver round trip).
    """
    from ..session import scratch_path
    tagged = tag_keys(df, key)
    if strict:
        bad = F.raise_error(F.concat(F.lit("bad row key: "), F.col("reason"))).cast("boolean")
        good = tagged.where(F.when(F.col("reason").isNull(), True).otherwise(bad)).drop("reason")
        return good, tagged.where(F.lit(False))
    path = scratch_path(df.sparkSession, "validated-keys")
    tagged.withColumn("_cw_good", F.col("reason").isNull()).write.partitionBy("_cw_good").parquet(path)
    held = df.sparkSession.read.schema(f"{tagged.schema.toDDL()}, _cw_good boolean").parquet(path)
    return (held.where(F.col("_cw_good")).drop("reason", "_cw_good"),
            held.where(~F.col("_cw_good")).drop("_cw_good"))


# ---------------------------------------------------------------------- E7
def table_stats(cells: DataFrame, m: Mapping) -> DataFrame:
    """rows, cells, bytes, and per mapped scalar column its non-null count and
    null rate, as one row.

    One scan and no pivot: the newest version of each cell (with the number and
    bytes of all its versions), then one count of distinct keys beside plain sums
    and conditional counts, which Spark plans as numbers per row key, folded in
    each map task.
    """
    cols = list(m.cell_fields)
    per = (cells.where(cell_filter(m.cell_fields + m.map_fields)).groupBy("row_key", "family", "qualifier")
           .agg(F.max(F.struct("ts", "seq", "value"))["value"].alias("value"), F.count(F.lit(1)).alias("n"),
                F.sum(F.octet_length("value") + F.octet_length("row_key") + F.octet_length("qualifier")).alias("b")))
    held = [F.count(F.when(_match(f), decode_field(F.col("value"), f, m))).alias(f"{f.name}_nonnull") for f in cols]
    out = per.agg(F.count_distinct("row_key").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("cells"),
                  F.sum("b").alias("bytes"), *held)
    return out.select(
        "rows", "cells", "bytes",
        *[F.col(f"{f.name}_nonnull") for f in cols],
        *[F.round(1 - F.col(f"{f.name}_nonnull") / F.col("rows"), 6).alias(f"{f.name}_null_rate")
          for f in cols])


# ---------------------------------------------------------------------- E8
def qualifier_profile(cells: DataFrame) -> DataFrame:
    """Per (family, qualifier): rows holding it, cells, first and last ts,
    bytes.  The distinct row count is planned as a two-level aggregate keyed
    by (family, qualifier, row_key), so no single task sees a whole family."""
    return cells.groupBy("family", "qualifier").agg(
        F.count_distinct("row_key").alias("rows"),
        F.count(F.lit(1)).alias("cells"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum(F.octet_length("value")).alias("bytes"),
    )


# ---------------------------------------------------------------------- E9
def mapping_frame(spark: SparkSession, m: Mapping) -> DataFrame:
    rows = [(f.name, f.role, f.family, f.qualifier) for f in m.fields
            if f.role in ("column", "family", "prefix")]
    return spark.createDataFrame(rows, "column string, role string, family string, pattern string")


def mapping_check(cells: DataFrame, m: Mapping, *, strict: bool = False) -> DataFrame:
    """Mapped columns with no cells, and occurring (family, qualifier) pairs no
    column maps, with their cell counts.

    The census is aggregated first (one row per qualifier); the mapping side
    is tiny and of known size, so the join is a broadcast.
    """
    spark = cells.sparkSession
    census = cells.groupBy("family", "qualifier").agg(F.count(F.lit(1)).alias("cells"))
    mp = F.broadcast(mapping_frame(spark, m))
    cond = ((census["family"] == mp["family"])
            & (((mp["role"] == "column") & (census["qualifier"] == mp["pattern"]))
               | (mp["role"] == "family")
               | ((mp["role"] == "prefix") & census["qualifier"].startswith(mp["pattern"]))))
    hit = census.join(mp, cond, "left").select(
        census["family"], census["qualifier"], census["cells"], mp["column"])
    unmapped = (hit.where(F.col("column").isNull())
                .select(F.lit("unmapped").alias("problem"), F.lit(None).cast("string").alias("column"),
                        "family", "qualifier", "cells"))
    used = hit.where(F.col("column").isNotNull()).groupBy("column").agg(
        F.sum("cells").alias("cells"))
    missing = (mapping_frame(spark, m).join(used, "column", "left_anti")
               .select(F.lit("no_cells").alias("problem"), "column", "family",
                       F.col("pattern").alias("qualifier"), F.lit(0).cast("bigint").alias("cells")))
    out = unmapped.unionByName(missing)
    if strict:
        out = out.withColumn("problem", F.raise_error(
            F.concat(F.lit("mapping check failed: "), F.col("problem"), F.lit(" "),
                     F.coalesce(F.col("family"), F.lit("")), F.lit(":"),
                     F.coalesce(F.col("qualifier"), F.lit("")))).cast("string"))
    return out


# --------------------------------------------------------------------- I12
def _faults(cells: DataFrame, m: Mapping, columns: list) -> DataFrame:
    """``columns`` of each cell once for every column that maps it, with what is
    wrong with it there: one pass over the cells (a cell may feed several
    columns)."""
    raw = codec.to_text(F.col("value"))
    is_nullseq = F.coalesce(raw == F.lit(m.null_format), F.lit(False))
    is_empty = F.octet_length("value") == 0
    tags = []
    for f in [*m.cell_fields, *m.map_fields]:
        is_map = f.role != "column"
        dtype = f.dtype.valueType if is_map else f.dtype
        decoded = _map_value(F.col("value"), f, m) if is_map else decode_field(F.col("value"), f, m)
        w = codec.width_of(dtype) if f.storage == "binary" else None
        wrong = (F.octet_length("value") != w) if w is not None else F.lit(False)
        bad_key = _map_key(F.col("qualifier"), f, m).isNull() if is_map else F.lit(False)
        tags.append(F.when(_match(f), F.struct(
            F.lit(f.name).alias("column"), F.lit(f.family).alias("family"),
            F.lit(f.qualifier or "").alias("qualifier"),
            (decoded.isNull() & ~is_nullseq & ~is_empty).alias("bad"),
            wrong.alias("wrong"), bad_key.alias("bad_key"))))
    found = F.filter(F.array(*tags), lambda t: t.isNotNull())
    return (cells.where(cell_filter([*m.cell_fields, *m.map_fields]))
            .select(*columns, is_nullseq.alias("_cw_nullseq"), is_empty.alias("_cw_empty"), F.explode(found).alias("_cw_t")))


def decode_audit(cells: DataFrame, m: Mapping) -> DataFrame:
    """Per mapped column, maps included: cells, values equal to the null
    sequence, empty values, undecodable values (read as NULL although present),
    for binary storage values of the wrong width, and for maps entries whose key
    does not decode (a map cannot hold them).  ``qualifier`` is a map's prefix,
    empty for a whole family."""
    return _faults(cells, m, []).groupBy("_cw_t.column", "_cw_t.family", "_cw_t.qualifier").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if("_cw_nullseq").alias("null_seq"),
        F.count_if("_cw_empty").alias("empty"),
        F.count_if("_cw_t.bad").alias("undecodable"),
        F.count_if("_cw_t.wrong").alias("wrong_width"),
        F.count_if("_cw_t.bad_key").alias("bad_keys"),
    )


def decode_rejects(cells: DataFrame, m: Mapping) -> DataFrame:
    """The cells behind the ``undecodable`` and ``bad_keys`` counts, with their
    column's name and the ``fault`` ("value" or "key")."""
    t = F.col("_cw_t")
    return (_faults(cells, m, cells.columns).where(t["bad"] | t["bad_key"])
            .select(*cells.columns, t["column"].alias("column"),
                    F.when(t["bad_key"], "key").otherwise("value").alias("fault")))


# --------------------------------------------------------------------- I11
def _moved(cells: DataFrame, m_from: Mapping, m_to: Mapping):
    """(row key, qualifier, value) of each cell under ``m_to``, and whether each
    of them could be decoded under ``m_from``."""
    to = {f.name: f for f in m_to.fields}
    raw = codec.to_text(F.col("value"))
    # the null sequence stays a NULL that overrides older versions: an empty
    # value in binary storage
    is_null = F.coalesce(raw == F.lit(m_from.null_format), F.lit(False))
    value, value_ok = F.col("value"), F.lit(True)
    qualifier, qualifier_ok = F.col("qualifier"), F.lit(True)
    for f in reversed([*m_from.cell_fields, *m_from.map_fields]):
        g = to.get(f.name)
        if g is None or g.role != f.role:
            continue
        is_map = f.role != "column"
        vg = Field("v", g.dtype.valueType, "column", g.family, "v", storage=g.storage) if is_map else g
        null = F.lit(b"") if vg.storage == "binary" else F.lit(m_to.null_format).cast("binary")
        decoded = _map_value(F.col("value"), f, m_from) if is_map else decode_field(F.col("value"), f, m_from)
        empty = F.octet_length("value") == 0
        new = F.when(is_null, null).when(empty & decoded.isNull(), F.col("value")).otherwise(encode_field(decoded, vg, m_to))
        value = F.when(_match(f), new).otherwise(value)
        value_ok = F.when(_match(f), is_null | empty | decoded.isNotNull()).otherwise(value_ok)
        if is_map:
            key = _map_key(F.col("qualifier"), f, m_from)
            qualifier = F.when(_match(f), _map_key_text(key, g)).otherwise(qualifier)
            qualifier_ok = F.when(_match(f), key.isNotNull()).otherwise(qualifier_ok)
    key = decode_key(F.col("row_key"), m_from)
    same = (m_from.key_codec is m_to.key_codec and m_from.key.storage == m_to.key.storage
            and m_from.key.dtype == m_to.key.dtype)
    row_key = F.col("row_key") if same else encode_key(key, m_to)
    key_ok = F.lit(True) if same else _all_decoded(key, m_from)
    return row_key, qualifier, value, key_ok, qualifier_ok, value_ok


def _all_decoded(key: Column, m: Mapping) -> Column:
    if m.key_codec is None:
        return key.isNotNull()
    return reduce(and_, [key[f.name].isNotNull() for f in m.key_codec.struct_type.fields])


def migrate_storage(cells: DataFrame, m_from: Mapping, m_to: Mapping, *, strict: bool = True) -> DataFrame:
    """Re-encode every cell from ``m_from``'s storage to ``m_to``'s: values, map
    keys and row keys (one key codec to another).

    Cell-wise (no pivot, no shuffle).  Cells no column maps, and columns that
    only one mapping has, keep their value.  A cell that does not decode
    raises, or with ``strict=False`` is left out and returned, unchanged, by
    :func:`migrate_rejects`.  The null sequence stays NULL.
    """
    row_key, qualifier, value, key_ok, qualifier_ok, value_ok = _moved(cells, m_from, m_to)
    ok = F.coalesce(key_ok & qualifier_ok & value_ok, F.lit(False))
    if strict:
        where = F.concat_ws(" ", F.hex(F.col("row_key").cast("binary")), "family", "qualifier")
        bad = F.raise_error(F.concat(F.lit("cell does not decode: "), where)).cast("binary")
        value = F.when(ok, value).otherwise(bad)
    else:
        cells = cells.where(ok)
    # keys are only encoded where they decode, as encoding a NULL raises
    row_key = F.when(ok, row_key)
    return cells.withColumns({"row_key": row_key, "qualifier": qualifier, "value": value})


def migrate_rejects(cells: DataFrame, m_from: Mapping, m_to: Mapping) -> DataFrame:
    """The cells that ``migrate_storage(strict=False)`` leaves out, unchanged,
    with the ``fault``: "row key", "map key" or "value"."""
    _, _, _, key_ok, qualifier_ok, value_ok = _moved(cells, m_from, m_to)
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return (cells.withColumn("fault", F.when(no(key_ok), "row key").when(no(qualifier_ok), "map key")
                             .when(no(value_ok), "value")).where(F.col("fault").isNotNull()))


__all__ = ["key_report", "tag_keys", "validate_keys", "table_stats", "qualifier_profile", "mapping_check",
           "mapping_frame", "decode_audit", "decode_rejects", "migrate_storage", "migrate_rejects"]
