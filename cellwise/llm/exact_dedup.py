"""Exact deduplication: 128-bit content hash, then bytes compared in each group."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def content_hash(text):
    """128-bit content hash (MD5 bytes)."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                hash_fn=content_hash) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; NULL counts as empty. ``keep`` names
    the stable id that stays, "min" or "max". Rows are grouped by content hash;
    the distinct byte strings of each group are gathered with
    ``collect_set``, which holds one text for any group free of collisions and
    folds copies in each map task, so a group of any size moves one text per
    task. A hash whose set has several texts is split by the text itself.
    Returned ids: a group whose ids are all NULL has a NULL keep_id; rows that
    repeat the kept id are all kept. Empty input gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    pick = F.min if keep == "min" else F.max
    src = docs.select(F.col(id_col).alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = src.select("doc_id", hash_fn(F.col("text")).alias("h"), "text")
    groups = materialise(
        rows.groupBy("h").agg(F.count("*").alias("group_size"), pick("doc_id").alias("keep_id"),
                              F.collect_set("text").alias("texts"))
        .select("h", "group_size", "keep_id", F.size("texts").alias("n_texts"),
                F.sha2(F.element_at("texts", 1).cast("binary"), 256).alias("text_sha256")), "exact")
    alone = (rows.select("doc_id", "h")
             .join(groups.filter("n_texts = 1"), "h")
             .select("doc_id", "keep_id", "group_size", "text_sha256"))
    if not groups.filter("n_texts > 1").isEmpty():
        # different texts under one hash: the text itself is the key
        mixed = rows.join(groups.filter("n_texts > 1").select("h"), "h", "left_semi")
        each = materialise(mixed.groupBy("text").agg(F.count("*").alias("group_size"),
                                                     pick("doc_id").alias("keep_id")), "exact-mixed")
        alone = alone.union(mixed.select("doc_id", "text").join(each, "text")
                            .select("doc_id", "keep_id", "group_size",
                                    F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")))
    return alone.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
