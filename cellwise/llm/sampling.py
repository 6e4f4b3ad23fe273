"""Bounded, reproducible samples of labelled rows for fitting classifiers."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRAIN = 1_000_000


def per_class(rows: DataFrame, label: str, id_col: str, most: int, *ties) -> DataFrame:
    """About ``most`` rows of each label value and never more, chosen by the hash of the id,
    rows of one id by the columns ``ties``.

    Class sizes are counted first; a hash threshold per class then keeps a few
    rows more than asked, and only those are ranked.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    keep = F.lit(False)
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(GRAIN))
    for value, n in sizes.items():
        share = min(GRAIN, int(GRAIN * 1.2 * most / n) + 1)
        keep = keep | ((F.col(label) == F.lit(value)) & (place < share))
    order = Window.partitionBy(label).orderBy("_place", id_col, *ties)
    return (rows.filter(keep).withColumn("_place", place).withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") <= most).drop("_place", "_rank"))


def single_labels(labels: DataFrame, id_col: str, label_col: str, train=None) -> DataFrame:
    """``doc_id, y`` of the documents that have one label only, 0 or 1.

    Rows without an id or with another label are left out, and so are documents that
    have both; ``train`` (a boolean column over ``doc_id``) limits the rows.
    """
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    if train is not None:
        rows = rows.filter(train)
    return rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_most")).filter("y = _most").drop("_most")
