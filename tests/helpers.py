from pyspark.sql import functions as F

from cellwise.mapping import CELL_DDL


def cells(spark, rows):
    """Cells from (row_key, family, qualifier, ts, value[, seq]) tuples; text
    values are UTF-8 encoded, bytes kept."""
    out = []
    for r in rows:
        k, fam, q, ts, v = r[:5]
        seq = r[5] if len(r) > 5 else 0
        if isinstance(v, str):
            v = v.encode()
        out.append((k, fam, q, ts, seq, bytearray(v) if v is not None else None))
    return spark.createDataFrame(out, CELL_DDL)


def rows(df, order=None):
    d = df.orderBy(*(order or df.columns[:1])) if order is not False else df
    return [tuple(r) for r in d.collect()]


__all__ = ["cells", "rows", "F"]
