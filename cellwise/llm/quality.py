"""Quality by compression: is a text shorter under a good or a bad dictionary?

Two zstandard dictionaries are trained on pieces of good and of bad labelled
texts. A text is compressed piece by piece under each, and the difference of
the sizes over the text's length is turned into a probability by a calibration learned
on labelled texts that built no dictionary.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_crc_mod, map_arrow, materialise, slices
from .sampling import per_class, single_labels


def pieces(text: str | None, size: int) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i: i + size] for i in range(0, len(raw), size)]


class Sizer:
    """Compressed sizes of a text under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes, piece: int, level: int):
        self.piece, self.tools = piece, []
        for d in (good, bad):
            held = zstandard.ZstdCompressionDict(d)
            held.precompute_compress(level=level)
            self.tools.append(zstandard.ZstdCompressor(
                dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))

    def difference(self, text: str | None) -> float:
        """(good - bad) over the length of the whole text in bytes; under 0: good is shorter."""
        parts = pieces(text, self.piece)
        if not parts:
            return 0.0
        good, bad = (sum(len(t.compress(p)) for p in parts) for t in self.tools)
        return (good - bad) / sum(map(len, parts))


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; with too little to train on, the
    samples themselves."""
    if sum(map(len, samples)) < 10 * size or len(samples) < 64:
        return b"".join(samples)[-size:] or b" "
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def calibrate(x: np.ndarray, y: np.ndarray, bins: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(differences, probabilities) of a non-increasing curve: pooled adjacent
    violators over equally filled bins, joined by straight lines."""
    if len(x) == 0:
        return np.array([0.0]), np.array([0.5])
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order].astype(np.float64)
    blocks: list[list[float]] = []               # (sum of x, good, rows)
    for part in np.array_split(np.arange(len(x)), min(bins, len(x))):
        blocks.append([float(x[part].sum()), float(y[part].sum()), float(len(part))])
        while len(blocks) > 1 and blocks[-1][1] * blocks[-2][2] > blocks[-2][1] * blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    at = np.array([b[0] / b[2] for b in blocks])
    return at, np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks])


class Model:
    def __init__(self, good: bytes, bad: bytes, piece: int, level: int, at: np.ndarray, p: np.ndarray):
        self.args, self.at, self.p = (good, bad, piece, level), at, p

    def sizer(self) -> Sizer:
        return Sizer(*self.args)

    def score(self, d: float) -> float:
        return float(np.interp(d, self.at, self.p))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_label: int = 2000, piece: int = 1024, dict_bytes: int = 65536, dict_pieces: int = 6000, level: int = 3,
        train=None) -> Model:
    """Dictionaries and calibration from at most ``per_label`` texts of each label.

    ``train`` (a boolean column over the id) limits the rows learned from. By a
    hash of the id, half of the sampled texts build the dictionaries (at most
    ``dict_pieces`` pieces for each) and half the calibration. A document without
    an id, or with both labels, teaches neither; one that is labelled twice alike counts
    once. Without labels the score is 0.5 everywhere, with one label the share of it.
    """
    mine = single_labels(labels, id_col, label_col, train)
    chosen = per_class(mine, "y", "doc_id", per_label)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
            .filter("text is not null").withColumn("half", doc_crc_mod(F.concat(F.lit("half"), F.col("doc_id").cast("string")), 2)))

    def cut(batches):
        for b in slices(batches):
            y, p = [], []
            for label, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for x in pieces(t, piece):
                    y.append(label), p.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(p, pa.binary())], names=["y", "piece"])

    cutting = materialise(rows.filter("half = 0").select("y", "text").transform(map_arrow, cut, "y int, piece binary"), "quality-pieces")
    got = per_class(cutting.withColumn("k", F.xxhash64("piece")).dropDuplicates(["y", "k"]), "y", "k", dict_pieces) \
        .orderBy("y", "k").select("y", "piece").collect()
    good, bad = (train_dictionary([bytes(r.piece) for r in got if r.y == v], dict_bytes) for v in (1, 0))

    def measure(batches):
        sizer = Sizer(good, bad, piece, level)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sizer.difference(t) for t in b.column(1).to_pylist()], pa.float64())], names=["y", "d"])

    seen = rows.filter("half = 1").select("y", "text").transform(map_arrow, measure, "y int, d double").toPandas()
    if seen["y"].nunique() < 2:
        share = float(seen["y"].mean()) if len(seen) else 0.5
        return Model(good, bad, piece, level, np.array([0.0]), np.array([share]))
    # the sample's labels are balanced; each bin counts by the share of its label
    at, p = calibrate(seen["d"].to_numpy(), seen["y"].to_numpy())
    sizes = {r["y"]: r["count"] for r in mine.groupBy("y").count().collect()}
    took = seen["y"].value_counts().to_dict()
    odds = p / (1 - p) * (sizes.get(1, 1) / took.get(1, 1)) / (sizes.get(0, 1) / took.get(0, 1))
    return Model(good, bad, piece, level, at, odds / (1 + odds))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, difference`` for every whole text; NULL and empty texts
    have difference 0. Map-only; both dictionaries are of bounded size."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        sizer = m.sizer()
        for b in slices(batches):
            d = [sizer.difference(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(x) for x in d], pa.float64()), pa.array(d, pa.float64())],
                                             names=["doc_id", "score", "difference"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.transform(map_arrow, run, "doc_id long, score double, difference double")
