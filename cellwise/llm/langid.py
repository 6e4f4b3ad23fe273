"""Language ID by nearest centroid.

A text is a normalised TF-IDF vector of hashed letter trigrams. Each language
has several centroids, clustered from a bounded sample of its labelled texts;
the language of the most similar centroid by cosine is predicted, and a text
farther from every centroid than texts of its length ever are is rejected.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise, slices
from .sampling import per_class

DIMS = 1 << 13
LETTER = regex.compile(r"\p{L}")
# ASCII letters stay, other ASCII bytes are spaces, bytes from 0x80 stay
_KEEP = bytes(b if chr(b).isascii() and chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))
_SHIFT = np.uint32(32 - 13)


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashed trigrams, how often each occurs) of the lower-cased text."""
    b = np.frombuffer(b" " + (text or "").lower().encode().translate(_KEEP) + b" ", np.uint8)
    x, y, z = b[:-2], b[1:-1], b[2:]
    ok = (y != 32) | ((x != 32) & (z != 32))
    code = (x * np.uint32(0x9E3779B1) + y * np.uint32(0x85EBCA77) + z * np.uint32(0xC2B2AE3D))[ok]
    code ^= code >> np.uint32(15)
    n = np.bincount((code * np.uint32(0x2C1B3C6D)) >> _SHIFT, minlength=DIMS)
    at = np.flatnonzero(n)
    return at, n[at]


def weigh(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(n) * idf[at]
    norm = np.sqrt(v @ v)
    return v / norm if norm > 0 else v


def length_bucket(n: np.ndarray) -> int:
    return int(n.sum()).bit_length()


def _sample_fn(batches):
    for b in slices(batches):
        rows = [trigram_counts(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([x.astype(np.int32) for x, _ in rows], pa.list_(pa.int32())),
             pa.array([np.minimum(n, 1 << 30).astype(np.int32) for _, n in rows], pa.list_(pa.int32()))],
            names=["lang", "at", "n"])


def _cluster_fn(idf: np.ndarray, k: int, rounds: int):
    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(pdf), DIMS), np.float32)
        sizes = []
        for i, (at, n) in enumerate(zip(pdf["at"], pdf["n"])):
            x[i, at] = weigh(np.asarray(at), np.asarray(n), idf)
            sizes.append(length_bucket(np.asarray(n)))
        order = np.argsort([-s for s in sizes], kind="stable")
        centres = [x[order].mean(axis=0)]
        while len(centres) < min(k, len(x)):             # the text least like any centre so far, among the longer ones
            like = np.max([x[order[: (len(x) + 1) // 2]] @ c for c in centres], axis=0)
            centres.append(x[order[int(like.argmin())]])
        c = np.stack(centres)
        for _ in range(rounds):
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
            own = (x @ c.T).argmax(axis=1)
            c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        like = (x @ c.T).max(axis=1)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centres": [c.ravel().tolist()],
                             "sizes": [sizes], "like": [like.tolist()]})
    return cluster


class Model:
    def __init__(self, langs: list[str], centres: np.ndarray, idf: np.ndarray, floor: np.ndarray):
        self.langs, self.centres, self.idf, self.floor = langs, centres, idf, floor

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, similarity, rejected)."""
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0, True
        at, n = trigram_counts(text)
        like = self.centres[:, at] @ weigh(at, n, self.idf)
        best = int(like.argmax())
        score = float(min(1.0, max(0.0, like[best])))
        return self.langs[best], score, score < self.floor[min(length_bucket(n), len(self.floor) - 1)]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 1500, clusters: int = 3, rounds: int = 8, low: float = 0.002, margin: float = 0.35) -> Model:
    """Centroids from at most ``per_lang`` labelled texts of each language.

    A text is rejected below ``margin`` times the ``low`` quantile of the
    sample's own similarities among texts of its length bucket (powers of two
    of trigrams). A bucket takes the least of its own and its two neighbours'
    quantiles, as far as they hold 20 texts; where none of them does, longer and
    shorter lengths alike, the nearest buckets that do count, and if no bucket
    does, all sampled texts together. What a bucket takes from a longer one
    falls with the root of the length, as similarity does. Rows without an id
    teach nothing; rows that share an id are ranked by their text's hash.
    """
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter("doc_id is not null and lang is not null and text is not null")
    rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    sample = materialise(per_class(rows, "lang", "doc_id", per_lang, F.xxhash64("text")).select("lang", "text")
                         .transform(map_arrow, _sample_fn, "lang string, at array<int>, n array<int>"), "lang-sample")
    total = sample.count()
    seen = sample.select(F.explode("at").alias("d")).groupBy("d").count().toPandas()      # DIMS rows at most
    df = np.zeros(DIMS)
    df[seen["d"].to_numpy(int)] = seen["count"].to_numpy()
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    got = sample.groupBy("lang").applyInPandas(
        _cluster_fn(idf, clusters, rounds), "lang string, centres array<float>, sizes array<int>, like array<float>") \
        .orderBy("lang").collect()
    langs, centres = [], []
    by_size: dict[int, list[float]] = {}
    for r in got:
        c = np.array(r.centres, np.float32).reshape(-1, DIMS)
        centres.append(c)
        langs += [r.lang] * len(c)
        for s, x in zip(r.sizes, r.like):
            by_size.setdefault(s, []).append(x)
    floor = margin * _least_by_bucket(by_size, low)
    return Model(langs, np.concatenate(centres) if centres else np.zeros((0, DIMS), np.float32), idf, floor)


def _least_by_bucket(by_size: dict[int, list[float]], low: float, enough: int = 20) -> np.ndarray:
    """Per length bucket the ``low`` quantile of similarity, from the nearest buckets of ``enough`` texts."""
    known = {b: float(np.quantile(x, low)) for b, x in by_size.items() if len(x) >= enough}
    if not known:
        pooled = [x for xs in by_size.values() for x in xs]
        return np.full(64, float(np.quantile(pooled, low)) if pooled else 0.0)
    out = np.zeros(64)
    for s in range(64):
        reach = max(1, min(abs(b - s) for b in known))
        out[s] = min(q * 2 ** (-max(0, b - s - 1) / 2) for b, q in known.items() if abs(b - s) <= reach)
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every whole text.

    ``lang_pred`` is a learned language, or "und" (score 0, rejected) if the
    text is NULL, has no letter, or nothing was learned. ``score`` is the cosine
    to the nearest centroid. Map-only; the model is a few centroids of fixed
    size per language.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in slices(batches):
            rows = [m.predict(t) for t in b.column(1).to_pylist()]
            lang, score, rejected = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array([bool(x) for x in rejected], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.transform(map_arrow, run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, same columns. NULL texts
    and texts without a letter go."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = held.value
        for b in slices(batches):
            yield b.filter(pa.array([not m.predict(t)[2] for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.transform(map_arrow, run, docs.schema)
