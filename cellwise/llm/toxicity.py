"""Toxicity by multiple-instance learning.

A document is a bag of sentences, and only the bag has a label. A sentence's
probability is a logistic of its words; a document's is the noisy-or of its
sentences. Trained from document labels, the sentence model then says which
sentence offends.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise, slices
from .sampling import per_class, single_labels

SENTENCE = regex.compile(r"[^.!?\n]+")
WORD = regex.compile(r"\w+")
STEM = 5


def features(text: str) -> set[str]:
    """The lower-cased words of a text, and the stems of longer ones."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


class Model:
    """Weights of the words that can make a sentence toxic, and a plain sentence's logit."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.words = {w for w in weights if not w.endswith("*")}
        self.stems = {w[:-1] for w in weights if w.endswith("*")}

    def sentence(self, text: str) -> float:
        """Logit of one sentence."""
        return self.bias + sum(self.weights[f] for f in features(text) if f in self.weights)

    def score(self, text: str | None) -> tuple[float, int, int, float]:
        """(document score, start and end of the worst sentence, its score); -1 without a sentence."""
        text = text or ""
        # words without a weight need no sentence of their own
        words = set(WORD.findall(text.lower()))
        hits = bool(words & self.words) or any(w[:STEM] in self.stems for w in words if len(w) > STEM)
        plain = float(np.logaddexp(0.0, self.bias))
        total, worst = 0.0, (-1, -1, 0.0)
        best = -np.inf
        for m in SENTENCE.finditer(text):
            z = self.sentence(m.group()) if hits else self.bias
            total += plain if z == self.bias else float(np.logaddexp(0.0, z))
            if z > best:
                best, worst = z, (*m.span(), 1 / (1 + float(np.exp(-z))))
            if not hits:
                total = plain * sum(1 for _ in SENTENCE.finditer(text))
                break
        return 1.0 - float(np.exp(-total)), *worst


def _count_fn(batches):
    """Documents of each label that hold a feature, added up within the task."""
    pos, neg = Counter(), Counter()
    for b in slices(batches):
        for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            (pos if y else neg).update(features(t or ""))
    names = list(pos.keys() | neg.keys())
    for at in range(0, len(names), 20_000):
        part = names[at: at + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([pos[f] for f in part], pa.int64()),
                                          pa.array([neg[f] for f in part], pa.int64())], names=["f", "pos", "neg"])


def train_bags(sentences: list[list[list[int]]], plain: np.ndarray, y: np.ndarray, n_features: int,
               rounds: int = 400, rate: float = 0.1, decay: float = 1e-4, most_bias: float = -10.0) -> tuple[np.ndarray, float]:
    """Weights and bias of the noisy-or likelihood, by Adam over all bags at once.

    ``sentences`` holds each document's sentences with features, ``plain`` the
    number of its sentences without. The bias stays at or under ``most_bias``,
    so that thousands of plain sentences do not add up to a toxic document.
    """
    flat = [(d, s) for d, bag in enumerate(sentences) for s in bag]
    doc = np.array([d for d, _ in flat], int)
    row = np.repeat(np.arange(len(flat)), [len(s) for _, s in flat]) if flat else np.array([], int)
    col = np.array([f for _, s in flat for f in s], int)
    w, b = np.full(n_features, 5.0), most_bias
    step_w, step_b = [np.zeros(n_features), np.zeros(n_features)], [0.0, 0.0]
    n_pos, n_neg = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    weight = np.where(y == 1, 0.5 / n_pos, 0.5 / n_neg)
    for r in range(1, rounds + 1):
        z = b + np.bincount(row, weights=w[col], minlength=len(flat))
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        a = np.bincount(doc, weights=np.logaddexp(0, z), minlength=len(y)) + plain * np.logaddexp(0, b)
        # d loss / d a: the bag's log-probability of no toxic sentence is -a
        slope = weight * np.where(y == 1, -1 / np.expm1(np.clip(a, 1e-6, 50)), 1.0)
        gz = slope[doc] * p
        gw = np.bincount(col, weights=gz[row], minlength=n_features) + decay * w
        gb = float(gz.sum() + (slope * plain).sum() * p0)
        for held, g in ((step_w, gw), (step_b, gb)):
            held[0] = 0.9 * held[0] + 0.1 * g
            held[1] = 0.99 * held[1] + 0.01 * g * g
        lr = rate * np.sqrt(1 - 0.99 ** r) / (1 - 0.9 ** r)
        w = w - lr * step_w[0] / (np.sqrt(step_w[1]) + 1e-8)
        b = min(most_bias, b - lr * step_b[0] / (np.sqrt(step_b[1]) + 1e-8))
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_label: int = 4000, n_features: int = 2000, least: int = 3, train=None) -> Model:
    """The sentence model from at most ``per_label`` texts of each document label.

    The ``n_features`` words and stems most tied to toxic documents (by the lower
    end of the smoothed log-odds, in ``least`` or more of them) can carry weight;
    all other words are neutral. ``train`` (a boolean column over the id) limits the rows
    learned from. Without toxic or without clean texts, everything scores 0.
    A document without an id, or with both labels, teaches neither; one that is labelled
    twice alike counts once. Rows of ``docs`` that repeat an id are all read.
    """
    mine = single_labels(labels, id_col, label_col, train)
    chosen = per_class(mine, "y", "doc_id", per_label)
    bags = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                       .join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text"), "tox-bags")
    sizes = {r["y"]: r["count"] for r in bags.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Model({}, -40.0)
    counts = bags.select("y", "text").transform(map_arrow, _count_fn, "f string, pos long, neg long").groupBy("f").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = (F.log((F.col("pos") + 0.5) / (sizes[1] - F.col("pos") + 0.5))
            - F.log((F.col("neg") + 0.5) / (sizes[0] - F.col("neg") + 0.5)))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    top = (counts.filter(F.col("pos") >= least).withColumn("odds", odds - 2 * error).filter("odds > 0.7")
           .orderBy(F.desc("odds"), "f").limit(n_features).collect())
    place = {r.f: i for i, r in enumerate(top)}

    def cut(batches):
        for b in slices(batches):
            out, plain = [], []
            for t in b.column(2).to_pylist():
                found = [sorted(place[f] for f in features(s) if f in place) for s in SENTENCE.findall(t or "")]
                out.append([s for s in found if s])
                plain.append(sum(not s for s in found))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(plain, pa.int64()),
                                              pa.array(out, pa.list_(pa.list_(pa.int32())))], names=["doc_id", "y", "plain", "hits"])

    seen = bags.transform(map_arrow, cut, "doc_id long, y int, plain long, hits array<array<int>>").orderBy("doc_id").collect()
    w, b = train_bags([r.hits for r in seen], np.array([r.plain for r in seen], float), np.array([r.y for r in seen]), len(place))
    return Model({f: float(w[i]) for f, i in place.items() if w[i] != 0.0}, b)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, worst_start, worst_end, worst_score`` for every whole text.

    The span of the sentence most likely toxic is in characters, -1 for texts
    without a sentence, whose score is 0. Map-only; the model holds a bounded
    number of words.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in slices(batches):
            rows = [m.score(t) for t in b.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.float64())], names=["doc_id", "score", "worst_start", "worst_end", "worst_score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.transform(map_arrow, run, "doc_id long, score double, worst_start int, worst_end int, worst_score double")
