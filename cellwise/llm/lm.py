"""LM scoring by deleted interpolation of n-gram estimates.

A bigram model over words: the maximum-likelihood estimates of the bigram and
of the word, and a uniform share for every word, are mixed with weights that
depend on how often the context was seen (buckets by powers of two). The
weights are learned by expectation-maximisation on held-out counts: each
training document is scored with its own counts deleted from the corpus.

Counts are exact over the whole corpus, by 64-bit word and bigram hashes. The
corpus is cut into blocks of about ``block_tokens`` words, written once as
compact id arrays. Each block sends its distinct hashes and counts to hash
ranges; each range adds them up and answers each block in the order it asked,
so that what moves is a few bytes per distinct bigram of a block.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashCache, doc_crc_mod, map_arrow, materialise, pair_hash, ship, slices, space_words

END, START = np.uint64(0x0E0D), np.uint64(0x57A7)        # the hashes of the end and of the start mark
_WORDS = HashCache()
BINS = 4                        # histogram bins for each doubling of a ratio
SPAN = 300                      # bins to either side
BLOCK = "block long, n_tokens long, ids binary, sizes binary, train binary, vocab binary, tokens binary"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def _pack_counts(a: np.ndarray) -> bytes:
    """Counts as 32-bit integers where they fit, else 64-bit ones."""
    wide = len(a) and int(a.max()) >= 1 << 32
    return (b"\x08" if wide else b"\x04") + _pack(a.astype("<i8" if wide else "<u4"))


def _unpack_counts(b: bytes) -> np.ndarray:
    return _unpack(b[1:], "<i8" if b[0] == 8 else "<u4").astype(np.int64)


def _block_fn(block_tokens: int):
    def run(batches):
        from pyspark import TaskContext
        made, part = 0, TaskContext.get().partitionId()
        ids, sizes, train, words, held = [], [], [], [], 0

        def flush():
            nonlocal ids, sizes, train, words, held, made
            flat = np.concatenate(words)
            vocab, inverse = np.unique(flat, return_inverse=True)
            # frequent words get small ids, which pack well
            order = np.argsort(-np.bincount(inverse, minlength=len(vocab)), kind="stable")
            place = np.empty(len(vocab), np.uint32)
            place[order] = np.arange(len(vocab), dtype=np.uint32)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([len(flat)], pa.int64()),
                 *(pa.array([x], pa.binary()) for x in (
                     _pack(np.array(ids, np.int64)), _pack(np.array(sizes, np.uint32)), _pack(np.array(train, np.uint8)),
                     vocab[order].tobytes(), _pack(place[inverse])))],
                names=["block", "n_tokens", "ids", "sizes", "train", "vocab", "tokens"])
            made += 1
            ids, sizes, train, words, held = [], [], [], [], 0
            return row

        for b in slices(batches):
            for i, t, learn in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                ws = space_words(t)
                h = np.empty(len(ws) + 1, np.uint64)
                h[:-1] = np.fromiter(map(_WORDS.__getitem__, ws), np.uint64, len(ws))
                h[-1] = END
                # a NULL id is written as the smallest long, and read back as NULL
                ids.append(-(1 << 63) if i is None else i), sizes.append(len(h)), train.append(bool(learn)), words.append(h)
                held += len(h)
                if held >= block_tokens:
                    yield flush()
        if words:
            yield flush()
    return run


class _Block:
    """A block read back: words and bigrams as indices into its distinct hashes."""

    def __init__(self, r):
        self.ids = _unpack(r["ids"], np.int64)
        self.sizes = _unpack(r["sizes"], np.uint32).astype(np.int64)
        self.train = _unpack(r["train"], np.uint8).astype(bool)
        vocab = np.frombuffer(r["vocab"], np.uint64)
        tok = _unpack(r["tokens"], np.uint32)
        order = np.argsort(vocab)
        self.words = vocab[order]
        rank = np.empty(len(vocab), np.int32)
        rank[order] = np.arange(len(vocab), dtype=np.int32)
        self.word = rank[tok]                                  # sorted place of each token's hash
        del tok
        starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        now = self.words[self.word]
        before = np.empty_like(now)
        before[1:] = now[:-1]
        before[starts] = START
        self.first = np.zeros(len(now), bool)
        self.first[starts] = True
        now = pair_hash(before, now)
        del before
        self.pairs, pair = np.unique(now, return_inverse=True)
        self.pair = pair.astype(np.int32)
        self.learn = self.train[self.doc]

    def asked(self):
        """(kind, sorted hashes, training counts of this block)."""
        yield 0, self.words, np.bincount(self.word, weights=self.learn, minlength=len(self.words)).astype(np.uint32)
        yield 1, self.pairs, np.bincount(self.pair, weights=self.learn, minlength=len(self.pairs)).astype(np.uint32)


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Places where the sorted hashes pass from one range to the next."""
    width = (1 << 64) // ranges + 1
    return np.searchsorted(keys, np.array([r * width for r in range(1, ranges)], np.uint64))


def _narrow(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences, in as few bytes each as the largest needs."""
    d = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    wide = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    head = keys[:1].astype("<u8").tobytes()
    d[:1] = 0
    wide = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([wide]) + head + d.view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def _widen(b: bytes) -> np.ndarray:
    wide, head = b[0], np.frombuffer(b[1:9], "<u8")[0]
    cols = np.frombuffer(b[9:], np.uint8).reshape(-1, wide)
    d = np.zeros((len(cols), 8), np.uint8)
    d[:, :wide] = cols
    return np.cumsum(d.view("<u8").ravel(), dtype=np.uint64) + head


def _ask_fn(ranges: int):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = _Block(r)
                out = {"bin": [], "block": [], "kind": [], "keys": [], "counts": []}
                for kind, keys, counts in block.asked():
                    for at, (k, c) in enumerate(zip(*(np.split(x, _cuts(keys, ranges)) for x in (keys, counts)))):
                        if len(k):
                            for col, v in zip(out.values(), (at, r["block"], kind, _narrow(k), _pack(c))):
                                col.append(v)
                for lo in range(0, len(out["bin"]), 256):
                    yield pa.RecordBatch.from_pydict({c: v[lo: lo + 256] for c, v in out.items()}, schema=_ASKED)
    return run


_ASKED = pa.schema([("bin", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()),
                    ("counts", pa.binary())])


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Total counts of one hash range: to each block, those of its hashes in its order."""
    out = []
    for kind, g in pdf.groupby("kind"):
        keys = [_widen(k) for k in g["keys"]]
        counts = [_unpack(c, np.uint32) for c in g["counts"]]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        known, held = int((total > 0).sum()), int(total.sum())
        for j, (block, at) in enumerate(zip(g["block"], np.split(place, ends[:-1]))):
            out.append((block, int(kind), int(pdf["bin"].iloc[0]), _pack(total[at]), known if j == 0 else 0, held if j == 0 else 0))
    return pd.DataFrame(out, columns=["block", "kind", "bin", "totals", "known", "held"])


def _totals(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Total counts of a block's words and bigrams, in the order of their hashes."""
    a = answers.sort_values(["kind", "bin"])
    return tuple(np.concatenate([_unpack(x, np.int64) for x in a["totals"][a["kind"] == k]]) for k in (0, 1))


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two of its count."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1).astype(np.float64))[1], 0)


def _ratios(pair, context, word, n, known):
    """Bigram and word estimates over the uniform one."""
    with np.errstate(divide="ignore", invalid="ignore"):
        two = np.where(context > 0, pair / np.maximum(context, 1), 0.0) * (known + 1)
        one = word / n * (known + 1) if n > 0 else np.ones(len(word))
    return two, one


def _contexts(word: np.ndarray, starts: np.ndarray, n_docs: int) -> np.ndarray:
    """Count of each token's context: of the word before it, or of the start mark."""
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[starts] = n_docs
    return context


def _own(index: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each token's entry occurs in its own document."""
    _, inverse, count = np.unique(index * np.int64(int(doc[-1]) + 1) + doc, return_inverse=True, return_counts=True)
    return count.astype(np.int32)[inverse]


def _histogram(block: _Block, words, pairs, n: int, known: int, n_docs: int):
    """Training tokens by (context bucket, binned ratios), own document deleted."""
    if not block.learn.any():
        return np.array([], np.int64), np.array([], np.int64)
    pair, word = pairs[block.pair], words[block.word]
    context = _contexts(word, np.flatnonzero(block.first), n_docs)
    own = _own(block.word, block.doc)
    own_context = np.empty_like(own)
    own_context[1:] = own[:-1]
    own_context[block.first] = 1
    pair, context, word = pair - _own(block.pair, block.doc), context - own_context, word - own
    rest = np.maximum(n - block.sizes[block.doc], 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        two = np.where(context > 0, pair / np.maximum(context, 1), 0.0) * (known + 1)
        one = word / rest * (known + 1)
        code = [np.where(x > 0, np.clip(np.rint(np.log2(np.maximum(x, 1e-30)) * BINS), -SPAN, SPAN) + SPAN + 1, 0).astype(np.int64)
                for x in (two, one)]
    size = 2 * SPAN + 2
    cell = (bucket_of(context).astype(np.int64) * size + code[0]) * size + code[1]
    return np.unique(cell[block.learn], return_counts=True)


def learn_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """(buckets, 3) weights of the bigram, word and uniform estimates, by
    expectation-maximisation over the held-out cells. A bucket without cells
    takes the weights of the one below it; an unseen context has no bigram share."""
    size = 2 * SPAN + 2
    bucket, two, one = cells // (size * size), cells // size % size, cells % size
    value = [np.where(x > 0, 2.0 ** ((x - SPAN - 1) / BINS), 0.0) for x in (two, one)]
    f = np.stack([value[0], value[1], np.ones(len(cells))], axis=1)
    weights = np.tile([0.3, 0.6, 0.1], (65, 1))
    weights[0] = [0.0, 0.9, 0.1]
    for b in range(65):
        mine = bucket == b
        if not mine.any():
            if b > 1:
                weights[b] = weights[b - 1]
            continue
        fb, cb, w = f[mine], counts[mine].astype(np.float64), weights[b]
        for _ in range(rounds):
            share = fb * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * cb[:, None]).sum(axis=0) / cb.sum()
            w = np.maximum(w, [0.0 if b == 0 else 1e-6, 1e-6, 1e-6])
            w /= w.sum()
        weights[b] = w
    return weights


def _scored(r: dict, weights, n: int, known: int, n_docs: int) -> pa.RecordBatch:
    """Scores of the documents of one counted block."""
    ids, sizes = _unpack(r["ids"], np.int64), _unpack(r["sizes"], np.uint32).astype(np.int64)
    train = _unpack(r["train"], np.uint8).astype(bool)
    pair, word = _unpack_counts(r["pair"]), _unpack_counts(r["word"])
    starts = np.cumsum(sizes) - sizes
    context = _contexts(word, starts, n_docs)
    two, one = _ratios(pair, context, word, n, known)
    w = weights[bucket_of(context)]
    score = np.log10((w[:, 0] * two + w[:, 1] * one + w[:, 2]) / (known + 1))
    base = np.log10((word + 1) / (n + (known + 1)))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    by_doc = lambda x: np.bincount(doc, weights=x, minlength=len(sizes))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64(), mask=ids == -(1 << 63)), pa.array(~train), pa.array(sizes),
         pa.array(by_doc(word > 0).astype(np.int64)), pa.array(np.full(len(sizes), n, np.int64)),
         pa.array(by_doc(base)), pa.array(by_doc(score))],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def lm_scores(docs: DataFrame, train=None, id_col: str = "doc_id", text_col: str = "text",
              block_tokens: int = 1_200_000, range_keys: int = 1_000_000) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` is a boolean column expression that names the documents the model
    learns from (default: all). Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z
    lower-cased, then one end mark; NULL and empty texts have the end alone.
    ``score`` is the log10 probability of the text under the mixture: with V
    known words, the uniform share is 1 / (V + 1). ``base_score`` is the add-one
    unigram. Without training documents both models are uniform over the one
    unknown word: 0. Rows that repeat an id come back once each.

    A block holds at least one document and ends once it has ``block_tokens``
    words; a hash range holds about ``range_keys`` keys.
    """
    spark = docs.sparkSession
    learn = F.lit(True) if train is None else train
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.coalesce(learn, F.lit(False)).alias("train"))
    blocks = materialise(src.transform(map_arrow, _block_fn(block_tokens), BLOCK), "lm-blocks")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = max(1, math.ceil(tokens / range_keys))
    ship(spark)
    asked = blocks.transform(map_arrow, _ask_fn(ranges), "bin int, block long, kind int, keys binary, counts binary")
    answers = materialise(asked.groupBy("bin").applyInPandas(
        _answer, "block long, kind int, bin int, totals binary, known long, held long"), "lm-answers")
    known, n = answers.filter("kind = 0").agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("held"), F.lit(0))).first()
    n_docs = src.filter("train").count()

    def annotate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in left.to_dict("records"):
            words, pairs = _totals(right)
            right = right.iloc[:0]
            block = _Block(r)
            cells, counts = _histogram(block, words, pairs, n, known, n_docs)
            out.append({**{c: r[c] for c in ("ids", "sizes", "train")},
                        "pair": _pack_counts(pairs[block.pair]), "word": _pack_counts(words[block.word]),
                        "cells": cells, "cell_counts": counts})
        return pd.DataFrame(out, columns=["ids", "sizes", "train", "pair", "word", "cells", "cell_counts"])

    full = materialise(
        blocks.groupBy("block").cogroup(answers.select("block", "kind", "bin", "totals").groupBy("block")).applyInPandas(
            annotate, "ids binary, sizes binary, train binary, pair binary, word binary, cells array<long>, "
                      "cell_counts array<long>"), "lm-counted")
    # cells are bounded by the bins, whatever the corpus
    hist = (full.select(F.explode(F.arrays_zip("cells", "cell_counts")).alias("c"))
            .groupBy(F.col("c.cells").alias("cell")).agg(F.sum("c.cell_counts").alias("n")).toPandas())
    weights = learn_weights(hist["cell"].to_numpy(np.int64), hist["n"].to_numpy(np.int64))

    def score(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                yield _scored(r, weights, n, known, n_docs)

    return full.drop("cells", "cell_counts").transform(
            map_arrow, score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
