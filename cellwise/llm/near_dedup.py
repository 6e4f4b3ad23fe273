"""MinHash near-duplicate detection by a multi-index Hamming join.

A signature holds ``chunks * width`` MinHash symbols of 16 bits. Two signatures
that differ in at most ``2 * chunks - 1`` symbols have, by pigeonhole, a chunk
with at most one wrong symbol; each chunk is therefore indexed once with each
of its symbols left out, and such a pair meets under at least one key. Pairs
within the distance are confirmed on their full shingle sets.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_arrow, materialise, mix, prefilter, shingles, slices, space_words, word_hashes

DIMS = 128          # of the exact count sketch
FULL = 65535        # a count of that many or more


class Index:
    """Parameters of the signature and its keys."""

    def __init__(self, chunks: int = 12, width: int = 5, seed: int = 1):
        self.chunks, self.width, self.n = chunks, width, chunks * width
        self.max_distance = 2 * chunks - 1
        rng = np.random.default_rng(seed)
        self.mult = rng.integers(0, 1 << 32, self.n, dtype=np.uint32) | np.uint32(1)
        self.add = rng.integers(0, 1 << 32, self.n, dtype=np.uint32)[:, None]

    def signature(self, s: np.ndarray) -> np.ndarray:
        low = (s ^ (s >> np.uint64(32))).astype(np.uint32)
        best = None
        for at in range(0, len(low), 8192):
            h = np.multiply.outer(self.mult, low[at: at + 8192])
            h += self.add
            m = h.min(axis=1)
            best = m if best is None else np.minimum(best, m)
        return ((best * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")

    def keys(self, sig: np.ndarray) -> np.ndarray:
        """(rows, symbols) → (rows, chunks * width) keys, one for each left-out symbol."""
        rows = len(sig)
        parts = sig.reshape(rows, self.chunks, self.width).astype(np.uint64)
        out = np.empty((rows, self.chunks, self.width), np.uint64)
        tag = mix(np.arange(1, self.n + 1, dtype=np.uint64)).reshape(self.chunks, self.width)
        for e in range(self.width):
            acc = np.broadcast_to(tag[:, e], (rows, self.chunks)).copy()
            for j in range(self.width):
                if j != e:
                    acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + parts[:, :, j] + np.uint64(1))
            out[:, :, e] = acc
        return out.reshape(rows, self.n).view(np.int64)

    def first_slot(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of row pairs, and the first (chunk, symbol) slot whose key they share."""
        diff = (a != b).reshape(len(a), self.chunks, self.width)
        wrong = diff.sum(axis=2)
        chunk = (wrong <= 1).argmax(axis=1)
        rows = np.arange(len(a))
        slot = chunk * self.width + np.where(wrong[rows, chunk] == 1, diff[rows, chunk].argmax(axis=1), 0)
        return wrong.sum(axis=1), slot


def sketch(s: np.ndarray) -> bytes:
    """Counts of the set's members by hash residue, up to ``FULL``."""
    return np.minimum(np.bincount((s >> np.uint64(7)) % np.uint64(DIMS), minlength=DIMS), FULL).astype("<u2").tobytes()


def most_common(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Upper bound of the intersection of sets of ``n_a`` and ``n_b`` members by their
    sketches: the sum of the smaller counts, unless both are full somewhere."""
    low = np.minimum(a, b)
    size = np.minimum(n_a, n_b)
    return np.where((low == FULL).any(axis=1), size, np.minimum(low.sum(axis=1, dtype=np.int64), size))


def _enough(inter, total, percent: int):
    """100 * intersection >= percent * union, where union = total - intersection."""
    return 100 * inter >= percent * (total - inter)


def _sketch_rows(ix: Index, w: int):
    def run(batches):
        for b in slices(batches):
            n, lo, hi, sig, hist = [], [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(word_hashes(space_words(t)), w)
                n.append(len(s))
                if len(s):
                    a = mix(s)
                    # 128-bit content of the set: two sums over differently mixed members
                    lo.append(int(a.sum().astype(np.int64)))
                    hi.append(int(mix(a ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().astype(np.int64)))
                    sig.append(ix.signature(s).tobytes())
                    hist.append(sketch(s))
                else:
                    lo.append(None), hi.append(None), sig.append(None), hist.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
                 pa.array(sig, pa.binary()), pa.array(hist, pa.binary())],
                names=["doc_id", "n_shingles", "lo", "hi", "sig", "hist"])
    return run


def _key_rows(ix: Index):
    def run(batches):
        for b in slices(batches, 2048):
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, ix.n)
            keys = ix.keys(sig)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), ix.n)), pa.array(np.tile(np.arange(ix.n, dtype=np.int32), len(sig))),
                 pa.array(keys.ravel())], names=["id", "slot", "k"])
    return run


def _near(ix: Index):
    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(a), "<u2").reshape(-1, ix.n)
        y = np.frombuffer(b"".join(b), "<u2").reshape(-1, ix.n)
        return pd.Series((x != y).sum(axis=1) <= ix.max_distance)
    return near


def _linked(w: int, percent: int):
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out, last, s = [], None, None
        for x, y in zip(a, b):
            if s is None or x != last:
                last, s = x, shingles(word_hashes(space_words(x)), w)
            t = shingles(word_hashes(space_words(y)), w)
            inter = len(np.intersect1d(s, t, assume_unique=True))
            out.append(_enough(inter, len(s) + len(t), percent))
        return pd.Series(out, dtype=bool)
    return linked


def confirm(pairs: DataFrame, docs: DataFrame, w: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets reach the similarity.

    The texts of the documents that occur in a pair are fetched once, by id;
    each pair's two texts then meet under the pair.
    """
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "near-ids")
    texts = materialise(prefilter(docs, F.col("doc_id"), ids).join(ids, "doc_id", "left_semi")
                        .groupBy("doc_id").agg(F.first("text").alias("text")), "near-texts")
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(ta, "a").join(tb, "b").filter(_linked(w, percent)("text_a", "text_b")).select("a", "b")


def _cross_fn(ix: Index, percent: int):
    """Pairs of different components in each (key, slot, block pair): within the
    distance, under the first slot they share, and not ruled out by the sketches."""
    step = 200_000

    def pairs_of(g: dict, lo: int, hi: int):
        """Index pairs of one run of equal keys that are in different components."""
        comp, side = g["comp"][lo:hi], g["side"][lo:hi]
        n = hi - lo
        left = np.flatnonzero(side <= 0)
        for at in range(0, len(left), max(1, step // n)):
            rows = left[at: at + max(1, step // n)]
            ok = comp[rows][:, None] != comp[None, :]
            if side[0] == 0:                       # one block against itself
                ok &= np.arange(n)[None, :] > rows[:, None]
            else:                                  # block -1 against block 1
                ok &= (side == 1)[None, :]
            i, j = np.nonzero(ok)
            yield rows[i] + lo, j + lo

    def test(g, i, j):
        dist, slot = ix.first_slot(g["sig"][i], g["sig"][j])
        ok = (dist <= ix.max_distance) & (slot == g["slot"][i])
        i, j = i[ok], j[ok]
        most = most_common(g["hist"][i], g["hist"][j], g["n"][i], g["n"][j])
        ok = _enough(most, g["n"][i] + g["n"][j], percent)
        return g["id"][i[ok]], g["id"][j[ok]]

    def run(batches):
        cols = ("k", "slot", "u", "v", "side", "id", "comp", "n")
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            g = {c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in cols}
            for c, width in (("sig", ix.n), ("hist", DIMS)):
                g[c] = np.frombuffer(b"".join(b.column(b.schema.get_field_index(c)).to_pylist()), "<u2").reshape(-1, width)
            if held is not None:
                g = {c: np.concatenate((held[c], g[c])) for c in g}
            edge = np.flatnonzero(np.any([g[c][1:] != g[c][:-1] for c in ("k", "u", "v")], axis=0)) + 1
            cut = int(edge[-1]) if len(edge) else 0
            held = {c: x[cut:] for c, x in g.items()}
            yield from groups({c: x[:cut] for c, x in g.items()}, edge[:-1] if len(edge) else edge)
        if held is not None:
            yield from groups(held, np.array([], int))

    def groups(g, edge):
        if not len(g["k"]):
            return
        bounds = [0, *edge.tolist(), len(g["k"])]
        wait_i, wait_j, size = [], [], 0
        found = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo < 2:
                continue
            for i, j in pairs_of(g, lo, hi):
                wait_i.append(i), wait_j.append(j)
                size += len(i)
                if size >= step:
                    found.append(test(g, np.concatenate(wait_i), np.concatenate(wait_j)))
                    wait_i, wait_j, size = [], [], 0
        if size:
            found.append(test(g, np.concatenate(wait_i), np.concatenate(wait_j)))
        if found:
            a, b = (np.concatenate([f[s] for f in found]) for s in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, w: int = 5, percent: int = 80, index: Index | None = None,
                    id_col: str = "doc_id", text_col: str = "text", block: int = 1024) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= percent * union of their
    sets of distinct ``w``-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased; a text of fewer words is one shingle). ``component_id`` is the
    smallest doc_id reachable over links, ``kept`` marks it. Texts that are
    NULL, empty or without words link with nothing. Rows with a NULL id are
    their own component (NULL) and kept; rows that repeat an id share its
    component. Shingles are compared by 64-bit hashes.

    1. Equal sets are collapsed by a 128-bit content hash of the set.
    2. Keys of the distinct sets are grouped with partial aggregates; under each
       shared key, members are compared with the smallest one (a join that AQE
       splits for hot keys), and confirmed links are contracted.
    3. Under keys that still hold several components, all pairs of different
       components are tested inside the tasks, large groups in block pairs of
       ``block`` rows; only pairs that pass the distance and an exact upper
       bound of the intersection come out, each once, and are confirmed.
    So every linked pair within the signature distance is found; with 60 symbols
    and distance 23, a pair at similarity 0.8 exceeds it in 3 of 10,000 cases.
    """
    ix = index or Index()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = materialise(src.transform(map_arrow, _sketch_rows(ix, w), "doc_id long, n_shingles long, lo long, hi long, sig binary, hist binary"),
                       "near-sets")
    usable = sets.filter("n_shingles > 0 and doc_id is not null")
    reps = materialise(usable.groupBy("lo", "hi", "n_shingles")
                       .agg(F.min(F.struct(F.col("doc_id").alias("id"), "sig", "hist")).alias("r"))
                       .select("lo", "hi", F.col("n_shingles").alias("n"), "r.id", "r.sig", "r.hist"), "near-reps")
    keys = reps.select("id", "sig").transform(map_arrow, _key_rows(ix), "id long, slot int, k long")
    shared = materialise(keys.groupBy("k").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
                         .filter("size > 1"), "near-keys")
    members = materialise(keys.join(shared, "k"), "near-members")
    sigs = reps.select("id", "sig")
    star = materialise(members.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct(),
                       "near-star")
    close = materialise(
        star.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
        .join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
        .filter(_near(ix)("sig_a", "sig_b")).select("a", "b"), "near-close")
    links = materialise(confirm(close, src, w, percent), "near-links")
    first = materialise(components(links), "near-comp")

    # keys that hold more than one component
    labelled = materialise(members.join(first, "id", "left")
                           .select("k", "slot", "size", "id", F.coalesce("component", "id").alias("comp")), "near-labelled")
    open_keys = materialise(labelled.groupBy("k").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
                            .filter("x <> y").select("k"), "near-open")
    parts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    rows = (labelled.join(open_keys, "k", "left_semi").withColumn("parts", parts).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("k", "slot", "id", "comp", F.least("own", "other").alias("u"), F.greatest("own", "other").alias("v"),
                    F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), -1).otherwise(1)
                    .alias("side"))
            .join(reps.select("id", "n", "sig", "hist"), "id"))
    # block (u, v) with u < v needs both sides; (u, u) is a block against itself
    cross = (rows.repartition("k", "u", "v").sortWithinPartitions("k", "u", "v", "side")
             .transform(map_arrow, _cross_fn(ix, percent), "a long, b long"))
    cross = materialise(cross.distinct(), "near-cross")
    more = materialise(confirm(cross, src, w, percent), "near-links")
    joined = components(links.union(more))

    groups = (reps.join(joined, "id", "left")
              .select("lo", "hi", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))
    groups = materialise(groups, "near-groups")
    out = usable.select("doc_id", "n_shingles", "lo", "hi").join(groups, ["lo", "hi", "n_shingles"]) \
        .select("doc_id", "n_shingles", "component_id")
    rest = sets.filter("not (n_shingles > 0 and doc_id is not null)") \
        .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
