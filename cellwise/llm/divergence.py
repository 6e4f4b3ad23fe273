"""Source divergence audit: how far a source's terms are from its language's and other sources'.

The terms of a language are those in at least ``min_docs`` of its documents. They are found by
iceberg prefix refinement: byte prefixes are counted by distinct documents, level by level, and
only extensions of prefixes that reach the threshold are counted at the next level, until
complete terms alone remain. Each level is one pass over the texts, the prefixes doubling in length.
A bitmap of fixed size says to the tasks which prefixes were kept; one that it lets through in
error is counted, and falls at the next level.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialise, ship, slices

BITS = 1 << 23                  # of the bitmap of kept prefixes: one megabyte
END = b"\x00"                   # ends a complete term; no term holds it
UNIT = 1_000_000_000
FIRST_LEVEL = 8                 # bytes of the first level's prefixes: shorter ones are nearly all kept

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


_CODES = np.frombuffer(_TABLE, np.uint8)


def terms(texts: list[bytes], above: int = 0) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters and non-ASCII characters with A-Z lower-cased, those of more than ``above``
    bytes, of all texts in a row; and the place in ``texts`` of each one's text."""
    shown = _CODES[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    letter = shown != 32
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    if letter[0]:
        edge = np.concatenate(([0], edge))
    start, size = edge[::2], edge[1::2] - edge[::2]
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(size))).astype("<i4")),
                                                            pa.py_buffer(shown[letter])])
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, ends), prepend=0))
    if above:
        words, owner = words.filter(pa.array(size > above)), owner[size > above]
    return words, owner


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut between terms."""
    shown, at = text.translate(_TABLE), 0
    while at < len(text):
        end = shown.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield shown[at:end]
        at = end


def _bucket(lang: bytes, key: bytes) -> int:
    """The bit of a key; Spark's xxhash64 of the same bytes modulo ``BITS``."""
    return xxhash.xxh64_intdigest(lang + END + key, 42) & (BITS - 1)


def _key(lang: bytes, term: bytes, length: int | None, was: int, bitmap: np.ndarray | None) -> bytes | None:
    """What is counted for a term in one pass, None if nothing is."""
    def kept(key: bytes) -> bool:
        at = _bucket(lang, key)
        return bool(bitmap[at >> 3] >> (at & 7) & 1)

    if length is None:                                              # the last pass: kept terms
        return term if kept(term + END) else None
    if bitmap is not None and not kept(term[:was]):
        return None                                                 # its prefix was discarded
    return term + END if len(term) <= length else term[:length]


def _runs(a: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(a)), bool), a[1:] != a[:-1])))


def _pass(docs: DataFrame, length: int | None, was: int, bits, block_bytes: int = 24 << 20) -> DataFrame:
    """Partial counts of one pass. With ``length``: ``lang, key, n``, the documents that hold a
    prefix of that length, or a complete term of above ``was`` and at most that length. Without:
    ``lang, source, key, n``, the occurrences of kept terms. ``bits``: the broadcast bitmap of what
    the last pass kept. A task counts texts of ``block_bytes`` at a time; a longer text goes in pieces."""
    names = ["lang", "key", "n"] if length else ["lang", "source", "key", "n"]

    def run(batches):
        bitmap = None if bits is None else np.frombuffer(bits.value, np.uint8)

        def numbered(lang, words):
            """The keys of the words, and the place of each word's own among them, -1 without one."""
            coded, keys = words.dictionary_encode(), {}
            found = [_key(lang, t, length, was, bitmap) for t in coded.dictionary.to_pylist()]
            to = np.array([-1 if k is None else keys.setdefault(k, len(keys)) for k in found], np.int64)
            return list(keys), to[coded.indices.to_numpy(zero_copy_only=False)]

        def out(lang, keys, at, n, source=None):
            keys, lang = pa.array(keys, pa.binary()), pa.scalar(lang, pa.binary())
            for i in range(0, len(n), 50_000):
                part = slice(i, i + 50_000)
                rows = [pa.repeat(lang, len(n[part])), keys.take(pa.array(at[part])), pa.array(n[part])]
                yield pa.RecordBatch.from_arrays(rows if source is None else [rows[0], source[part], *rows[1:]], names=names)

        def block(lang, texts, sources):
            words, owner = terms(texts, was)
            keys, at = numbered(lang, words)
            k = max(1, len(keys))
            group = owner
            if not length:
                named = {}
                group = np.array([named.setdefault(s, len(named)) for s in sources], np.int64)[owner]
            pair = (group * k + at)[at >= 0]
            pair.sort()
            first = _runs(pair)
            if length:
                yield from out(lang, keys, np.arange(len(keys)), np.bincount(pair[first] % k, minlength=len(keys)))
            else:
                n = np.diff(np.append(first, len(pair)))
                yield from out(lang, keys, pair[first] % k, n, pa.array(list(named), pa.binary()).take(pa.array(pair[first] // k)))

        def long_text(lang, text, source):
            seen = set()
            for piece in pieces(text, block_bytes):
                if length:
                    seen.update(numbered(lang, terms([piece], was)[0])[0])
                else:
                    yield from block(lang, [piece], [source])
            if length:
                yield from out(lang, list(seen), np.arange(len(seen)), np.ones(len(seen), np.int64))

        held, size = {}, 0
        for b in slices(batches):
            for text, lang, source in zip(*[c.to_pylist() for c in b.columns]):
                if len(text) > block_bytes:
                    yield from long_text(lang, text, source)
                    continue
                own = held.setdefault(lang, ([], []))
                own[0].append(text)
                own[1].append(source)
                size += len(text) + 1
                if size >= block_bytes:
                    for lang, own in held.items():
                        yield from block(lang, *own)
                    held, size = {}, 0
        for lang, own in held.items():
            yield from block(lang, *own)

    return map_arrow(docs, run, "lang binary, key binary, n long" if length else "lang binary, source binary, key binary, n long")


def _bitmap(kept: DataFrame):
    """The broadcast bitmap of ``lang, key``: of fixed size, whatever the number of keys."""
    at = F.xxhash64(F.concat("lang", F.lit(END), "key")).bitwiseAND(BITS - 1)
    words = (kept.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(63).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits")))
    out = np.zeros(BITS // 64, "<i8")
    for r in words.toLocalIterator():
        out[r["word"]] = r["bits"]
    return kept.sparkSession.sparkContext.broadcast(out.tobytes())


def kept_terms(docs: DataFrame, min_docs: int = 30) -> DataFrame:
    """``lang, term`` (as bytes): the terms in at least ``min_docs`` of a language's documents. ``docs``:
    ``text, lang, source`` as bytes without NULL; each row is a document."""
    done, length, was, bits = None, FIRST_LEVEL, 0, None
    while True:
        level = materialise(_pass(docs, length, was, bits).groupBy("lang", "key").agg(F.sum("n").alias("n"))
                            .filter(F.col("n") >= min_docs).select("lang", "key", F.endswith("key", F.lit(END)).alias("whole")),
                            "terms-level")
        if bits is not None:
            bits.destroy()
        whole = level.filter("whole").select("lang", F.col("key").alias("key"))
        done = whole if done is None else done.union(whole)
        open_ = level.filter("not whole").select("lang", "key")
        if open_.isEmpty():
            return done.select("lang", F.expr("substring(key, 1, length(key) - 1)").alias("term"))
        bits, was, length = _bitmap(open_), length, 2 * length


def _p(count, n, v):
    """``1 + floor(UNIT * (count + 5) / (n + 5 * v))``, exactly."""
    wide = lambda c: F.col(c).cast("decimal(20,0)") if isinstance(c, str) else F.lit(c).cast("decimal(20,0)")
    top = (wide(count) + F.lit(5)) * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, wide(n) + F.lit(5) * wide(v)).cast("long")


def _tile_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Of two tiles of sources and one block of terms: for each pair of sources, the sum over the
    terms that any source here has of ``|p - p'|``, less that of two sources that have none of them."""
    (first, second) = key[2:]
    names, at = np.unique(rows["source"].to_numpy(object), return_inverse=True)
    tile, zero = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    tile[at], zero[at] = rows["tile"], rows["zero"]
    has = rows["term"].notna().to_numpy()           # one row without a term for each source
    found, term = np.unique(rows["term"].to_numpy(object)[has], return_inverse=True)
    p = np.repeat(zero[:, None], len(found), 1)
    p[at[has], term] = rows["p"][has]
    out = []
    for i in range(len(names)):
        if first == second:
            j = np.arange(i + 1, len(names))
        elif tile[i] == first:
            j = np.flatnonzero(tile == second)
        else:
            continue
        if len(j):
            total = np.abs(p[j] - p[i]).sum(axis=1) - len(found) * np.abs(zero[j] - zero[i])
            out.append(pd.DataFrame({"a": [names[i]] * len(j), "b": names[j], "part": total}))
    out = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "part": []})
    flip = (out["a"] > out["b"]).to_numpy(bool)
    a, b = out["a"].where(~flip, out["b"]), out["b"].where(~flip, out["a"])
    return pd.DataFrame({"lang": key[0], "a": a, "b": b, "part": out["part"].astype("int64")})


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source", tile_sources: int = 32, block_terms: int = 2048) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps
    the V terms that at least ``min_docs`` of its rows hold (every row is a document, repeated ids
    too). In a group (a source of a language, or the language) a kept term has
    ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``, with N the group's count of kept terms.

    * part ``pair``: item is each other source of the language, value the sum over the kept
      terms of the difference of the two sources' p, all ranks (0 without kept terms);
    * part ``term``: item is each kept term that the source holds and whose p is above its
      language's, value the difference, the ``top`` ranks.

    Ranks start at 1, by value descending, then by item. NULL text, lang and source are read as
    empty strings. An empty table gives an empty result.

    Pairs are summed in tasks of two tiles of about ``tile_sources`` sources and one block of about
    ``block_terms`` terms, over the terms that some source of the two holds; what the others
    add is the same for each term. No task sees all of a language's sources or terms.
    """
    ship(docs.sparkSession)
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")
    src = docs.select(read(text_col).alias("text"), read(lang_col).alias("lang"), read(source_col).alias("source"))
    text = lambda c: F.col(c).cast("string").alias(c)

    kept = materialise(kept_terms(src, min_docs), "terms-kept")
    sizes = kept.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("v"))
    bits = _bitmap(kept.select("lang", F.concat("term", F.lit(END)).alias("key")))
    found = _pass(src, None, 0, bits).groupBy("lang", "source", F.col("key").alias("term")).agg(F.sum("n").alias("n"))
    kept_too = kept.select(F.col("lang").alias("l"), F.col("term").alias("t"))
    counts = materialise(found.join(kept_too, (F.col("lang") == F.col("l")) & (F.col("term") == F.col("t")), "left_semi"), "terms-counts")
    bits.destroy()

    totals = counts.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(F.sum("n").alias("total"))
    groups = src.select("lang", "source").distinct()
    many = groups.groupBy(F.col("lang").alias("m")).agg(F.count("*").alias("sources"))
    groups = (groups.join(totals, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "left").drop("l", "s")
              .join(many, F.col("lang") == F.col("m")).drop("m")
              .join(sizes, F.col("lang") == F.col("l"), "left").drop("l")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
                      F.ceil(F.col("sources") / tile_sources).cast("int").alias("tiles"))
              .withColumn("zero", F.when(F.col("v") > 0, _p(0, "total", "v")).otherwise(F.lit(0).cast("long")))
              .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")))
    groups = materialise(groups, "terms-groups")

    g = groups.select(*[F.col(c).alias(f"_{c}") for c in groups.columns])
    rated = materialise(
        counts.join(g, (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source")))
        .select("lang", "source", "term", "n", _p("n", "_total", "_v").alias("p"), F.col("_v").alias("v"), F.col("_zero").alias("zero"),
                F.col("_tile").alias("tile"), F.col("_tiles").alias("tiles")), "terms-rated")

    # part term: the language's own p of each term
    whole = counts.groupBy(F.col("lang").alias("l"), F.col("term").alias("t")).agg(F.sum("n").alias("n_lang"))
    lang_total = counts.groupBy(F.col("lang").alias("m")).agg(F.sum("n").alias("total_lang"))
    q = materialise(whole.join(lang_total, F.col("l") == F.col("m")).join(sizes.withColumnRenamed("l", "k"), F.col("l") == F.col("k"))
                    .select("l", "t", _p("n_lang", "total_lang", "v").alias("q")), "terms-lang")
    above = (rated.join(q, (F.col("lang") == F.col("l")) & (F.col("term") == F.col("t"))).filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    # part pair: tiles of sources by blocks of terms
    blocks = F.ceil(F.col("v") / block_terms)
    here = rated.select("lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "tile", "tiles", "source", "term", "p", "zero")
    every = groups.filter("v > 0").select("lang", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)).alias("block"), "tile", "tiles", "source",
                                          F.lit(None).cast("binary").alias("term"), F.col("zero").alias("p"), "zero")
    sides = here.union(every).select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    parts = (sides.groupBy("lang", "block", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"))
             .applyInPandas(_tile_sums, "lang binary, a binary, b binary, part long")
             .groupBy("lang", "a", "b").agg(F.sum("part").alias("part")))
    one = groups.select("lang", "source", "zero", "v", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    two = g.select("_lang", "_source", "_zero", "_tile")
    pairs = one.join(two, (F.col("lang") == F.col("_lang")) & (F.col("other") == F.col("_tile")) & (F.col("source") != F.col("_source")))
    pairs = (pairs.withColumn("a", F.least("source", "_source")).withColumn("b", F.greatest("source", "_source"))
             .join(parts.select(F.col("lang").alias("l"), F.col("a").alias("x"), F.col("b").alias("y"), "part"),
                   (F.col("lang") == F.col("l")) & (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left"))
    by_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("_source").alias("item"),
                           (F.coalesce("part", F.lit(0)) + F.col("v") * F.abs(F.col("zero") - F.col("_zero"))).alias("value"))
    by_pair = by_pair.withColumn("rank", F.row_number().over(order))
    return by_pair.union(by_term).select(text("lang"), text("source"), "part", text("item"), "value", "rank")
