"""Token-id files: Parquet list columns in document order.

Each row holds a document's ids as a list column with delta encoding (or a
dictionary), beside small metadata columns. Row-group and page sizes are set,
and Parquet's page indexes let a reader take the metadata of all documents, or
the tokens of a few, without reading the rest.
"""
from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import byte_chars
from .common import map_arrow, slices

SCHEMA = "part int, row_start long, doc_id long, n_tokens long, ids array<int>"


#: Latin letters that lower-case one to one and that normalisation leaves alone, then ASCII signs
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


class UnitTokenizer:
    """The tokenizers library, asked once for each distinct white-space unit.

    The vocabulary's pre-tokenizer drops white space and its normalizer works
    within a unit, so the ids of a text are those of its units in a row. A unit
    of plain Latin letters and closing signs is cut between the two, as the
    pre-tokenizer does; its letters go to the library's BPE model directly, in
    lower case, as the normalizer makes them. All else goes through the whole
    encoder. Ids of the first units and words are kept.
    """

    def __init__(self, path: str, cap: int = 400_000):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model
        chars = byte_chars()
        self.shown = {c: "".join(chars[b] for b in c.encode()) for c in map(chr, range(0xC0, 0x100))}
        self.cap, self.units, self.words = cap, {}, {}

    def word(self, letters: str) -> bytes:
        got = self.words.get(letters)
        if got is None:
            shown = letters if letters.isascii() else "".join([self.shown.get(c, c) for c in letters])
            got = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
            if len(self.words) < self.cap:
                self.words[letters] = got
        return got

    def unit(self, raw: bytes) -> bytes:
        got = self.units.get(raw)
        if got is None:
            text = raw.decode()
            m = _PLAIN.fullmatch(text)
            if m and m[2]:
                got = self.word(m[1].lower()) + self.unit(m[2].encode())
            elif m:
                got = self.word(text.lower())
            else:
                got = np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            if len(self.units) < self.cap and len(raw) < 64:
                self.units[raw] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, as little-endian uint32 bytes."""
        if not text:
            return b""
        ws = text.encode().split()
        have, unit = self.units, self.unit
        new = {w: unit(w) for w in set(ws) if w not in have}
        if not new:
            return b"".join(map(have.__getitem__, ws))
        return b"".join([have[w] if w in have else new[w] for w in ws])


@lru_cache(maxsize=4)
def load(path: str) -> UnitTokenizer:
    return UnitTokenizer(path)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def write_tokens(docs: DataFrame, path: str, vocab: str | None = None, end_id: int | None = 2,
                 id_col: str = "doc_id", text_col: str = "text", encoding: str = "delta",
                 row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10) -> None:
    """Tokenise ``docs`` and write the files below ``path`` in ascending id order.

    Rows are range-partitioned by id and sorted within each partition before
    they are tokenised, so each file holds the next run of ids. Columns:
    ``part`` (the file's place in the order), ``row_start`` (ids before the row
    in its file), ``doc_id``, ``n_tokens``, ``ids``. NULL and empty texts hold
    the end id alone (nothing if it is None); NULL ids come first; rows that
    repeat an id are in text order. ``encoding``: "delta" (Parquet v2 delta
    integers, no dictionary) or "dictionary".
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError("encoding is 'delta' or 'dictionary'")
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext
        part, start = TaskContext.get().partitionId(), 0
        tok = load(vocab or vocabulary_path())
        for b in slices(batches, 256):
            rows = [tok.encode(t) + tail for t in b.column(1).to_pylist()]
            n = np.array([len(x) // 4 for x in rows], np.int64)
            ends = np.cumsum(n)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(rows), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), part, np.int32)), pa.array(start + ends - n), b.column(0),
                 pa.array(n), ids], names=["part", "row_start", "doc_id", "n_tokens", "ids"])
            start += int(ends[-1]) if len(rows) else 0

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = src.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").transform(map_arrow, run, SCHEMA)
    (out.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.writer.version", "PARQUET_2_0").option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def read_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, doc_id, row_start, n_tokens, start``: where each document's ids
    begin in the whole stream. Reads the metadata columns alone; the offsets of
    the files are a running sum over one row per file."""
    meta = read_tokens(spark, path).select("part", "doc_id", "row_start", "n_tokens")
    files = meta.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    return (meta.join(F.broadcast(offsets), "part")            # one row per file
            .withColumn("start", F.col("offset") + F.col("row_start")).drop("offset"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``part, row_start, doc_id, start, n_tokens, ids_crc32`` read back from the files: the
    unsigned crc32 of each document's ids as little-endian 32-bit integers."""
    meta = read_tokens(spark, path)
    files = meta.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))

    def run(batches):
        for b in slices(batches):
            ids = b.column(4)
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.cumsum(
                np.concatenate(([0], ids.value_lengths().to_numpy(zero_copy_only=False))))
            crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(ends).astype(np.int64)),
                 pa.array(crc, pa.int64())], names=["part", "row_start", "doc_id", "n_tokens", "ids_crc32"])

    rows = meta.select("part", "row_start", "doc_id", "n_tokens", "ids").transform(
            map_arrow, run, "part int, row_start long, doc_id long, n_tokens long, ids_crc32 long")
    return (rows.join(F.broadcast(offsets), "part")            # one row per file
            .select("doc_id", (F.col("offset") + F.col("row_start")).alias("start"), "n_tokens", "ids_crc32"))


def read_window(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """Ids of the documents ``lo <= doc_id < hi``: the bounds are pushed to the
    scan, where row-group statistics and page indexes skip the rest."""
    return read_tokens(spark, path).filter((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)).select("doc_id", "ids")
