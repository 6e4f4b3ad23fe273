"""Byte-level BPE by per-prefix dynamic programming.

For every prefix of a piece the last token of its BPE encoding is unique. An
automaton over the vocabulary lists the tokens that are suffixes of a prefix;
the one whose pairing with the last token of the remaining prefix is stable
under the merges is stored, and following the stored tokens back from the end
gives the exact ids. Pieces are what the pre-tokenizer cuts.
"""
from __future__ import annotations

import json
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

# fixed values: the published pre-tokenizer pattern of the byte-level vocabulary
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NEVER = 1 << 60
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file:
    printable Latin-1 stands for itself, other bytes take 256, 257, ... in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}
    return [chr(rest.get(b, b)) for b in range(256)]


class ByteBPE:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str, cap: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.id_of = {raw(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (max([*self.id_of.values(), *self.special.values()]) + 1)
        for k, v in self.id_of.items():
            self.bytes_of[v] = k
        for k, v in self.special.items():
            self.bytes_of[v] = k.encode()
        self.rank: dict[int, int] = {}                         # left << 20 | right → rank
        self.made: dict[int, tuple[int, int, int]] = {}        # token → (rank, left, right)
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (m.split(" ") if isinstance(m, str) else m))
            a, b, whole = self.id_of[a], self.id_of[b], self.id_of[a + b]
            self.rank.setdefault(a << 20 | b, r)
            self.made.setdefault(whole, (r, a, b))
        self.split = regex.compile("(" + "|".join(regex.escape(k) for k in sorted(self.special, key=len, reverse=True))
                                   + ")") if self.special else None
        self.cap, self.units, self.pairs = cap, {}, {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.auto = ahocorasick.Automaton()
        for k, v in self.id_of.items():
            # a token that its own merges do not rebuild never appears
            if v not in self.made or self.stable(*self.made[v][1:], self.made[v][0]):
                self.auto.add_word(k.decode("latin-1"), (len(k), v))
        self.auto.make_automaton()

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """(node, rank at which it appears, rank at which it is merged away) from
        the token down its left (1) or right (2) edge."""
        out = self.edges[side - 1].get(token)
        if out is None:
            out, gone, node = [], NEVER, token
            while True:
                made = self.made.get(node)
                out.append((node, made[0] if made else -1, gone))
                if not made:
                    break
                gone, node = made[0], made[side]
            self.edges[side - 1][token] = out
        return out

    def stable(self, a: int, b: int, below: int = NEVER) -> bool:
        """True if no merge of rank under ``below`` crosses the border between a and b.

        A crossing merge happens when its two nodes stand at the border at the
        same time and its rank comes before those that merge them away; of equal
        ranks the left place goes first.
        """
        rank, right = self.rank.get, self._edge(b, 1)
        for x, x_from, x_gone in self._edge(a, 2):
            x <<= 20
            for y, y_from, y_gone in right:
                r = rank(x | y)
                if r is not None and r < below and r < x_gone and r <= y_gone \
                        and x_from < y_gone and y_from < x_gone:
                    return False
        return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.stable(a, b)
            if len(self.pairs) < self.cap // 2:
                self.pairs[key] = ok
        return ok

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one piece, as little-endian uint32 bytes."""
        raw = piece.encode()
        n = len(raw)
        size, token = [0] * (n + 1), [-1] * (n + 1)      # of the last token of each prefix
        pairs, done = self.pairs, 0
        for end, (k, t) in self.auto.iter(raw.decode("latin-1")):
            if end < done:                               # this prefix has its token
                continue
            at = end + 1 - k
            if at:
                before = token[at]
                if before < 0:
                    continue
                key = before << 20 | t
                ok = pairs.get(key)
                if ok is None:
                    ok = self.fits(before, t)
                if not ok:
                    continue
            done = end + 1
            size[done], token[done] = k, t
        out, i = [], n
        while i:
            if token[i] < 0:
                raise ValueError("a byte is missing from the vocabulary")
            out.append(token[i])
            i -= size[i]
        out.reverse()
        return array("I", out).tobytes() if LITTLE else np.array(out, "<u4").tobytes()

    def unit(self, text: str) -> bytes:
        """Ids of a run of whole pieces; those of short runs and pieces are kept."""
        got = self.units.get(text)
        if got is None:
            parts = PIECE.findall(text)
            got = self.piece_ids(text) if len(parts) == 1 else b"".join(map(self.unit, parts))
            if len(self.units) < self.cap and len(text) < 64:
                self.units[text] = got
        return got

    def _plain(self, text: str) -> bytes:
        if "  " in text or " \n" in text or "\n " in text or not _ONLY_PLAIN(text):
            return b"".join(map(self.unit, _UNITS.findall(text)))
        # a piece never runs over the start of a single space between other characters
        first, *rest = text.split(" ")
        unit = self.unit
        return unit(first) + b"".join([unit(" " + x) for x in rest])

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as little-endian uint32 bytes."""
        if not text:
            return b""
        if self.split is None or not any(k in text for k in self.special):
            return self._plain(text)
        out = []
        for i, part in enumerate(self.split.split(text)):
            out.append(np.array([self.special[part]], "<u4").tobytes() if i % 2 else self._plain(part) if part else b"")
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


#: whole pieces: non-space runs, each with the white space before it
_UNITS = regex.compile(r"\s*\S+|\s+")
_ODD = regex.compile(r"[^\S \n]")


def _ONLY_PLAIN(text: str) -> bool:
    return _ODD.search(text) is None


@lru_cache(maxsize=4)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False, source: bool = False) -> DataFrame:
    """``doc_id, ids``: the exact BPE ids of each whole text, as little-endian
    unsigned 32-bit integers in one binary value; with ``decoded``, also the
    text decoded back from them, and with ``source``, the text (NULL as empty).

    NULL and empty texts have no ids. Special tokens of the vocabulary file are
    recognised in the text. ``vocab`` is the vocabulary file's path on every
    worker (default: the installed public file, looked up on the worker).
    Map-only: each row is worked on alone, in batches of a few hundred; a worker
    keeps the ids of its first 300,000 distinct short units.
    """
    names = ["doc_id", "ids", *["decoded"] * decoded, *["text"] * source]

    def run(batches):
        bpe = load(vocab or vocabulary_path())
        for b in slices(batches):
            ids = [bpe.encode(t) for t in b.column(1).to_pylist()]
            cols = [b.column(0), pa.array(ids, pa.binary())]
            if decoded:
                cols.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
            if source:
                cols.append(pa.array([t or "" for t in b.column(1).to_pylist()], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.transform(map_arrow, run, "doc_id long, ids binary" + ", decoded string" * decoded + ", text string" * source)


def decode(ids: DataFrame, vocab: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` decoded from binary ids; NULL ids give a NULL text."""
    def run(batches):
        bpe = load(vocab or vocabulary_path())
        for b in slices(batches):
            text = [None if x is None else bpe.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    src = ids.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return src.transform(map_arrow, run, "doc_id long, text string")
