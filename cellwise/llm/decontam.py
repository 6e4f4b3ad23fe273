"""Benchmark decontamination with a generalised suffix automaton.

The words of every benchmark item go into one automaton. Training words are
streamed through it while the length of the longest match that ends at each
word is tracked: a match of ``window`` words or more is an occurrence of an
item's window, and items shorter than a window are found at the states that
end them.
"""
from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise, prefilter, slices

# words are runs of 0-9, a-z and bytes from 0x80; all else separates
_KEEP = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
FOUND = "n_words long, hits array<struct<lo:int,hi:int>>, items array<string>"
OUT = "doc_id long, " + FOUND


def item_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.encode().lower().translate(_KEEP).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton of the word sequences of ``items``.

    Nearly every state has one transition: it lies in two flat arrays (word and
    target; word 0 is none), and only the further ones of a state in ``more``.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.word, self.to = array("i", [0]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        names: list[str] = []
        seqs: list[array] = []
        for k, ws in items:
            if ws:
                names.append(k)
                seqs.append(array("i", [self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws]))
        for s in seqs:
            last = 0
            for c in s:
                last = self._extend(last, c)
        self.shortest = min([window, *(len(s) for s in seqs)]) if seqs else window
        self.names = names
        # items of the full window that ends at a state: 0 none, i + 1 the item i,
        # -1 - k the set k of several; and the short items with their words
        self.windows, self.several = array("i", bytes(4 * len(self.length))), []
        self.ends: dict[int, set[tuple[int, int]]] = {}
        for j, s in enumerate(seqs):
            state, size = 0, 0
            for c in s:
                state, size = self._step(state, c), size + 1
                if size >= window:
                    self._hold(self._at(state, window), j)
            if len(s) < window:
                self.ends.setdefault(self._at(state, len(s)), set()).add((len(s), j))

    def _hold(self, state: int, item: int) -> None:
        """Adds an item to those of the window that ends at ``state``."""
        held = self.windows[state]
        if held < 0:
            self.several[-1 - held].add(item)
        elif held == 0:
            self.windows[state] = item + 1
        elif held != item + 1:
            self.several.append({held - 1, item})
            self.windows[state] = -len(self.several)

    def _step(self, state: int, c: int) -> int:
        """The state after word ``c``, -1 if there is none."""
        if self.word[state] == c:
            return self.to[state]
        return self.more[state].get(c, -1) if state in self.more else -1

    def _point(self, state: int, c: int, target: int) -> None:
        """Sets the transition of ``state`` by ``c``."""
        if self.word[state] in (0, c):
            self.word[state], self.to[state] = c, target
        else:
            self.more.setdefault(state, {})[c] = target

    def _extend(self, last: int, c: int) -> int:
        link, length = self.link, self.length
        q = self._step(last, c)
        if q >= 0:
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = self._new(length[last] + 1)
        p = last
        while p >= 0 and (q := self._step(p, c)) < 0:
            self._point(p, c, cur)
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _new(self, length: int) -> int:
        for held, v in ((self.word, 0), (self.to, 0), (self.link, 0), (self.length, length)):
            held.append(v)
        return len(self.length) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = self._new(self.length[p] + 1)
        self.word[twin], self.to[twin], self.link[twin] = self.word[q], self.to[q], self.link[q]
        if q in self.more:
            self.more[twin] = dict(self.more[q])
        self.link[q] = twin
        while p >= 0 and self._step(p, c) == q:
            self._point(p, c, twin)
            p = self.link[p]
        return twin

    def _at(self, state: int, size: int) -> int:
        """The state of the suffix of ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit spans ``[lo, hi)`` and the items that have an occurrence."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        if len(words) < self.shortest or not self.vocab:
            return spans, set()
        ids = np.fromiter((self.vocab.get(w, 0) for w in words), np.int32, len(words))
        # only runs of known words that are long enough can hold an occurrence
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ids != 0, [0]))))
        first, to, more, link, length = self.word, self.to, self.more, self.link, self.length
        window, at, none = self.window, self._at, {}
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if hi - lo < self.shortest:
                continue
            state = size = 0
            for i, c in enumerate(ids[lo:hi].tolist(), lo + 1):
                while True:
                    q = to[state] if first[state] == c else more.get(state, none).get(c, -1)
                    if q >= 0 or not state:
                        break
                    state = link[state]
                    size = length[state]
                if q >= 0:
                    state = q
                    size += 1
                got = 0
                if size >= window:
                    got = window
                    held = self.windows[at(state, window)]
                    if held > 0:
                        found.add(held - 1)
                    else:
                        found.update(self.several[-1 - held])
                if self.ends and size >= self.shortest:
                    s = state
                    while s:
                        for n, k in self.ends.get(s, ()):
                            if n <= size:
                                found.add(k)
                                got = max(got, n)
                        s = link[s]
                if got:
                    a = i - got
                    while spans and spans[-1][1] >= a:
                        a = min(a, spans.pop()[0])
                    spans.append((a, i))
        return spans, {self.names[j] for j in found}


def _scan_fn(held):
    """The last column is the text; the others are passed on."""
    def run(batches):
        for b in slices(batches):
            n, hits, items = [], [], []
            for t in b.column(b.num_columns - 1).to_pylist():
                ws = item_words(t)
                spans, found = held.value.scan(ws)
                n.append(len(ws))
                hits.append([{"lo": x, "hi": y} for x, y in spans])
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n, pa.int64()),
                 pa.array(hits, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
                 pa.array(items, pa.list_(pa.string()))], names=[*b.schema.names[:-1], "n_words", "hits", "items"])
    return run


def _automata(docs: DataFrame, benchmark: DataFrame, window: int, item_col: str, item_text: str, max_block_chars: int) -> list:
    """Broadcast automata of the benchmark's blocks, each of a bounded size.

    Items are dealt by a hash of id and text, so a repeated or NULL id does not fill
    one block. A worker holds the automaton of the pass it runs, about 25 bytes for
    each character of the block. Copies of one item in a block are read once."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("k"), F.col(item_text).alias("t"))
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-int(chars) // max_block_chars))
    out = []
    for i in range(blocks):
        part = items.filter("t is not null").filter(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == i)
        rows = sorted((r.k, r.t) for r in part.distinct().toLocalIterator())
        out.append(docs.sparkSession.sparkContext.broadcast(ItemAutomaton(((k, item_words(t)) for k, t in rows), window)))
    return out


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                   max_block_chars: int = 4_000_000) -> DataFrame:
    """``doc_id, n_words, hits, items``: the word spans of each document inside
    any occurrence of a benchmark window, and the items (as text) they come from.

    The benchmark is cut into blocks of about ``max_block_chars`` characters by
    a hash of item id and text; each block makes one automaton, broadcast at that bounded size,
    and one map-only pass over the documents. With several blocks the documents are
    written with a row number and the passes are merged by it. An item of fewer words than ``window`` is one window;
    an item without words never occurs; a NULL item id reads as ''. NULL or
    empty texts have no words. Rows that repeat an id come back once each.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    automata = _automata(docs, benchmark, window, item_col, item_text, max_block_chars)
    if len(automata) == 1:
        return src.transform(map_arrow, _scan_fn(automata[0]), OUT)
    rows = materialise(src.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "leak-rows")
    out = _passes(rows, automata, "row long, " + OUT)
    # spans of several blocks: sorted, then overlapping ones joined
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("hits"))), F.expr("cast(array() as array<struct<lo:int,hi:int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] >= x["lo"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1),
                     F.array(F.struct(F.element_at(acc, -1)["lo"].alias("lo"),
                                      F.greatest(F.element_at(acc, -1)["hi"], x["hi"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(x))))
    return out.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), merged.alias("hits"),
                                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("row")


def _passes(rows: DataFrame, automata: list, schema: str) -> DataFrame:
    """One pass over ``rows`` (its last column the text) for each block, one below the other."""
    out = None
    for held in automata:
        p = rows.transform(map_arrow, _scan_fn(held), schema)
        out = p if out is None else out.union(p)
    return out


def report(scanned: DataFrame) -> DataFrame:
    """Per document: ``n_words, n_hit, n_items, items_sha256, contaminated``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + (x["hi"] - x["lo"]))
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def cut_text(automaton: ItemAutomaton, text: str | None, min_words: int, max_cover: float) -> str | None:
    """``text`` without the occurrences of at least ``min_words`` words, None if
    they cover more than ``max_cover`` of its words. What is left is scanned
    again, as two ends may meet in a new occurrence."""
    total = gone = 0
    while True:
        words = item_words(text)
        cut = [s for s in automaton.scan(words)[0] if s[1] - s[0] >= min_words]
        if not cut:
            return text
        total, gone = total or len(words), gone + sum(y - x for x, y in cut)
        if gone > max_cover * total:
            return None
        text = _without(text, cut)


def _without(text: str, cut: list[tuple[int, int]]) -> str:
    """``text`` without the word spans ``cut``."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.lower())]
    out, pos = [], 0
    for x, y in cut:
        out.append(raw[pos:at[x][0]])
        pos = at[y - 1][1]
    return b"".join([*out, raw[pos:]]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, min_words: int | None = None,
                 max_cover: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text",
                 max_block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with benchmark spans cut out of the text, same columns and order
    of columns. A document whose cut spans cover more than ``max_cover`` of its
    words is dropped; one without a span keeps its row unchanged. Spans shorter
    than ``min_words`` (default: all occurrences) stay. With several blocks of the
    benchmark the spans of all blocks are joined before the cover is measured
    and the text cut, and rows that were cut are scanned by all blocks again, so
    that the result is that of one block."""
    automata = _automata(docs, benchmark, window, item_col, item_text, max_block_chars)
    if len(automata) == 1:
        return _cut(docs, automata[0], min_words or 1, max_cover, text_col)
    return _cut_by_blocks(docs, automata, min_words or 1, max_cover, text_col)


def _cut(docs: DataFrame, held, min_words: int, max_cover: float, text_col: str) -> DataFrame:
    at = docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            was = b.column(at).to_pylist()
            new = [cut_text(held.value, t, min_words, max_cover) for t in was]
            arrays = [pa.array(new, b.schema.field(j).type) if j == at else c for j, c in enumerate(b.columns)]
            keep = pa.array([x is None or y is not None for x, y in zip(was, new)], pa.bool_())
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema).filter(keep)
    return docs.transform(map_arrow, run, docs.schema)


def _cut_by_blocks(docs: DataFrame, automata: list, min_words: int, max_cover: float, text_col: str) -> DataFrame:
    row = "_row"
    while row in docs.columns:
        row = "_" + row
    base = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "leak-rows")
    live = base.select(F.col(row).alias("row"), F.lit(0).cast("long").alias("total"),
                       F.lit(0).cast("long").alias("gone"), F.col(text_col).alias("text"))
    rounds = []
    while True:
        found = _passes(live.select("row", "text"), automata, "row long, " + FOUND).filter(F.size("hits") > 0)
        found = materialise(found.groupBy("row").agg(F.flatten(F.collect_list("hits")).alias("hits")), "leak-hits")
        cut = materialise(prefilter(live, F.col("row"), found.select("row")).join(found, "row")
                          .select("row", "total", "gone", "text", "hits")
                          .transform(map_arrow, _round_fn(min_words, max_cover),
                                     "row long, total long, gone long, text string, dropped boolean"), "leak-cut")
        if cut.isEmpty():
            break
        rounds.append(cut.withColumn("round", F.lit(len(rounds))))
        live = cut.filter("not dropped").drop("dropped")
    if not rounds:
        return base.select(*docs.columns)
    out = rounds[0]
    for r in rounds[1:]:
        out = out.union(r)
    at, new = row + "_at", row + "_new"
    last = out.groupBy(F.col("row").alias(at)).agg(F.max_by(F.struct("text", "dropped"), "round").alias(new))
    both = base.join(materialise(last, "leak-new"), F.col(row) == F.col(at), "left").filter(~F.coalesce(F.col(new)["dropped"], F.lit(False)))
    return both.withColumn(text_col, F.when(F.col(new).isNotNull(), F.col(new)["text"]).otherwise(F.col(text_col))) \
        .select(*docs.columns)


def _round_fn(min_words: int, max_cover: float):
    """One round of :func:`cut_text` with the spans of all blocks; rows without a cut are left out."""
    def run(batches):
        for b in slices(batches):
            out = []
            for r in b.to_pylist():
                cut = [s for s in _joined((h["lo"], h["hi"]) for h in r["hits"]) if s[1] - s[0] >= min_words]
                if cut:
                    total = r["total"] or len(item_words(r["text"]))
                    gone = r["gone"] + sum(y - x for x, y in cut)
                    dropped = gone > max_cover * total
                    out.append((r["row"], total, gone, None if dropped else _without(r["text"], cut), dropped))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=["row", "total", "gone", "text", "dropped"])
    return run


def _joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap or touch joined."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and out[-1][1] >= x:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out
