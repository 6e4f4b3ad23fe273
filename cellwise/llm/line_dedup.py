"""Line deduplication by a segment-partition edit join, in DataFrame functions.

Two lines within ``t`` edits, cut into ``t + 1`` segments, share one segment
exactly. Each line is indexed under its own segments and a range of lengths; it
probes the indexes of its own range, and of the one that lines of up to ``t``
characters less fall into, with the substrings that can align with a segment
under ``t`` edits. Lines that meet under a key are verified with a banded
bit-parallel edit distance. ``t`` may grow with the length: each length class
has indexes and probes of its own.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, materialise, release

#: counted for the filter before verification, digits too, as lines of one template often differ in
#: numbers only: an edit changes the counts by two at most
LETTERS = "etaoinshrdlu 0123456789"

#: of these only whether the count is odd: more columns make the join's code too long to be compiled
RARE = "wcmfgypbvkxjqz.,"

#: (characters of the shorter line, edits): about one edit in twenty characters, four at most
EDITS_BY_LENGTH = ((20, 1), (40, 2), (120, 3), (240, 4))


def length_classes(max_edits: int | Sequence[tuple[int, int]], min_chars: int) -> list[tuple[int, int | None, int]]:
    """``(lo, hi, t)``: lines of ``lo`` to below ``hi`` characters (None: no end) allow ``t`` edits."""
    if isinstance(max_edits, int):
        return [(min_chars, None, max_edits)]
    steps = sorted(max_edits)
    if not steps or steps[0][0] > min_chars:
        raise ValueError("lengths start above min_chars")
    ends = [lo for lo, _ in steps[1:]] + [None]
    return [(max(lo, min_chars), hi, t) for (lo, t), hi in zip(steps, ends) if hi is None or hi > min_chars]


def _by_class(length: Column, classes: Sequence[tuple[int, int | None, int]], value) -> Column:
    """``value(t)`` of the class that ``length`` falls into."""
    out = value(classes[-1][2])
    for _, hi, t in reversed(classes[:-1]):
        out = F.when(length < hi, value(t)).otherwise(out)
    return out


def _windows(t: int) -> list[tuple[int, int]]:
    """``(i, o)``: segments of ``t + 1`` and how far each may lie from its own place, counted from
    the line's nearer end. Of lines within ``t`` edits one segment ``i`` is shared with ``i`` edits left
    of it and ``t - i`` right of it at most, and each edit moves it by one character at most."""
    return [(i, o) for i in range(t + 1) for o in range(-min(i, t - i), min(i, t - i) + 1)]


def line_keys(lines: DataFrame, classes: Sequence[tuple[int, int | None, int]]) -> DataFrame:
    """``k, who``: one row per line (``id, line, n``) and key, ``who`` is ``2 * id``, plus 1 where
    the line is held under the key.

    Lengths are cut into ranges of ``4 t`` from each class's first one. All lines of a range have
    segments of one size: the first half counted from the line's start, the others from its end, so
    that few places match. A line is held under its own segments, and asks for the other windows; one
    less than ``t`` characters above a range, or a class, asks for all windows of that one too. The
    shorter line's class sets ``t``.
    """
    ints = lambda rows, *names: F.array(*[F.struct(*[F.lit(v).cast("int").alias(c) for v, c in zip(r, names)]) for r in rows])
    ranges = ints([(lo, hi if hi is not None else (1 << 31) - 1, t, max(1, 4 * t), d) for lo, hi, t in classes for d in range(t + 1)],
                  "lo", "hi", "t", "width", "d")
    edits = sorted({t for _, _, t in classes})
    t, other = F.col("r.t"), F.col("n") - F.col("r.d")
    last = ((other + 1 - F.col("r.lo")) % F.col("r.width") == 0) | (other + 1 == F.col("r.hi"))
    of_range = (lines.select("id", "line", F.col("n").cast("int").alias("n"), F.explode_outer(ranges).alias("r"))
                .filter((other >= F.col("r.lo")) & (other < F.col("r.hi")) & ((F.col("r.d") == 0) | last))
                .select("id", "line", "n", "r.d", t.alias("t"), (other - (other - F.col("r.lo")) % F.col("r.width")).alias("least")))
    windows = ints(_windows(edits[-1]), "i", "o")
    for e in edits[-2::-1]:
        windows = F.when(F.col("t") == e, ints(_windows(e), "i", "o")).otherwise(windows)
    t, i, o = F.col("t"), F.col("w.i"), F.col("w.o")
    size = ((F.col("least") - F.col("least") % (t + 1)) / (t + 1)).cast("int")
    at = F.when(2 * i <= t, i * size + o).otherwise(F.col("n") - (t - i + 1) * size + o)
    key = F.xxhash64("t", "least", i, F.substring("line", at + 1, size))
    return (of_range.select("id", "line", "n", "d", "t", "least", F.explode_outer(windows).alias("w"))
            .filter((at >= 0) & (at + size <= F.col("n")))
            .select(key.alias("k"), (F.col("id") * 2 + F.when((F.col("d") == 0) & (o == 0), 1).otherwise(0)).alias("who")))


def edit_distance(a: Column, b: Column, t: int) -> Column:
    """Banded bit-parallel edit distance of two character arrays with more than
    ``t`` characters whose sizes differ by at most ``t``; exact up to ``t``, more than ``t`` beyond.

    One word holds the band of ``2t + 1`` rows around the diagonal as vertical
    differences (``p``: +1, ``m``: -1). Each character of ``b`` moves the band
    down by one row; ``s`` is the distance at its lower edge, and along the
    last row once the band has reached it.
    """
    if not 1 <= t <= 15:
        raise ValueError("1 to 15 edits")
    full = (1 << (2 * t + 1)) - 1
    word = lambda x: F.lit(x).cast("long")
    rows = F.size(a)

    def step(acc: Column, j: Column) -> Column:
        c = F.get(b, j - 1)
        match = word(0)
        for k in range(2 * t + 1):
            # band bit k is row j - t + k of a, counted from 1
            match = match.bitwiseOR(F.when(F.get(a, j - t + k - 1) == c, word(1 << k)).otherwise(word(0)))

        def with_match(x: Column) -> Column:
            p, m = acc["p"], acc["m"]
            return ((x.bitwiseAND(p) + p).bitwiseXOR(p)).bitwiseOR(x).bitwiseOR(m).bitwiseAND(word(full))

        def with_diagonal(d: Column) -> Column:
            p, m = acc["p"], acc["m"]
            up = m.bitwiseOR(F.bitwise_not(d.bitwiseOR(p))).bitwiseAND(word(full))
            down = d.bitwiseAND(p)
            moved = F.shiftright(d, 1)
            edge = F.call_function("shiftleft", word(1), (rows - j + t).cast("int"))
            s = F.when(j + t <= rows, acc["s"] + F.when(d.bitwiseAND(word(1 << (2 * t))) == 0, 1).otherwise(0)).otherwise(
                acc["s"] + F.when(up.bitwiseAND(edge) != 0, 1).when(down.bitwiseAND(edge) != 0, -1).otherwise(0))
            return F.struct(down.bitwiseOR(F.bitwise_not(moved.bitwiseOR(up))).bitwiseAND(word(full)).alias("p"),
                            moved.bitwiseAND(up).alias("m"), s.cast("int").alias("s"))

        bound = F.transform(F.transform(F.array(match), with_match), with_diagonal)
        return F.element_at(bound, 1)

    start = F.struct(word(full - ((1 << t) - 1)).alias("p"), word(0).alias("m"), F.lit(t).alias("s"))
    return F.aggregate(F.sequence(F.lit(1), F.size(b)), start, step, lambda acc: acc["s"])


def explode_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line_no`` (from 0) ``, line``; NULL texts have no lines."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))


def line_classes(docs: DataFrame, max_edits: int | Sequence[tuple[int, int]] = 1, min_chars: int = 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per line: ``doc_id, line_no, class_doc, class_line, n_links, kept``.

    Lines (cut at ``\\n``) of at least ``min_chars`` characters are linked when
    they are within ``max_edits`` character edits; given as pairs (characters,
    edits) such as ``EDITS_BY_LENGTH``, the last pair that the shorter line's
    length reaches counts. A class holds the lines
    reachable over links; its first line by (doc_id, line_no) is kept and named
    in ``class_doc, class_line``. ``n_links`` counts the different texts linked
    to the line's own. Shorter lines are classes of their own and kept. NULL
    texts have no lines and an empty text has one empty line; NULL ids come
    first in the order; rows that repeat an id and line number are all kept.

    Equal lines meet by their 128-bit hash, with partial aggregates, and each different
    text is written once. Of these only keys and numbers are shuffled: all keys under
    which lines are indexed, and of those that lines ask for the ones that pass a
    bitmap of the former, of fixed size. Pairs leave the join only if their counts of
    letters and digits allow the edits. Tables are deleted when nothing reads them any more.
    """
    return _line_classes(docs, max_edits, min_chars, id_col, text_col, _links)


def _line_classes(docs: DataFrame, max_edits: int | Sequence[tuple[int, int]], min_chars: int, id_col: str, text_col: str,
                  find) -> DataFrame:
    """``line_classes`` over the links that ``find`` returns: ``_links`` or ``_joining_links``."""
    steps = length_classes(max_edits, min_chars)
    lines = explode_lines(docs, id_col, text_col).withColumn("n", F.char_length("line"))
    long_lines = lines.filter(F.col("n") >= min_chars).withColumn("h", F.unhex(F.md5(F.col("line").cast("binary"))))
    groups = materialise(
        long_lines.select("h", F.struct("doc_id", "line_no").alias("place"), "line", "n")
        .groupBy("h").agg(F.min("place").alias("place"), F.first("line").alias("line"), F.first("n").alias("n"),
                          F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("id"), "h", "place", "line", "n", "copies"), "line-groups")
    links = find(groups, steps)
    linked = materialise(_class_of(links), "line-linked")
    classes = materialise(
        groups.select("h", "place").join(linked, "h", "left")
        .select("h", F.coalesce("class_place", "place").alias("class_place"),
                F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "line-classes")
    release(groups, links, linked)
    out = (long_lines.select("doc_id", "line_no", "h").join(classes, "h")
           .select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("class_place.doc_id").alias("class_doc"),
                   F.col("class_place.line_no").cast("long").alias("class_line"), "n_links"))
    short = lines.filter(F.col("n") < min_chars).select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("doc_id").alias("class_doc"),
        F.col("line_no").cast("long").alias("class_line"), F.lit(0).cast("long").alias("n_links"))
    return out.union(short).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("class_doc")) & (F.col("line_no") == F.col("class_line")))


#: columns of a line that rule out pairs before its text is read
COUNTS = ["n", "odd", *(f"c{i}" for i in range(len(LETTERS)))]


def _meetings(groups: DataFrame, classes: list[tuple[int, int | None, int]]) -> tuple[DataFrame, DataFrame]:
    """``k, is_held, id, copies`` and ``COUNTS`` of the lines that meet another line under a
    key, and the texts of these lines: ``id, h, line, n, place``, counts."""
    # one exchange by key serves both the count and the join (an inner one: a semi join would be moved below it)
    rows = line_keys(groups, classes).repartition("k")
    # keys under which one line is held and another one is held or asks
    busy = (rows.groupBy("k").agg(F.min("who").alias("lo"), F.max("who").alias("hi"), F.max(F.col("who") % 2).alias("held"))
            .filter("shiftright(lo, 1) <> shiftright(hi, 1) and held = 1").select("k"))
    met = materialise(rows.join(busy, "k").select("k", (F.col("who") % 2 == 1).alias("is_held"), F.shiftright("who", 1).alias("id")),
                      "line-met")
    handles = materialise(met.select("id").distinct(), "line-handles")
    counts = [(F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(c)))).alias(f"c{i}")
              for i, c in enumerate(LETTERS + RARE)]
    table = materialise(_may_be_held(groups, "id", handles.withColumnRenamed("id", "k"), 1 << 18).join(handles, "id", "left_semi")
                        .select("id", "h", "line", "n", "place", "copies", *counts), "line-texts")
    # the counts' parities: an edit changes two of them at most, and one comparison rules out most pairs
    odd = sum((F.call_function("shiftleft", F.col(f"c{i}").bitwiseAND(1).cast("long"), F.lit(i)) for i in range(1, len(LETTERS + RARE))),
              F.col("c0").bitwiseAND(1).cast("long")).alias("odd")
    near = materialise(met.join(table.select("id", "copies", "n", odd, *COUNTS[2:]), "id")
                       .select("k", "is_held", "id", "copies", *COUNTS), "line-near")
    release(met, handles)
    return near, table


def _pairs(a: DataFrame, b: DataFrame, classes: list[tuple[int, int | None, int]], *also: str, both_ways: bool = True) -> DataFrame:
    """``a, b``: lines of ``a``, all held, that meet lines of ``b`` under a key and whose counts
    allow the edits; columns ``also`` differ. ``both_ways``: all held lines of ``b`` are in ``a`` too."""
    names = [*COUNTS, *also]
    a = a.select("k", F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in names])
    b = b.select("k", F.col("id").alias("b"), F.col("is_held").alias("b_held"), *[F.col(c).alias(f"b_{c}") for c in names])
    apart = sum((F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) for c in COUNTS[3:]), F.abs(F.col("a_c0") - F.col("b_c0")))
    odd = F.col("a_odd").bitwiseXOR(F.col("b_odd"))
    apart = apart + F.bit_count(F.shiftrightunsigned(odd, len(LETTERS)))
    allowed = _by_class(F.least("a_n", "b_n"), classes, F.lit)
    wanted = ((F.bit_count(odd) <= 2 * allowed)
              & (F.abs(F.col("a_n") - F.col("b_n")) <= allowed) & (apart <= 2 * allowed))
    for c in also:
        wanted = wanted & (F.col(f"a_{c}") != F.col(f"b_{c}"))
    # of two lines held under a key, the one with the smaller number is the first
    once = F.when(F.lit(both_ways) & F.col("b_held"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    return (a.join(b, (a.k == b.k) & once & wanted)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _verified(pairs: DataFrame, table: DataFrame, classes: list[tuple[int, int | None, int]]) -> DataFrame:
    """The linked ones of ``pairs``, with both lines' hash and place. Texts go through
    the joins as they are; their characters are set apart next to the comparison."""
    one = table.select(F.col("id").alias("a"), F.col("line").alias("line_a"), F.col("h").alias("h_a"), F.col("place").alias("place_a"))
    two = table.select(F.col("id").alias("b"), F.col("line").alias("line_b"), F.col("h").alias("h_b"), F.col("place").alias("place_b"))

    def linked(x: Column) -> Column:
        a, b = x["a"], x["b"]
        return _by_class(F.least(F.size(a), F.size(b)), classes, lambda t: (F.abs(F.size(a) - F.size(b)) <= t)
                         & (edit_distance(a, b, t) <= t))

    chars = F.array(F.struct(F.split("line_a", "").alias("a"), F.split("line_b", "").alias("b")))
    return (pairs.join(one, "a").join(two, "b").filter(F.get(F.transform(chars, linked), F.lit(0)))
            .select("a", "b", "h_a", "h_b", "place_a", "place_b"))


def _links(groups: DataFrame, classes: list[tuple[int, int | None, int]]) -> DataFrame:
    """One row per linked pair: ``a, b`` (ids of ``groups``) with both lines' hash and place."""
    near, table = _meetings(groups, classes)
    pairs = materialise(_pairs(near.filter("is_held"), near, classes), "line-pairs")
    release(near)
    links = materialise(_verified(pairs, table, classes), "line-links")
    release(table, pairs)
    return links


def _joining_links(groups: DataFrame, classes: list[tuple[int, int | None, int]]) -> DataFrame:
    """Of ``_links``, enough to reach the same lines over them. Under each key all lines
    are first compared with the held one of most copies; then only lines that these
    links leave in different components are compared with each other. A group of near
    copies takes a comparison for each line and key, not one for each pair."""
    near, table = _meetings(groups, classes)
    middle = near.filter("is_held").groupBy("k").agg(F.max(F.struct("copies", "id", *COUNTS)).alias("_m")).select("k", "_m.*")
    first = materialise(_pairs(middle, near, classes, both_ways=False), "line-pairs")
    star = materialise(_verified(first, table, classes), "line-links")
    reached = materialise(components(star.select("a", "b")), "line-reached")
    placed = near.join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = placed.groupBy("k").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("k")
    left = materialise(placed.join(apart, "k", "left_semi"), "line-apart")
    release(near, reached)
    rest = materialise(_pairs(left.filter("is_held"), left, classes, "component"), "line-pairs")
    rest_links = materialise(_verified(rest, table, classes), "line-links")
    release(left, first)
    links = materialise(star.union(rest_links), "line-links")
    release(table, rest, star, rest_links)
    return links


def _may_be_held(asked: DataFrame, key: str, held: DataFrame, words: int = 1 << 20) -> DataFrame:
    """Rows of ``asked`` whose column ``key`` may be among ``k`` of ``held``: a bitmap of ``words`` times 64
    bits, never more than ``words`` rows, is broadcast; a key sets three bits of its
    word. No row with a held key is lost."""
    def at(c: Column) -> tuple[Column, Column]:
        one = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function(
            "shiftright", c, F.lit(by)).bitwiseAND(63).cast("int"))
        return F.pmod(c, F.lit(words)).alias("_word"), one(58).bitwiseOR(one(46)).bitwiseOR(one(34)).alias("_mask")

    seen = held.select(*at(F.xxhash64("k"))).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    found = asked.select("*", *at(F.xxhash64(key)))
    return (found.join(F.broadcast(seen), "_word").filter(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
            .select(*asked.columns))


def _class_of(links: DataFrame) -> DataFrame:
    """``h, class_place, n_links`` of the lines that have a link."""
    ends = (links.select(F.col("a").alias("id"), F.col("h_a").alias("h"), F.col("place_a").alias("place"))
            .union(links.select("b", "h_b", "place_b")))
    nodes = ends.groupBy("id").agg(F.first("h").alias("h"), F.first("place").alias("place"), F.count("*").alias("n_links"))
    nodes = materialise(nodes.join(components(links.select("a", "b")), "id"), "line-nodes")
    firsts = nodes.groupBy("component").agg(F.min("place").alias("class_place"))
    return nodes.join(materialise(firsts, "line-firsts"), "component").select("h", "class_place", "n_links")


def drop_repeats(docs: DataFrame, max_edits: int | Sequence[tuple[int, int]] = 1, min_chars: int = 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that are not kept, same columns in the same order.

    A document all of whose lines that hold more than white space are dropped
    goes; one from which nothing is dropped keeps its row unchanged (NULL and
    empty texts too). ``id_col`` is unique; rows with a NULL id are unchanged.
    """
    gone = (_line_classes(docs, max_edits, min_chars, id_col, text_col, _joining_links).filter("not kept and doc_id is not null")
            .groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone")))
    gone = materialise(gone.withColumnRenamed("doc_id", "_gone_id"), "line-gone")
    left = F.filter(F.split(F.col(text_col), "\n", -1),
                    lambda line, i: ~F.array_contains(F.col("_gone"), i.cast("long")))
    # documents that lose nothing are not shuffled: their ids' buckets, 2^20 at most, are known to all tasks
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20)).alias("_line_bucket")
    seen = F.broadcast(gone.select(bucket("_gone_id")).distinct())
    dealt = docs.select("*", bucket(id_col))
    whole = dealt.join(seen, "_line_bucket", "left_anti").select(*docs.columns)
    docs = dealt.join(seen, "_line_bucket", "left_semi").select(*docs.columns)
    cut = docs.join(gone, docs[id_col] == gone["_gone_id"], "left").withColumn(
        "_left", F.when(F.col("_gone").isNotNull(), F.array_join(left, "\n")))
    cut = cut.filter(F.col("_left").isNull() | F.col("_left").rlike(r"\S"))
    return whole.union(cut.withColumn(text_col, F.coalesce(F.col("_left"), F.col(text_col))).select(*docs.columns))
