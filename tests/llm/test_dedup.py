import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellwise.llm import exact_dedup, line_dedup, near_dedup
from cellwise.llm.common import components, prefilter

from helpers_llm import EXTRA, ODD, component_map, documents, edits, families, near_groups


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_match_brute_force(spark, keep, weak):
    texts = ODD + ODD[:6] + ["copy"] * 40 + [f"copy {i % 7}" for i in range(30)]
    hash_fn = (lambda t: F.substring(F.md5(t.cast("binary")), 1, 1)) if weak else exact_dedup.content_hash
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(documents(spark, texts), keep=keep, hash_fn=hash_fn).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        best = min(same) if keep == "min" else max(same)
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (best, len(same), i == best)
        assert got[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_null_and_repeated_ids(spark):
    got = exact_dedup.exact_dedup(documents(spark, ["a", "a", "b", "b", "c"], [1, 1, None, None, None])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id) == [(1, 1, 2, True)] * 2
    assert sorted((r.group_size, r.keep_id, r.kept) for r in got if r.doc_id is None) == [(1, None, True), (2, None, True), (2, None, True)]


def test_empty_tables(spark):
    none = documents(spark, ["a"]).limit(0)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert line_dedup.line_classes(none).count() == 0
    assert line_dedup.drop_repeats(none).count() == 0


def test_components_match_brute_force(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(9, 9)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    want = component_map(nodes, edges[:-1])
    assert {n: got[n] for n in nodes} == want


def test_prefilter_keeps_every_match(spark):
    df, keys = spark.range(5000), spark.range(0, 5000, 97)
    got = {r.id for r in prefilter(df, F.col("id"), keys, buckets=64).collect()}
    assert set(range(0, 5000, 97)) <= got
    assert len({r.id for r in prefilter(df, F.col("id"), keys).collect()}) < 500


def test_index_finds_every_pair_within_the_distance():
    ix, rnd = near_dedup.Index(), np.random.default_rng(4)
    a = rnd.integers(0, 1 << 16, (400, ix.n)).astype("<u2")
    b = a.copy()
    for i in range(len(b)):
        b[i, rnd.choice(ix.n, ix.max_distance, replace=False)] ^= 1
    ka, kb = ix.keys(a), ix.keys(b)
    assert (ka == kb).any(axis=1).all()
    dist, slot = ix.first_slot(a, b)
    assert (dist == ix.max_distance).all()
    assert [int((x == y).argmax()) for x, y in zip(ka, kb)] == slot.tolist()


@pytest.mark.parametrize("w,block", [(2, 1024), (5, 1024), (2, 4)])
def test_near_components_match_brute_force(spark, w, block):
    texts = ODD + families(1) + families(2, base_words=25) + ODD
    got = {r.doc_id: r for r in near_dedup.near_duplicates(documents(spark, texts), w=w, block=block).collect()}
    sets, want = near_groups(texts, w, 80)
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_full_counts_do_not_rule_out_a_pair():
    """Sets of 10 million members that share nearly all: more than the counts hold."""
    ix, n = near_dedup.Index(), 10_000_000
    sig = np.zeros((2, ix.n), "<u2")
    hist = np.frombuffer(near_dedup.sketch(np.arange(n, dtype=np.uint64) << np.uint64(7)), "<u2")
    batch = pa.RecordBatch.from_pydict({
        "k": [1, 1], "slot": [0, 0], "u": [0, 0], "v": [0, 0], "side": [0, 0], "id": [1, 2], "comp": [1, 2],
        "n": [n, n], "sig": [x.tobytes() for x in sig], "hist": [hist.tobytes()] * 2})
    out = [x for b in near_dedup._cross_fn(ix, 80)([batch]) for x in b.to_pylist()]
    assert out == [{"a": 1, "b": 2}]


def test_near_null_and_repeated_ids(spark):
    t = "one two three four five six seven"
    got = near_dedup.near_duplicates(documents(spark, [t, t, t, t], [7, 7, 3, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (3, 3, True), (7, 3, False), (7, 3, False)]


@pytest.mark.parametrize("t", [1, 2, 4])
def test_bit_parallel_distance(spark, t):
    rnd, rows = random.Random(t), []
    for _ in range(800):
        a = [rnd.choice("abé") for _ in range(rnd.randint(6, 26))]
        b = list(a)
        for _ in range(rnd.randint(0, 6)):
            p = rnd.randrange(len(b))
            b[p:p + rnd.randint(0, 1)] = [rnd.choice("abéd")] * rnd.randint(0, 1) or ["a"]
        if abs(len(a) - len(b)) <= t < len(b):
            rows.append(("".join(a), "".join(b)))
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", line_dedup.edit_distance(F.split("a", ""), F.split("b", ""), t).alias("d")).collect()
    assert all(min(r.d, t + 1) == min(edits(r.a, r.b), t + 1) for r in got)
    assert {min(r.d, t + 1) for r in got} == set(range(t + 2))


def _lines(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(20, 40))) for _ in range(12)]
    texts = []
    for _ in range(40):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            s = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2, 3])):
                p = rnd.randrange(len(s))
                s[p:p + rnd.randint(0, 1)] = rnd.choice(["x", "", "é"])
            lines.append("".join(s))
        texts.append("\n".join(lines + rnd.choice([[], ["short"], [""]])))
    return texts


@pytest.mark.parametrize("t", [1, 2, 3])
def test_line_classes_match_brute_force(spark, t):
    texts = [x for x in ODD if x is None or len(x) < 5000] + _lines(t)
    at = [(i, j, s) for i, x in enumerate(texts) if x is not None for j, s in enumerate(x.split("\n"))]
    distinct = sorted({s for _, _, s in at if len(s) >= 20})
    links = [(i, j) for i in range(len(distinct)) for j in range(i)
             if abs(len(distinct[i]) - len(distinct[j])) <= t and edits(distinct[i], distinct[j]) <= t]
    comp = component_map(range(len(distinct)), links)
    where, first = {s: i for i, s in enumerate(distinct)}, {}
    for i, j, s in at:
        if s in where:
            first.setdefault(comp[where[s]], (i, j))
    got = {(r.doc_id, r.line_no): r for r in line_dedup.line_classes(documents(spark, texts), t, 20).collect()}
    assert set(got) == {(i, j) for i, j, _ in at}
    for i, j, s in at:
        r, want = got[i, j], first[comp[where[s]]] if s in where else (i, j)
        assert (r.class_doc, r.class_line) == want and r.kept == (want == (i, j))
        assert r.n_links == (sum(where[s] in e for e in links) if s in where else 0)


def test_line_edits_grow_with_the_length(spark):
    """One to four edits by the shorter line's length, class ends included, against brute force."""
    rnd, texts = random.Random(5), []
    for n in (22, 39, 40, 41, 44, 118, 119, 120, 122, 239, 240, 241, 300, 700):
        base = [rnd.choice("abcdé ") for _ in range(n)]
        for k in (0, 1, 2, 2, 3, 3, 4, 4, 5):
            s = list(base)
            for p in sorted(rnd.sample(range(len(s)), k), reverse=True):
                s[p:p + rnd.randint(0, 1)] = rnd.choice(["x", "xy"[:rnd.randint(0, 1)], "z"])
            texts.append("".join(s))
    rnd.shuffle(texts)
    allowed = lambda a, b: [t for n, t in line_dedup.EDITS_BY_LENGTH if n <= min(len(a), len(b))][-1]
    long = sorted({s for s in texts if len(s) >= 20})
    links = [(i, j) for i in range(len(long)) for j in range(i) if abs(len(long[i]) - len(long[j])) <= 4
             and edits(long[i], long[j]) <= allowed(long[i], long[j])]
    comp, where, first = component_map(range(len(long)), links), {s: i for i, s in enumerate(long)}, {}
    for i, s in enumerate(texts):
        if s in where:
            first.setdefault(comp[where[s]], i)
    got = {r.doc_id: r for r in line_dedup.line_classes(documents(spark, texts), line_dedup.EDITS_BY_LENGTH, 20).collect()}
    for i, s in enumerate(texts):
        assert got[i].class_doc == (first[comp[where[s]]] if s in where else i)
        assert got[i].n_links == (sum(where[s] in e for e in links) if s in where else 0)


@pytest.mark.parametrize("edits_allowed", [1, 2, 3, 4, line_dedup.EDITS_BY_LENGTH])
def test_lines_within_the_edits_meet_under_a_held_key(spark, edits_allowed):
    """Also where edits move a line over the end of a range or class of lengths; few keys for each line."""
    rnd = random.Random(str(edits_allowed))
    classes = line_dedup.length_classes(edits_allowed, 20)
    rows, allowed = [], lambda n: next(t for lo, hi, t in classes[::-1] if n >= lo)
    for _ in range(1500):
        line = "".join(rnd.choice("abcdefgh ") for _ in range(rnd.choice([rnd.randint(24, 90), rnd.randint(110, 130), rnd.randint(230, 275)])))
        other = line
        for _ in range(rnd.randint(1, allowed(len(line) - 4 if len(line) > 24 else 20))):
            i, how = rnd.randrange(len(other) + 1), rnd.randrange(3)
            other = other[:i] + ("#" if how else "") + other[i + (how != 1):]
        rows += [(line, len(line)), (other, len(other))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, line string, n int")
    keys = {}
    for r in line_dedup.line_keys(df, classes).collect():
        keys.setdefault(r.who >> 1, {}).setdefault(r.k, set()).add(r.who & 1)
    for i in range(0, len(rows), 2):
        a, b = keys[i], keys[i + 1]
        assert any(1 in a[k] | b[k] for k in a.keys() & b.keys()), rows[i:i + 2]
    assert sum(map(len, keys.values())) <= 20 * len(rows)


def test_no_map_of_fixed_size_is_filled_by_line_keys(spark, monkeypatch):
    """Which keys meet is found by key, not by a bitmap that lets all pass once the lines are many; and
    the code made for it stays small."""
    made, write = [], line_dedup.materialise
    def noted(df, name, *by):
        if name == "line-met":
            made.append(df._jdf.queryExecution().toString())
        return write(df, name, *by)
    monkeypatch.setattr(line_dedup, "materialise", noted)
    assert line_dedup.drop_repeats(documents(spark, _lines(3)), line_dedup.EDITS_BY_LENGTH).count()
    assert made and "_bits" not in made[0] and len(made[0]) < 100_000


def test_lines_that_differ_in_rare_letters_are_not_compared(spark, monkeypatch):
    """150 lines of one start whose ends differ by more edits than allowed, all in letters that are not counted."""
    rnd = random.Random(11)
    texts = ["the same start of all these lines, " + "".join(rnd.sample("wcmfgypbvkxjqz", 7)) + " end" for _ in range(150)]
    compared, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *rest: (compared.append(pairs.count()), verified(pairs, *rest))[1])
    assert line_dedup.drop_repeats(documents(spark, texts), 1, 20).count() <= 150
    assert compared and sum(compared) < 150 * 149 // 20


def test_near_copies_of_a_line_are_not_compared_in_pairs(spark, monkeypatch):
    """A line of many copies and 150 lines with one edit each: dropped as line_classes says, with
    a few comparisons for each line. Lines that only meet over others are dropped too."""
    rnd = random.Random(3)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(30))
    texts = [line] * 3 + [line[:i % 30] + "xyzuvw"[i // 30] + line[i % 30 + 1:] for i in range(150)]
    texts = [f"{t}\n{i}" for i, t in enumerate(texts)] + [f"#{s}" for s in _lines(4)]
    df, compared, verified = documents(spark, texts), [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *rest: (compared.append(pairs.count()), verified(pairs, *rest))[1])
    kept = {(r.doc_id, r.line_no) for r in line_dedup.line_classes(df, 1, 20).filter("kept").collect()}
    all_pairs = compared.pop()
    got = {r.doc_id: r.text for r in line_dedup.drop_repeats(df, 1, 20).collect()}
    lines = {i: "\n".join(s for j, s in enumerate(t.split("\n")) if (i, j) in kept) for i, t in enumerate(texts)}
    assert got == {i: t for i, t in lines.items() if t.strip()}
    assert all_pairs > 2_000 and sum(compared) < 1_000


def test_pipeline_drops_a_long_line_with_two_edits(spark):
    rnd = random.Random(9)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    near = "#" + line[1:150] + "#" + line[151:]
    out = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, documents(spark, [line, "other\n" + near]), "").collect()}
    assert out == {0: line, 1: "other"}


def test_drop_repeats(spark):
    line, other = "this line is long enough to count", "another line that is long enough too"
    texts = [f"{line}\n{other}", f"{line}!\nshort", line, None, "", "short", f"{other}\n\n"]
    df = documents(spark, texts)
    out = line_dedup.drop_repeats(df, 1, 20)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in got.items()} == {0: texts[0], 1: "short", 3: None, 4: "", 5: "short"}
    assert all(got[i][c] == f"e{i}" for i in got for c in EXTRA)
