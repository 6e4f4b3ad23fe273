import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from cellwise.llm import bpe, decontam, token_files
from cellwise.session import scratch_path

from helpers_llm import EXTRA, ODD, documents


def _odd_texts(n=1500):
    rnd = random.Random(2)
    parts = list("aabetio sn'  \n\t.,!?012ABéÉß漢😀́ \x85") + ["'s", "'ll", "<|endoftext|>", "aaaa", "    ", " the", "ing"]
    return ODD + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + ["ab" * 2000, " " * 700]


def test_bpe_matches_the_library(spark):
    lib = Tokenizer.from_file(bpe.vocabulary_path())
    texts = _odd_texts()
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = {r.doc_id: r for r in bpe.encode(documents(spark, texts), decoded=True).collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(bytes(got[i].ids), "<u4").tolist() == want[i], t
        assert got[i].decoded == (t or "") == lib.decode(want[i], skip_special_tokens=False)
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(documents(spark, texts[:40]))).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts[:40])}
    assert bpe.encode(documents(spark, ["a"]).limit(0)).count() == 0


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_files(spark, encoding):
    lib = Tokenizer.from_file(token_files.vocabulary_path())
    texts = _odd_texts(300)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(documents(spark, texts, ids), path, encoding=encoding)
    want = {i: lib.encode(t or "", add_special_tokens=False).ids + [2] for i, t in zip(ids, texts)}
    got = {r.doc_id: r for r in token_files.token_digests(spark, path).collect()}
    starts = {r.doc_id: r.start for r in token_files.read_starts(spark, path).collect()}
    at = 0
    for i in sorted(want):
        assert (got[i].start, got[i].n_tokens, starts[i]) == (at, len(want[i]), at)
        assert got[i].ids_crc32 == zlib.crc32(np.array(want[i], "<u4").tobytes())
        at += len(want[i])
    some = {r.doc_id: list(r.ids) for r in token_files.read_window(spark, path, 10, 20).collect()}
    assert some == {i: want[i] for i in range(10, 20)}
    last = -1
    for f in sorted(glob.glob(path.removeprefix("file:") + "/part-*.parquet")):
        column = pq.ParquetFile(f).metadata.row_group(0).column(4)
        assert column.has_offset_index and column.has_column_index
        assert ("DELTA_BINARY_PACKED" in column.encodings) == (encoding == "delta")
        ids_here = pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
        assert ids_here == sorted(ids_here) and ids_here[0] > last
        last = ids_here[-1]


def _brute(texts, items, window):
    out = []
    sets = {}
    for k, t in items:
        ws = decontam.item_words(t)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            sets.setdefault(tuple(ws[i:i + n]), set()).add(str(k))
    for t in texts:
        ws, hit, found = decontam.item_words(t), set(), set()
        for n in {len(s) for s in sets}:
            for i in range(len(ws) - n + 1):
                ks = sets.get(tuple(ws[i:i + n]))
                if ks:
                    hit |= set(range(i, i + n))
                    found |= ks
        out.append((len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def _leaks(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 2, 3, 5, 8, 20, 40])))) for i in range(12)]
    items = [x for x in items if len(x[1].split()) > 1] + [(90, None), (91, ""), (92, "--"), (93, "a b c d e f g h i j k"), (94, items[0][1])]
    texts = []
    for _ in range(60):
        t = rnd.choices(words, k=rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            s = rnd.choice([x for _, x in items if x]).split()
            p, lo = rnd.randint(0, len(t)), rnd.randint(0, len(s) - 1)
            t[p:p] = s[lo:lo + rnd.randint(1, 25)]
        texts.append(rnd.choice([" ", ", ", "\n"]).join(t).title())
    return ODD + texts, items


@pytest.mark.parametrize("seed,window,block", [(1, 10, 10 ** 6), (2, 4, 10 ** 6), (3, 10, 60)])
def test_leaks_match_brute_force(spark, seed, window, block):
    texts, items = _leaks(seed)
    bench = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, doc_id string")
    got = {r.doc_id: tuple(r)[1:] for r in decontam.report(decontam.scan_documents(
        documents(spark, texts), bench, window, max_block_chars=block)).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, items, window)


@pytest.mark.parametrize("ids", [[None], [7], ["7", "8"]])
def test_leaks_of_items_that_share_an_id(spark, ids):
    """NULL and repeated item ids are dealt over the blocks; the result is that of the brute force."""
    texts, items = _leaks(4)
    named = [(ids[j % len(ids)], t) for j, (_, t) in enumerate(items)]
    bench = spark.createDataFrame([(None if k is None else str(k), t) for k, t in named], "item_id string, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontam.report(decontam.scan_documents(
        documents(spark, texts), bench, 10, max_block_chars=100)).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, [("" if k is None else k, t) for k, t in named], 10)


def test_automaton_of_many_items_of_one_template():
    head = [b"t%d" % i for i in range(30)]
    items = [(f"i{j}", head + [b"x%d" % j]) for j in range(5000)]
    a = decontam.ItemAutomaton(items, 10)
    spans, found = a.scan(head[5:20] + [b"other"])
    assert spans == [(0, 15)] and found == {k for k, _ in items}
    assert a.scan(head[25:] + [b"x77"])[1] == set()
    assert a.scan(head[20:] + [b"x77"])[1] == {k for k, _ in items}     # its first ten words are all items'
    assert a.scan(head[21:] + [b"x77"]) == ([(0, 10)], {"i77"})


def test_cut_leaves_no_occurrence(spark):
    texts, items = _leaks(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, texts)
    out = decontam.remove_spans(df, bench, 10, max_cover=0.6)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    before = _brute(texts, items, 10)
    for i, (t, (n, hit, *_)) in enumerate(zip(texts, before)):
        if not hit:
            assert got[i].text == t and all(got[i][c] == f"e{i}" for c in EXTRA)
        elif hit > 0.6 * n:
            assert i not in got
    assert not any(x[-1] for x in _brute([r.text for r in got.values()], items, 10))
    empty = bench.limit(0)
    assert {r.doc_id: r.text for r in decontam.remove_spans(df, empty).collect()} == dict(enumerate(texts))


def test_the_number_of_blocks_does_not_show(spark):
    items = [" ".join(f"i{j}w{k}" for k in range(12)) for j in range(6)]
    fill = " ".join(f"f{k}" for k in range(40))
    pairs = [(a, b) for a in items for b in items if a != b]
    heavy = [f"{a} f f f f f f f f {b} g g g g g g g g" for a, b in pairs]       # 30 % of either, dropped
    nested = [f"{a[:29]} {b} {a[30:]} {fill}" for a, b in pairs]                 # the ends of a meet when b is cut
    leaks, more = _leaks(7)
    texts = heavy + nested + leaks
    bench = spark.createDataFrame([*more, *enumerate(items, 200)], "item_id long, text string")
    ids = [None, 5, 5] * (len(texts) // 3) + list(range(len(texts) % 3))
    df = documents(spark, texts, ids)
    rows = lambda d: sorted(map(repr, d.collect()))
    one, some = (decontam.remove_spans(df, bench, 10, max_block_chars=n) for n in (10 ** 6, 300))
    assert len(decontam._automata(df, bench, 10, "item_id", "text", 300)) > 2
    assert one.columns == some.columns and rows(one) == rows(some)
    assert not {r.h for r in some.collect()} & {f"e{i}" for i in range(len(heavy))}
    left = {r.h: r.text for r in some.collect()}
    assert all(left[f"e{i}"].split() == fill.split() for i in range(len(heavy), len(heavy) + len(nested)))
    one, some = (decontam.scan_documents(df, bench, 10, max_block_chars=n) for n in (10 ** 6, 300))
    assert one.columns == some.columns and rows(one) == rows(some) and some.count() == len(texts)
