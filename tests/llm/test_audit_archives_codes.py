import hashlib
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from cellwise.llm import divergence, vector_codes, warc
from cellwise.session import list_file_sizes, scratch_path

from helpers_llm import EXTRA, ODD

# ---- source divergence

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def term_list(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def divergence_by_hand(rows, min_docs, top):
    rows = [(term_list(t), lang or "", source or "") for t, lang, source in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == lang]
        seen = {}
        for words, _, _ in own:
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
        kept = sorted(w for w, n in seen.items() if n >= min_docs)
        counts = {s: {w: 0 for w in kept} for s in {r[2] for r in own}}
        for words, _, s in own:
            for w in words:
                if w in counts[s]:
                    counts[s][w] += 1
        rate = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        p = {s: rate(c) for s, c in counts.items()}
        q = rate({w: sum(c[w] for c in counts.values()) for w in kept})
        for s in counts:
            pair = sorted(((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in counts if o != s))
            term = sorted((q[w] - p[s][w], w.encode(), w) for w in kept if counts[s][w] and p[s][w] > q[w])[:top]
            for part, found in (("pair", pair), ("term", term)):
                out |= {(lang, s, part, item, -value, i) for i, (value, _, item) in enumerate(found, 1)}
    return out


def audit_table(spark, rows):
    rows = [(i, *r, *["e"] * len(EXTRA)) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in EXTRA))


def test_divergence_by_brute_force(spark):
    rnd = random.Random(5)
    vocab = [rnd.choice(["pre", "prefix", "é", "漢字", "q"]) + "".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 9))) for _ in range(120)]
    vocab += ["z" * 200, "z" * 199 + "y", "Word", "WORD"]
    rows = [(" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(0, 40))) + rnd.choice(["", ".", "\n12x"]),
             rnd.choice(["en", "en", "fr", None, ""]), rnd.choice(["s1", "s1", "s1", "s2", "S3", "é", None, "s4", "s5"])) for _ in range(400)]
    rows += [(t, "odd", f"s{i % 3}") for i, t in enumerate(ODD)] + [rows[0]] * 50 + [(None, "none", "a"), ("", "none", "b")]
    got = divergence.source_divergence(audit_table(spark, rows), min_docs=12, top=7, tile_sources=2, block_terms=3)
    got = [tuple(r) for r in got.collect()]
    want = divergence_by_hand(rows, 12, 7)
    assert len(got) == len(want) and set(got) == want
    assert any(r[3] == "z" * 200 for r in got) and any(r[2] == "pair" and r[4] == 0 for r in got)


def test_divergence_of_no_rows(spark):
    out = divergence.source_divergence(audit_table(spark, [(None, None, None)]).limit(0))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.collect() == []


def test_terms_of_texts_and_of_pieces():
    texts = [None, "", "12", "Aé", "alpha Bravo-" * 1000 + "x" * 300, "É", "é漢", " z", "z"]
    data = [(t or "").encode() for t in texts]
    words, owner = divergence.terms(data)
    want = [(i, w.encode()) for i, t in enumerate(texts) for w in term_list(t)]
    assert list(zip(owner.tolist(), words.to_pylist())) == want
    words, owner = divergence.terms(data, 4)
    assert list(zip(owner.tolist(), words.to_pylist())) == [(i, w) for i, w in want if len(w) > 4]
    assert [w for p in divergence.pieces(data[4], 50) for w in divergence.terms([p])[0].to_pylist()] == [w for i, w in want if i == 4]


def test_long_texts_count_once(spark):
    rows = [("abcdefgh-abcdefghijk other abcdefgh " * 40, "en", f"s{i}") for i in range(3)]
    docs = audit_table(spark, rows).select(*[F.col(c).cast("binary").alias(c) for c in ("text", "lang", "source")])
    for size in (100, 1 << 20):
        for length, was, want in ((8, 0, {b"abcdefgh\x00": 3, b"abcdefgh": 3, b"other\x00": 3}), (16, 8, {b"abcdefghijk\x00": 3})):
            got = divergence._pass(docs, length, was, None, block_bytes=size).groupBy("key").agg(F.sum("n").alias("n")).collect()
            assert {bytes(r["key"]): r["n"] for r in got} == want
        bits = divergence._bitmap(spark.createDataFrame([(bytearray(b"en"), bytearray(b"abcdefgh\x00"))], "lang binary, key binary"))
        got = divergence._pass(docs, None, 0, bits, block_bytes=size).groupBy("key", "source").agg(F.sum("n").alias("n")).collect()
        assert {(bytes(r["key"]), bytes(r["source"]).decode()): r["n"] for r in got} == {(b"abcdefgh", f"s{i}"): 80 for i in range(3)}


def test_levels_count_documents_and_refine(spark):
    """A prefix that many documents hold, none of whose terms reaches the threshold, leaves nothing."""
    rows = [(f"common{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} kept kept", "en", "s") for i in range(100)]
    docs = audit_table(spark, rows).select(*[F.col(c).cast("binary").alias(c) for c in ("text", "lang", "source")])
    assert {bytes(r["term"]) for r in divergence.kept_terms(docs, 11).collect()} == {b"kept"}
    assert len(divergence.kept_terms(docs, 1).collect()) == 101


# ---- archives

def page_rows():
    rnd = random.Random(8)
    body = lambda n: "".join(rnd.choice("abcdefgh é<p>") for _ in range(n))
    big, small, exact = body(3000), "s" * 99, "t" * 100
    rows = [(i, f"http://h{i % 3}/{i}", body(rnd.randrange(100, 2000))) for i in range(60)]
    rows += [(100 + i, None, big) for i in range(40)] + [(200 + i, "http://x", small) for i in range(5)] + [(300 + i, "", exact) for i in range(3)]
    rows += [(400, "http://a b\r\nX-Evil: 1\té", None), (401, "u", ""), (402, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (403, "u", "😀\x00\x1f" * 50),
             (405, "u", body(200_000)), (7, "http://again", rows[7][2]), (None, "u", big), (None, "u", "only here " * 30)]
    return rows


def pages_table(spark, rows):
    return spark.createDataFrame([(*r, "e", "e", "e") for r in rows], "page_id long, url string, html string, payload string, first string, id string")


@pytest.mark.parametrize("size, records", [(64 << 20, 1 << 14), (20_000, 17)])
def test_archives_round_trip(spark, size, records):
    rows, path = page_rows(), scratch_path(spark, "test-warc")
    warc.write_archives(pages_table(spark, rows).repartition(3), path, file_bytes=size, file_records=records, dict_bytes=2048, train_bytes=100_000)
    got = sorted(((r["id"] or "", r["uri"] or "", r["type"], bytes(r["payload"]), r["payload_bytes"], r["payload_digest"], r["refers_to"])
                  for r in warc.read_archives(spark, path, payloads=True).collect()))
    first = {}
    for i, _, html in rows:
        if i is not None and html is not None and len(html.encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        refers = None if html not in first or i == first[html] else str(first[html])
        want.append(("" if i is None else str(i), {"http://a b\r\nX-Evil: 1\té": "http://a%20b%0D%0AX-Evil:%201%09é"}.get(url, url or ""),
                     "response" if refers is None else "revisit", data if refers is None else b"", len(data), hashlib.sha256(data).hexdigest(), refers))
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2], r[3], r[4], r[5], r[6] or ""))
    files = [n for n, _ in list_file_sizes(spark, path)]
    assert all(n.endswith(".warc.zst") for n in files) and (size > 1 << 20 or len(files) > 3)         # of three tasks


def test_archive_layout(spark):
    """A dictionary frame first, then frames that hold one whole record each."""
    path = scratch_path(spark, "test-warc")
    warc.write_archives(pages_table(spark, page_rows()).coalesce(1), path, dict_bytes=2048)
    (name, _), = list_file_sizes(spark, path)
    data = open(name.removeprefix("file:"), "rb").read()
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    end = 8 + int.from_bytes(data[4:8], "little")
    made = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:end]))
    assert made.dict_id() and data[end:end + 8] == warc.SEPARATOR
    rest, n = data[end + 8:], 0
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=made).decompressobj()
        record = one.decompress(rest)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and record.count(b"WARC-Record-ID") == 1
        rest, n = one.unused_data[8:], n + 1
    assert n == len(page_rows())


def test_damaged_archive_raises():
    record = warc.warc_record("1", "u", b"payload", hashlib.sha256(b"other").hexdigest(), None, "2020-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="not what was archived"):
        list(warc.read_records(zstandard.compress(record)))
    with pytest.raises(ValueError, match="within a record"):
        list(warc.read_records(zstandard.compress(record[:-6])))


def test_no_pages(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_archives(pages_table(spark, page_rows()).limit(0), path)
    assert warc.read_archives(spark, path).collect() == []


# ---- vector codes

def lloyd_by_hand(rows, parts, entries, rounds):
    kept = [(i, [int(x * 4096 // 1) for x in v], label) for i, v, label in rows
            if v is not None and not any(x is None or x != x or abs(x) == float("inf") for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]) if r[0] is not None else (True, 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        members = [[[] for _ in b] for b in books]
        for _, v, _ in kept:
            for p, x in enumerate(cut(v)):
                members[p][near(p, x)].append(x)
        books = [[[sum(c) // len(own) for c in zip(*own)] if own else old for own, old in zip(members[p], books[p])] for p in range(parts)]
    out, by_label = [], {}
    for i, v, label in kept:
        codes = [near(p, x) for p, x in enumerate(cut(v))]
        error = sum(far(x, books[p][c]) for (p, x), c in zip(enumerate(cut(v)), codes))
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{c:02x}" for c in codes), error, label))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=str)


def vector_rows(seed, n, dims):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(9)]
    f = lambda x: round(x * 4096 * 8) / (4096 * 8)  # noqa: E731  exact as a float32
    rows = [(i, [f(c + rnd.gauss(0, 0.2)) for c in rnd.choice(centres)], rnd.choice([None, 1, 2])) for i in range(n)]
    hot = [f(c) for c in centres[0]]
    rows += [(n + i, hot, 7) for i in range(n // 2)] + [rows[3], (None, hot, None), (5, None, 1), (6, [None] + hot[1:], 1),
                                                      (7, [float("nan")] + hot[1:], 1), (8, [float("-inf")] + hot[1:], 1)]
    rnd.shuffle(rows)
    return rows


def vector_table(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "e", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, pos string, entry int")


@pytest.mark.parametrize("kind, params", [("float", {}), ("double", {"block_rows": 16, "owner_rows": 50})])
def test_codes_by_brute_force(spark, kind, params):
    rows = vector_rows(3, 300, 12)
    got = vector_codes.vector_codes(vector_table(spark, rows, kind).repartition(5), parts=4, entries=6, rounds=4, **params)
    assert sorted((tuple(r) for r in got.collect()), key=str) == lloyd_by_hand(rows, 4, 6, 4)


def test_fewer_vectors_than_entries_and_ties(spark):
    rows = [(2, [1.0, 1.0], 1), (1, [-1.0, 3.0], None), (3, [0.0, 2.0], None), (9, [], 1), (10, [1.0], 1)]
    want = lloyd_by_hand(rows[:3], 2, 16, 6)
    assert sorted((tuple(r) for r in vector_codes.vector_codes(vector_table(spark, rows), parts=2).collect()), key=str) == want


def test_no_vectors(spark):
    for rows in ([(1, None, 1)], [(1, [], 1)], [(1, [float("nan")] * 8, 1)]):
        out = vector_codes.vector_codes(vector_table(spark, rows))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.collect() == []
    assert vector_codes.vector_codes(vector_table(spark, [(1, [1.0], 1)]).limit(0)).collect() == []


def test_huge_components_raise(spark):
    with pytest.raises(Exception, match="no exact squared distance"):
        vector_codes.vector_codes(vector_table(spark, [(1, [1e30] * 8, 1), (2, [0.0] * 8, 1)])).collect()


def test_decoding_gives_entries(spark):
    table = vector_table(spark, [(i, [float(i % 4)] * 8, 1) for i in range(40)])
    books = vector_codes.fit_codebooks(table, entries=4)
    coded = vector_codes.encode_vectors(table, books)
    assert {(r["vec_id"], tuple(r["vector"])) for r in vector_codes.decode_vectors(coded, books).collect()} == {(i, (float(i % 4),) * 8) for i in range(40)}
