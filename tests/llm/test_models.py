import collections
import math
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from cellwise.llm import langid, lm, quality, toxicity
from cellwise.llm.common import doc_crc_mod
from cellwise.llm.queries import QUERIES
from cellwise.llm.sampling import per_class, single_labels

from conftest import SF_CHECK, SF_SMALL
from helpers_llm import ODD, documents, families, words


def _crc(i, m):
    return zlib.crc32(str(i).encode()) % m


@pytest.mark.parametrize("block,keys", [(2_000_000, 1_000_000), (200, 37)])
def test_lm_counts_match_brute_force(spark, block, keys):
    texts = ODD + families(3) + ODD
    df = documents(spark, texts)
    got = {r.doc_id: r for r in lm.lm_scores(df, doc_crc_mod(F.col("doc_id"), 7) != 2, block_tokens=block, range_keys=keys).collect()}
    toks = [words(t) + [None] for t in texts]
    c = collections.Counter(w for i, ws in enumerate(toks) if _crc(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(texts)
    for i, ws in enumerate(toks):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_crc(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert r.score <= 0


def test_lm_does_not_depend_on_the_blocks(spark):
    df = documents(spark, families(4) + ODD)
    one, many = ({r.doc_id: r.score for r in lm.lm_scores(df, block_tokens=b, range_keys=k).collect()}
                 for b, k in ((2_000_000, 1_000_000), (150, 50)))
    assert one == pytest.approx(many, rel=1e-9)


def test_lm_score_is_the_mixture(spark):
    """The scores of all one-word texts and the empty one add up to the start
    context's probability of words that end; checked by the definition."""
    texts = ["a b", "a b c", "b a", "a"]
    got = {r.doc_id: r.score for r in lm.lm_scores(documents(spark, texts)).collect()}
    toks = [t.split() + ["</s>"] for t in texts]
    c = collections.Counter(w for ws in toks for w in ws)
    pairs = collections.Counter((x, y) for ws in toks for x, y in zip(["<s>", *ws], ws))
    ctx = collections.Counter(x for ws in toks for x in ["<s>", *ws[:-1]])
    n, v = sum(c.values()), len(c)
    # weights as learned from the held-out cells, by the same definition
    cells = collections.Counter()
    size = 2 * lm.SPAN + 2
    code = lambda x: 0 if x <= 0 else int(np.clip(np.rint(np.log2(x) * lm.BINS), -lm.SPAN, lm.SPAN)) + lm.SPAN + 1
    for ws in toks:
        own, own_pairs = collections.Counter(ws), collections.Counter(zip(["<s>", *ws], ws))
        own_ctx = collections.Counter(["<s>", *ws[:-1]])
        for x, y in zip(["<s>", *ws], ws):
            # a context's count is its count as a word, the start mark's the number of texts
            k = (len(toks) if x == "<s>" else c[x]) - (1 if x == "<s>" else own[x])
            two = (pairs[x, y] - own_pairs[x, y]) / k * (v + 1) if k else 0
            one = (c[y] - own[y]) / max(1, n - len(ws)) * (v + 1)
            cells[(int(lm.bucket_of(np.array([k]))[0]) * size + code(two)) * size + code(one)] += 1
    assert ctx["<s>"] == len(toks) and own_ctx
    keys = np.array(sorted(cells))
    weights = lm.learn_weights(keys, np.array([cells[x] for x in keys]))
    assert weights.sum(axis=1) == pytest.approx(np.ones(len(weights)))
    for i, ws in enumerate(toks):
        want = 0.0
        for x, y in zip(["<s>", *ws], ws):
            k = len(toks) if x == "<s>" else c[x]
            w = weights[lm.bucket_of(np.array([k]))[0]]
            want += math.log10(w[0] * pairs[x, y] / k + w[1] * c[y] / n + w[2] / (v + 1))
        assert got[i] == pytest.approx(want, rel=1e-9)


def test_lm_without_rows_or_training(spark):
    df = documents(spark, ["a b", None])
    assert lm.lm_scores(df.limit(0)).count() == 0
    got = lm.lm_scores(df, F.lit(False)).collect()
    assert [(r.held_out, r.train_tokens, r.n_known, r.base_score, r.score) for r in got] == [(True, 0, 0, 0.0, 0.0)] * 2


def test_lm_beats_the_base_on_held_out_documents(spark):
    got = QUERIES["op4_lm_score"](spark, SF_CHECK).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_language_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = QUERIES["op1_language_id"](spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n, rejected = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"),
                                 F.avg(F.col("rejected").cast("int"))).first()
    assert n > 200 and right >= 0.97 and rejected <= 0.01
    model = langid.fit(docs, per_lang=200)
    odd = documents(spark, [None, "", "123 !!", "漢字" * 400, "шла саша по шоссе " * 80])
    assert {r.doc_id: r.rejected for r in langid.identify(odd, model).collect()} == dict.fromkeys(range(5), True)
    assert [r.lang_pred for r in langid.identify(odd, model).orderBy("doc_id").limit(3).collect()] == ["und"] * 3
    kept = langid.keep_identified(odd.union(documents(spark, [docs.first().text])), model)
    assert kept.count() == 1 and kept.columns == odd.columns
    nothing = langid.fit(docs.limit(0))
    assert [(r.lang_pred, r.score) for r in langid.identify(odd, nothing).collect()] == [("und", 0.0)] * 5


def test_language_rejection_at_lengths_that_the_sample_lacks(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter("length(text) > 0")
    model = langid.fit(docs, per_lang=200)
    assert (model.floor > 0).all()
    known = max((r.text for r in docs.select("text").collect()), key=len)
    odd = documents(spark, ["漢字仮名交文章" * 60_000, "漢字仮名交文章" * 400, known * (2_000_000 // len(known))])
    assert [r.rejected for r in langid.identify(odd, model).orderBy("doc_id").collect()] == [True, True, False]
    starts = [r.text[:12] for r in docs.select("text").collect() if langid.LETTER.search(r.text[:12])]
    assert sum(model.predict(t)[2] for t in starts) <= 0.1 * len(starts)
    few = langid.fit(docs.limit(15))
    assert (few.floor > 0).all()
    assert few.predict("漢字仮名交文章" * 60_000)[2]


def test_toxicity_accuracy_and_span(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = QUERIES["op2_toxicity"](spark, SF_CHECK).join(labels, "doc_id")
    assert got.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0] >= 0.93
    model = toxicity.Model({"awful": 14.0}, -10.0)
    texts = [None, "", "All fine here. You awful thing! Good bye.", "All fine here.", "Fine. " * 2000]
    rows = {r.doc_id: r for r in toxicity.score(documents(spark, texts), model).collect()}
    assert rows[2].score > 0.9 and texts[2][rows[2].worst_start:rows[2].worst_end] == " You awful thing"
    assert [rows[i].score < 0.5 for i in (0, 1, 3, 4)] == [True] * 4 and rows[0].worst_start == rows[1].worst_start == -1
    empty = toxicity.fit(docs, labels.limit(0))
    assert [r.score for r in toxicity.score(documents(spark, ["x. y."]), empty).collect()] == [pytest.approx(0.0)]


def test_noisy_or_finds_the_toxic_word():
    rnd = np.random.default_rng(0)
    bags, y = [], []
    for i in range(300):
        toxic = i % 2
        bag = [[int(rnd.integers(1, 20))] for _ in range(6)]
        if toxic:
            bag[int(rnd.integers(0, 6))].append(0)
        bags.append(bag), y.append(toxic)
    w, b = toxicity.train_bags(bags, np.full(300, 4.0), np.array(y), 20)
    assert w[0] > 8 and w[0] > w[1:].max() + 5 and b <= -10


def test_quality_accuracy_and_edges(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = QUERIES["op3_quality"](spark, SF_CHECK).join(labels, "doc_id")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] >= 0.9
    model = quality.fit(docs, labels, per_label=100)
    rows = quality.score(documents(spark, ODD), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    for few in (labels.limit(0), labels.filter("quality = 1")):
        assert all(0 <= r.score <= 1 for r in quality.score(documents(spark, ODD), quality.fit(docs, few)).collect())


def test_calibration_is_monotone():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=2000)
    at, p = quality.calibrate(x, (rnd.random(2000) < 1 / (1 + np.exp(3 * x))).astype(int))
    assert (np.diff(at) > 0).all() and (np.diff(p) <= 1e-9).all() and p[0] > 0.9 > 0.1 > p[-1]


def test_documents_with_both_labels_teach_neither(spark):
    rows = [(1, 1), (1, 0), (2, 1), (2, 1), (3, 0), (None, 1), (4, None), (5, 2), (6, 0), (6, 2)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    got = single_labels(labels, "doc_id", "toxic").collect()
    assert sorted((r.doc_id, r.y) for r in got) == [(2, 1), (3, 0), (6, 0)]
    assert [r.doc_id for r in single_labels(labels, "doc_id", "toxic", F.col("doc_id") < 3).collect()] == [2]


def test_samples_do_not_depend_on_the_order_of_rows(spark):
    rows = [(i % 7, "a", f"t{i}") for i in range(200)]
    picks = [{r.text for r in per_class(spark.createDataFrame(part, "id long, label string, text string").repartition(n), "label", "id", 20,
                                        F.xxhash64("text")).collect()} for part, n in ((rows, 3), (rows[::-1], 5))]
    assert picks[0] == picks[1] and len(picks[0]) == 20


def _models(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    return [(langid.identify, langid.fit(docs)), (toxicity.score, toxicity.fit(docs, labels)), (quality.score, quality.fit(docs, labels))]


def test_models_score_every_row(spark):
    """No rows, NULL ids and repeated ids: one result per row, equal for equal texts."""
    texts = ["Some words here. And more of them.", None, "", "Some words here. And more of them."]
    some = documents(spark, texts, ids=[None, 5, 5, 5])
    for apply, model in _models(spark):
        assert apply(documents(spark, ["x"]).limit(0), model).count() == 0
        got = [tuple(r) for r in apply(some, model).collect()]
        assert sorted((r[0] for r in got), key=str) == [5, 5, 5, None]
        assert next(r for r in got if r[0] is None)[1:] in [r[1:] for r in got if r[0] == 5]


def test_scores_by_brute_force(spark):
    """Cosine, noisy-or and size difference of whole texts, written out plainly."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    texts = {r.doc_id: r.text for r in docs.collect()}
    (identify, lang), (toxic, bags), (good, sizes) = _models(spark)
    for r in identify(docs, lang).collect():
        at, n = langid.trigram_counts(texts[r.doc_id])
        v = {int(d): math.log(1 + c) * float(lang.idf[d]) for d, c in zip(at, n)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        like = [(sum(x * float(c[d]) for d, x in v.items()) / norm, name) for c, name in zip(lang.centres, lang.langs)]
        if r.lang_pred != "und":
            assert r.score == pytest.approx(max(like)[0], abs=1e-4) and r.lang_pred in [b for a, b in like if a > max(like)[0] - 1e-5]
    for r in toxic(docs, bags).collect():
        clean = 1.0
        for sentence in re.findall(r"[^.!?\n]+", texts[r.doc_id] or ""):
            ws = set(re.findall(r"\w+", sentence.lower()))
            z = bags.bias + sum(bags.weights.get(f, 0.0) for f in ws | {w[:5] + "*" for w in ws if len(w) > 5})
            clean *= 1 - 1 / (1 + math.exp(-z))
        assert r.score == pytest.approx(1 - clean, abs=1e-6)
    one, other, piece, level = sizes.args
    for r in good(docs, sizes).collect():
        raw = (texts[r.doc_id] or "").encode()
        total = [0, 0]
        for i, d in enumerate((one, other)):
            c = zstandard.ZstdCompressionDict(d)
            c.precompute_compress(level=level)
            z = zstandard.ZstdCompressor(dict_data=c, write_checksum=False, write_content_size=False, write_dict_id=False)
            total[i] = sum(len(z.compress(raw[k:k + piece])) for k in range(0, len(raw), piece))
        assert r.difference == pytest.approx((total[0] - total[1]) / len(raw) if raw else 0.0)
        assert r.score == pytest.approx(float(np.interp(r.difference, sizes.at, sizes.p)))
