import hashlib
import os
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellwise.llm import bpe, decontam, line_dedup
from cellwise.llm.common import materialise
from cellwise.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from oracle_check import TABLES, digest  # noqa: E402

from conftest import SF_SMALL
from helpers_llm import ODD, component_map, documents, edits, near_groups


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()], None)[0] == digest(cols, cur.fetchall(), None)[0]


def _edits_allowed(n):
    return max((t for lo, t in line_dedup.EDITS_BY_LENGTH if n >= lo), default=0)


def _drop_lines(texts):
    """Without the lines that are not the first of their class: equal lines, and those within the
    edits that the shorter one's length allows, over any number of links."""
    first = {}
    for i, t in texts:
        for j, s in enumerate((t or "").split("\n")):
            if len(s) >= 20:
                first.setdefault(s, (i, j))
    bags = {s: Counter(s) for s in first}
    by_length = {}
    for s in first:
        by_length.setdefault(len(s), []).append(s)
    links = []
    for n, own in by_length.items():
        t = _edits_allowed(n)
        for d in range(t + 1):
            for x in own:
                for y in by_length.get(n + d, ()):
                    if (d or x < y) and max((bags[x] - bags[y]).total(), (bags[y] - bags[x]).total()) <= t and edits(x, y) <= t:
                        links.append((first[x], first[y]))
    top = component_map(first.values(), links)
    out = {}
    for i, t in texts:
        ls = (t or "").split("\n")
        left = [s for j, s in enumerate(ls) if len(s) < 20 or top[first[s]] == (i, j)]
        if len(left) == len(ls):
            out[i] = t
        elif "\n".join(left).strip():
            out[i] = "\n".join(left)
    return out


def test_stages_by_brute_force(spark):
    """Every stage against its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = documents(spark, ODD, range(10_000, 10_000 + len(ODD)), ["en"] * len(ODD)).select(*docs.columns)
    table, rows = materialise(docs.union(odd), "test"), {}
    for name, stage in corpus_pipeline.STAGES:
        was = {r.doc_id: r.text for r in table.collect()}
        new = materialise(stage(spark, table, SF_SMALL), "test")
        if name != "encoding":
            assert new.columns == docs.columns
            now = {r.doc_id: r.text for r in new.collect()}
            rows[name] = (was, now)
        table = new
    was, now = rows["language"]
    assert all(now[i] == was[i] for i in now) and {i for i, t in was.items() if not (t or "").strip()} & set(now) == set()
    assert len([i for i in was if i < 10_000 and i not in now]) <= 1
    was, now = rows["lines"]
    assert now == _drop_lines(sorted(was.items()))
    was, now = rows["near duplicates"]
    ids = sorted(was)
    _, comp = near_groups([was[i] for i in ids], 5, 80)
    assert now == {i: was[i] for j, i in enumerate(ids) if comp[j] == j}
    was, now = rows["decontamination"]
    bench = decontam.ItemAutomaton(((str(r.item_id), decontam.item_words(r.text)) for r in
                                    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()), 10)
    assert any(bench.scan(decontam.item_words(t))[0] for t in was.values())
    assert not any(bench.scan(decontam.item_words(t))[0] for t in now.values())
    assert all(now[i] == t for i, t in was.items() if not bench.scan(decontam.item_words(t))[0])
    tool = bpe.load(bpe.vocabulary_path())
    got = {r.doc_id: r for r in table.collect()}
    assert set(got) == set(now)
    for i, t in now.items():
        assert bytes(got[i].ids) == tool.encode(t) and got[i].n_tokens * 4 == len(got[i].ids)
        assert got[i].text_sha256 == got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "text_sha256", "decoded_sha256"]
    assert out.filter(F.col("text_sha256") != F.col("decoded_sha256")).count() == 0 and out.count() > 150


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
