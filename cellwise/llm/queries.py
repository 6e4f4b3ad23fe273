"""The registered queries: each operator over its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bpe, decontam, divergence, exact_dedup, langid, line_dedup, lm, near_dedup, quality, token_files, toxicity,
               vector_codes, warc)
from .common import doc_crc_mod, read_table
from .registry import ORACLE, QUERIES, query

__all__ = ["QUERIES", "ORACLE"]


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ids and decoded text of every document, as digests."""
    out = bpe.encode(read_table(spark, sf_dir, "documents"), decoded=True)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return token_files.token_digests(spark, path)


@query("op9_decontamination", """
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws FROM benchmark),
k AS (SELECT *, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS s
        FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM k)),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS s
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
occ AS (SELECT g.doc_id, g.i, g.n, win.item FROM g JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    return decontam.report(decontam.scan_documents(read_table(spark, sf_dir, "documents"),
                                                   read_table(spark, sf_dir, "benchmark"), window=10))


@query("op10_exact_dedup", """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents; the largest id stays."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), keep="max")


@query("op6_near_dedup", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws ELSE
             list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT g, count(*) AS df FROM s GROUP BY g),
r AS (SELECT s.doc_id, s.g, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY df.df, s.g) AS pos
      FROM s JOIN df USING (g) JOIN n USING (doc_id)),
p AS (SELECT doc_id, g, n FROM r WHERE pos <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b USING (g)
      WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM (SELECT c.a, c.b, any_value(na) AS na, any_value(nb) AS nb, count(*) AS i
      FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b AND y.g = x.g GROUP BY c.a, c.b)
      WHERE 100 * i >= 80 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t AS (SELECT doc_id AS id, doc_id AS m FROM documents UNION SELECT e.b, t.m FROM t JOIN e ON e.a = t.id),
m AS (SELECT id, min(m) AS m FROM t GROUP BY id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, m.m AS component_id, doc_id = m.m AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN m ON m.id = doc_id
""")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 2-word shingles, Jaccard 0.8."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), w=2, percent=80)


@query("op7_line_dedup", """
WITH RECURSIVE l AS (
  SELECT doc_id, unnest(range(0, len(ls))) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
d AS (SELECT row_number() OVER (ORDER BY line) AS id, line, place FROM (
        SELECT line, min(struct_pack(doc_id := doc_id, line_no := line_no)) AS place FROM l WHERE length(line) >= 20 GROUP BY line)),
v AS (SELECT id, md5(left(line, i - 1) || chr(10) || substr(line, i + 1)) AS changed, md5(left(line, i - 1) || substr(line, i + 1)) AS cut
      FROM (SELECT id, line, unnest(range(1, length(line) + 1)) AS i FROM d)),
h AS (SELECT id, md5(line) AS whole FROM d),
e AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b USING (changed) WHERE a.id <> b.id
      UNION SELECT v.id, h.id FROM v JOIN h ON v.cut = h.whole
      UNION SELECT h.id, v.id FROM v JOIN h ON v.cut = h.whole),
t AS (SELECT a AS id, a AS m FROM e UNION SELECT e.b, t.m FROM t JOIN e ON e.a = t.id),
c AS (SELECT t.id, min(d.place) AS first FROM t JOIN d ON d.id = t.m GROUP BY t.id),
n AS (SELECT a AS id, count(*) AS n_links FROM e GROUP BY a),
k AS (SELECT d.line, coalesce(c.first, d.place) AS first, coalesce(n.n_links, 0) AS n_links
      FROM d LEFT JOIN c USING (id) LEFT JOIN n USING (id)),
r AS (SELECT l.doc_id, l.line_no, coalesce(k.first.doc_id, l.doc_id) AS class_doc, coalesce(k.first.line_no, l.line_no) AS class_line,
             coalesce(k.n_links, 0) AS n_links FROM l LEFT JOIN k USING (line))
SELECT *, doc_id = class_doc AND line_no = class_line AS kept FROM r
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal and nearly equal lines (one edit) over all documents."""
    return line_dedup.line_classes(read_table(spark, sf_dir, "documents"), max_edits=1, min_chars=20)


@query("op7_line_dedup_by_length")
def op7_line_dedup_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of lines over all documents, one to four edits by the length: what the pipeline links."""
    return line_dedup.line_classes(read_table(spark, sf_dir, "documents"), line_dedup.EDITS_BY_LENGTH, min_chars=20)


@query("op4_lm_score")
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; a seventh of them is held out."""
    return lm.lm_scores(read_table(spark, sf_dir, "documents"), train=doc_crc_mod(F.col("doc_id"), 7) != 2)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a third of them is held out of learning."""
    docs = read_table(spark, sf_dir, "documents")
    held = doc_crc_mod(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.filter(~F.coalesce(held, F.lit(False))))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def _held_fifth():
    return F.coalesce(doc_crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, and its worst sentence."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), train=~_held_fifth())
    return toxicity.score(docs, model).select(
        "doc_id", _held_fifth().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "worst_start", "worst_end", "worst_score")


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by compressed sizes."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), train=~_held_fifth())
    return quality.score(docs, model).select(
        "doc_id", _held_fifth().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "difference")


@query("op11_source_divergence", """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (total + 5 * v) AS p
      FROM t JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + (1000000000 * (sum(n)::HUGEINT + 5)) // (any_value(total) + 5 * any_value(v)) AS q
      FROM c JOIN (SELECT lang, sum(total)::HUGEINT AS total FROM t GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - q.q)::BIGINT FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from its language and from each other source, over the terms of all documents."""
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"), min_docs=30, top=50)


@query("op12_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT *, CASE WHEN octet_length(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first FROM p)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""")
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, and the archives read back."""
    path = scratch_path(spark, "warc")
    pages = read_table(spark, sf_dir, "pages")
    warc.write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(spark, path).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"))


def _lloyd_sql(rounds: int = 6) -> str:
    """The rounds one after the other, each a CTE for the assignment and one for its codebook."""
    square = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    mean = "list_transform(range(1, w + 1), lambda i: (s[i] - ((s[i] % n) + n) % n) // n)"
    ctes = ["""k AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::HUGEINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
            """m AS (SELECT r, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x FROM k, (SELECT unnest(range(0, 8)) AS p))""",
            """b0 AS (SELECT p, e, x AS c FROM m JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM k) USING (r) WHERE e < 16)"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min_by(e, (f, e)) AS e, min(f) AS f
  FROM (SELECT r, p, x, e, {square} AS f FROM m JOIN b{i} USING (p)) GROUP BY r, p)""")
        if i < rounds:
            ctes.append(f"""u{i} AS (SELECT p, e, n, w, list(s ORDER BY j) AS s FROM (
    SELECT p, e, j, count(*)::HUGEINT AS n, any_value(len(x)) AS w, sum(x[j]) AS s FROM a{i}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS j) GROUP BY p, e, j)
  GROUP BY p, e, n, w)""")
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT p, e, CASE WHEN n IS NULL THEN c ELSE {mean} END AS c FROM b{i} LEFT JOIN u{i} USING (p, e))")
    return "WITH " + ",\n".join(ctes) + f""",
z AS (SELECT r, string_agg(lower(printf('%02x', e::INTEGER)), '' ORDER BY p) AS code, sum(f)::BIGINT AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS sha FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM k JOIN z USING (r), h"""


@query("op13_vector_codes", _lloyd_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: 8 parts, 16 entries each, 6 rounds."""
    return vector_codes.vector_codes(read_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
