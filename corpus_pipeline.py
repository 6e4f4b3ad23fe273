"""The corpus pipeline: stages over ``documents``, each reading what the last wrote.

1. Language ID drops documents that no learned language fits.
2. Line dedup keeps the first of equal or nearly equal lines (one edit from 20
   characters on, two from 40, three from 120, four from 240).
3. MinHash near-dedup keeps one document of each group (five-word shingles,
   similarity 0.8).
4. Decontamination cuts benchmark passages out, and drops documents that mostly
   consist of them.
5. BPE encodes what is left, and checks that the ids decode to the same text.

All stages but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.llm import bpe, decontam, langid, line_dedup, near_dedup
from cellwise.llm.common import doc_crc_mod, materialise, read_table


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after the text has changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.filter(doc_crc_mod(F.col("doc_id"), 3) != 1))
    return langid.keep_identified(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup.drop_repeats(docs, line_dedup.EDITS_BY_LENGTH, min_chars=20))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_duplicates(docs, w=5, percent=80)
    gone = materialise(groups.filter("not kept").select("doc_id").distinct(), "near-gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(decontam.remove_spans(docs, read_table(spark, sf_dir, "benchmark"), window=10, max_cover=0.5))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text_sha256, decoded_sha256``."""
    ids = bpe.encode(docs, decoded=True, source=True)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      digest("text").alias("text_sha256"), digest("decoded").alias("decoded_sha256"))


STAGES = [("language", language), ("lines", lines), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("encoding", encoding)]

#: no SQL states the language model or the encoder; tests/llm checks the stages by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, in order."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
