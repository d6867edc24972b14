"""Corpus pipeline over ``documents``: quality, repeated lines, near copies,
benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns the columns of documents, but for the last, which returns
the pieces of packed sequences.  ``run`` writes each stage's result to the
shared scratch folder and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm.common import free_name, with_row_key
from scorewell.llm.decontaminate import find_benchmark
from scorewell.llm.line_dedup import drop_repeated_lines
from scorewell.llm.ngram_join import ngram_components
from scorewell.llm.packing import pack_documents
from scorewell.llm.quality import keep_good
from scorewell.llm.tokens import load_spec
from scorewell.session import scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier one; a document of which no
    word is left goes, as all it said is said before.  Rows are told apart by
    file and place (``common.with_row_key``)."""
    removed, key = free_name("n_lines_removed", docs.columns), free_name("row", docs.columns)
    rows = with_row_key(docs, key)
    out = drop_repeated_lines(rows, min_tokens=1, removed_col=removed, row_col=key)
    some = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    out = out.where(some | (F.col(removed) == 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(removed) == 0, F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest
    id: five-word shingles, similarity 0.8 or more.  Texts without words are
    no copies of each other.  Rows are told apart by file and place, so a
    repeated id does no harm."""
    key = free_name("row", docs.columns)
    rows = with_row_key(docs, key)
    found = ngram_components(rows, n=5, threshold=0.8, id_col=key, row_col=key).where("n_shingles > 0").select(
        F.col("doc_id").alias("at"), F.col("component_id").alias("group"))
    found = found.join(rows.select(F.col(key).alias("at"), F.col("doc_id").alias("id")), "at")
    first = found.groupBy("group").agg(F.min(F.struct("id", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    copies = (found.join(first.where("n > 1"), "group").where(F.col("first.at") != F.col("at"))
              .select(F.col("at").alias(key)))
    return rows.join(copies, key, "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; each row is judged on its
    own, told apart by file and place."""
    key = free_name("row", docs.columns)
    rows = with_row_key(docs, key)
    held = find_benchmark(rows, table(spark, sf_dir, "benchmark"), id_col=key).select(
        F.col("doc_id").alias(key)).distinct()
    return rows.join(held, key, "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    spec = load_spec(public_tokenizers.path("word_bpe_49k.json"))
    return pack_documents(docs, spec, end_id=1).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", decontaminate), ("packing", packing)]

#: Tokenising and the language model have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    root = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
    return docs
