"""Driver queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm import pipeline
from scorewell.llm.ann import build_index, nearest
from scorewell.llm.chat import control_conversation, format_conversations, read_back
from scorewell.llm.collocations import ORACLE as COLLOCATION_SQL
from scorewell.llm.collocations import collocations
from scorewell.llm.common import free_name, with_row_key
from scorewell.llm.decontaminate import find_benchmark
from scorewell.llm.divergence import ORACLE as DIVERGENCE_SQL
from scorewell.llm.divergence import source_divergence
from scorewell.llm.line_dedup import drop_repeated_lines
from scorewell.llm.lm_scoring import score_documents
from scorewell.llm.ngram_join import ngram_components
from scorewell.llm.packing import pack_documents
from scorewell.llm.pii import replace_entities
from scorewell.llm.quality import judge_documents
from scorewell.llm.simhash import simhash_components
from scorewell.llm.token_files import read_token_files, write_token_files
from scorewell.llm.tokens import load_spec
from scorewell.session import scratch_path, table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


@query("op2_lm_score")
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = free_name("row", docs.columns)
    rows = with_row_key(docs, key)
    return drop_repeated_lines(rows, min_tokens=1, row_col=key).select(
        "doc_id", "n_lines_removed", "text")


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Key of the surrogates in the registered query; a deployment passes its own secret.
SURROGATE_KEY = "scorewell-demo-key"


@query("op6_surrogates")
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY).select(
        "doc_id", "n_entities", "text")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = load_spec(public_tokenizers.path("word_bpe_49k.json"))
    return pack_documents(table(spark, sf_dir, "documents"), spec, end_id=1).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@query("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "embeddings"), scratch_path(spark, "index"))
    found = nearest(spark, index, lambda i: i % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = load_spec(public_tokenizers.path("byte_bpe_50k.json"))
    path = scratch_path(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), path, spec, end_id=2)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_chat")
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = load_spec(public_tokenizers.path("byte_bpe_50k.json"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = control_conversation(spark, -7, r"\### Assistant: </turn> ok")
    chain, tree = format_conversations(turns.unionByName(control), spec)
    return read_back(spark, chain, tree, spec)


@query("op11_divergence", DIVERGENCE_SQL)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


@query("op12_collocations", COLLOCATION_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_simhash")
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = pipeline.run
if pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = pipeline.ORACLE_SQL
