"""Token-id files: Simple-8b blocks in Parquet, ids in ascending key order.

Files hold one row per block.  A block has whole documents: their keys and
counts, the words and escapes of all their ids, its shard (one write task)
and the number of ids before it in that shard.  Shards follow each other in
key order, so the place of any document in the whole stream is the ids of
earlier shards plus two offsets, and blocks decode independently.

Edge cases: a null or empty text is the end id alone; null keys come first;
rows of one key are written as often as they occur, in the order of their
texts' hashes; an empty table gives files without blocks; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewell.llm import simple8b
from scorewell.llm.common import two_columns
from scorewell.llm.tokens import text_encoder
from scorewell.session import ship_package

BLOCK_SCHEMA = ("shard long, block long, ids_before long, n_ids long, doc_ids array<long>, "
                "counts array<long>, words binary, escapes binary")


def _encode(batches: Iterator[pa.RecordBatch], spec: str, end_id: int,
            block_ids: int) -> Iterator[pa.RecordBatch]:
    enc, end = text_encoder(spec), np.array([end_id], "<u4").tobytes()
    shard, block, before = TaskContext.get().partitionId(), 0, 0
    keys: list = []
    parts: list[bytes] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal block, before, held, keys, parts
        ids = np.frombuffer(b"".join(parts), "<u4").astype(np.uint64)
        words, escapes = simple8b.pack(ids)
        row = pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "block": pa.array([block], pa.int64()),
            "ids_before": pa.array([before], pa.int64()),
            "n_ids": pa.array([len(ids)], pa.int64()),
            "doc_ids": pa.array([keys], pa.list_(pa.int64())),
            "counts": pa.array([[len(p) // 4 for p in parts]], pa.list_(pa.int64())),
            "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
            "escapes": pa.array([escapes.astype("<u8").tobytes()], pa.binary())})
        block, before = block + 1, before + len(ids)
        held, keys, parts = 0, [], []
        return row

    for b in batches:
        for lo in range(0, b.num_rows, 512):
            cut = b.slice(lo, 512)
            for key, ids in zip(cut.column(0).to_pylist(), enc.encode(cut.column(1).to_pylist())):
                ids += end
                keys.append(key)
                parts.append(ids)
                held += len(ids) // 4
                if held >= block_ids:
                    yield flush()
    if keys:
        yield flush()


def write_token_files(df: DataFrame, path: str, spec: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = 1 << 16) -> None:
    """Encode every whole text and write its ids plus ``end_id`` to ``path``.

    ``spec`` is the vocabulary's JSON text (``tokens.load_spec``).  One range
    shuffle of the texts puts them in key order (its bounds are found on keys and
    hashes, so no text comes to the driver, and a hot key is spread); encoding follows in the same
    tasks, so ids are never shuffled.
    """
    ship_package(df.sparkSession)
    (two_columns(df, id_col, text_col)
     .withColumn("doc_id", F.col("doc_id").cast("long"))
     .withColumn("hash", F.xxhash64("text"))
     .repartitionByRange(F.col("doc_id").asc_nulls_first(), "hash")
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "hash", F.col("text").asc_nulls_first())
     .select("doc_id", "text")
     .mapInArrow(lambda it: _encode(it, spec, end_id, block_ids), BLOCK_SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            ids = simple8b.unpack(np.frombuffer(r["words"], "<u8"),
                                  np.frombuffer(r["escapes"], "<u8")).astype("<u4")
            counts = np.array(r["counts"], np.int64)
            ends = np.cumsum(counts)
            raw, start = ids.tobytes(), r["shard_start"] + r["ids_before"]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(r["doc_ids"], pa.int64()),
                "start": pa.array(start + ends - counts, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids": pa.array([raw[4 * (e - c):4 * e] for e, c in zip(ends.tolist(),
                                                                       counts.tolist())],
                                pa.binary())})


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (little-endian unsigned 32-bit) of every document in the files."""
    ship_package(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row per write task, so no more rows than the job had partitions
    shards = (blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(
                  Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)).alias("shard_start")))
    return blocks.join(F.broadcast(shards), "shard").mapInArrow(
        _decode, "doc_id long, start long, n_tokens long, ids binary")
