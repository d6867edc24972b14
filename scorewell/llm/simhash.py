"""SimHash near-duplicates: fingerprints linked by covering locality-sensitive hashing.

Words have A-Z lower-cased; the shingles of a text are its windows of
``n`` words, repeats included (fewer words than n: the whole sequence).  A
fingerprint bit is 1 when it is set in over half of the shingles' XXH64
hashes (seed 42).  Two fingerprints link at ``radius`` or fewer differing bits.

1. Rows with one fingerprint are one point from here on; a partial
   aggregation folds them before any shuffle.
2. Covering masks: every bit position i gets a vector m(i) of radius + 1 bits.
   For each non-zero v the mask of v keeps the positions with odd
   ``m(i) & v``.  At most ``radius`` differing positions cannot rule out every
   v, so each pair within the radius agrees on all kept bits of some mask:
   no link is lost, whatever the vectors are.  They are dealt out evenly,
   so a mask of a free word keeps about half its bits.
3. A table's bucket holds the points that agree on a mask.  Buckets are
   counted first.  One of at most ``limit`` points is searched by XOR and bit
   counts; it gives links that span it, not its pairs.  A larger one is
   dealt again, by covering masks over the bits its mask leaves free; as
   each step fixes more bits and k free bits have 2^k points at most, this
   ends without a cap on buckets.
4. Connected components of the links give each row its component id.

Edge cases: null, empty and wordless texts have fingerprint zero and are
linked like any other; a null id is no one's smallest (a component of null
ids only has a null component id); rows with one id stay separate rows; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import byte_words, two_columns
from scorewell.llm.graph import components
from scorewell.session import scratch_path, ship_package

BITS = 64
SEED = 42
#: Shingles hashed at a time.
BLOCK = 1 << 16


def fingerprint(text: str | None, n: int = 3) -> int:
    """SimHash of a text as an unsigned 64-bit number."""
    words = byte_words(text)
    if not words:
        return 0
    k = min(n, len(words))
    hashes = map(_hash, map(b" ".join, zip(*(islice(words, i, None) for i in range(k)))))
    counts, total = np.zeros(BITS, np.int64), len(words) - k + 1
    for lo in range(0, total, BLOCK):
        h = np.fromiter(islice(hashes, BLOCK), "<u8", min(BLOCK, total - lo))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _hash(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, SEED)


def _fingerprints(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = np.fromiter((fingerprint(t.as_py(), n) for t in b.column("text")), "<u8", b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints.view("<i8"))], names=["doc_id", "fp"])


@lru_cache(1 << 12)
def covering_masks(fixed: int, radius: int) -> tuple[int, ...]:
    """Masks that keep the bits of ``fixed`` and cover all others: any
    ``radius`` positions outside ``fixed`` are left out by one of them.

    The unit vectors are dealt out first, so where more than ``radius`` bits
    are free each mask keeps at least one bit more than ``fixed``.
    """
    size = radius + 1
    units = [1 << i for i in range(size)]
    vectors = units + [v for v in range(1, 1 << size) if v not in units]
    free = [i for i in range(BITS) if not fixed >> i & 1]
    random.Random(fixed).shuffle(free)
    owner = {bit: vectors[at % len(vectors)] for at, bit in enumerate(free)}
    return tuple(fixed | sum(1 << bit for bit, m in owner.items() if (m & v).bit_count() % 2)
                 for v in range(1, 1 << size))


def _deal(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """(mask, value, fp): each point of a bucket in the finer buckets of the covering masks."""
    for b in batches:
        fixed, points = (c.to_numpy(zero_copy_only=False).view("<u8") for c in b.columns)
        for mask in np.unique(fixed):
            own = points[fixed == mask]
            for finer in covering_masks(int(mask), radius):
                finer = np.uint64(finer)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view("<i8")) for x in (np.full(len(own), finer), own & finer, own)],
                    names=["mask", "value", "fp"])


def spanning_links(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between points at ``radius`` or fewer differing bits that join all such pairs."""
    left, out = points, []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                out += [(int(at), int(x)) for x in left[near]]
                reached += list(left[near])
                left = left[~near]
    return out


def _span(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        links = [x for points in b.column("points") for x in spanning_links(
            points.values.to_numpy(zero_copy_only=False).view("<u8"), radius)]
        u, v = (np.array([x[i] for x in links], "<u8").view("<i8") for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def near_points(points: DataFrame, radius: int = 3, limit: int = 1024) -> DataFrame:
    """u, v: links that span each component of the distinct longs ``fp``."""
    if limit < 1 << radius:
        raise ValueError("a bucket of so few points may have no free bits to deal by")
    spark = points.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "simhash_links")
    rows, found, level = points.select(F.lit(0).cast("long").alias("mask"), "fp"), None, 0
    while True:
        dealt = rows.mapInArrow(lambda it: _deal(it, radius), "mask long, value long, fp long")
        (dealt.groupBy("mask", "value").agg(F.count_distinct("fp").alias("n") if level else F.count(F.lit(1)).alias("n"))
         .where("n > 1").write.parquet(f"{root}/sizes{level}"))
        sizes = spark.read.parquet(f"{root}/sizes{level}")
        small = dealt.join(sizes.where(F.col("n") <= limit), ["mask", "value"])
        links = (small.groupBy("mask", "value").agg(F.collect_set("fp").alias("points")).select("points")
                 .mapInArrow(lambda it: _span(it, radius), "u long, v long"))
        found = links if found is None else found.unionByName(links)
        large = sizes.where(F.col("n") > limit)
        if large.isEmpty():
            return found
        rows = dealt.join(large, ["mask", "value"]).select("mask", "fp").distinct()
        rows.write.parquet(f"{root}/rows{level}")
        rows, level = spark.read.parquet(f"{root}/rows{level}"), level + 1


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                       radius: int = 3, limit: int = 1024) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id (smallest
    id reachable by links) of every row."""
    spark = df.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "simhash")
    docs = two_columns(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    docs.mapInArrow(lambda it: _fingerprints(it, n), "doc_id long, fp long").write.parquet(f"{root}/prints")
    docs = spark.read.parquet(f"{root}/prints")
    docs.groupBy("fp").agg(F.min("doc_id").alias("least")).write.parquet(f"{root}/points")
    points = spark.read.parquet(f"{root}/points")
    linked = components(near_points(points.select("fp"), radius, limit)).withColumnRenamed("node", "fp")
    placed = points.join(linked, "fp").select("fp", "root", "least")
    whole = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = placed.join(whole, "root").select("fp", F.col("component_id"), F.lit(True).alias("moved"))
    named = points.join(moved, "fp", "left").select(
        "fp", F.when(F.col("moved"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    return docs.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
