"""N-gram Jaccard join: documents linked by their word shingles, by groups.

Words have A-Z lower-cased; a document's set holds its distinct n-word
shingles as 64-bit hashes (fewer words than n: the whole sequence).  Two
documents link when the Jaccard similarity of their sets reaches t.

1. Documents with equal sets are one class.  A class whose set is so rich in
   shingles that no other class has that too few are left for any partner
   (fewer than ceil(t * size)) has no link and goes no further.  That is
   judged twice: over all documents by the shingles below a fixed hash value,
   which errs to keeping a class, then over the classes left by all shingles.
2. Grouped prefix join: with shingles ordered by rarity, two sets that link
   share one of their first size - ceil(t * size) + 1.  Classes with the same
   prefix (but for shingles of their own) and size are one group; groups of
   like sizes that share a prefix shingle are candidates.  Rarity comes from
   sharded counts: blocks of sets send their distinct shingles, cut by hash
   range, to shards and get the totals back.
3. Candidate groups are gathered into their connected components, and the
   members of a component meet in one task, each set once.  A large component
   is dealt into blocks and each pair of blocks meets in a task of its own,
   so no task holds more than two blocks.
4. Members are verified exactly: from a member with few shingles of its own,
   its intersections with all members not yet reached are counted at once;
   sizes and unique shingles rule out most of them before.  Links found that
   way span each component; every pair is either compared, ruled out by a
   bound, or already joined by links, so none is lost between components.
5. The links' components give each document its component id.

Edge cases: null, empty and word-free texts have empty sets and link with
nothing; a text of any length is taken whole; repeated rows each give a row;
rows with one doc_id and different texts are different documents that share
an id; a null id is ignored as smallest id unless there is no other; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import byte_words, free_name, numbered, place, with_row_key
from scorewell.llm.graph import components
from scorewell.session import scratch_path, ship_package

_U = np.uint64
#: Odd multipliers that tell the words of a shingle apart, and a finaliser.
_MIX, _FINAL = 0x9E3779B97F4A7C15, _U(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    """Word -> 64-bit hash, kept for words met before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Ascending distinct 63-bit hashes of the text's n-word shingles."""
    words = byte_words(text)
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), _U, len(words))
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, _U)
    for i in range(k):
        part = h[i:len(h) - k + 1 + i] + _U((2 * i + 1) * _MIX % 2**64)
        part ^= part >> _U(32)
        out = (out * _U(_MIX) + part) * _FINAL
        out ^= out >> _U(29)
    out *= _U(_MIX)
    out ^= out >> _U(32)
    return np.unique((out >> _U(1)).astype(np.int64))


def class_id(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - 2**63


def least(t: Fraction, n) -> int:
    """ceil(t * n): what a partner of a set of size n must share with it."""
    return -(-n * t.numerator // t.denominator)


def _least(t: Fraction, n: Column) -> Column:
    return ((n * t.numerator + (t.denominator - 1)) / t.denominator).cast("long")


def _sign(batches: Iterator[pa.RecordBatch], n: int, t: Fraction, limit: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, ids, low = [], [], []
        for text in b.column(1).to_pylist():
            s = shingle_set(text, n)
            sizes.append(len(s))
            ids.append(class_id(s) if len(s) else None)
            low.append(s[:np.searchsorted(s, limit)])
        offsets = np.cumsum([0, *map(len, low)])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                      pa.array(np.concatenate([*low, np.empty(0, np.int64)]), pa.int64())), b.column(2)],
            names=["doc_id", "n", "class", "low", "row"])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own, sizes, raw = [], [], []
        for c, text in zip(*(c.to_pylist() for c in b.columns)):
            s = shingle_set(text, n)
            own.append(c)
            sizes.append(len(s))
            raw.append(s.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()), pa.array(sizes, pa.int64()), pa.array(raw, pa.binary())],
            names=["class", "n", "shingles"])


def _tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, distinct shingles, places of all shingles among them, and counts."""
    sets = [np.frombuffer(x, np.int64) for x in raw]
    keys, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    return np.array([len(s) for s in sets]), keys, place, count


def _ask(table: pa.Table, shards: int) -> pa.Table:
    _, keys, _, count = _tokens(table.column("shingles").to_pylist())
    edges = np.array([(i << 63) // shards for i in range(shards)], np.int64)
    cut = [*np.searchsorted(keys, edges), len(keys)]
    rows = [(s, lo, hi) for s, (lo, hi) in enumerate(zip(cut, cut[1:])) if lo < hi]
    return pa.table({
        "shard": pa.array([s for s, _, _ in rows], pa.int64()),
        "block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int64()),
        "keys": pa.array([keys[lo:hi].tobytes() for _, lo, hi in rows], pa.binary()),
        "counts": pa.array([count[lo:hi].astype("<u4").tobytes() for _, lo, hi in rows], pa.binary())})


def _answer(table: pa.Table) -> pa.Table:
    keys = [np.frombuffer(x, "<i8") for x in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=counts).astype("<u4")
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({
        "block": table.column("block"), "shard": table.column("shard"),
        "totals": pa.array([total[place[e - len(k):e]].tobytes() for k, e in zip(keys, ends)], pa.binary())})


def _prefixes(sets: pa.Table, answers: pa.Table, t: Fraction) -> pa.Table:
    """Live classes with the shared shingles of their prefixes, rarest first."""
    sizes, keys, place, _ = _tokens(sets.column("shingles").to_pylist())
    df = np.concatenate([np.frombuffer(x, "<u4") for x in answers.sort_by("shard").column("totals").to_pylist()])
    own, size, prefix = [], [], []
    ends = np.cumsum(sizes)
    for c, n, e in zip(sets.column("class").to_pylist(), sizes.tolist(), ends.tolist()):
        mine = place[e - n:e]
        often = df[mine]
        alone = int((often == 1).sum())
        if n - alone >= least(t, n):
            first = mine[np.lexsort((mine, often))][alone:n - least(t, n) + 1]
            own.append(c)
            size.append(n)
            prefix.append(keys[first].tolist())
    return pa.table({"class": pa.array(own, pa.int64()), "n": pa.array(size, pa.int64()),
                     "prefix": pa.array(prefix, pa.list_(pa.int64()))})


def span(ids: list[int], sets: list[np.ndarray], t: Fraction) -> Iterator[tuple[int, int]]:
    """Links that join exactly the sets which links of Jaccard >= t join."""
    up, down = t.numerator, t.denominator
    n = np.array([len(s) for s in sets], np.int64)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    who = np.repeat(np.arange(len(sets)), n)
    rest = np.bincount(who[shared], minlength=len(sets))  # what others may share with it
    alive = np.flatnonzero(rest * down >= n * up)
    if len(alive) < 2:
        return
    alive = alive[np.argsort(n[alive] - rest[alive], kind="stable")]
    mine = [place[a:b][shared[a:b]] for a, b in zip(np.cumsum(n) - n, np.cumsum(n))]
    flag = np.zeros(len(count), bool)
    left = alive
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            a = queue.pop()
            need = -(-(n[a] + n[left]) * up // (up + down))  # least intersection
            able = (np.minimum(rest[a], rest[left]) >= need) & (
                np.minimum(n[a], n[left]) * down >= np.maximum(n[a], n[left]) * up)
            some = left[able]
            if len(some):
                flag[mine[a]] = True
                sizes = rest[some]
                both = np.add.reduceat(flag[np.concatenate([mine[i] for i in some])].astype(np.int64),
                                       np.cumsum(sizes) - sizes)
                flag[mine[a]] = False
                hit = both >= need[able]
                new = some[hit]
                if len(new):
                    yield from ((int(ids[a]), int(ids[i])) for i in new)
                    queue += new.tolist()
                    gone = np.zeros(len(n), bool)
                    gone[new] = True
                    left = left[~gone[left]]


def _verify(table: pa.Table, t: Fraction) -> pa.Table:
    parts: dict[str, dict[int, np.ndarray]] = {}
    for part, own, raw in zip(*(table.column(c).to_pylist() for c in ("part", "class", "shingles"))):
        parts.setdefault(part, {})[own] = np.frombuffer(raw, np.int64)
    links = [x for p in parts.values() for x in span(list(p), list(p.values()), t)]
    u, v = zip(*links) if links else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def ngram_components(df: DataFrame, n: int = 3, threshold: float = 0.9, id_col: str = "doc_id",
                     text_col: str = "text", block: int = 1024, unit_shingles: int = 1 << 20,
                     row_col: str | None = None) -> DataFrame:
    """doc_id, n_shingles, class_id (null for an empty set) and component_id
    (smallest doc_id reachable by links) of every row of ``df``.

    A task verifies at most two blocks of ``block`` classes, and about
    ``unit_shingles`` shingles if its sets allow; neither changes the result.
    ``row_col``: a number of its own for each row, the same in every scan;
    without it rows are told apart by file and place (``common.with_row_key``).
    """
    t = Fraction(str(threshold))
    if not 0 < t <= 1:
        raise ValueError("threshold must be in (0, 1]")
    spark = df.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "ngram_join")
    keyed = df if row_col else with_row_key(df, free_name("row", df.columns))
    row = place(df, row_col) if row_col else len(df.columns)
    docs = numbered(keyed).select(F.col(f"c{place(df, id_col)}").cast("long").alias("doc_id"),
                                  F.col(f"c{place(df, text_col)}").alias("text"),
                                  F.col(f"c{row}").cast("long").alias("row"))
    # enough shingles below the limit to see that a class is too much on its own
    limit = min(int(float(1 - t) * 1.4 * 2**63), 2**63 - 1)
    docs.mapInArrow(lambda it: _sign(it, n, t, limit),
                    "doc_id long, n long, class long, low array<long>, row long").write.parquet(f"{root}/signed")
    signed = spark.read.parquet(f"{root}/signed")
    full = signed.where("n > 0")
    tokens = full.select("class", F.explode("low").alias("token"))
    alone = (tokens.groupBy("token").agg(F.min("class").alias("a"), F.max("class").alias("b"))
             .where("a = b").groupBy(F.col("a").alias("class")).agg(F.count(F.lit(1)).alias("own")))
    # one row's text stands for a class, whatever its id
    classes = full.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                        F.min("row").alias("row"))
    live = (classes.join(alone, "class", "left").withColumn("own", F.coalesce("own", F.lit(0)))
            .where(F.col("n") - F.col("own") >= _least(t, F.col("n"))))
    texts = live.select("class", "row").join(docs.select("row", "text"), "row").select("class", "text")
    texts.mapInArrow(lambda it: _sets(it, n), "class long, n long, shingles binary").write.parquet(f"{root}/sets")
    sets = spark.read.parquet(f"{root}/sets")
    weight = sets.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-weight // unit_shingles))
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(shards)))
    (dealt.groupBy("block").applyInArrow(lambda tab: _ask(tab, shards),
                                         "shard long, block long, keys binary, counts binary")
     .groupBy("shard").applyInArrow(_answer, "block long, shard long, totals binary")
     .write.parquet(f"{root}/answers"))
    answers = spark.read.parquet(f"{root}/answers")
    (dealt.groupBy("block").cogroup(answers.groupBy("block"))
     .applyInArrow(lambda a, b: _prefixes(a, b, t), "class long, n long, prefix array<long>")
     .withColumn("grp", F.xxhash64("n", "prefix")).write.parquet(f"{root}/live"))
    live = spark.read.parquet(f"{root}/live")
    # sizes of a linked pair differ by a factor of t at most: the same step of sizes or the next
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(t) if t < 1 else 1e-9) + 1e-6)
    posts = live.select("grp", step.alias("step"), F.explode("prefix").alias("token")).distinct()
    posts = posts.select("grp", F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step"), "token")
    heads = (posts.groupBy("token", "step").agg(F.min("grp").alias("v"), F.max("grp").alias("w"))
             .where("v <> w"))
    near = components(posts.join(heads, ["token", "step"]).select(F.col("grp").alias("u"), "v"))
    member = (live.join(near.select(F.col("node").alias("grp"), "root"), "grp", "left")
              .withColumn("root", F.coalesce("root", "grp")).select("class", "n", "root"))
    size = member.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight"))
    size = size.where("members > 1").withColumn("blocks", F.greatest(
        F.ceil(F.col("members") / block), F.ceil(F.col("weight") / unit_shingles)).cast("int"))
    size.write.parquet(f"{root}/size")
    size = spark.read.parquet(f"{root}/size")
    units = max(1, -(-(size.agg(F.sum("weight")).first()[0] or 0) // unit_shingles))
    member = member.join(size, "root")
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    # one block: the component shares a task with others; more: one task for each pair of blocks
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    name = F.concat_ws("-", F.col("root"), F.least(own, F.col("o")), F.greatest(own, F.col("o")))
    placed = member.withColumn("o", F.explode(other)).select(
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(units))).otherwise(
            F.xxhash64(name)).alias("unit"), name.alias("part"), "class")
    links = (placed.join(sets.select("class", "shingles"), "class")
             .groupBy("unit").applyInArrow(lambda tab: _verify(tab, t), "u long, v long"))
    links.write.parquet(f"{root}/links")
    joined = components(spark.read.parquet(f"{root}/links"))
    placed = classes.join(joined.select(F.col("node").alias("class"), "root"), "class", "left").select(
        "class", "doc_id", F.coalesce("root", "class").alias("root"))
    firsts = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = placed.join(firsts, "root").select("class", "component_id")
    out = signed.select("doc_id", "n", "class").join(by_class, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("class").alias("class_id"))
