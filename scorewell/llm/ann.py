"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Index: a unit vector is turned by a random rotation that depends on a seed
and the dimension only, and each coordinate keeps its sign.  A row stores
the packed signs and one correction scalar, the inner product f of the unit
vector with its own code (signs / sqrt(d)).

Search: a rotated query is rounded to ``PLANES``-bit numbers, kept as bit
planes packed like the codes.  Its inner product with a code comes from the
packed bits alone: the ones of code AND plane, counted a word of 64 bits at a
time and weighted by the plane.  Divided by f it estimates the cosine; with
e = epsilon * sqrt((1 - f*f) / (f*f * (d - 1))) the true value lies within
estimate -+ (e + the most that the rounding can change) but with small
probability.  A
batch of codes is searched for a block of queries at once: the k-th largest
lower bound is what a vector must reach with its upper bound to be reranked
on the original vectors in double precision.  The k best of each task meet
in one aggregation per query.

Queries come in blocks of at most ``block`` vectors, so what is sent to the
tasks is bounded whatever the number of queries; each block is one pass over
the codes.  Every row is indexed; nothing is fitted.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as query or candidate; vectors of another
dimension than the query's are no candidates for it; a row is never its own
neighbour, equal vectors tie to the smaller id; repeated ids of one vector
count once; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm.common import two_columns
from scorewell.session import scratch_path, ship_package

#: Bits a rotated query's coordinates are rounded to.
PLANES = 8
INDEX_SCHEMA = "id long, dim int, vector array<double>, code binary, scale double"
FOUND_SCHEMA = "query_id long, id long, score double"


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random rotation, uniform over the orthogonal matrices."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.array(batch.column(batch.schema.get_field_index(name)).flatten(), np.float64).reshape(
        batch.num_rows, -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.asarray(batch.column(batch.schema.get_field_index("dim")))
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two: exact, with the largest component near one."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _encode(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    turns: dict[int, np.ndarray] = {}
    for whole in batches:
        for d, b in _by_dim(whole):
            turn = turns.setdefault(d, rotation(d, seed))
            turned = _unit(_scaled(_rows(b, "vector"))) @ turn
            code = _words(turned >= 0)
            scale = np.abs(turned).sum(axis=1) / np.sqrt(d)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array(scale, pa.float64())], names=["id", "dim", "vector", "code", "scale"])


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of zeros and ones packed into 64-bit words, filled up with zeros."""
    packed = np.packbits(bits, axis=-1)
    fill = [(0, 0)] * (packed.ndim - 1) + [(0, -packed.shape[-1] % 8)]
    return np.ascontiguousarray(np.pad(packed, fill)).view("<u8")


def usable(v: Column) -> Column:
    """True for a non-zero vector of finite components."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0)


def build_index(df: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding",
                seed: int = 7) -> DataFrame:
    """Write the index of all usable vectors to ``path`` and read it back."""
    ship_package(df.sparkSession)
    two = two_columns(df, id_col, vector_col, ("id", "vector"))
    rows = two.select(two.id.cast("long").alias("id"), two.vector.cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False)))
    rows = rows.select("id", F.size("vector").alias("dim"), "vector")
    rows.mapInArrow(lambda it: _encode(it, seed), INDEX_SCHEMA).write.parquet(path)
    return df.sparkSession.read.schema(INDEX_SCHEMA).parquet(path)


class _Block:
    """The queries of one dimension, and the k best candidates of a task so far."""

    def __init__(self, dim: int, ids: np.ndarray, vectors: np.ndarray, k: int, seed: int):
        self.dim, self.ids, self.vectors, self.k = dim, ids, _scaled(vectors), k
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        turned = _unit(self.vectors) @ rotation(dim, seed)
        # turned = low + step * whole numbers, but for a rest of step / 2 at most
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-12) / (2**PLANES - 1)
        whole = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * whole
        self.total, self.rest = rounded.sum(axis=1), np.abs(turned - rounded).sum(axis=1)
        self.planes = np.stack([_words(whole >> j & 1) for j in range(PLANES)], axis=1)
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]  # (-score, id), ascending

    def product(self, q: int, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Inner products of the rounded query with codes of signs, from packed bits."""
        inside = np.zeros(codes.shape[1], np.int64)
        for j, plane in enumerate(self.planes[q]):
            for mine, word in zip(codes, plane):
                inside += np.bitwise_count(mine & word).astype(np.int64) << j
        return 2 * (self.low[q] * ones + self.step[q] * inside) - self.total[q]

    def search(self, b: pa.RecordBatch, epsilon: float) -> None:
        d, k = self.dim, self.k
        row_ids = np.asarray(b.column(b.schema.get_field_index("id")))
        x = _scaled(_rows(b, "vector"))
        scale = np.asarray(b.column(b.schema.get_field_index("scale")))
        codes = np.frombuffer(b"".join(b.column(b.schema.get_field_index("code")).to_pylist()), "<u8")
        codes = np.ascontiguousarray(codes.reshape(len(row_ids), -1).T)  # one row a word
        ones = np.bitwise_count(codes).sum(axis=0, dtype=np.int64)
        own = np.sqrt((x * x).sum(axis=1))
        far = np.sqrt(d) * scale
        bound = 1e-5 + epsilon * np.sqrt(
            np.maximum(1 - scale * scale, 0) / (scale * scale * max(d - 1, 1)))
        different, group = np.unique(row_ids, return_inverse=True)
        for q in range(len(self.ids)):
            est, error = self.product(q, codes, ones) / far, bound + self.rest[q] / far
            other, best = row_ids != self.ids[q], self.best[q]
            low = np.where(other, est - error, -np.inf)
            if len(different) < len(row_ids):  # a repeated id is one candidate
                by_id = np.full(len(different), -np.inf)
                np.maximum.at(by_id, group, low)
                low = by_id
            need = np.partition(low, -k)[-k] if len(low) > k else -np.inf
            if len(best) == k:
                need = max(need, -best[-1][0] - 1e-9)
            keep = np.flatnonzero(other & (est + error >= need))
            # sums row by row: equal vectors get equal scores wherever they stand
            score = (x[keep] * self.vectors[q]).sum(axis=1) / (own[keep] * self.norms[q])
            if len(keep) > 4 * k:  # ties of the k-th stay in
                top = score >= np.partition(score, -k)[-k] if len(
                    different) == len(row_ids) else score >= -np.inf
                keep, score = keep[top], score[top]
            met: dict[int, float] = {}
            for s, i in sorted([*best, *zip((-score).tolist(), row_ids[keep].tolist())]):
                if len(met) == k:
                    break
                met.setdefault(i, s)
            self.best[q] = [(s, i) for i, s in met.items()]

    def rows(self) -> Iterator[tuple[int, int, float]]:
        for q, best in zip(self.ids.tolist(), self.best):
            yield from ((q, i, -s) for s, i in best)


def _search(batches: Iterator[pa.RecordBatch], queries, k: int, epsilon: float,
            seed: int) -> Iterator[pa.RecordBatch]:
    blocks = {d: _Block(d, *v, k, seed) for d, v in queries.value.items()}
    for whole in batches:
        for d, b in _by_dim(whole):
            if d in blocks:
                blocks[d].search(b, epsilon)
    rows = [r for block in blocks.values() for r in block.rows()]
    for lo in range(0, len(rows), 20_000):
        cols = list(zip(*rows[lo:lo + 20_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.float64())], names=["query_id", "id", "score"])


def _blocks(queries: DataFrame, block: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """At most ``block`` queries at a time, in id order, as (ids, vectors) by dimension."""
    last = None
    while True:
        part = queries if last is None else queries.where(F.col("id") > F.lit(last))
        rows = part.orderBy("id").limit(block).collect()  # bounded by `block`
        if not rows:
            return
        last, by = rows[-1].id, {}
        for r in rows:
            by.setdefault(r.dim, ([], []))
            by[r.dim][0].append(r.id)
            by[r.dim][1].append(r.vector)
        yield {d: (np.array(i), np.array(v, np.float64)) for d, (i, v) in by.items()}
        if len(rows) < block:
            return


def nearest(spark: SparkSession, index: DataFrame, is_query: Callable[[Column], Column], k: int = 5,
            epsilon: float = 3.0, block: int = 4096, seed: int = 7) -> DataFrame:
    """query_id, rank (from 1), id, score: the ``k`` nearest rows of the index
    for each indexed vector whose id passes ``is_query``.

    ``epsilon`` widens the error bounds: larger reranks more and misses less.
    """
    ship_package(spark)
    asked = index.where(is_query(F.col("id"))).groupBy("id").agg(
        F.min(F.struct("dim", "vector")).alias("v")).select("id", "v.dim", "v.vector")
    parts = []
    for by in _blocks(asked, block):
        sent = spark.sparkContext.broadcast(by)
        found = index.mapInArrow(lambda it, s=sent: _search(it, s, k, epsilon, seed),
                                 FOUND_SCHEMA)
        parts.append(_top(found, k))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    path = scratch_path(spark, "nearest")
    for part in parts:  # one pass of the codes each; blocks share no query
        part.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best per query of what the batches found (k rows a batch at most)."""
    best = F.slice(F.sort_array(F.collect_set(F.struct(
        (-F.col("score")).alias("far"), F.col("id")))), 1, k)
    return (found.groupBy("query_id").agg(best.alias("b"))
            .select("query_id", F.posexplode("b").alias("p", "x"))
            .select("query_id", (F.col("p") + 1).alias("rank"), "x.id", (-F.col("x.far")).alias("score")))
