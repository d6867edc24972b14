"""Nearest neighbours against brute force, with recall."""

import numpy as np
import pytest

from scorewell.llm.ann import _Block, _words, build_index, nearest, rotation
from scorewell.session import scratch_path

SF = "/root/testdata/sf0.01"


def brute(rows, is_query, k):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = np.array(v, np.float64)
    out = {}
    for q, v in good.items():
        if is_query(q):
            near = sorted((-float((w * v).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum()))), i)
                          for i, w in good.items() if i != q and len(w) == len(v))
            out[q] = near[:k]
    return out


def run(spark, df, mod, k=5, **kw):
    index = build_index(df, scratch_path(spark, "i"))
    out = {}
    for r in sorted(nearest(spark, index, lambda i: i % mod == 0, k, **kw).collect()):
        out.setdefault(r.query_id, []).append((-r.score, r.id))
        assert r.rank == len(out[r.query_id])
    return out


def test_rotation_is_orthogonal():
    r = rotation(17)
    assert np.allclose(r @ r.T, np.eye(17))


def test_products_from_packed_bits():
    """Equal to the product of the rounded query with the signs, and near that of the query itself."""
    rng = np.random.default_rng(5)
    for d in (1, 7, 64, 100, 130):
        ids, queries, signs = np.arange(4), rng.standard_normal((4, d)), rng.integers(0, 2, (50, d))
        block = _Block(d, ids, queries, 5, 7)
        codes = np.ascontiguousarray(_words(signs).T)
        turned = queries / np.linalg.norm(queries, axis=1, keepdims=True) @ rotation(d)
        for q in range(4):
            got = block.product(q, codes, signs.sum(axis=1))
            exact = (signs * 2 - 1) @ turned[q]
            assert np.all(np.abs(got - exact) <= block.rest[q] + 1e-9)
            assert block.rest[q] <= d * block.step[q] / 2 + 1e-9


def test_recall_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 50 == 0, 5)
    got = run(spark, df, 50)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.99
    blocks = run(spark, df, 50, block=3)
    assert blocks == got


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1e-200, 1e-200]), (3, None), (4, [0.0, 0.0]),
            (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]),
            (9, [1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (12, [-1.0, 0.5]), (13, []),
            (14, [3.0, 0.0]), (15, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, id int, score string")
    got = run(spark, df, 4, k=3)
    assert [i for _, i in got[0]] == [1, 8, 14]
    assert [i for _, i in got[8]] == [0, 1, 14]
    assert [i for _, i in got[12]] == [2, 0, 1] and np.isclose(got[12][0][0], 0.5 / np.sqrt(2.5))
    assert got.keys() == {0, 8, 12}
    assert run(spark, df.limit(0), 4) == {}


@pytest.mark.parametrize("d,n", [(1, 9), (3, 200), (100, 300)])
def test_random(spark, d, n):
    rng = np.random.default_rng(d)
    rows = [(i, rng.standard_normal(d).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(20)]  # ties with one vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want, got = brute(rows, lambda i: i % 10 == 0, 5), run(spark, df, 10)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
