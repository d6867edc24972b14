"""The grouped prefix join against all pairs."""

import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewell.llm.graph import components
from scorewell.llm.ngram_join import ngram_components, shingle_set, span

SF = "/root/testdata/sf0.001"


def shingles(text, n):
    words = (text or "").encode().lower().split()
    k = min(n, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if k else frozenset()


def brute(rows, n=3, up=9, down=10):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) * down >= len(a | b) * up:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(str((d, len(sets[i]), low.get(find(i)))) for i, (d, _) in enumerate(rows))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, "y") for d, t in rows],
                               "doc_id long, text string, n int, `class` string").repartition(4)
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in ngram_components(df, **kw).collect())


def corpus(seed, docs, words, edits):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([2, 5, 40, 80, 150]))] for _ in range(6)]
    rows = []
    for d in range(docs):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(text))
            text[at:at + 1] = rng.choice([[], [rng.choice(vocab)], [rng.choice(vocab), text[at]]])
        rows.append((d, " ".join(text).upper() if d % 3 else "\n ".join(text)))
    return rows


@pytest.mark.parametrize("kw,args", [({}, (3, 9, 10)), ({"n": 5, "threshold": 0.8}, (5, 4, 5)),
                                     ({"block": 3}, (3, 9, 10)), ({"unit_shingles": 60}, (3, 9, 10))])
def test_near_copies(spark, kw, args):
    rows = corpus(1, 130, 400, 3)
    assert run(spark, rows, **kw) == brute(rows, *args)


def test_edges(spark):
    long = " ".join(f"x{i % 7000}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b c"), (8, "a b c"),
            (8, "a b c"), (9, "other text under one id here"), (9, "a b c"), (None, "a b c"),
            (None, "null id only"), (10, long), (11, long + " z"), (12, "a\x1cb c"), (13, "a  b\vc")]
    assert run(spark, rows) == brute(rows)


def test_many_rows_of_one_id(spark):
    """A row's text is read for its own class only, however many rows share its id, null included."""
    rows = [(None if i % 2 else 7, f"t{i // 4} " + " ".join(f"w{(i // 4 * 31 + j) % 997}" for j in range(40)))
            for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_components(df).select("doc_id", "n_shingles", "component_id").collect()
    same = lambda a, b: sorted(map(str, a)) == sorted(map(str, b))
    assert same(map(tuple, got), brute(rows))
    own = ngram_components(df.selectExpr("*", "monotonically_increasing_id() as k"), row_col="k")
    assert same(map(tuple, own.select("doc_id", "n_shingles", "component_id").collect()), brute(rows))


def test_empty_table(spark):
    assert ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op1_over_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id))
                 for r in QUERIES["op1_ngram_join"](spark, SF).collect())
    assert got == brute(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=24), min_size=1, max_size=14),
       st.sampled_from([(1, 2), (4, 5), (9, 10), (1, 1)]))
def test_span_joins_what_links_join(sets, t):
    rows = [np.array(sorted(s), np.int64) for s in sets]
    root = list(range(len(sets)))

    def join(pairs):
        r = list(range(len(sets)))
        for a, b in pairs:
            x, y = r[a], r[b]
            r = [x if z == y else z for z in r]
        return {frozenset(i for i in root if r[i] == x) for x in r}
    links = [(i, j) for i in root for j in range(i)
             if len(sets[i] & sets[j]) * t[1] >= len(sets[i] | sets[j]) * t[0]]
    found = list(span(root, rows, Fraction(*t)))
    assert join(found) == join(links)
    assert {tuple(sorted(x)) for x in found} <= {tuple(sorted(x)) for x in links}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(5, 5)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    rows = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert rows == {
        i: find(i) for i in root if any(i in e and e[0] != e[1] for e in edges)}


def test_shingles_are_hashes_of_distinct_windows():
    for n in (1, 3, 5):
        for text in ("a b a b a b", "x", "", None, "one two three four five six"):
            assert len(shingle_set(text, n)) == len(shingles(text, n))
