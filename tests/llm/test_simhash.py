"""Fingerprints against a plain count of bits, links against all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorewell.llm.simhash import covering_masks, fingerprint, near_points, simhash_components, spanning_links

SF = "/root/testdata/sf0.001"


def plain_print(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(n, len(words))
    hashes = [xxhash.xxh64(b" ".join(words[i:i + k]), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    """Smallest place reachable, for each place."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i
    points = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(points[:i] ^ points[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def brute(rows):
    prints = [plain_print(t) for _, t in rows]
    place = groups(prints)
    low = {}
    for (d, _), p in zip(rows, place):
        if d is not None:
            low[p] = min(low.get(p, d), d)
    return sorted(str((d, f"{x:016x}", low.get(p))) for (d, _), x, p in zip(rows, prints, place))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "y", 1) for d, t in rows],
                               "doc_id long, text string, fp string, mask int").repartition(3)
    return sorted(str(tuple(r)) for r in simhash_components(df, **kw).collect())


def test_edges(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(900)}" for _ in range(90_000))
    base = [f"x{i}" for i in range(400)]
    rows = [(3, None), (2, ""), (9, " \n\t"), (4, "a"), (5, "A"), (6, "a b"), (7, "A b C"), (7, "a b c"),
            (None, "a b c"), (None, "alone here it is"), (10, long), (11, long + " z"), (12, "a\x1cb ü"), (13, "a  b\vc")]
    rows += [(100 + i, " ".join(base[:i] + ["new"] + base[i + 1:])) for i in range(0, 400, 9)]
    want = brute(rows)
    assert len({x.rsplit(",", 1)[1] for x in want}) < len(rows) - 20
    assert run(spark, rows) == want


def test_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op13_over_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(str(tuple(r)) for r in QUERIES["op13_simhash"](spark, SF).collect()) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.sets(st.integers(0, 63), max_size=3), st.sets(st.integers(0, 63), max_size=56))
def test_masks_cover_every_close_pair(point, flips, fixed):
    start = sum(1 << i for i in fixed)
    other = point ^ sum(1 << i for i in flips - fixed)
    masks = covering_masks(start, 3)
    assert len(masks) == 15 and any(point & m == other & m for m in masks)
    assert all(m & start == start and m != start for m in masks)


def test_every_three_bits_are_left_out_by_some_mask():
    masks = covering_masks(0, 3)
    assert all(28 <= m.bit_count() <= 36 for m in masks)
    for bits in itertools.combinations(range(64), 3):
        assert any(not m & sum(1 << b for b in bits) for m in masks)


@pytest.mark.parametrize("limit", [8, 16, 1024])
def test_hot_buckets_are_dealt_again(spark, limit):
    """Points within few bits of each other, far more than a bucket may hold."""
    rng = random.Random(limit)
    points = {sum(1 << b for b in rng.sample(range(20), rng.randint(0, 5))) for _ in range(700)}
    points |= {rng.getrandbits(64) for _ in range(300)}
    points = sorted(points)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "fp long").repartition(4)
    links = [tuple(x % (1 << 64) for x in r) for r in near_points(df, 3, limit).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    place = {p: i for i, p in enumerate(points)}
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(place[a]), find(place[b])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(points))] == groups(points)


def test_links_of_a_bucket_span_it():
    points = np.array([0, 7, 63, 15 << 40, (15 << 40) + 1, 511], np.uint64)
    links = spanning_links(points, 3)
    assert len(links) == 4 and set(links) == {(0, 7), (7, 63), (63, 511), (15 << 40, (15 << 40) + 1)}


def test_bits_follow_the_plain_count():
    for t in ("a b c d", "x", None, "one two", "the same the same the same the same"):
        assert fingerprint(t) == plain_print(t)
    assert fingerprint("a B c") == xxhash.xxh64(b"a b c", seed=42).intdigest()


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h
    assert got % (1 << 64) == fingerprint("a b c")
