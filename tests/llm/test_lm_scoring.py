"""Scores against a plain walk through the automaton of order three, word by word."""

import math
import zlib
from collections import Counter

import pytest

from scorewell.llm.lm_scoring import score_documents

SF = "/root/testdata/sf0.001"


def words(text):
    return [*(text or "").encode().lower().split(), None]


class Plain:
    """The automaton as dictionaries: states are tuples of words, followed one word at a time."""

    def __init__(self, train):
        self.documents, self.arcs = len(train), Counter()
        for t in train:
            line = ["start", *t]
            for i in range(1, len(line)):
                for n in (1, 2, 3):
                    if n == 1 or i - n + 1 >= 0:
                        self.arcs[tuple(line[i - n + 1:i + 1])] += 1
        kinds = [[c for g, c in self.arcs.items() if len(g) == n] for n in (1, 2, 3)]
        self.n, self.v = sum(kinds[0]), len(kinds[0])
        n1, n2 = kinds[0].count(1), kinds[0].count(2)
        self.d = (n1 + 1) / (n1 + 2 * n2 + 2)
        self.k = [None, *((kinds[n].count(1) + 1) / (len(kinds[n - 1]) + 1) for n in (1, 2))]

    def seen(self, state):
        return self.documents if state == ("start",) else self.arcs[state]

    def weight(self, state, w):
        if not state:
            c = self.arcs[w,]
            return (c - self.d) / self.n if c else self.d * self.v / self.n
        c, k = self.seen(state), self.k[len(state)]
        return (self.arcs[*state, w] + k * self.weight(state[1:], w)) / (c + k)

    def read(self, state, w):
        """log10 weight of the failure arcs and the arc taken, and the next state."""
        total, now = 0.0, state
        while now and not self.arcs[*now, w]:
            k = self.k[len(now)]
            total, now = total + math.log10(k / (self.seen(now) + k)), now[1:]
        after = (*state[-1:], w)
        while after and not self.seen(after):
            after = after[1:]
        return total + math.log10(self.weight(now, w)), after


def brute(rows):
    out = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    plain = Plain([words(t) for i, t in rows if not out[i]])
    one, n, v = plain.arcs, plain.n, plain.v
    result = []
    for i, t in rows:
        score, state = 0.0, ("start",)
        for w in words(t) if n else []:
            weight, state = plain.read(state, w)
            score += weight
        base = sum(math.log10((one[w,] + 1) / (n + v + 1)) for w in words(t))
        result.append((i, out[i], len(words(t)), sum(one[w,] > 0 for w in words(t)), n, base, score))
    return result


def same(got, want):
    key = lambda r: str(r[:5]) + f"{r[5]:.6f}"
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows, brute(rows)


def test_op2_over_the_whole_table(spark, table):
    from scorewell.llm.queries import QUERIES
    got = QUERIES["op2_lm_score"](spark, SF).collect()
    same(got, table[1])
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_blocks_and_shards_change_nothing(spark, table):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    same(score_documents(df, block_rows=7, shard_chars=20_000).collect(), table[1])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b a B"), (3, "a b a B"), (4, "new words"), (None, "a c"),
            (6, "w " * 30000 + "z"), (7, "a b"), (8, "A\tb\nq"), (9, "é É")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, block int, score string")
    same(score_documents(df).collect(), brute(rows))
    only_out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = [(i, "a b") for i in only_out]
    same(score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute(rows))
    assert score_documents(df.limit(0)).count() == 0


def test_unseen_words_keep_a_share(spark):
    """No word occurs once: every score is finite, and all words together with one unseen have probability one."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2]
    out = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2)
    for copies in (2, 3, 5):
        rows = [(i, "aa bb cc") for i in ids[:copies]] + [(out, "zz new words")]
        got = {r.doc_id: r for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert all(math.isfinite(r.score) for r in got.values())
        same(got.values(), brute(rows))


def test_every_state_sums_to_one():
    plain = Plain([words(t) for t in ("a b a b c", "a b c a", "", "b b b", "a b a b c")])
    vocabulary = [g[0] for g in plain.arcs if len(g) == 1]
    states = {g for g in plain.arcs if len(g) < 3 and g[-1] is not None}
    for state in [(), ("start",), *states]:
        assert sum(plain.weight(state, w) for w in [*vocabulary, "never seen"]) == pytest.approx(1.0)


def test_rows_read_by_two_tasks_of_one_block(spark, tmp_path):
    """Blocks cut between tasks, and cut in other places when read again, give the same scores."""
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i % 30))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    df.write.option("parquet.block.size", 1024).parquet(str(tmp_path / "t"))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "1000")
        again = spark.read.parquet(str(tmp_path / "t"))
        scored = score_documents(again, block_rows=64)
        spark.conf.set(names[0], "1700")
        same(scored.collect(), brute(rows))
    finally:
        for n, x in zip(names, old):
            spark.conf.set(n, x)
