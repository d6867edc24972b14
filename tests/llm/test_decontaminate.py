"""Decontamination against a full edit table."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewell.llm.decontaminate import Benchmark, budget, find_benchmark, myers, normal, pieces

SF = "/root/testdata/sf0.001"


def table(pattern, text, whole=False):
    col, out = list(range(len(pattern) + 1)), []
    for j, c in enumerate(text):
        new = [j + 1 if whole else 0]
        for i, p in enumerate(pattern):
            new.append(min(col[i] + (p != c), col[i + 1] + 1, new[-1] + 1))
        col = new
        out.append(col[-1])
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=25), st.booleans())
def test_myers(pattern, text, whole):
    assert myers(pattern, text, whole) == table(pattern, text, whole)


def test_pieces_are_long_enough():
    for n in range(1, 200):
        k = budget(n, 16)
        parts = list(pieces("x" * n, k))
        assert len(parts) == k + 1 and sum(len(p) for _, p in parts) == n
        assert k == 0 or min(len(p) for _, p in parts) >= 16


def stands(item, text):
    """A short item of a script with blanks stands in a text as whole words."""
    return re.search(rf"(?<![^\W_]){re.escape(item)}(?![^\W_])" if item[0].isalnum() and item[-1].isalnum()
                     else re.escape(item), text)


def brute(docs, items, piece=16, short=24):
    out = set()
    for d, t in docs:
        for i, item in items:
            item = normal(item)
            if t and 0 < len(item) < short:
                if stands(item, normal(t)):
                    out.add((d, i, 0))
            elif t and item:
                best = min(table(item, normal(t)), default=len(item))
                if best <= budget(len(item), piece):
                    out.add((d, i, best))
    return out


def test_edited_items(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 20)))) for i in range(12)]
    docs = []
    for d in range(60):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(text))
            text[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
        docs.append((d, " ".join(word() for _ in range(9)) + " \n" + "".join(text).upper() + "\t " + word()))
    docs += [(100, None), (101, ""), (102, items[3][1]), (102, items[3][1]), (None, items[2][1]),
             (103, ("pad " * 8000) + items[4][1] + " pad" * 8000)]
    items += [(50, None), (51, "short"), (52, items[3][1]), (52, items[3][1]), (53, " \n"),
              (54, items[5][1].split()[1][:3]), (55, " ".join(items[6][1].split()[:2])[:20])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    want = brute([x for x in docs if x[0] != 103], items)
    assert 20 < len(want) < 200
    for block in (1 << 20, 100):
        rows = find_benchmark(df, bench, block_chars=block).collect()
        got = {(r.doc_id, r.item_id, r.distance) for r in rows}
        assert {x for x in got if x[0] != 103} == want and (103, 4, 0) in got
        twice = [x for x in got if x[0] == 102]  # the row that is there two times
        assert {(102, 3, 0), (102, 52, 0)} <= set(twice) and len(rows) == len(got) + len(twice)
    texts = dict(docs)
    for r in rows:
        item = normal(dict(items)[r.item_id])
        assert table(item, normal(texts[r.doc_id][r.span_start:r.span_end]), True)[-1] == r.distance


def test_short_items_stand_whole(spark):
    docs = [(1, "So WHAT  is\n2+2?"), (2, "(what is 2+2?)"), (3, "somewhat is 2+2?"), (4, "what is 2+2"), (5, "ab cab abc"),
            (6, "x ab, y ab"), (7, "天空是什么颜色的呢"), (8, "ab"), (9, "ünab abü"), (10, None), (11, "")]
    items = [(1, "What is 2+2?"), (2, "ab"), (3, "什么颜色"), (4, ""), (5, None), (6, "  \t"), (7, "ab")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 3):
        rows = find_benchmark(df, bench, block_chars=block).collect()
        assert sorted((r.doc_id, r.item_id) for r in rows) == [
            (1, 1), (2, 1), (5, 2), (5, 7), (6, 2), (6, 7), (7, 3), (8, 2), (8, 7)]
        assert {r.distance for r in rows} == {0}
        span = {(r.doc_id, r.item_id): dict(docs)[r.doc_id][r.span_start:r.span_end] for r in rows}
        assert span[1, 1] == "WHAT  is\n2+2?" and span[7, 3] == "什么颜色" and span[6, 2] == "ab"
    assert find_benchmark(df, bench, piece=2, short=24).count() == 9  # small pieces leave short items whole


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a long enough item of the benchmark")], "item_id long, text string")
    assert find_benchmark(df, bench.limit(0)).count() == 0
    assert find_benchmark(df.limit(0), bench).count() == 0


def test_op3_over_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    rows = QUERIES["op3_decontaminate"](spark, SF).collect()
    docs = [(r.doc_id, normal(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, normal(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {(d, i) for d, t in docs for i, x in items if x in t}
    assert exact and exact == {(r.doc_id, r.item_id) for r in rows if r.distance == 0}


def test_empty_block():
    assert list(Benchmark([], 16).matches("text")) == []
    with pytest.raises(StopIteration):
        next(Benchmark([(1, "some item")], 16).matches(""))
