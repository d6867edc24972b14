"""Divergence of sources against a plain count over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scorewell.llm.divergence import shares, source_divergence

SF = "/root/testdata/sf0.001"


def brute(rows, least, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for w, n in docs[lang].items() if n >= least]
        mine = [g for g in groups if g[0] == lang]

        def share(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10 ** 9 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}
        q = share(sum((counts[g] for g in mine), Counter()))
        p = {g: share(counts[g]) for g in mine}
        for g in mine:
            far = [(-sum(abs(p[g][w] - p[h][w]) for w in kept), h[1].encode()) for h in mine if h != g]
            fav = [(q[w] - p[g][w], w.encode()) for w in kept if counts[g][w] and p[g][w] > q[w]]
            for part, found in (("pair", sorted(far)), ("term", sorted(fav)[:top])):
                out += [(*g, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "lang string, source string, text string, term string, n int").repartition(3)
    return sorted(map(tuple, source_divergence(df, **kw).collect()))


def corpus(seed, docs, sources, langs=("en", "de", None, "")):
    rng = random.Random(seed)
    vocab = [rng.choice("abcäßñ中") + str(i) + rng.choice("xyzÉ") for i in range(12)] + ["Word", "wORD", "zürich", "a"]
    return [(rng.choice(langs), rng.choice([None, *[f"s{min(rng.randrange(s), sources)}" for s in (3, 2 * sources)]]),
             " ".join(rng.choices(vocab, k=rng.randint(0, 30)))) for _ in range(docs)]


@pytest.mark.parametrize("kw", [{}, {"group_block": 2, "term_block": 3}, {"group_block": 1, "term_block": 1}])
def test_cells_of_any_size(spark, kw):
    rows = corpus(3, 160, 9)
    want = brute(rows, 8, 4)
    assert len(want) > 150 and {x[2] for x in want} == {"pair", "term"}
    assert run(spark, rows, min_docs=8, top=4, **kw) == want


def test_edges(spark):
    rows = [("en", "a", "same text here"), ("en", "b", "same text here"), ("en", None, None), ("en", "", ""),
            ("en", "c", "1 2 3 _-_ [] \x7f"), ("fr", "a", "alone"), (None, None, "x"), ("", "z", "X x\x00x"),
            ("en", "É", "Same " * 40_000 + "other"), ("en", "e", "same"), ("en", "É", "same"), ("en", "d", "SAME same")]
    assert run(spark, rows, min_docs=2) == brute(rows, 2)
    assert run(spark, rows, min_docs=1) == brute(rows, 1)
    none = run(spark, rows, min_docs=99)
    assert none == brute(rows, 99) and {x[4] for x in none} == {0}


def test_empty_table(spark):
    assert run(spark, [], min_docs=1) == []


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(2000):
        total = rng.randint(1, rng.choice([50, 10 ** 6, 9 * 10 ** 15]))
        n = rng.randint(0, total)
        assert shares(np.array([n]), np.array([total]))[0] == 1 + 10 ** 9 * (n + 5) // total
    with pytest.raises(OverflowError):
        shares(np.array([1]), np.array([10 ** 16]))


def test_op11_over_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").collect()]
    got = QUERIES["op11_divergence"](spark, SF)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute(rows, 30)
