"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from scorewell.llm import collocations as c
from scorewell.llm.collocations import collocations

SF = "/root/testdata/sf0.001"


def brute(rows, least=100, top=2000, longest=5):
    out, f, n = [], defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i:i + k]] = max(held[p[i:i + k]], a)
        scored = []
        for p, a in cand.items():
            if p in held and held[p] >= a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -score)
                for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def corpus(seed, rows):
    rng = random.Random(seed)
    vocab = ["The", "of", "é", "a", "x-y", *[f"w{i}" for i in range(40)]]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    fixed = [rng.choices(vocab, k=rng.randint(2, 9)) for _ in range(12)]
    out = []
    for _ in range(rows):
        text = []
        for _ in range(rng.randint(0, 12)):
            text += rng.choice(fixed) if rng.random() < .5 else rng.choices(vocab, weights, k=rng.randint(1, 6))
            text.append(rng.choice(["", "", "", ".", ",", "\t", "\n", "!", " ; "]))
        out.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), " ".join(text)))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "lang string, text string, phrase string, n int").repartition(3)
    return sorted(map(tuple, collocations(df, **kw).collect()))


@pytest.mark.parametrize("kw", [{}, {"top": 15, "batch": 3}, {"top": 6, "batch": 1}, {"longest": 3}])
def test_rounds_of_any_size(spark, kw):
    rows = corpus(4, 500)
    want = brute(rows, 20, **{k: v for k, v in kw.items() if k != "batch"})
    assert len(want) >= 24 and len({w[0] for w in want}) == 4
    assert run(spark, rows, least=20, **kw) == want


def test_a_settled_language_is_not_expanded_further(spark, monkeypatch):
    """Rare words that always meet score above the bound of all frequent ones."""
    rows = [("en", f"rare{i} pair{i}")  for i in range(8) for _ in range(3)]
    rows += [("en", f"many{i} words{i} here") for i in range(30) for _ in range(60)]
    seen, plain = [], c._round
    monkeypatch.setattr(c, "_round", lambda *a: seen.append(a[2].count()) or plain(*a))
    assert run(spark, rows, least=3, top=8, batch=8) == brute(rows, 3, 8)
    assert seen == [16]
    seen.clear()  # with ninth places to fill it goes on
    assert run(spark, rows, least=3, top=9, batch=8) == brute(rows, 3, 9)
    assert len(seen) > 1


def test_ties_with_the_bound_are_settled(spark):
    """The last place has exactly the score that bounds the waiting words."""
    rows = [("en", "a b")] * 4 + [("en", "c d")] * 4 + [("en", "0 1")] * 4 + [("en", "e f g")] * 6
    for top in (1, 2, 3, 4):
        for batch in (1, 4):
            assert run(spark, rows, least=2, top=top, batch=batch) == brute(rows, 2, top)


def test_edges(spark):
    rows = [(None, None), ("en", ""), ("en", " .,\t"), ("en", "solo"), ("fr", "x x x x x x x"), ("fr", "x x\x0bx x"),
            ("de", "A\u00a0b c " * 4), ("de", "long word " * 30_000), ("", "p q;p q:p q?p q"), ("", "p q")]
    for least in (1, 2, 4):
        assert run(spark, rows, least=least) == brute(rows, least)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_phrases_with_one_hash_are_told_apart(monkeypatch):
    chunk = c.Chunk("en", [b"", b"a", b"b", b"c"], [0, 1, 2, 0, 1, 3, 0, 1, 2, 0])
    got = c._phrases(chunk, np.array([1, 4, 7]), np.zeros(3, np.uint64), 2)
    assert sorted(zip(*(x.to_pylist() for x in got.columns[1:4]))) == [("a b", 2, 2), ("a c", 2, 1)]


def test_hashes_of_phrases_do_not_depend_on_the_text():
    chunk = c.Chunk("en", [b"", b"a", b"b"], [0, 2, 1, 2, 1, 0])
    *_, (h, whole) = chunk.hashes(3)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["b a b", "a b a"])], names=["lang", "phrase"])
    assert next(c._phrase_hashes([batch])).column("h").to_pylist() == h.view("<i8")[1:3].tolist()
    assert whole.tolist() == [False, True, True, False]


def test_op12_over_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    got = QUERIES["op12_collocations"](spark, SF)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_words_are_numbered_as_a_plain_split_does():
    rng = random.Random(2)
    for _ in range(300):
        texts = ["".join(rng.choice("aB\u00c9\x00\x1c \t\n.,;\r\x0b\x0c x\u4f60!?: ") for _ in range(rng.randint(0, 12)))
                 for _ in range(rng.randint(0, 4))]
        names, ids = c._numbers(texts)
        low = re.sub("[A-Z]", lambda m: m[0].lower(), "\n".join(texts))
        pieces = [re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", low)]
        want = [w.encode() for p in pieces if p for w in ["", *p]] + [b""]
        assert [names[i] for i in ids] == want and len(set(names)) == len(names)


def test_tasks_get_small_batches(spark):
    from pyspark.sql import functions as F

    from scorewell.session import small_batches
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    wide = spark.range(3000).coalesce(1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    with small_batches(spark):
        assert max(r.n for r in wide.mapInArrow(sizes, "n long").collect()) < 8 << 20
    assert spark.conf.get(key) == before
    big = pa.RecordBatch.from_arrays([pa.array(np.arange(3 * c.HANDED + 1))], names=["n"])
    assert [b.num_rows for b in c._handed(big)] == [c.HANDED] * 3 + [1]
