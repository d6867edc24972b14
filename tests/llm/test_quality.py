"""The Kneser-Ney models against a plain one, and held-out accuracy."""

import math
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorewell.llm.quality import ORDER, _measure, _words, fit, judge_documents, keep_good

SF = "/root/testdata/sf0.1"


class Plain:
    """Interpolated modified Kneser-Ney with dictionaries."""

    def __init__(self, texts):
        words = Counter(w for t in texts for w in (t or "").encode().split())
        top = Counter()
        for w, k in words.items():
            s = "\x02" * (ORDER - 1) + w.decode() + "\x03"
            for i in range(ORDER - 1, len(s)):
                top[s[i - ORDER + 1:i + 1]] += k
        counts = [top]
        for _ in range(ORDER - 1):
            counts.insert(0, Counter(g[1:] for g in counts[0]))
        self.tables = []
        for c in counts:
            n = [max(sum(v == i for v in c.values()), 1) for i in range(1, 5)]
            y = n[0] / (n[0] + 2 * n[1])
            d = [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], .1 * k), .95 * k) for k in (1, 2, 3)]
            total, freed = Counter(), Counter()
            for g, v in c.items():
                total[g[:-1]] += v
                freed[g[:-1]] += d[min(v, 3)]
            self.tables.append((c, d, total, freed))
        self.uniform = 1 / (len(counts[0]) + 1)

    def log_prob(self, w):
        s, out = "\x02" * (ORDER - 1) + w + "\x03", 0
        for i in range(ORDER - 1, len(s)):
            p = self.uniform
            for n, (c, d, total, freed) in enumerate(self.tables, 1):
                g = s[i - n + 1:i + 1]
                if total[g[:-1]]:
                    v = c[g]
                    p = ((v - d[min(v, 3)]) + freed[g[:-1]] * p) / total[g[:-1]]
            out += math.log(p)
        return out


def test_model_equals_the_plain_one(spark):
    texts = ["the cat sat on the mat", "the cats  at the\tend", None, "", "Ünï cödé é", "a a a b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain, words = Plain(texts), ["the", "cat", "zzz", "a", "thé", "é", "mats", "\U0001f600", "x" * 300]
    for shards in (1, 5):
        got = fit(df, shards).log_prob(words)
        assert got == pytest.approx([plain.log_prob(w) for w in words], rel=1e-9)
    total = sum(math.exp(x) for x in fit(df).log_prob(["th"]))
    assert 0 < total < 1


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    half = labels.where("doc_id % 2 = 0")  # fitted and thresholded on one half only
    judged = judge_documents(docs, half).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    share = lambda q, t: [r.rejected for r in judged if (r.quality, r.toxic) == (q, t)]
    toxic, low, clean = share(1, 1), share(0, 0), share(1, 0)
    assert len(toxic) > 150 and sum(toxic) >= 0.6 * len(toxic)  # 200 toxic ones are fitted here
    assert len(low) > 200 and sum(low) >= 0.7 * len(low)
    assert len(clean) > 1500 and sum(clean) <= 0.01 * len(clean)


def test_keep_good_and_edges(spark):
    base = "the quick brown fox jumps over the lazy dog and runs home again"
    rows = [(i, base, "en") for i in range(36)] + [(40, "VILE vilest the dog", "en"), (41, "vile fox", "de")]
    rows += [(50, None, "en"), (51, "", None), (52, " \n", "en"), (53, "#### @@@@ $$$$ %%%%", "en"),
             (54, "the vile dog", None), (54, base, None), (None, base, "xx"), (56, (base + " ") * 2000, "en")]
    df = spark.createDataFrame([(*r, 1, "r") for r in rows],
                               "doc_id long, text string, lang string, contrast int, `row` string")
    marks = [(i, 1, 0) for i in range(36)] + [(40, 1, 1), (41, 1, 1), (52, 1, 0), (99, 1, 0), (None, 0, 1),
                                              (53, 0, 0), (29, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = keep_good(df, labels)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    got = kept.collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got)
    gone = [r for r in rows if (r[0] is None, r[0] or 0, r[1] or "") not in ids]
    assert {r[0] for r in gone} == {40, 41, 53, 54} and [r[1] for r in gone if r[0] == 54] == ["the vile dog"]
    assert all(r["row"] == "r" and r.contrast == 1 for r in got)
    assert keep_good(df, labels.limit(0)).count() == df.count()
    assert keep_good(df.limit(0), labels).count() == 0
    judged = judge_documents(df, labels.where("toxic = 0")).collect()
    assert all(r.contrast is None for r in judged)


def test_op5_covers_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    small = "/root/testdata/sf0.001"
    got = QUERIES["op5_quality"](spark, small)
    assert got.count() == spark.read.parquet(f"{small}/documents.parquet").count()
    assert got.where(F.col("perplexity").isNull()).count() == 0


def test_words_of_arrow_are_those_of_bytes_split():
    texts = [" a\tb\x0b\x0c c \r\n", "", None, "\x1c x\x85y \xa0", "one", "  ", "a a"]
    ends, at, words = _words(pa.array(texts))
    got = [[words[i] for i in at[lo:hi]] for lo, hi in zip(ends, ends[1:])]
    assert got == [[w.decode() for w in (t or "").encode().split()] for t in texts]
    ends, at, words = _words(pa.array([], pa.string()))
    assert list(ends) == [0] and not len(at) and not words


def test_a_worker_holds_a_word_once(spark):
    class Sent:
        value = (fit(spark.createDataFrame([("some words",)], "text string")), None)
    b = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["words unseen " * 400_000])], names=["doc_id", "text"])
    tracemalloc.start()
    out = list(_measure(iter([b]), Sent, 1, [0]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[0].num_rows == 1 and peak < 60e6


def test_the_text_goes_to_the_tasks_once(spark):
    df = spark.createDataFrame([(i, "en", f"good text {i}", True) for i in range(60)],
                               "doc_id long, lang string, text string, other boolean")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    got = keep_good(df, labels)
    assert got.columns == df.columns and got.count() <= 60
    assert "struct(" not in got._jdf.queryExecution().analyzed().toString()


def test_rows_are_measured_once(spark):
    """The result is read off the measures that are written; no task runs the models again."""
    rows = [(i, "some plain words of text" if i % 3 else "zq xv qj", "en") for i in range(60)]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(60)],
                                   "doc_id long, quality int, toxic int")
    kept = keep_good(df, labels)
    assert kept.columns == df.columns
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()
    gone = {r.doc_id for r in judge_documents(df, labels).where("rejected").collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows + rows[:5] if r[0] not in gone)
