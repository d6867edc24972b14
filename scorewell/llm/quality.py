"""Quality classifier: perplexity under interpolated modified Kneser-Ney models.

Two models of the letters inside words (white space parts words; a start and
an end mark belong to each) are fitted with Spark aggregations: one on
trusted text (quality 1, toxic 0) and one on toxic text.  Fitting takes at
most ``fit_docs`` labelled documents of each kind, those with the smallest
hashes of their ids, with their whole texts; of the trusted ones only every
second (by hash), the others set the limits.  Everything else covers all
documents.

Counts of the highest order are of word occurrences, those of lower orders
of the different letters before; three discounts an order come from its
counts of counts.  The tables of probabilities and backoff weights are
bounded by the fitted documents.  They are cut into shards by hash and a
task joins the distinct n-grams of the words it has not met before to each
shard, by merging sorted keys.

A document has two measures: ``perplexity`` per letter under the trusted
model, and ``contrast``, the largest amount by which the toxic model's
log-probability of one of its words exceeds the trusted model's.  It is
rejected when one lies beyond the limit of its language: the ``quantile``
of the measure over all trusted documents of the language that the models
were not fitted on, moved away from their median by the share ``margin``.  A
language with fewer than ``min_docs`` of them takes the limits over all
languages.

Edge cases: null, empty and word-free texts have no measures and are kept;
without trusted documents (of each half) nothing is rejected, without toxic ones there is
no contrast; several labels of one id count as trusted only if all are;
labels of unknown ids and null labels have no effect; repeated rows are
judged alike; a null language is a language of its own; an empty table
gives no rows; all columns of the input pass ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import SPACE_CLASS, free_name, numbered, place, with_row_key
from scorewell.session import scratch_path, ship_package, small_batches

ORDER = 5
_U = np.uint64
_START, _END = "\x02", "\x03"
#: Odd multipliers for the letters of an n-gram, the last letter first.
_MULT = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 2**64) | 1 for i in range(8)], _U)
MEASURES = "log_perplexity double, contrast double"


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(_U) + _U(0x632BE59BD9B4E019)) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def gram_keys(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that end at the places ``at``."""
    out = np.full(len(at), n, _U)
    for j in range(n):
        out += codes[at - j] * _MULT[j]
    out ^= out >> _U(32)
    return out * _U(0x94D049BB133111EB)


class Shard:
    """One hash range of a model's tables: sorted keys with their values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def join(self, keys: np.ndarray, out: np.ndarray, found: np.ndarray) -> None:
        """Sorted ``keys`` that are here get their values."""
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.values[at[hit]]
            found |= hit


@dataclass
class Model:
    """Per order: shards of n-gram probabilities and of context backoff weights."""

    grams: list[list[Shard]]
    contexts: list[list[Shard]]
    uniform: float

    @staticmethod
    def look(shards: list[Shard], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, place = np.unique(keys, return_inverse=True)
        out, found = np.zeros(len(distinct)), np.zeros(len(distinct), bool)
        edges = [(i << 64) // len(shards) for i in range(1, len(shards))]
        cut = [0, *np.searchsorted(distinct, np.array(edges, _U)), len(distinct)]
        for shard, lo, hi in zip(shards, cut, cut[1:]):
            shard.join(distinct[lo:hi], out[lo:hi], found[lo:hi])
        return out[place], found[place]

    def log_prob(self, words: list[str]) -> np.ndarray:
        """Natural log-probability of each word, its end included."""
        marked = [_START * (ORDER - 1) + w + _END for w in words]
        codes = _mixed(np.frombuffer("".join(marked).encode("utf-32-le"), "<u4"))
        sizes = np.array([len(w) for w in words]) + 1  # letters that are predicted
        whole = sizes + ORDER - 1
        first = np.cumsum(whole) - whole + ORDER - 1
        offset = np.cumsum(sizes) - sizes
        at = np.repeat(first - offset, sizes) + np.arange(sizes.sum())
        p = np.full(len(at), self.uniform)
        for n in range(1, ORDER + 1):
            back, known = self.look(self.contexts[n - 1], gram_keys(codes, at - 1, n - 1))
            mine, _ = self.look(self.grams[n - 1], gram_keys(codes, at, n))
            p = np.where(known, mine + back * p, p)
        return np.add.reduceat(np.log(p), offset)


def _counts(texts: DataFrame, path: str) -> list[DataFrame]:
    """Per order: gram, v (Kneser-Ney counts), each written once."""
    spark = texts.sparkSession
    word = F.explode(F.split("text", SPACE_CLASS)).alias("w")
    words = texts.select(word).where(F.col("w") != "").groupBy("w").agg(F.count(F.lit(1)).alias("k"))
    marked = F.concat(F.lit(_START * (ORDER - 1)), "w", F.lit(_END))
    grams = F.transform(F.sequence(F.lit(1), F.length("w") + 1),
                        lambda i: F.substr(marked, i, F.lit(ORDER)))
    out = [words.select(F.explode(grams).alias("gram"), "k").groupBy("gram").agg(F.sum("k").alias("v"))]
    for n in range(ORDER, 0, -1):
        out[0].write.parquet(f"{path}/{n}")
        out[0] = spark.read.parquet(f"{path}/{n}")
        if n > 1:
            out.insert(0, out[0].groupBy(F.substr("gram", F.lit(2)).alias("gram")).agg(
                F.count(F.lit(1)).alias("v")))
    return out


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    found = {r.c: r.n for r in counts.where("v <= 4").groupBy(F.col("v").alias("c")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n = [max(found.get(i, 0), 1) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1 * k), 0.95 * k) for k in (1, 2, 3)]


def _strings_to_keys(grams: list[str], n: int) -> np.ndarray:
    if not grams or not n:
        return np.full(len(grams), gram_keys(np.zeros(1, _U), np.zeros(1, np.int64), 0)[0], _U)
    codes = _mixed(np.frombuffer("".join(grams).encode("utf-32-le"), "<u4"))
    return gram_keys(codes, np.arange(len(grams)) * n + n - 1, n)


def _shards(keys: np.ndarray, values: np.ndarray, shards: int) -> list[Shard]:
    edges = np.array([(i << 64) // shards for i in range(1, shards)], _U)
    own = np.searchsorted(edges, keys, side="right")
    return [Shard(keys[own == i], values[own == i]) for i in range(shards)]


def fit(texts: DataFrame, shards: int = 8) -> Model | None:
    """The model of a bounded table of texts; None if it holds no word."""
    counts = _counts(texts, scratch_path(texts.sparkSession, "kneser_ney"))
    grams, contexts, letters = [], [], 0
    for n, c in enumerate(counts, 1):
        d1, d2, d3 = _discounts(c)
        d = F.when(F.col("v") == 1, d1).when(F.col("v") == 2, d2).otherwise(d3)
        ctx = F.substr("gram", F.lit(1), F.lit(n - 1))
        by = c.groupBy(ctx.alias("ctx")).agg(F.sum("v").alias("t"), F.sum(d).alias("d"))
        prob = c.withColumn("ctx", ctx).join(by, "ctx").select("gram", ((F.col("v") - d) / F.col("t")).alias("p"))
        # bounded by the fitted documents
        g, b = prob.toPandas(), by.select("ctx", (F.col("d") / F.col("t")).alias("b")).toPandas()
        if n == 1:
            letters = len(g)
        grams.append(_shards(_strings_to_keys(g["gram"].tolist(), n), g["p"].to_numpy(float), shards))
        contexts.append(_shards(_strings_to_keys(b["ctx"].tolist(), n - 1), b["b"].to_numpy(float), shards))
    return Model(grams, contexts, 1 / (letters + 1)) if letters else None


class _Measurer:
    """Measures of texts; words met before keep theirs, up to ``keep`` of them.

    Arrow splits texts and numbers their distinct words, so Python holds one
    text of each word, not of each occurrence."""

    def __init__(self, models: tuple[Model, Model | None], keep: int = 400_000):
        self.models, self.keep = models, keep
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.good, self.contrast, self.size = np.zeros(0), np.zeros(0), np.zeros(0)

    def _learn(self, words: list[str]) -> None:
        good = self.models[0].log_prob(words)
        bad = self.models[1].log_prob(words) if self.models[1] else np.full(len(words), np.nan)
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.good = np.concatenate([self.good, good])
        self.contrast = np.concatenate([self.contrast, bad - good])
        self.size = np.concatenate([self.size, [len(w) + 1.0 for w in words]])

    def measure(self, texts: pa.Array) -> list[tuple]:
        ends, at, words = _words(texts)
        if len(self.place) > self.keep:
            self._clear()
        new = [w for w in words if w not in self.place]
        for lo in range(0, len(new), 20_000):
            self._learn(new[lo:lo + 20_000])
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))[at]
        out = []
        for lo, hi in zip(ends, ends[1:]):
            if lo == hi:
                out.append((None, None))
                continue
            one = at[lo:hi]
            top = float(self.contrast[one].max())
            out.append((float(-self.good[one].sum() / self.size[one].sum()), None if np.isnan(top) else top))
        return out


#: The worker's last models and their measurer, which later tasks find warm.
_WARM: list = []


def _measurer(models: tuple) -> _Measurer:
    if not _WARM or _WARM[0] is not models:
        _WARM[:] = [models, _Measurer(models)]
    return _WARM[1]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each text's words begin and the last one's end, the words as
    numbers, and what the numbers stand for; white space being ASCII white space."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = cut.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # white space at an end leaves an empty word
    ends = np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    return ends, coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _measure(batches: Iterator[pa.RecordBatch], models, text_at: int,
             keep: list[int]) -> Iterator[pa.RecordBatch]:
    measurer = _measurer(models.value)
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            cut = b.slice(lo, 1024)
            got = measurer.measure(cut.column(text_at))
            yield pa.RecordBatch.from_arrays(
                [*(cut.column(i) for i in keep), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=[*(b.schema.names[i] for i in keep), "log_perplexity", "contrast"])


@dataclass
class Classifier:
    """Fitted models (in the tasks' reach) and the table of limits by language."""

    models: object
    limits: DataFrame | None

    def measured(self, df: DataFrame, text_at: int, keep: list[int], schema: str) -> DataFrame:
        models = self.models
        return df.mapInArrow(lambda it: _measure(it, models, text_at, keep), f"{schema}, {MEASURES}")

    def judged(self, measured: DataFrame) -> DataFrame:
        """``measured`` (with a column lang) and rejected."""
        lim = self.limits
        own = lim.where("NOT pooled").select(F.col("lang").alias("own"), F.col("log_perplexity").alias("p"),
                                             F.col("contrast").alias("c"), F.lit(True).alias("has"))
        out = measured.join(own, measured["lang"].eqNullSafe(F.col("own")), "left")
        pooled = lim.where("pooled").first()  # one row
        p = F.when(F.col("has"), F.col("p")).otherwise(F.lit(pooled.log_perplexity).cast("double"))
        c = F.when(F.col("has"), F.col("c")).otherwise(F.lit(pooled.contrast).cast("double"))
        bad = F.coalesce(F.col("log_perplexity") > p, F.lit(False)) | F.coalesce(
            F.col("contrast") > c, F.lit(False))
        return out.withColumn("rejected", bad).drop("own", "p", "c", "has")


def _limits(measured: DataFrame, trusted: DataFrame, quantile: float, margin: float,
            min_docs: int) -> DataFrame:
    known = measured.join(trusted, measured["doc_id"] == trusted["id"], "left_semi")
    def limit(c: str):
        mid, top = (F.percentile_approx(c, F.lit(q), F.lit(100_000)) for q in (0.5, quantile))
        return (mid + (top - mid) * (1 + margin)).alias(c)
    per = known.groupBy("lang").agg(limit("log_perplexity"), limit("contrast"), F.lit(False).alias("pooled"),
                                    F.count("log_perplexity").alias("n")).where(F.col("n") >= min_docs).drop("n")
    every = known.agg(limit("log_perplexity"), limit("contrast")).select(
        F.lit(None).cast("string").alias("lang"), "log_perplexity", "contrast", F.lit(True).alias("pooled"))
    return per.unionByName(every)


def fit_classifier(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", label_id: str = "doc_id", quality_col: str = "quality",
                   toxic_col: str = "toxic", fit_docs: int = 4000, quantile: float = 0.999,
                   margin: float = 0.25, min_docs: int = 100,
                   row_col: str | None = None) -> tuple[Classifier | None, DataFrame]:
    """The classifier and the measures of all rows: doc_id, lang, with
    ``row_col`` (a number of its own for each row) row, and both measures."""
    spark = df.sparkSession
    ship_package(spark)
    def column(of: DataFrame, name: str):
        return F.col(f"c{place(of, name)}")
    docs = numbered(df).select(column(df, id_col).cast("long").alias("doc_id"),
                               column(df, lang_col).cast("string").alias("lang"),
                               column(df, text_col).alias("text"),
                               *([column(df, row_col).cast("long").alias("row")] if row_col else []))
    marks = numbered(labels).select(column(labels, label_id).cast("long").alias("id"),
                                    column(labels, quality_col).alias("q"), column(labels, toxic_col).alias("t")).where("id IS NOT NULL").groupBy("id").agg(
        F.min("q").alias("q"), F.max("t").alias("t"))
    trusted = marks.where("q = 1 AND t = 0").select("id")

    def sample(ids: DataFrame) -> DataFrame:
        # at most fit_docs ids, so small enough to send to every task
        some = ids.orderBy(F.xxhash64("id"), "id").limit(fit_docs)
        return docs.join(F.broadcast(some), docs["doc_id"] == some["id"], "left_semi").select("text")
    fitted = F.xxhash64("id", F.lit(5)) % 2 == 0
    good = fit(sample(trusted.where(fitted)))
    if good is None:
        return None, docs.select("doc_id", "lang", F.lit(None).cast("double").alias("log_perplexity"),
                                 F.lit(None).cast("double").alias("contrast"))
    bad = fit(sample(marks.where("t = 1").select("id")))
    path = scratch_path(spark, "quality")
    out = Classifier(spark.sparkContext.broadcast((good, bad)), None)
    keep, fields = ([0, 1, 3], ", row long") if row_col else ([0, 1], "")
    with small_batches(spark):
        out.measured(docs, 2, keep, "doc_id long, lang string" + fields).write.parquet(f"{path}/measured")
    measured = spark.read.parquet(f"{path}/measured")
    _limits(measured, trusted.where(~fitted), quantile, margin, min_docs).write.parquet(f"{path}/limits")
    out.limits = spark.read.parquet(f"{path}/limits")
    return out, measured


def judge_documents(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, lang, perplexity, contrast and rejected of every row."""
    model, measured = fit_classifier(df, labels, **options)
    judged = model.judged(measured) if model else measured.withColumn("rejected", F.lit(False))
    return judged.select("doc_id", "lang", F.exp("log_perplexity").alias("perplexity"), "contrast", "rejected")


def keep_good(df: DataFrame, labels: DataFrame, text_col: str = "text", lang_col: str = "lang",
              **options) -> DataFrame:
    """The rows of ``df`` that the classifier does not reject, unchanged.
    Each row is measured once; the rejected ones are told by their keys."""
    key = free_name("row", df.columns)
    rows = with_row_key(df, key)
    model, measured = fit_classifier(rows, labels, text_col=text_col, lang_col=lang_col, row_col=key, **options)
    if model is None:
        return df
    bad = model.judged(measured).where("rejected").select("row")
    rows = numbered(rows)
    return rows.join(bad, rows[f"c{len(df.columns)}"] == bad["row"], "left_anti").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
