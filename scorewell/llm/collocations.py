"""Phrase collocation mining: best-first branch-and-bound growth of phrases.

Texts have A-Z lower-cased, are split into pieces at ``[.,;:!?\\x0A-\\x0D]``
and those into words ``[^\\x20\\x09]+``.  Everything is per language.  A
candidate is a phrase of 2 to ``longest`` words that occurs ``least`` times or
more within pieces, overlaps included.  Cut after its first k words, with l
and r the counts of both parts, a its own and n that of all words, it scores
floor(1000 * a * n / (l * r)); its lowest cut counts, ties to the smallest k.
A candidate is dropped if a longer candidate that contains it occurs as often.

1. Bound: a is at most the count of the rest, so no phrase that begins with
   a prefix x scores more than floor(1000 * n / f(x)), and by f(x) <= f(first
   word) its first word's count bounds the whole branch.
2. Frontier: first words wait in the order of that bound, the rarest first.
   A round expands the best ones of each open language, about ``batch`` of
   them and all of one bound together, in one set of passes over the corpus.
   A language is settled when nothing waits, or when its ``top``-th surviving
   score is above the best bound that waits (an equal one is still expanded,
   for ties).  Only open languages go on, and only with first words whose
   bound still reaches that score.
3. Growth: the corpus is written once as numbers of frequent words, in chunks
   with the words they stand for.  From word to word a phrase is counted only
   where its first part is alive (counted ``least`` times) and its own rest,
   where that begins with a word of the round too, is alive.  Growth
   counts 64-bit hashes, folded in tasks; what is alive goes to the tasks as a
   bit sieve of fixed size.  Hashes and sieves let a phrase too many through,
   never one too few; then the phrases are counted as text and ``least`` is
   applied to those counts, so no hash decides anything.
4. Rests of candidates that begin with a word of no round yet are counted in
   a pass of their own.
5. A longer candidate as frequent as its part exists exactly when all
   occurrences of the part have the same word before them, or the same word
   after.  Both are folded along with the count, so words that wait in the
   frontier are known to a survivor, too.

Sent to the tasks: at most ``longest`` sieves of ``SIEVE_BITS`` bits a pass.  The driver sees sieves and the number of open languages.

Edge cases: null text is empty; null lang is ``und``; repeated rows count each
time; equal scores are ranked by count, then by phrase in UTF-8 bytes; fewer
than ``top`` survivors are all given; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewell.llm.common import numbered, place
from scorewell.session import scratch_path, ship_package, shuffles_removed, small_batches

#: Bits of a sieve; each entry sets two.
SIEVE_BITS = 1 << 25
#: Bits of one row of a sieve's table (4 KiB, what bitmap_construct_agg makes).
PAGE = 1 << 15
#: Words that a task looks at together, about.
CHUNK = 1 << 18
#: Rows of phrases that a task folds together before it hands them on.
HELD = 1 << 18
#: Rows that a task hands to the JVM at once.
HANDED = 1 << 14
#: Chunks are written in pages of one each, and read so many at a time: rows of a megabyte, not of a few bytes.
PAGED = {"parquet.page.size.row.check.min": 1, "parquet.block.size": 8 << 20}
READ = {"spark_sql_parquet_columnarReaderBatchSize": 4}

#: A-Z lower-cased, all ends of pieces a line feed, a tab a blank.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
CHUNKS = "lang string, words binary, ids binary"
PHRASES = "lang string, phrase string, size int, n long, before string, after string"
KEY = ["lang", "phrase"]


class Chunk:
    """Words of whole texts of one language as numbers; 0 ends a piece."""

    def __init__(self, lang: str, names: list[bytes], ids: list[int] | np.ndarray):
        self.lang, self.names, self.ids = lang, names, np.asarray(ids, np.int64)
        self.word_hash = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.names), "<u8", len(self.names))
        self.start = np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))

    def hashes(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For phrase lengths 1, 2, ...: hash at each place, and whether all words lie in one piece."""
        h = self.word_hash[self.ids]
        here, whole = _mix(h + self.start), self.ids > 0
        yield here, whole
        for k in range(1, longest):
            here = _mix(here[:-1] * _ODD + h[k:])
            whole = whole[:-1] & (self.ids[k:] > 0)
            yield here, whole


_ODD, _MULTIPLY, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _HALF)) * _MULTIPLY
    return h ^ (h >> _HALF)


def _chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[Chunk]:
    held: dict[str, list[str]] = {}
    total = 0
    for b in batches:
        for lang, text in zip(*b.columns):
            text = text.as_py() or ""
            held.setdefault(lang.as_py(), []).append(text)
            total += len(text)
            if total > 6 * size:  # letters of so many words, about
                yield from (Chunk(k, *_numbers(texts)) for k, texts in held.items())
                held, total = {}, 0
    yield from (Chunk(k, *_numbers(texts)) for k, texts in held.items())


def _numbers(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Names of the words (no word first), and the words as numbers, 0 at both ends of each piece."""
    letters = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode().translate(PLAIN), np.uint8)
    end = letters == 10
    inside = ~(end | (letters == 32))
    begin = np.concatenate([[False], inside[1:] & ~inside[:-1]])
    bounds = np.concatenate([[0], np.cumsum(inside)])[np.append(np.flatnonzero(begin), len(letters))]
    words = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(letters[inside])]).dictionary_encode()
    item = np.flatnonzero(begin | end)
    ids = np.zeros(len(item), np.int64)
    ids[begin[item]] = words.indices.to_numpy() + 1
    ids = ids[(ids > 0) | (np.concatenate([[1], ids[:-1]]) > 0)]
    return [b"", *words.dictionary.to_pylist()], ids


def _handed(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    yield from (rows.slice(lo, HANDED) for lo in range(0, rows.num_rows, HANDED))


class Sieve:
    """Bits that tell which hashes are surely not in a set."""

    def __init__(self, pages: list[tuple[int, bytes]]):
        self.bits = np.zeros(SIEVE_BITS // 8, np.uint8)
        for page, bits in pages:
            self.bits[page * PAGE // 8:(page + 1) * PAGE // 8] = np.frombuffer(bits, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for spot in (h, h >> _HALF):
            spot = spot & np.uint64(SIEVE_BITS - 1)
            out &= (self.bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def _sieve(rows: DataFrame) -> Sieve:
    """Sieve of the column h; SIEVE_BITS / PAGE rows come to the driver at most."""
    spots = rows.select(F.explode(F.array(*[x.bitwiseAND(F.lit(SIEVE_BITS - 1)) for x in (
        F.col("h"), F.shiftrightunsigned("h", 32))])).alias("spot"))
    pages = spots.groupBy(F.floor(F.col("spot") / PAGE).alias("page")).agg(
        F.expr(f"bitmap_construct_agg(spot % {PAGE})").alias("bits"))
    return Sieve([(r.page, bytes(r.bits)) for r in pages.collect()])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        n = np.bincount(c.ids, minlength=len(c.names))[1:]
        yield from _handed(pa.RecordBatch.from_arrays(
            [pa.array([c.lang] * len(n), pa.string()), pa.array(c.names[1:], pa.binary()).cast(pa.string()),
             pa.array(_mix(c.word_hash[1:] + c.start).view("<i8")), pa.array(n, pa.int64())],
            names=["lang", "phrase", "h", "n"]))


def _encode(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[pa.RecordBatch]:
    """Chunks of frequent words only; any other word ends a piece."""
    frequent = frequent.value
    for c in _chunks(batches):
        stay = frequent.has(_mix(c.word_hash + c.start))
        stay[0] = False
        ids = np.where(stay, np.cumsum(stay), 0)[c.ids]
        ids = ids[(ids > 0) | (np.concatenate([[1], ids[:-1]]) > 0)]
        words = b" ".join([c.names[i] for i in np.flatnonzero(stay)])
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.lang], pa.string()), pa.array([words], pa.binary()),
                 pa.array([ids.astype("<u4").tobytes()], pa.binary())], names=["lang", "words", "ids"])


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for b in batches:
        for lang, words, ids in zip(*b.columns):
            yield Chunk(lang.as_py(), [b"", *words.as_py().split(b" ")], np.frombuffer(ids.as_py(), "<u4"))


def _alive(c: Chunk, first: Sieve, levels: list[Sieve], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, hashes) of phrases to count: one length more than
    there are ``levels``, whose own phrases are let through by all of them."""
    begins = shorter = None
    for k, (h, whole) in enumerate(c.hashes(longest), 1):
        if k == 1:
            begins = first.has(_mix(c.word_hash + c.start))[c.ids] & whole
            if not begins.any():
                return
            shorter = begins
            continue
        m = len(h)
        at = shorter[:m] & whole
        if k > 2:  # where the rest begins with a word of the round, it is alive or there is nothing to count
            at &= ~begins[1:m + 1] | shorter[1:m + 1]
        at = np.flatnonzero(at)
        yield k, at, h[at]
        if k - 2 == len(levels):
            return
        at = at[levels[k - 2].has(h[at])]
        shorter = np.zeros(m, bool)
        shorter[at] = True


def _grow(batches: Iterator[pa.RecordBatch], first, levels, longest: int) -> Iterator[pa.RecordBatch]:
    """(h, n) of the phrases that are one word longer than the last level."""
    first, levels = first.value, [x.value for x in levels]
    for c in _read_chunks(batches):
        for k, _, h in _alive(c, first, levels, longest):
            if k == len(levels) + 2:
                h, n = np.unique(h, return_counts=True)
                yield from _handed(pa.RecordBatch.from_arrays(
                    [pa.array(h.view("<i8")), pa.array(n, pa.int64())], names=["h", "n"]))


def _read(batches: Iterator[pa.RecordBatch], first, levels, longest: int) -> Iterator[pa.RecordBatch]:
    """Phrases that are let through at every length, as text."""
    first, levels = first.value, [x.value for x in levels]
    for c in _read_chunks(batches):
        for k, at, h in _alive(c, first, levels, longest):
            if k <= len(levels) + 1:
                some = levels[k - 2].has(h)
                yield _phrases(c, at[some], h[some], k)


def _look_up(batches: Iterator[pa.RecordBatch], asked, longest: int) -> Iterator[pa.RecordBatch]:
    """All phrases that the sieve lets through, as text."""
    asked = asked.value
    for c in _read_chunks(batches):
        for k, (h, whole) in enumerate(c.hashes(longest - 1), 1):
            if k > 1:
                at = np.flatnonzero(whole)
                at = at[asked.has(h[at])]
                yield _phrases(c, at, h[at], k)


def _phrases(c: Chunk, at: np.ndarray, h: np.ndarray, k: int) -> pa.RecordBatch:
    """Counts of the phrases at these places, with the word that stands before
    all of them and that after all of them (empty where there is none)."""
    rows = c.ids[at[:, None] + np.arange(k)]
    _, head, group, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    if not (rows[head][group] == rows).all():  # two phrases with one hash
        _, head, group, n = np.unique(rows, axis=0, return_index=True, return_inverse=True, return_counts=True)
        group = group.reshape(-1)
    sides = []
    for spot in (at - 1, at + k):
        word = c.ids[spot]
        own = word[head]
        mixed = np.bincount(group, weights=word != own[group], minlength=len(n)) > 0
        sides.append(_text([c.names[w] for w in np.where(mixed, 0, own)]))
    text = _text([b" ".join([c.names[w] for w in r]) for r in rows[head].tolist()])
    return pa.RecordBatch.from_arrays(
        [pa.array([c.lang] * len(n), pa.string()), text, pa.array([k] * len(n), pa.int32()),
         pa.array(n, pa.int64()), *sides], names=["lang", "phrase", "size", "n", "before", "after"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one phrase put together, as ``_counted`` does between tasks."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) > HELD:
            held = _fold(held)
            if held[0].num_rows > HELD // 2:
                yield from _handed(held[0])
                held = []
    if held:
        yield from _handed(_fold(held)[0])


def _fold(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    rows = pa.Table.from_batches(held).group_by(["lang", "phrase", "size"]).aggregate(
        [("n", "sum"), *[(side, how) for side in ("before", "after") for how in ("min", "max")]])
    sides = [pc.if_else(pc.equal(rows[f"{x}_min"], rows[f"{x}_max"]), rows[f"{x}_min"], "") for x in ("before", "after")]
    columns = [rows["lang"], rows["phrase"], rows["size"], rows["n_sum"], *sides]
    names = ["lang", "phrase", "size", "n", "before", "after"]
    return [pa.RecordBatch.from_arrays([c.combine_chunks() for c in columns], names=names)]


def _text(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _phrase_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes that ``Chunk.hashes`` has where these phrases stand."""
    for b in batches:
        out = []
        for lang, phrase in zip(*(x.to_pylist() for x in b.columns)):
            words = phrase.encode().split(b" ")
            c = Chunk(lang, [b"", *words], np.arange(1, len(words) + 1))
            out.append([h[0] for h, _ in c.hashes(len(words))][-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.array(out, "<u8").view("<i8"))], names=["h"])


def _counted(rows: DataFrame) -> DataFrame:
    def same(side: str) -> Column:
        return F.when(F.min(side) == F.max(side), F.min(side)).otherwise("").alias(side)
    return rows.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"), same("before"), same("after"))


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def _cuts(candidates: DataFrame) -> DataFrame:
    """Each candidate with its cuts: k, left, right."""
    cut = candidates.withColumn("words", F.split("phrase", " ")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    return cut.select("lang", "phrase", "size", F.col("n").alias("a"), "k", _part(F.lit(1), F.col("k")).alias("left"),
                      _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))


def _scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each candidate, by its lowest cut."""
    def part(name: str, count: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    wide = "decimal(19,0)"
    cuts = (_cuts(candidates).join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
            .join(totals.select("lang", F.col("total").alias("n")), "lang"))
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") *
                            F.col("n").cast(wide), F.col("l").cast(wide) * F.col("r").cast(wide))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _limits(words: DataFrame, below: DataFrame, batch: int) -> DataFrame:
    """lang, low, high: the next best first words of each open language are
    those with counts above low and up to high; counts above cap are out of
    bounds already.  Distinct counts of a language
    are no more than about the root of twice its words."""
    waiting = (words.join(below, "lang").where("n > low and n <= cap").groupBy("lang", "low", "n")
               .agg(F.count(F.lit(1)).alias("c")))
    before = F.sum("c").over(Window.partitionBy("lang").orderBy("n")) - F.col("c")
    return waiting.withColumn("before", before).where(F.col("before") < batch).groupBy("lang", "low").agg(
        F.max("n").alias("high"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, top: int = 2000,
                 longest: int = 5, batch: int = 1 << 13) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` of each language.

    ``batch``: how many first words a round expands, about; each next round
    takes eight times as many.
    """
    ship_package(df.sparkSession)
    with small_batches(df.sparkSession), shuffles_removed(df.sparkSession):
        best = _mined(df, text_col, lang_col, least, top, longest, batch)
    return _ranked(best, top)


def _mined(df: DataFrame, text_col: str, lang_col: str, least: int, top: int, longest: int, batch: int) -> DataFrame:
    """The same without ranks, written."""
    spark = df.sparkSession
    root = scratch_path(spark, "collocations")

    def written(rows: DataFrame, name: str, **options) -> DataFrame:
        rows.write.options(**options).parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    texts = numbered(df).select(F.coalesce(F.col(f"c{place(df, lang_col)}").cast("string"), F.lit("und")).alias("lang"),
                                F.col(f"c{place(df, text_col)}").cast("string").alias("text"))
    words = texts.mapInArrow(_word_counts, "lang string, phrase string, h long, n long").groupBy(
        "lang", "phrase", "h").agg(F.sum("n").alias("n"))
    words = written(words, "all_words")
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    words = written(words.where(F.col("n") >= least), "words")
    known = words.select("lang", "phrase", "n")
    frequent = spark.sparkContext.broadcast(_sieve(words))
    chunks = written(texts.mapInArrow(lambda it: _encode(it, frequent), CHUNKS), "chunks", **PAGED)
    frequent.unpersist()
    best = spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")
    no_cap = F.lit((1 << 63) - 1)
    below, turn = totals.select("lang", F.lit(0).cast("long").alias("low"), no_cap.alias("cap")), 0
    while True:
        limits = written(_limits(words, below, batch << 3 * turn), f"limits{turn}")
        if limits.isEmpty():
            return best
        first = words.join(limits, "lang").where("n > low and n <= high")
        with small_batches(spark, **READ):
            candidates, known = _round(spark, chunks, first, known, least, longest, written, turn)
        alone = (F.col("size") == longest) | ((F.col("before") == "") & (F.col("after") == ""))
        found = _scored(candidates.where(alone), known, totals)
        best = written(_ranked(best.unionByName(found), top), f"best{turn}").drop("rank")
        # languages whose last place may still change hands
        last = best.groupBy("lang").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("places"))
        rest = (words.join(limits, "lang").where("n > high").groupBy("lang", "high").agg(F.min("n").alias("rarest"))
                .join(totals, "lang").join(last, "lang", "left"))
        # a first word with a larger count cannot reach the last place any more
        cap = F.when((F.col("places") == top) & (F.col("last") > 0), F.call_function(
            "div", F.col("total").cast("decimal(19,0)") * F.lit(1000).cast("decimal(4,0)"),
            F.col("last").cast("decimal(19,0)"))).otherwise(no_cap)
        open_ = rest.withColumn("cap", cap).where("rarest <= cap")
        below, turn = open_.select("lang", F.col("high").alias("low"), "cap"), turn + 1


def _round(spark: SparkSession, chunks: DataFrame, first: DataFrame, known: DataFrame, least: int, longest: int,
           written: Callable, turn: int) -> tuple[DataFrame, DataFrame]:
    """Candidates that begin with the words of ``first``, and all counts known
    by then, those of the candidates' parts among them."""
    send = spark.sparkContext.broadcast
    begin = send(_sieve(first))
    levels: list = []
    for _ in range(2, longest + 1):
        now = list(levels)
        grown = (chunks.mapInArrow(lambda it: _grow(it, begin, now, longest), "h long, n long")
                 .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
        level = _sieve(grown)
        if not level.bits.any():
            break
        levels.append(send(level))
    read = chunks.mapInArrow(lambda it: _folded(_read(it, begin, levels, longest)), PHRASES)
    candidates = written(_counted(read).where(F.col("n") >= least), f"candidates{turn}")
    known = known.unionByName(candidates.select("lang", "phrase", "n"))
    asked = _cuts(candidates).where("size - k > 1").select("lang", F.col("right").alias("phrase")).distinct()
    asked = written(asked.join(known, KEY, "left_anti"), f"asked{turn}")
    if not asked.isEmpty():
        sieve = send(_sieve(asked.mapInArrow(_phrase_hashes, "h long")))
        rests = _counted(chunks.mapInArrow(lambda it: _folded(_look_up(it, sieve, longest)), PHRASES))
        rests = written(rests.join(asked, KEY, "left_semi").select("lang", "phrase", "n"), f"rests{turn}")
        # a later round may find the same phrase as a candidate of its own
        known = known.unionByName(rests).distinct()
        sieve.unpersist()
    for x in [begin, *levels]:
        x.unpersist()
    return candidates, known


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB, over the table documents, by counting every phrase.
ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
w AS (SELECT id, lang, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM p),
x AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4,
         lead(w1, 4) OVER o AS w5
  FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
s AS (
  SELECT lang, 1 AS size, w1 AS phrase FROM x
  UNION ALL SELECT lang, 2, concat_ws(' ', w1, w2) FROM x WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3) FROM x WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) FROM x WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, concat_ws(' ', w1, w2, w3, w4, w5) FROM x WHERE w5 IS NOT NULL),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS a FROM s GROUP BY 1, 2, 3),
totals AS (SELECT lang, count(*)::BIGINT AS n FROM w GROUP BY 1),
c AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND a >= 100),
cuts AS MATERIALIZED (
  SELECT *, array_to_string(ws[1:k], ' ') AS first_part, array_to_string(ws[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
left_counts AS MATERIALIZED (
  SELECT cuts.*, f.a AS l FROM cuts JOIN f ON f.lang = cuts.lang AND f.phrase = cuts.first_part),
both_counts AS MATERIALIZED (
  SELECT t.*, f.a AS r FROM left_counts t JOIN f ON f.lang = t.lang AND f.phrase = t.rest),
scored AS (
  SELECT t.lang, t.phrase, t.size, t.a, t.l, t.r, totals.n, t.k,
         (1000::HUGEINT * t.a * totals.n) // (t.l::HUGEINT * t.r) AS score
  FROM both_counts t JOIN totals ON totals.lang = t.lang),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, ws, m, unnest(range(1, size - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS m FROM c))),
held AS (SELECT lang, phrase, max(a) AS a FROM inner_parts GROUP BY 1, 2),
ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang
                                      ORDER BY score DESC, lowest.a DESC, lowest.phrase ASC) AS rank
  FROM lowest LEFT JOIN held ON held.lang = lowest.lang AND held.phrase = lowest.phrase
  WHERE held.a IS NULL OR 100 * held.a < 100 * lowest.a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
