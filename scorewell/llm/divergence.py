"""Source divergence audit: how far the sources of each language lie apart.

Terms are runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``), A-Z
lower-cased.  A language keeps the V terms that stand in at least ``min_docs``
of its rows.  A group is a (lang, source) that occurs; a group and a language
as a whole give each kept term the share

    p = 1 + floor(UNIT * (count + PRIOR) / (N + PRIOR * V))

with N the sum of its counts of kept terms.  Two groups are as far apart as
the sum of ``abs(p - q)`` over all kept terms.

1. Tasks fold the words they read into (lang, source, term) counts of bounded
   size before anything is shuffled, so a hot source or term costs no more
   than a rare one.
2. Three-dimensional cube: the groups of a language are dealt into blocks by
   hash, its kept terms too.  A task owns a cell (group block, group block,
   term block).  The slice of a group block and a term block, a bounded number
   of counts, is replicated along the other group axis.  The cell gives the
   partial divergence of each pair of its groups; terms that occur in
   none of its groups count at once, as many times as there are.
3. Partial divergences are reduced along the term axis.
4. Terms that a group favours over its language are ranked on their own, the
   first ``top`` of each group.

All arithmetic is in whole numbers: shares by long division in steps of 1000,
exact for N + PRIOR * V below 9 * 10**15.

Edge cases: null text, lang and source count as empty ones; a group without
terms is a group (every count is 0); a language without kept terms has all
pairs at 0 and no terms; repeated rows count each time; a language with one
source has no pairs; ties go to the smaller item in UTF-8 bytes; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import numbered, place
from scorewell.session import scratch_path, ship_package

UNIT = 1_000_000_000
PRIOR = 5
#: Entries of counts that a task holds before it hands them on.
HELD = 1 << 18
#: For every byte the letter it stands for; a blank where it is none.
LETTERS = bytes(0x20 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if b <= 0x5A else b
                for b in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order; bytes of a character beyond ASCII are all letters."""
    return (text or "").encode().translate(LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms and of rows that hold them; a row without term for each group."""
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for b in batches:
        for lang, source, text in zip(*b.columns):
            key = lang.as_py(), source.as_py()
            if key not in seen:
                seen[key] = Counter(), Counter()
            n, docs = seen[key]
            words = terms(text.as_py())
            held -= len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n)
            if held > HELD:
                yield from _counted(seen)
                seen, held = {}, 0
    yield from _counted(seen)


def _counted(seen: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in seen.items():
        words = list(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(n) + 1)), pa.array([source] * (len(n) + 1)),
             pa.array([*words, None], pa.binary()).cast(pa.string()),
             pa.array([*n.values(), 0], pa.int64()), pa.array([*(docs[w] for w in words), 0], pa.int64())],
            names=["lang", "source", "term", "n", "docs"])


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (n + PRIOR) / total), exact for totals below 9 * 10**15."""
    if (total > 9 * 10 ** 15).any():
        raise OverflowError("too many words for 64-bit long division")
    out, rest = np.divmod(n + PRIOR, total)
    for _ in range(3):  # UNIT is 1000 ** 3
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def _share(n: Column, total: Column) -> Column:
    """The same as ``shares``, in decimals."""
    wide = "decimal(19,0)"
    product = F.lit(UNIT).cast("decimal(10,0)") * (n + PRIOR).cast(wide)
    return F.call_function("div", product, total.cast(wide)) + 1


def _cell(rows: pa.Table) -> pa.Table:
    """Partial divergence of the pairs of a cell's groups, each pair once."""
    rows = rows.to_pandas()
    groups = rows[rows["term"].isna()].sort_values("source").reset_index(drop=True)
    some = rows[rows["term"].notna()]
    at = groups.reset_index().set_index("source")["index"]
    words, term = np.unique(some["term"].to_numpy(str), return_inverse=True)
    n = np.zeros((len(groups), len(words)), np.int64)
    n[at[some["source"]].to_numpy(np.int64), term] = some["n"].to_numpy(np.int64)
    total = np.maximum(groups["total"].to_numpy(np.int64), 1)[:, None]
    p, bare = shares(n, total), shares(np.zeros_like(total), total)[:, 0]
    rest = int(groups["terms"].iloc[0]) - len(words)
    i, j, t = (int(rows[c].iloc[0]) for c in ("i", "j", "t"))
    own = groups["block"].to_numpy(np.int64)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    names, out = groups["source"].to_numpy(object), []
    for a in left:
        others = right[right > a] if i == j else right
        far = np.abs(p[others] - p[a]).sum(1) + rest * np.abs(bare[others] - bare[a])
        out.append((np.full(len(others), a), others, far))
    a, b, far = (np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in range(3))
    lang = rows["lang"].iloc[0]
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(names[a], pa.string()),
                     "b": pa.array(names[b], pa.string()), "t": pa.array(np.full(len(a), t), pa.int32()),
                     "far": pa.array(far, pa.int64())})


def source_divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 30, top: int = 50, group_block: int = 64,
                      term_block: int = 4096) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: each other source of the language, farthest first.  Part
    ``term``: the kept terms of the group whose share is above the language's,
    by how much, at most ``top``.  ``group_block`` and ``term_block``: about
    how many groups and terms a block of the cube holds.
    """
    spark = df.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "divergence")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    texts = numbered(df).select(
        *[F.coalesce(F.col(f"c{place(df, c)}").cast("string"), F.lit("")).alias(a)
          for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = written(texts.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = written(counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("of_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        .select("lang", "term", "of_lang"), "kept")
    some = written(counts.where("term is not null").join(kept, ["lang", "term"]).select(
        "lang", "source", "term", "n", "of_lang"), "some")
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("words"))
    sums = some.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = (counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left")
              .join(vocabulary, "lang", "left").na.fill(0))
    groups = written(groups.select("lang", "source", (F.col("n") + PRIOR * F.col("v")).alias("total"), "v",
                                   (F.col("words") + PRIOR * F.col("v")).alias("total_lang")), "groups")
    cube = written(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("v").alias("v")).select(
        "lang", F.ceil(F.col("s") / group_block).cast("int").alias("group_blocks"),
        F.greatest(F.ceil(F.col("v") / term_block), F.lit(1)).cast("int").alias("term_blocks")), "cube")

    favoured = some.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (_share(F.col("n"), F.col("total")) - _share(F.col("of_lang"), F.col("total_lang"))).alias("value"))
    favoured = _ranked(favoured.where("value > 0"), "term").where(F.col("rank") <= top)
    return _ranked(_pairs(some, kept, groups, cube), "pair").unionByName(favoured)


def _pairs(some: DataFrame, kept: DataFrame, groups: DataFrame, cube: DataFrame) -> DataFrame:
    """lang, source, item, value of every ordered pair of groups."""
    def dealt(name: str, blocks: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(blocks)).cast("int")
    blocks = kept.join(cube, "lang").groupBy("lang", dealt("term", "term_blocks").alias("t")).agg(
        F.count(F.lit(1)).alias("terms"))
    blocks = (cube.select("*", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("t"))
              .join(blocks, ["lang", "t"], "left").na.fill(0, ["terms"]))
    nothing = F.lit(None).cast("long")
    heads = groups.join(blocks, "lang").select(
        "lang", "source", dealt("source", "group_blocks").alias("block"), "t", "group_blocks",
        F.lit(None).cast("string").alias("term"), nothing.alias("n"), "total", "terms")
    slices = some.join(cube, "lang").select(
        "lang", "source", dealt("source", "group_blocks").alias("block"), dealt("term", "term_blocks").alias("t"),
        "group_blocks", "term", "n", nothing.alias("total"), nothing.alias("terms"))
    every = heads.unionByName(slices).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other"))
    cells = every.select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "t", "block", "source", "term", "n", "total", "terms")
    partial = cells.groupBy("lang", "i", "j", "t").applyInArrow(
        _cell, "lang string, a string, b string, t int, far long")
    far = partial.groupBy("lang", "a", "b").agg(F.sum("far").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p")
    return far.select("lang", both, "value").select("lang", "p.source", "p.item", "value")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


#: The same in DuckDB, over the table documents.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS of_lang FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v, sum(of_lang) AS words FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
       FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn.total + 5 * v.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.of_lang + 5)) // (v.words + 5 * v.v)::HUGEINT AS q
  FROM gn JOIN kept k ON k.lang = gn.lang JOIN v ON v.lang = gn.lang
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
far AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
favoured AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
every AS (SELECT * FROM pairs UNION ALL SELECT * FROM favoured),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item ASC))::INTEGER AS rank
  FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
