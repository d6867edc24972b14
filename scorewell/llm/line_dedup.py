"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line's tokens are its distinct words (A-Z lower-cased); two lines match
when the Jaccard similarity of their token sets reaches the threshold.  A
line is removed when an earlier one, in (doc_id, line number) order, matches
it, whether or not that one is itself removed.

1. Each text is lowered and split once; its lines are written as hashes of
   their distinct words (64 bits: two words of one line that share a hash would
   count as one).  Equal lines (same text but for letter case) meet by hash; the
   first of them stands for all from here on, under a number in line order.
2. Tokens are ordered by rarity, as all lines count it: words fall into
   ``CELLS`` cells by hash, and a token ranks by how many lines hold words of its
   cell, in steps of half a power of two, then by hash.  The counts have
   a fixed size, whatever the vocabulary; a rare word that shares its cell
   with a frequent one only comes later.  Any fixed order gives the same
   matches; this one keeps posting lists short.
3. Prefix filter: two matching sets share a token among the first
   n - ceil(t * n) + 1 of each, of the smaller one even among the first
   n - ceil(2 * t * n / (1 + t)) + 1.
4. Length and positional filters, and 64 parities of each token set (128 of
   sets of ``LONG`` tokens or more), drop pairs that cannot reach the overlap
   which the threshold asks for.
5. Each line is verified first against the earliest lines of its posting
   lists (``HEADS`` parts of a list have one each), which settles most of a
   large group of near copies; only lines still there are joined with the other
   earlier lines of their lists.
6. Verification fetches the words of lines in such pairs and compares these, so
   no line is removed by a hash of words.
7. Each step is written and its shuffle files go before the next one starts,
   as do files that no later step reads; posting lists are joined in ``PASSES``
   passes, by hash of the token.

Edge cases: null and empty texts pass unchanged; lines of fewer than
``min_tokens`` tokens are neither removed nor matched (1 leaves out lines
without words only, and is what the query and the pipeline ask for); rows with
one doc_id are the same document and are treated alike (null is an id of its
own, the first in order) unless ``row_col`` tells rows apart, as in the query
and the pipeline: then each row is judged on its own, those of one doc_id in
the order of that column; an empty table gives no rows; all columns of the
input pass, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import LOWER, UPPER, free_name, numbered, place
from scorewell.session import remove_scratch, scratch_path, shuffles_removed

#: Cells in which words are counted.
CELLS = 1 << 17
#: Passes over the posting lists; a part of them lies on disk at a time.
PASSES = 2
#: Parts of a posting list, by parities of the lines, that have an earliest line each.
HEADS = 4
#: Token sets of this size get more parities.
LONG = 64
#: White space besides the blank.
BLANKS = "\t\x0b\x0c\r\n"


def _low(line: Column) -> Column:
    """A-Z lower-cased, every white space a blank."""
    plain = F.octet_length(line) == F.length(line)  # ASCII only, where lower() is fast and the same everywhere
    for c in BLANKS:
        plain = plain & ~F.contains(line, F.lit(c))
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER + BLANKS, LOWER + " " * len(BLANKS)))


def _tokens(low: Column) -> Column:
    """Distinct words of a text that is lowered already."""
    return F.array_remove(F.array_distinct(F.split(low, " ")), "")


def _hashes(low: Column) -> Column:
    """Hashes of the distinct words of a text that is lowered already."""
    found = F.array_distinct(F.transform(F.split(low, " "), lambda w: F.xxhash64(w)))
    bare = ~(F.contains(low, F.lit("  ")) | F.startswith(low, F.lit(" ")) | F.endswith(low, F.lit(" ")) | (low == ""))
    return F.when(bare, found).otherwise(F.array_remove(found, F.xxhash64(F.lit(""))))


def _least(t: Fraction, n: Column) -> Column:
    """ceil(t * n) in whole numbers."""
    return ((n * t.numerator + (t.denominator - 1)) / t.denominator).cast("long")


def _overlap(t: Fraction, a: Column, b: Column) -> Column:
    """Least intersection of sets of sizes a and b with Jaccard t or more."""
    up, down = t.numerator, t.numerator + t.denominator
    return (((a + b) * up + (down - 1)) / down).cast("long")


def word_ranks(hashed: DataFrame) -> Column:
    """An array of ``CELLS`` small numbers, the larger the more lines hold words of
    the cell; so many numbers come to the driver and back as a constant."""
    words = hashed.select(F.explode("hashes").alias("h"))
    counts = words.groupBy(_cell(F.col("h")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    ranks = [0] * CELLS
    for r in counts.select("cell", F.floor(2 * F.log2(F.col("n") + 1)).cast("int").alias("rank")).collect():
        ranks[r.cell] = r.rank
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<tinyint>")


def _cell(h: Column) -> Column:
    return h.bitwiseAND(F.lit(CELLS - 1)).cast("int")


def _order_key(h: Column, ranks: Column) -> Column:
    """One long per token that sorts by rarity: rank of its cell, then hash.

    Never null, so that arrays of it are sorted as plain numbers."""
    rank = F.coalesce(F.get(ranks, _cell(h)), F.lit(0).cast("tinyint"))
    return F.shiftleft(rank.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))


def duplicate_lines(lines: DataFrame, threshold: float = 0.8, min_tokens: int = 5) -> DataFrame:
    """(doc_id, line_no) of every line that an earlier one matches.

    ``lines``: doc_id long, line_no int, line string; with a column row, long
    and not null, lines are told apart and ordered by (doc_id, row, line_no),
    and so are those given back.
    """
    key = ["doc_id", *[c for c in lines.columns if c == "row"], "line_no"]
    lines = lines.select(F.struct(*key).alias("at"), "line")
    with shuffles_removed(lines.sparkSession):
        every, first, gone = _matched(lines, Fraction(str(threshold)), min_tokens)
    # back to all lines: those equal to an earlier one, and first ones that are matched
    marked = (first.select("id", "f1", "f2", F.col("at").alias("first"), "copies")
              .join(gone.select("id", F.lit(True).alias("gone")), "id", "left").where("gone or copies > 1"))
    return (every.join(marked.hint("shuffle_hash"), ["f1", "f2"])
            .where("gone or not (at <=> first)").select("at.*"))


def _matched(lines: DataFrame, t: Fraction, min_tokens: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All lines by hash, the first of equal ones, and those of them that an
    earlier one matches; all written."""
    spark = lines.sparkSession
    root = scratch_path(spark, "line_dedup")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    # an array of one text is exploded, else the text would be lowered again in each column
    low = lines.select("at", F.explode(F.array(_low(F.col("line")))).alias("low"))
    hashed = written(low.select("at", F.xxhash64("low").alias("f1"), F.xxhash64("low", F.lit(1)).alias("f2"),
                                _hashes(F.col("low")).alias("hashes")), "hashed").where(F.size("hashes") >= min_tokens)
    first = written(_first(hashed, word_ranks(hashed), t), "equal")
    every = written(hashed.select("at", "f1", "f2"), "every")
    remove_scratch(spark, f"{root}/hashed")
    first = written(first.orderBy("at").withColumn("id", F.monotonically_increasing_id()), "first")
    remove_scratch(spark, f"{root}/equal")
    sides = ["n", "i", "bits", "half"]

    def posts(of: DataFrame, part: int) -> DataFrame:
        # nothing is null; said here, so that both sides of a join have one plan and one exchange
        rows = of.where("id is not null and n is not null")
        rows = rows.select("id", "n", "bits", "half", F.posexplode("prefix").alias("i", "token"))
        return rows.where(F.col("token").isNotNull() & (F.col("token").bitwiseAND(F.lit(PASSES - 1)) == part))

    def head_pairs(part: int) -> DataFrame:
        # earliest line of each list's parts, and the token's place in that line's order
        dealt = posts(first, part).repartition("token")
        heads = dealt.groupBy("token", F.col("bits").bitwiseAND(F.lit(HEADS - 1))).agg(
            F.min("id").alias("id2"), F.count(F.lit(1)).alias("df"),
            *[F.min_by(c, "id").alias(c + "2") for c in sides]).where("df > 1").select("token", "id2", *[c + "2" for c in sides])
        return dealt.join(heads.hint("shuffle_hash"), "token").where(F.col("id2") < F.col("id"))

    def other_pairs(part: int) -> DataFrame:
        # the larger set of a pair, and the smaller one by a shorter prefix; settled lines have ~id
        other = posts(marked, part).where(F.col("i") <= F.col("n") - _overlap(t, F.col("n"), F.col("n")))
        other = other.select("token", *[F.col(c).alias(c + "2") for c in ["id", *sides]])
        a, b = (F.greatest(c, F.bitwise_not(c)) for c in ("id", "id2"))
        n, n2 = F.col("n"), F.col("n2")
        return (posts(marked, part).join(other, "token").where(((n2 < n) | ((n2 == n) & (b < a)))
                & F.when(b < a, F.col("id") >= 0).otherwise(F.col("id2") >= 0))
                .withColumns({"id": F.greatest(a, b), "id2": F.least(a, b)}))

    def confirmed(name: str, pairs: Callable[[int], DataFrame]) -> DataFrame:
        for part in range(PASSES):
            found = pairs(part).where(_possible(t)).select("id", "id2").distinct()
            found.write.parquet(f"{root}/{name}_pairs/part={part}")
        found = spark.read.parquet(f"{root}/{name}_pairs").select("id", "id2").distinct()
        words = written(_words(found, first, lines), f"{name}_words")
        return written(_verified(found, words, t).select("id").distinct(), name)

    by_head = confirmed("by_head", head_pairs)
    settled = by_head.select("id", F.lit(True).alias("settled"))
    marked = written(first.join(settled.hint("shuffle_hash"), "id", "left").select(F.when(F.col("settled"), F.bitwise_not("id")).otherwise(
        F.col("id")).alias("id"), "n", "bits", "half", "prefix"), "marked")
    return every, first, by_head.unionByName(confirmed("by_other", other_pairs))


def _first(hashed: DataFrame, ranks: Column, t: Fraction) -> DataFrame:
    """The first of equal lines: its size, parities and prefix, and how many copies there are."""
    keys = F.sort_array(F.transform("hashes", lambda h: _order_key(h, ranks)))
    keyed = hashed.select("at", "f1", "f2", F.size("hashes").alias("n"), keys.alias("keys"))
    half = F.filter("keys", lambda k: k.bitwiseAND(F.lit(64)) != 0)
    keyed = keyed.select("at", "f1", "f2", "n", _bits(F.col("keys")).alias("bits"), F.when(
        F.col("n") >= LONG, _bits(half)).alias("half"), F.slice(
        "keys", F.lit(1), (F.col("n") - _least(t, F.col("n")) + 1).cast("int")).alias("prefix"))
    first = keyed.groupBy("f1", "f2").agg(F.min(F.struct("at", "n", "bits", "half", "prefix")).alias("x"),
                                          F.count(F.lit(1)).alias("copies"))
    return first.select("f1", "f2", "x.*", "copies")


def _bits(keys: Column) -> Column:
    """64 parities of the token set: sets differ in as many tokens at least as
    their parities differ in bits."""
    one = F.lit(1).cast("long")
    return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(
        F.call_function("shiftleft", one, k.bitwiseAND(F.lit(63)).cast("int"))))


def _possible(t: Fraction) -> Column:
    """Length, positional and parity filter on two lines (n, i, bits, half and
    n2, i2, bits2, half2) that share a token at the places i and i2.

    The token, all later ones and at most as many earlier ones as the smaller
    place may be shared."""
    n, n2, i, i2 = (F.col(c) for c in ("n", "n2", "i", "i2"))
    need = _overlap(t, n, n2)
    differ, half = F.col("bits").bitwiseXOR(F.col("bits2")), F.col("half").bitwiseXOR(F.col("half2"))
    # the parities of all tokens are those of one half and of the other, put together
    more = F.bit_count(half) + F.bit_count(differ.bitwiseXOR(half))
    return ((n2 * t.denominator >= n * t.numerator) & (n * t.denominator >= n2 * t.numerator)
            & (F.least(n - i, n2 - i2) + F.least(i, i2) >= need)
            & (F.coalesce(more, F.bit_count(differ)) <= n + n2 - 2 * need))


def _words(pairs: DataFrame, first: DataFrame, lines: DataFrame) -> DataFrame:
    """The words of the lines in ``pairs``."""
    asked = pairs.select(F.explode(F.array("id", "id2")).alias("id")).distinct()
    asked = first.select("id", "at", "f1", "f2").join(asked.hint("shuffle_hash"), "id")
    words = lines.join(asked.hint("shuffle_hash"), "at").select("id", "at", "f1", "f2", _low(F.col("line")).alias("low"))
    # rows of one id are one document, and may have other lines at this place
    words = words.where((F.xxhash64("low").bitwiseXOR(F.col("f1")) == 0)
                        & (F.xxhash64("low", F.lit(1)).bitwiseXOR(F.col("f2")) == 0))
    return words.select("id", "at", _tokens(F.col("low")).alias("w"))


def _verified(pairs: DataFrame, words: DataFrame, t: Fraction) -> DataFrame:
    """Pairs whose token sets reach the threshold, the first line being later."""
    got = pairs.join(words, "id").join(words.toDF("id2", "at2", "w2"), "id2").where("at2 < at")
    both = F.size(F.array_intersect("w", "w2"))
    return got.where(both * t.denominator >= (F.size("w") + F.size("w2") - both) * t.numerator)


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        threshold: float = 0.8, min_tokens: int = 5,
                        removed_col: str = "n_lines_removed", row_col: str | None = None) -> DataFrame:
    """``df`` with later matching lines taken out of ``text_col`` and
    ``removed_col`` (how many of the row's lines) added, with underscores
    after its name where that is taken.

    ``row_col``: a number of its own for each row, the same in every scan."""
    at, own = place(df, text_col), F.col(f"c{place(df, row_col or id_col)}").cast("long")
    lines = numbered(df).select(F.col(f"c{place(df, id_col)}").cast("long").alias("doc_id"),
                                *([own.alias("row")] if row_col else []),
                                F.posexplode(F.split(f"c{at}", "\n")).alias("line_no", "line"))
    gone = (duplicate_lines(lines, threshold, min_tokens).groupBy(F.col("row" if row_col else "doc_id").alias("own"))
            .agg(F.collect_set("line_no").alias("gone")))
    rows = numbered(df).withColumn("own", own)
    both = rows.join(gone.withColumnRenamed("own", "of").hint("shuffle_hash"), F.col("own") == F.col("of") if row_col
                     else F.col("own").eqNullSafe(F.col("of")), "left")
    t = F.col(f"c{at}")
    # the lines are bound to a name, else they would be split again for each line that stays
    text = F.when(F.col("gone").isNull() | t.isNull(), t).otherwise(F.get(F.transform(
        F.array(F.split(t, "\n")), lambda s: F.array_join(F.transform(F.array_except(
            F.sequence(F.lit(0), F.size(s) - 1), "gone"), lambda i: F.get(s, i)), "\n")), 0))
    return both.select(*[(text if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(df.columns)],
                       F.when(t.isNull(), 0).otherwise(F.coalesce(F.size(F.col("gone")), F.lit(0))).alias(
                           free_name(removed_col, df.columns)))
