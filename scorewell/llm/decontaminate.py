"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared with A-Z lower-cased and each run of ASCII white space as
one blank.  An item of m characters may be edited k = m // piece - 1 times
(0 at least): cut into k + 1 pieces of at least ``piece`` characters, one of
them must stand unedited in any text that holds the item with k edits or
fewer.  One Aho-Corasick automaton finds the exact hits of all pieces; the
text around a hit is then verified with Myers' bit-parallel distance, which
moves a whole column of the edit table in one step of integer operations.

Items come in blocks of bounded length, each one pass over the documents, so
what is sent to the tasks does not grow with the benchmark.

Items shorter than ``short`` characters must stand unedited and whole: where
the item and the text around it both go on with a letter or digit, it would be
part of a longer word and is not reported.  Scripts written without blanks
know no such bounds.

Edge cases: null and empty texts hold nothing; items without a word, null ones
included, are in no text; items with the same text are each reported; repeated document rows are reported as often as
they occur, repeated items with one id once; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import two_columns
from scorewell.session import scratch_path, ship_package

MATCH_SCHEMA = "doc_id long, item_id long, distance int, span_start long, span_end long"
#: Thai and Lao, Myanmar, Khmer; wide characters are known by their width.
UNSPACED = (("\u0e00", "\u0eff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(text: str | None) -> str:
    """A-Z lower-cased, words joined by single blanks."""
    return b" ".join(text.encode().lower().split()).decode() if text else ""


def budget(length: int, piece: int) -> int:
    """Edits allowed in an item of this many characters."""
    return max(length // piece - 1, 0)


def pieces(item: str, k: int) -> Iterator[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their places."""
    n = len(item)
    for i in range(k + 1):
        at, end = i * n // (k + 1), (i + 1) * n // (k + 1)
        yield at, item[at:end]


def _unspaced(c: str) -> bool:
    """Whether the script of this character is written without blanks."""
    return east_asian_width(c) in "WF" or any(lo <= c <= hi for lo, hi in UNSPACED)


def _bounded(text: str, lo: int, hi: int) -> bool:
    """Whether ``text[lo:hi]`` begins and ends with the words around it."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()
                   and not _unspaced(text[at - 1]) and not _unspaced(text[at]) for at in (lo, hi))


def myers(pattern: str, text: str, whole: bool = False) -> list[int]:
    """After each character of ``text``: the least number of edits between
    ``pattern`` and a part of the text that ends there (with ``whole``, and
    the text up to there)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, out = full, 0, m, []
    first = 1 if whole else 0
    get = masks.get
    for c in text:
        eq = get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 | first
        minus <<= 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
        out.append(score)
    return out


class Benchmark:
    """The items of one block with the automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]], piece: int, short: int = 24):
        import ahocorasick

        self.items, self.short = items, short
        self.k = [budget(len(t), piece) if len(t) >= short else 0 for _, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for at, part in pieces(text, self.k[i]):
                where.setdefault(part, []).append((i, at))
        self.found = ahocorasick.Automaton()
        for part, places in where.items():
            self.found.add_word(part, (len(part), places))
        if where:
            self.found.make_automaton()
        self.empty = not where

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) in a normal text: each item's best
        occurrence within its budget, the first of equals."""
        if self.empty:
            return
        # whole short items are reported as they come; for others, the places to verify
        near: dict[int, list[list[int]]] = {}
        seen: set[int] = set()
        for last, (length, places) in self.found.iter(text):
            for i, at in places:
                if len(self.items[i][1]) < self.short:
                    if i not in seen and _bounded(text, last + 1 - length, last + 1):
                        seen.add(i)
                        yield i, 0, last + 1 - length, last + 1
                    continue
                k = self.k[i]
                lo = max(last + 1 - length - at - k, 0)
                hi = min(last + 1 - length - at + len(self.items[i][1]) + k, len(text))
                spans = near.setdefault(i, [])
                if spans and lo <= spans[-1][1] and spans[-1][0] <= hi:
                    spans[-1][0], spans[-1][1] = min(lo, spans[-1][0]), max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
        for i, spans in near.items():
            best = None
            for lo, hi in spans:
                scores = myers(self.items[i][1], text[lo:hi])
                d = min(scores)
                if d <= self.k[i] and (best is None or (d, lo + scores.index(d)) < best[:2]):
                    best = (d, lo + scores.index(d), lo)
            if best:
                d, last, lo = best
                yield i, d, self._start(i, text[lo:last + 1], d) + lo, last + 1

    def _start(self, i: int, part: str, d: int) -> int:
        """Where the match that ends with ``part`` begins (the shortest one)."""
        back = myers(self.items[i][1][::-1], part[::-1], whole=True)
        return len(part) - 1 - back.index(d) if d in back else 0


def _spans(text: str, found: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Places in the normal text as places in the text itself."""
    words, at, place = [], 0, []
    for w in _WORD.finditer(text):
        words.append(w)
        place.append(at)
        at += w.end() - w.start() + 1
    from bisect import bisect_right
    for i, d, lo, hi in found:
        a, b = bisect_right(place, lo) - 1, bisect_right(place, hi - 1) - 1
        start = min(words[a].start() + lo - place[a], words[a].end())
        end = min(words[b].start() + hi - place[b], words[b].end())
        yield i, d, start, end


def _scan(batches: Iterator[pa.RecordBatch], items, piece: int, short: int) -> Iterator[pa.RecordBatch]:
    bench = Benchmark(items.value, piece, short)
    for b in batches:
        out: list[tuple] = []
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if text and (found := list(bench.matches(normal(text)))):
                out += [(key, bench.items[i][0], d, lo, hi) for i, d, lo, hi in _spans(text, found)]
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["doc_id", "item_id", "distance", "span_start", "span_end"])


def _blocks(bench: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most ``block_chars`` characters, or one item."""
    block, held = [], 0
    for r in bench.orderBy("doc_id", "text").toLocalIterator():
        text = normal(r.text)
        if not text:
            continue
        if block and held + len(text) > block_chars:
            yield block
            block, held = [], 0
        block.append((r.doc_id, text))
        held += len(text)
    if block:
        yield block


def find_benchmark(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", piece: int = 16,
                   short: int = 24, block_chars: int = 1 << 20) -> DataFrame:
    """One row per document row and item it holds: doc_id, item_id, distance
    and the span of the best occurrence (characters of the whole text)."""
    spark = docs.sparkSession
    ship_package(spark)
    two = two_columns(docs, id_col, text_col)
    two = two.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = two_columns(bench, item_col, item_text_col).distinct()
    path, some = scratch_path(spark, "benchmark"), False
    for block in _blocks(items.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                         block_chars):
        sent = spark.sparkContext.broadcast(block)
        found = two.mapInArrow(lambda it, s=sent: _scan(it, s, piece, short), MATCH_SCHEMA)
        found.write.mode("append").parquet(path)
        sent.destroy()
        some = True
    return spark.read.schema(MATCH_SCHEMA).parquet(path) if some else spark.createDataFrame(
        [], MATCH_SCHEMA)
