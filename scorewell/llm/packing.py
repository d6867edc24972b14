"""Packing documents into fixed windows by minimum bin slack.

A document's ids are cut into full windows and a remainder.  Remainders wait
in a pool of bounded size per task, as a multiset of lengths.  Each window
starts with the longest remainder left; a bitset dynamic program over the
other lengths (bit s: some sub-multiset sums to s) finds the sum closest to
the room that is left, and walking the stored bitsets back gives how many of
each length to take.  What the last windows of a task lack is filled by
cutting a remainder; the end of a task's stream is cut at powers of two,
which need no padding.

Packing is local to a task: no shuffle, no driver step, and a lost task
gives the same windows again because a scan's rows come in the same order.

Edge cases: a null or empty text is the end id alone; null keys are packed
like others; repeated rows are packed as often as they occur; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from scorewell.llm.common import two_columns
from scorewell.llm.tokens import text_encoder
from scorewell.session import ship_package

PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
                "offset long, ids binary")


def fill(lengths: list[int], copies: Callable[[int], int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to
    ``room`` as any sub-multiset comes, without going over it.

    ``lengths``: the different lengths, ascending; ``copies`` gives how many
    there are of one.  The longest lengths are tried first and the search
    ends once ``room`` itself is reached.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[at]
        before, left, part = reach, min(copies(length), room // length), 1
        while left:  # up to `left` copies, by shifts of 1, 2, 4, ... of them
            part = min(part, left)
            reach |= reach << (part * length) & mask
            left -= part
            part *= 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            taken[length] = n
    return taken


class Packer:
    """Windows from a stream of remainders: ``(doc, start, ids)`` pieces."""

    def __init__(self, capacity: int, pool_ids: int):
        self.capacity, self.pool_ids = capacity, pool_ids
        self.pool: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []  # keys of the pool, ascending
        self.held = 0

    def add(self, doc, start: int, ids: bytes) -> None:
        length = len(ids) // 4
        if length not in self.pool:
            self.pool[length] = []
            insort(self.lengths, length)
        self.pool[length].append((doc, start, ids))
        self.held += length

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.held -= length
        return piece

    def _window(self) -> list[tuple]:
        first = self.lengths[-1]
        window = [self._take(first)]
        taken = fill(self.lengths, lambda x: len(self.pool[x]), self.capacity - first)
        for length, n in taken.items():
            window += [self._take(length) for _ in range(n)]
        return window

    def full(self) -> bool:
        return self.held >= self.pool_ids

    def windows(self, last: bool) -> Iterator[list[tuple]]:
        """Windows until half of the pool is left, or all of it if ``last``."""
        while self.pool and (last or self.held > self.pool_ids // 2):
            window = self._window()
            slack = self.capacity - sum(len(x[2]) // 4 for x in window)
            while slack and self.pool:  # every length left is longer than the slack
                doc, start, ids = self._take(self.lengths[0])
                window.append((doc, start, ids[:4 * slack]))
                self.add(doc, start + slack, ids[4 * slack:])
                slack = 0
            if slack:  # the last pieces of all: sequences of 2**k ids, longest first
                yield from _by_powers(window, self.capacity)
            else:
                yield window


def _by_powers(pieces: list[tuple], capacity: int) -> Iterator[list[tuple]]:
    rest = sum(len(x[2]) // 4 for x in pieces)
    pieces = pieces[::-1]
    while rest:
        size = min(1 << (rest.bit_length() - 1), capacity)
        window, room = [], size
        while room:
            doc, start, ids = pieces.pop()
            n = min(len(ids) // 4, room)
            window.append((doc, start, ids[:4 * n]))
            if 4 * n < len(ids):
                pieces.append((doc, start + n, ids[4 * n:]))
            room -= n
        rest -= size
        yield window


def _pack(batches: Iterator[pa.RecordBatch], spec: str, end_id: int, capacity: int,
          pool_ids: int) -> Iterator[pa.RecordBatch]:
    enc, end = text_encoder(spec), np.array([end_id], "<u4").tobytes()
    packer = Packer(capacity, pool_ids)
    seq = TaskContext.get().partitionId() << 40  # 2**40 sequences a task
    rows: list[tuple] = []

    def emit() -> pa.RecordBatch:
        cols = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(cols[6], pa.binary())],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    def put(window: list[tuple]) -> None:
        nonlocal seq
        at = 0
        for (key, total), start, ids in window:
            n = len(ids) // 4
            rows.append((key, start, n, total, seq, at, ids))
            at += n
        seq += 1

    for b in batches:
        for lo in range(0, b.num_rows, 512):
            cut = b.slice(lo, 512)
            for key, ids in zip(cut.column(0).to_pylist(), enc.encode(cut.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                doc, whole = (key, total), total // capacity * capacity
                for s in range(0, whole, capacity):
                    put([(doc, s, ids[4 * s:4 * (s + capacity)])])
                if whole < total:
                    packer.add(doc, whole, ids[4 * whole:])
                if packer.full():
                    for window in packer.windows(last=False):
                        put(window)
                if len(rows) >= 2000:
                    yield emit()
    for window in packer.windows(last=True):
        put(window)
        if len(rows) >= 2000:
            yield emit()
    if rows:
        yield emit()


def pack_documents(df: DataFrame, spec: str, end_id: int, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text",
                   pool_ids: int = 1 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset and ids (little-endian unsigned 32-bit).

    ``pool_ids`` bounds what a task holds back before it builds windows; it
    changes which pieces meet, never which ids are packed.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    ship_package(df.sparkSession)
    two = two_columns(df, id_col, text_col)
    return two.select(two.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(
        lambda it: _pack(it, spec, end_id, capacity, pool_ids), PIECE_SCHEMA)
