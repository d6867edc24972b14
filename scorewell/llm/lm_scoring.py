"""Language-model scores from a weighted backoff automaton of order three.

Model.  The training documents' n-grams (n = 1, 2, 3; one end per document, a
start before it that is not a token) are counted.  A word seen c > 0 times has
probability (c - D) / N; the mass D * V / N so freed goes to all unseen words
together (D from the numbers of words seen once and twice).  After a history h
of one or two words, seen c(h) times:

    P(w | h) = (c(h, w) + K * P(w | h without its first word)) / (c(h) + K)

K, one for each length of h, is the number of n-grams seen once for each
history of that length.  Each of these distributions sums to one.

Automaton.  States are the root, each seen word (the start counts as one) and
each seen pair.  A state has an arc for each word seen after it, of weight
P(w | h), and one failure arc of weight K / (c(h) + K) to the state of its
last word, or from there to the root; the root has an arc for every word,
the unseen ones included.  Reading w in a state follows failure arcs, adding
their log weights, to the first state with an arc for w, adds that arc's, and
goes on in the longest stored suffix of what was read: the pair if it is
stored, else the word, else the root.  As that suffix depends on the last two
words only, a block's states are laid out from left to right at once and all
its positions take their failure arcs together, two steps at most.

Sharded counts.  The model grows with the corpus and is never held whole.
Documents come in blocks of consecutive rows of a file.  A block sends the
sorted distinct hashes of its n-grams with its training counts, cut by hash
range, to the shards; a shard adds up the counts of all blocks and sends each
block the totals of the keys it asked about, in order.  An n-gram is one entry
a block, however frequent, so shards stay even.  Where a block's rows are read
by two tasks each asks for its own rows; an answer says which rows it is for, so
scores do not depend on how the scan was split, then or when it is read again.

Edge cases: null and empty texts are the end alone; a null id counts as the
empty text for choosing training documents; repeated rows count as often as
they occur; with no training documents every token is unseen with
probability one for ``score`` and 1 / (0 + 0 + 1) for ``base_score``; scores
are finite whatever repeats; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import byte_words, free_name, numbered, place, with_row_key
from scorewell.session import scratch_path, ship_package

_U = np.uint64
#: Hashes of the end of a document and of the state it starts in.
_END, _START = _U(0xD1B54A32D192ED03), _U(0x2545F4914F6CDD1D)
SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                "score double")
WORDS, PAIRS, TRIPLES = KINDS = 0, 1, 2
_COUNTS = ("total", "distinct", "once", "twice")
_ASK = "shard long, kind int, block long, first long, rows int, keys binary, counts binary"
_ANSWER = ("block long, first long, rows int, kind int, shard long, totals binary, "
           + ", ".join(f"{c} long" for c in _COUNTS))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def held_out(doc_id: int | None, fold: int = 2, folds: int = 7) -> bool:
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % folds == fold


def _mix(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (history * _U(0x9E3779B97F4A7C15) + (word ^ (word >> _U(31)))) * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(30)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _before(x: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """What stands one place earlier, ``start`` at the first places of documents."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = start
    return out


class Block:
    """Tokens of some documents, with their distinct n-grams."""

    def __init__(self, ids: list, texts: list[str | None]):
        parts, length = [], np.empty(len(ids), np.int64)
        for i, text in enumerate(texts):
            words = byte_words(text)
            length[i] = len(words) + 1
            parts.append(np.fromiter(map(_HASHES.__getitem__, words), _U, len(words)))
            parts.append(np.array([_END]))
        tokens = np.concatenate(parts)
        self.ids, self.length = ids, length
        self.first = np.cumsum(length) - length
        self.out = np.array([held_out(i) for i in ids])
        train = np.repeat(~self.out, length)
        pairs = _mix(_before(tokens, self.first, _START), tokens)
        triples = _mix(_before(pairs, self.first, _START), tokens)
        later = train.copy()  # a first word has no history of two, so its triple never counts
        later[self.first] = False
        self.keys, self.place, self.at, self.counts = [], [], [], []
        for key, counted in ((tokens, train), (pairs, train), (triples, later)):
            keys, place = np.unique(key, return_inverse=True)
            at = np.empty(len(keys), np.int64)  # a position of each
            at[place] = np.arange(len(key))
            self.keys.append(keys)
            self.place.append(place)
            self.at.append(at)
            self.counts.append(np.bincount(place[counted], minlength=len(keys)))

    def scores(self, totals: list[np.ndarray], s: dict) -> tuple[np.ndarray, ...]:
        """(n_known, base, score) per document from the totals of all keys."""
        n, v = s[WORDS, "total"], s[WORDS, "distinct"]
        c = totals[WORDS][self.place[WORDS]]
        base = np.log10((c + 1.0) / (n + v + 1.0))
        score = Automaton(self, totals, s).walk() if n else np.zeros(len(c))
        add = lambda x: np.add.reduceat(x, self.first)
        return add((c > 0).astype(np.int64)), add(base), add(score)


class Automaton:
    """The part of the automaton that a block's texts reach.

    ``arc[n]``: log10 weights of the arcs that the n-th kind of n-grams are
    (NaN: not stored); ``state[n]``: for each position the number of the state
    of n words it may be read in (-1: not stored), and ``fail[n]`` the log10
    weights of those states' failure arcs.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], s: dict):
        self.place = block.place
        n, v = s[WORDS, "total"], s[WORDS, "distinct"]
        # above 0 whatever repeats, so that unseen words keep a share
        d = (s[WORDS, "once"] + 1.0) / (s[WORDS, "once"] + 2.0 * s[WORDS, "twice"] + 2.0)
        weight = np.where(totals[WORDS] > 0, np.maximum(totals[WORDS] - d, 0) / n, d * v / n)
        self.arc, self.state, self.fail = [np.log10(weight)], [None], [None]
        for kind in (PAIRS, TRIPLES):
            k = (s[kind, "once"] + 1.0) / (s[kind - 1, "distinct"] + 1.0)
            # states of this length; the last is the start, which only words have
            seen = np.append(totals[kind - 1], s["documents"] if kind == PAIRS else 0)
            state = _before(block.place[kind - 1], block.first, len(seen) - 1)
            at, total = block.at[kind], totals[kind]
            shorter = weight[block.place[kind - 1][at]]
            with np.errstate(divide="ignore"):
                weight = np.where(total > 0, (total + k * shorter) / (seen[state[at]] + k), np.nan)
                self.fail.append(np.log10(k / (seen + k)))
            self.arc.append(np.log10(weight))
            self.state.append(np.where(seen[state] > 0, state, -1))

    def walk(self) -> np.ndarray:
        """log10 weight of the path that reads each word."""
        total = np.zeros(len(self.place[WORDS]))
        going = np.arange(len(total))  # positions whose word is not read yet
        for kind in (TRIPLES, PAIRS):
            state = self.state[kind][going]
            arc = np.where(state >= 0, self.arc[kind][self.place[kind][going]], np.nan)
            read = ~np.isnan(arc)
            total[going[read]] += arc[read]
            failed = ~read & (state >= 0)
            total[going[failed]] += self.fail[kind][state[failed]]
            going = going[~read]
        total[going] += self.arc[WORDS][self.place[WORDS][going]]
        return total


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers as byte planes, as many as the largest needs."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Block]]:
    """(block, key of its first row, rows) of a partition; rows of one block
    follow each other."""
    at, first, ids, texts = None, None, [], []
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            for block, key, i, text in zip(*(c.to_pylist() for c in b.slice(lo, 256).columns)):
                if block != at and ids:
                    yield at, first, Block(ids, texts)
                    ids, texts = [], []
                if not ids:
                    at, first = block, key
                ids.append(i)
                texts.append(text)
    if ids:
        yield at, first, Block(ids, texts)


def _ask(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    edges = np.array([(i << 64) // shards for i in range(shards)], _U)
    for block, first, b in _blocks(batches):
        for kind in KINDS:
            keys, counts = b.keys[kind], b.counts[kind]
            cut = [*np.searchsorted(keys, edges), len(keys)]
            rows = [(s, lo, hi) for s, (lo, hi) in enumerate(zip(cut, cut[1:])) if lo < hi]
            steps = [np.diff(keys[lo:hi], prepend=edges[s]) for s, lo, hi in rows]
            k = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _, _ in rows], pa.int64()), pa.array([kind] * k, pa.int32()),
                 pa.array([block] * k, pa.int64()), pa.array([first] * k, pa.int64()),
                 pa.array([len(b.ids)] * k, pa.int32()),
                 pa.array([_pack(x) for x in steps], pa.binary()),
                 pa.array([_pack(counts[lo:hi]) for _, lo, hi in rows], pa.binary())],
                names=["shard", "kind", "block", "first", "rows", "keys", "counts"])


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one shard's keys for each block that asked, and a row of counts
    of the shard (block null)."""
    asked = table.num_rows
    # cumulated from the shard's lower edge, which all its blocks share
    keys = [np.cumsum(_unpack(x), dtype=_U) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([_unpack(x) for x in table.column("counts").to_pylist()])
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=counts).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    back = [_pack(total[place[e - len(k):e]]) for k, e in zip(keys, ends)]
    numbers = (total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum())
    of_all = lambda name: table.column(name)[0].as_py()
    return pa.table({
        **{c: pa.array([*table.column(c).to_pylist(), None], t)
           for c, t in (("block", pa.int64()), ("first", pa.int64()), ("rows", pa.int32()))},
        "kind": pa.array([of_all("kind")] * (asked + 1), pa.int32()),
        "shard": pa.array([of_all("shard")] * (asked + 1), pa.int64()),
        "totals": pa.array([*back, None], pa.binary()),
        **{c: pa.array([None] * asked + [int(x)], pa.int64()) for c, x in zip(_COUNTS, numbers)}})


def _score(docs: pa.Table, answers: pa.Table, stats: dict) -> pa.Table:
    """Scores of one block: its rows in file order, cut as they were asked for."""
    docs, answers, out = docs.sort_by("key"), answers.sort_by("shard"), []
    keys = docs.column("key").to_numpy()
    for first, rows in sorted({*zip(answers.column("first").to_pylist(), answers.column("rows").to_pylist())}):
        part = docs.slice(int(np.searchsorted(keys, first)), rows)
        mine = answers.filter(pa.compute.equal(answers.column("first"), first))
        b = Block(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
        totals = []
        for kind in KINDS:
            some = mine.filter(pa.compute.equal(mine.column("kind"), kind))
            totals.append(np.concatenate([_unpack(x) for x in some.column("totals").to_pylist()]
                                         ).astype(np.int64))
            if len(totals[-1]) != len(b.keys[kind]):
                raise ValueError("the table changed while it was read")
        known, base, score = b.scores(totals, stats)
        out.append(pa.table({
            "doc_id": pa.array(b.ids, pa.int64()), "held_out": pa.array(b.out, pa.bool_()),
            "n_tokens": pa.array(b.length, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())}))
    return pa.concat_tables(out)


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_rows: int = 1024, shard_chars: int = 12 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10 probability of the whole text) per row."""
    spark = df.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "lm")
    key = free_name("row", df.columns)
    keyed = with_row_key(df, key)
    docs = numbered(keyed).select(F.col(f"c{place(df, id_col)}").cast("long").alias("doc_id"),
                                  F.col(f"c{place(df, text_col)}").alias("text"),
                                  F.col(f"c{len(df.columns)}").alias("key"))
    docs = docs.select(F.expr(f"key div {int(block_rows)}").alias("block"), "key", "doc_id", "text")
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_chars))
    (docs.mapInArrow(lambda it: _ask(it, shards), _ASK).groupBy("shard", "kind")
     .applyInArrow(_answer, _ANSWER).write.parquet(f"{root}/answers"))
    answers = spark.read.parquet(f"{root}/answers")
    stats = {(kind, c): 0 for kind in KINDS for c in _COUNTS}
    for r in answers.where("block is null").groupBy("kind").agg(*[F.sum(c).alias(c) for c in _COUNTS]).collect():
        stats.update({(r.kind, c): r[c] for c in _COUNTS})
    stats["documents"] = docs.where(~_held_out(F.col("doc_id"))).count()
    asked = answers.where("block is not null").select("block", "first", "rows", "kind", "shard", "totals")
    scored = docs.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        lambda d, a: _score(d, a, stats), SCORE_SCHEMA)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(stats[WORDS, "total"]).cast("long").alias("train_tokens"), "base_score", "score")


def _held_out(i):
    return F.crc32(F.coalesce(i.cast("string"), F.lit(""))) % 7 == 2
