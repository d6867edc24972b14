"""Chat formatting as a prefix tree of turns.

Template of a turn: ``### <role>: <text> </turn>\n`` with role and text
escaped, so that no control string of the template can occur inside them:
a backslash is put before every backslash, ``###`` and ``</turn>``, and in a
role also before ``:``.  Unescaping drops it again; the first unescaped
``: `` ends a role and the first unescaped `` </turn>`` a text.

Tree: a node is a turn together with all turns before it, named by a chained
SHA-256, so conversations that share initial turns share nodes.  Each node's
tokens are made and emitted once.  Sorting the nodes by the names of their
ancestors that have siblings, then by depth, puts the forest depth-first; a
running sum of token counts over that order gives each node its place in the
emitted stream.  Position ids count along the path from the root, not along
the stream, and a token attends to its own node up to itself and to the
stream intervals of its ancestors, adjoining ones as one.  A node's names and
intervals are worked out along one conversation that holds it, so a long
conversation costs its length, not the square of it.

The loss mask covers the text of assistant turns.

Nodes are aggregated from distinct (name, turn) rows, so a first turn shared
by a third of all conversations is one row per task before the shuffle.

Edge cases: a null role or text is empty; turns are ordered by turn (null
first), then role and text, and repeated rows are turns of their own; rows
without a conversation id belong to one conversation with a null id; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewell.llm.common import numbered, place
from scorewell.llm.tokens import text_encoder
from scorewell.session import scratch_path, ship_package

# Fixed values of the template.
HEAD, AFTER_ROLE, END = "### ", ": ", " </turn>\n"
ASSISTANT = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*): "
                   r"((?:[^\\<]|<(?!/turn>)|\\(?:\\|###|</turn>))*) </turn>\n")

NODE_SCHEMA = ("node string, parent string, depth int, owner long, ids binary, n_ids long, "
               "loss_start long, loss_end long")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per turn of each conversation, with the chained names."""
    for b in batches:
        out: list[tuple] = []
        for conv, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parent = ""
            for depth, t in enumerate(turns):
                part = "".join(f"{len(x.encode())}:{x}" for x in (t["role"], t["text"]))
                node = hashlib.sha256(f"{parent}\n{part}".encode()).hexdigest()
                out.append((conv, depth, node, parent or None, t["role"], t["text"]))
                parent = node
                if len(out) >= 5000:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), *[pa.string()] * 4)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["conv_id", "depth", "node", "parent", "role", "text"])


def turn_chain(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
               role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, depth, node, parent, role, text: each turn and its tree node."""
    ship_package(df.sparkSession)
    conv, turn, role, text = (F.col(f"c{place(df, c)}") for c in (conv_col, turn_col, role_col, text_col))
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    turns = numbered(df).select(conv.cast("long").alias("conv_id"), F.struct(
        turn.cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return talks.mapInArrow(_chain, "conv_id long, depth int, node string, parent string, "
                                    "role string, text string")


def _tokens(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    enc = text_encoder(spec)
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            rows = b.slice(lo, 512).to_pylist()
            three = enc.encode([x for r in rows for x in (
                HEAD + escape_role(r["role"]) + AFTER_ROLE, escape(r["text"]), END)])
            ids, start, end = [], [], []
            for i, r in enumerate(rows):
                head, text, tail = three[3 * i:3 * i + 3]
                ids.append(head + text + tail)
                start.append(len(head) // 4)
                end.append((len(head) + len(text) if r["role"] == ASSISTANT else len(head)) // 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in (
                    ("node", pa.string()), ("parent", pa.string()), ("depth", pa.int32()),
                    ("owner", pa.int64()))]
                + [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                   pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                names=["node", "parent", "depth", "owner", "ids", "n_ids", "loss_start", "loss_end"])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of n_ids over the earlier rows of the partition (rows are sorted)."""
    at = 0
    for b in batches:
        n = np.asarray(b.column(b.schema.get_field_index("n_ids")))
        ends = at + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends - n, pa.int64())],
                                         names=[*b.schema.names, "before"])
        at = int(ends[-1]) if len(ends) else at


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort keys of the nodes a conversation owns."""
    for b in batches:
        out = []
        for conv, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            path = ""
            for t in turns:
                path += t["node"][:16] if t["branch"] else ""
                if t["owner"] == conv:
                    out.append((t["node"], path, t["depth"], t["n_ids"]))
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int64()))],
            names=["node", "path", "depth", "n_ids"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and attended intervals of the nodes a conversation owns."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        out = []
        for conv, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            above: list[dict] = []
            position = 0
            for t in turns:
                if t["owner"] == conv:
                    out.append((t["node"], t["start"], position, [dict(x) for x in above]))
                end = t["start"] + t["n_ids"]
                if above and above[-1]["end"] == t["start"]:
                    above[-1]["end"] = end
                else:
                    above.append({"start": t["start"], "end": end})
                position += t["n_ids"]
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), kind))],
            names=["node", "start", "position", "attends"])


def prefix_tree(chain: DataFrame, path: str, spec: str) -> DataFrame:
    """The forest of ``chain`` written to ``path`` and read back, one row per node:

    node, parent, depth, owner (smallest conv_id that holds it), ids
    (little-endian unsigned 32-bit), n_ids, loss_start and loss_end (in the
    node's ids), start (place of its first id in the depth-first stream),
    position (position id of its first id) and attends (stream intervals
    [start, end) of its ancestors, in order).
    """
    spark = chain.sparkSession
    one = chain.groupBy("node").agg(*[F.min(c).alias(c) for c in ("parent", "depth", "role", "text")],
                                    F.min("conv_id").alias("owner"))
    one.select("node", "parent", "depth", "owner", "role", "text").mapInArrow(
        lambda it: _tokens(it, spec), NODE_SCHEMA).write.parquet(f"{path}/tokens")
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/tokens")
    forks = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    info = nodes.select("node", "owner", "n_ids", "parent").join(
        forks.select("parent", F.lit(True).alias("fork")), "parent", "left").select(
        "node", "owner", "n_ids", (F.col("parent").isNull() | F.coalesce("fork", F.lit(False))).alias("branch"))
    turns = chain.select("conv_id", "depth", "node")

    def along(columns: DataFrame) -> DataFrame:
        """Each conversation with its nodes in order; null conversations own nodes of null owners."""
        rows = turns.join(columns, "node").withColumn("owner", F.coalesce("owner", "conv_id"))
        names = ["depth", *[c for c in rows.columns if c not in ("depth", "conv_id")]]
        return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("turns"))
    along(info).mapInArrow(_paths, "node string, path string, depth int, n_ids long").write.parquet(
        f"{path}/paths")
    keyed = spark.read.parquet(f"{path}/paths").dropDuplicates(["node"])
    order = (keyed.repartitionByRange("path", "depth").sortWithinPartitions("path", "depth")
             .select("node", "n_ids", F.spark_partition_id().alias("part")))
    order.mapInArrow(_running, "node string, n_ids long, part int, before long").write.parquet(f"{path}/order")
    order = spark.read.parquet(f"{path}/order")
    # one row per write task of the line above, so no more rows than it had partitions
    parts = order.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    placed = order.join(F.broadcast(parts), "part").select(
        "node", "n_ids", (F.col("base") + F.col("before")).alias("start"))
    placed = placed.join(nodes.select("node", "owner"), "node")
    along(placed).mapInArrow(
        _spans, "node string, start long, position long, attends array<struct<start:bigint,end:bigint>>"
    ).dropDuplicates(["node"]).write.parquet(f"{path}/spans")
    nodes.join(spark.read.parquet(f"{path}/spans"), "node").write.parquet(f"{path}/tree")
    return spark.read.parquet(f"{path}/tree")


def _read(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec)

    def text(ids: bytes) -> str:
        return tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)

    for b in batches:
        out: list[tuple] = []
        for r in b.to_pylist():
            turns = parse(formatted := "".join(text(n["ids"]) for n in r["nodes"]))
            loss = "".join(unescape(text(n["ids"][4 * n["loss_start"]:4 * n["loss_end"]]))
                           for n in r["nodes"])
            told = "".join(f"{role}\n{said}\n" for role, said in turns)
            out.append((r["conv_id"], len(turns), hashlib.sha256(told.encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        cols = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if i in (2, 4) else pa.int64()) for i, c in enumerate(cols)],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(spark: SparkSession, chain: DataFrame, tree: DataFrame, spec: str) -> DataFrame:
    """Every conversation put together again from the emitted nodes and parsed."""
    ship_package(spark)
    node = F.struct("depth", "ids", "loss_start", "loss_end")
    talks = (chain.select("conv_id", "node")
             .join(tree.select("node", "depth", "ids", "loss_start", "loss_end"), "node")
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(node)).alias("nodes")))
    return talks.select("conv_id", "nodes").mapInArrow(
        lambda it: _read(it, spec), "conv_id long, n_turns long, turns_sha256 string, "
                                    "loss_chars long, loss_sha256 string, formatted_chars long")


def format_conversations(df: DataFrame, spec: str, path: str | None = None,
                         **columns: str) -> tuple[DataFrame, DataFrame]:
    """(chain, tree) of a table of turns; see ``turn_chain`` and ``prefix_tree``."""
    path = path or scratch_path(df.sparkSession, "chat")
    turn_chain(df, **columns).write.parquet(f"{path}/chain")
    chain = df.sparkSession.read.parquet(f"{path}/chain")
    return chain, prefix_tree(chain, path, spec)


def control_conversation(spark: SparkSession, conv_id: int, text: str) -> DataFrame:
    """A user and an assistant turn that both say ``text``."""
    return spark.range(2).select(
        F.lit(conv_id).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit(text).alias("text"))
