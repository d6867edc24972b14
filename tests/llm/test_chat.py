"""The prefix tree against a plain walk over the conversations."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scorewell.llm import chat
from scorewell.llm.queries import QUERIES
from scorewell.llm.tokens import load_spec

SF = "/root/testdata/sf0.001"
SPEC = load_spec(public_tokenizers.path("byte_bpe_50k.json"))
ODD = r"\### Assistant: </turn> ok"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="#a:\\ </turn>\n", max_size=8),
                          st.text(alphabet="# a\\</turn>\n:", max_size=14)), max_size=4))
def test_template_is_reversible(turns):
    text = "".join(chat.HEAD + chat.escape_role(r) + chat.AFTER_ROLE + chat.escape(t) + chat.END
                   for r, t in turns)
    assert chat.parse(text) == turns


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (
            r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def digest(turns):
    told = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    size = sum(len(chat.HEAD + chat.escape_role(r) + chat.AFTER_ROLE + chat.escape(t) + chat.END)
               for r, t in turns)
    return (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), size)


def test_op10_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)]
    want = {k: digest(v) for k, v in brute(rows).items()}
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op10_chat"](spark, SF).collect()}
    assert got == want


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "a"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "b"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "other"), (4, 0, "user", "hi"),
        (5, 0, "user", "hi"), (5, 1, "assistant", "hello"), (5, 2, "user", "a"),
        (6, None, None, None), (6, 1, "assistant", ""), (6, 1, "assistant", ""),
        (None, 0, "user", "x"), (7, 0, "a: b", ODD), (8, 0, "assistant", "long " * 20000),
        (9, 0, "user", "<|endoftext|> é\u0301 \U0001f600")] + [
    (c, i, "user", "x" if i < 300 or c == 20 else "y") for c in (20, 21) for i in range(400)]


def test_tree(spark):
    df = spark.createDataFrame([(*r, "n", 1) for r in ROWS],
                               "conv_id long, turn long, role string, text string, node string, ids int")
    chain, tree = chat.format_conversations(df, SPEC)
    nodes = {r.node: r for r in tree.collect()}
    want = brute(ROWS)
    assert len(nodes) == len({tuple(v[:i + 1]) for v in want.values() for i in range(len(v))})
    tok = Tokenizer.from_str(SPEC)
    order = sorted(nodes.values(), key=lambda r: r.start)
    at, stack = 0, []
    for r in order:  # depth-first: the parent is the last node of the stack at depth - 1
        assert r.start == at and len(r.ids) == 4 * r.n_ids
        stack = stack[:r.depth]
        assert (stack[-1].node if stack else None) == r.parent and len(stack) == r.depth
        spans = []
        for x in stack:  # adjoining intervals are one
            if spans and spans[-1][1] == x.start:
                spans[-1] = (spans[-1][0], x.start + x.n_ids)
            else:
                spans.append((x.start, x.start + x.n_ids))
        assert [tuple(x) for x in r.attends] == spans
        assert r.position == sum(s.n_ids for s in stack)
        stack.append(r)
        at += r.n_ids
    got = {r[0]: tuple(r[1:]) for r in chat.read_back(spark, chain, tree, SPEC).collect()}
    assert got == {k: digest(v) for k, v in want.items()}
    for r in chain.collect():
        n = nodes[r.node]
        text = tok.decode(np.frombuffer(n.ids, "<u4").tolist(), skip_special_tokens=False)
        assert chat.parse(text) == [(r.role, r.text)]
        assert (n.loss_end > n.loss_start) == (r.role == "assistant" and r.text != "")


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    chain, tree = chat.format_conversations(df, SPEC)
    assert tree.count() == 0 and chat.read_back(spark, chain, tree, SPEC).count() == 0
