"""Token ids, Simple-8b, token files and packing against the library and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scorewell.llm import simple8b
from scorewell.llm.packing import fill, pack_documents
from scorewell.llm.token_files import read_token_files, write_token_files
from scorewell.llm.tokens import TextEncoder, load_spec
from scorewell.session import scratch_path

SF = "/root/testdata/sf0.001"
NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = ["", None, " ", "a", "it's  we'll\n\n x", " a \n\nb   c", "é ́x",
       "a<|endoftext|>b <|startoftext|>", "\t\x1c\x1dq\x85z", "日本語 テスト", "x" * 5000,
       "  lead and trail  ", "ÀÉÎ İstanbul ǅ", "12 345,6", "\U0001f600 ok\r\nnew",
       "straße Élan, ÿ. Œuvre ñandú!? naïve; Ωμέγα: ÀB don't l'été e\u0301te\u0301"]


@pytest.mark.parametrize("name", NAMES)
def test_ids_equal_the_library_on_whole_texts(spark, name):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    spec = load_spec(public_tokenizers.path(name))
    enc, tok = TextEncoder(spec, keep=500), Tokenizer.from_str(spec)
    assert enc.mode != "whole"
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]
    assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t  ab'sé1.́\x1c", max_size=12), max_size=4))
def test_ids_equal_the_library_on_odd_white_space(texts):
    for name in NAMES:
        tok = _lib(name)
        got = [np.frombuffer(x, "<u4").tolist() for x in _encoder(name).encode(texts)]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


_SPECS: dict = {}


def _spec(name):
    if name not in _SPECS:
        _SPECS[name] = load_spec(public_tokenizers.path(name))
    return _SPECS[name]


def _encoder(name):
    if ("enc", name) not in _SPECS:
        _SPECS["enc", name] = TextEncoder(_spec(name))
    return _SPECS["enc", name]


def _lib(name):
    if ("lib", name) not in _SPECS:
        _SPECS["lib", name] = Tokenizer.from_str(_spec(name))
    return _SPECS["lib", name]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 70000), st.integers(0, 2**64 - 1)),
                max_size=300))
def test_simple8b_round_trip(values):
    words, escapes = simple8b.pack(np.array(values, np.uint64))
    assert simple8b.unpack(words, escapes).tolist() == values


def test_simple8b_uses_wide_words_for_small_values():
    words, escapes = simple8b.pack(np.ones(600, np.uint64))
    assert len(words) == 10 and not len(escapes)


def _expected(rows, name, end):
    tok = _lib(name)
    out = {}
    for key, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end]
        out.setdefault(key, []).append(ids)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (3, "b c"), (None, "no key"),
                                                  (99, "w " * 9000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "doc_id long, text string, shard string, ids string")
    return rows, df


def test_token_files(spark, docs):
    rows, df = docs
    path = scratch_path(spark, "t")
    write_token_files(df, path, _spec(NAMES[1]), 2, block_ids=50)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    want = _expected(rows, NAMES[1], 2)
    assert len(got) == len(rows) and got[0].doc_id is None
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        assert np.frombuffer(r.ids, "<u4").tolist() in want[r.doc_id]
        at += r.n_tokens
    keys = [r.doc_id for r in got[1:]]
    assert keys == sorted(keys)


def test_token_files_of_an_empty_table(spark, docs):
    path = scratch_path(spark, "t")
    write_token_files(docs[1].limit(0), path, _spec(NAMES[1]), 2)
    assert read_token_files(spark, path).count() == 0


def _best(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fill_reaches_the_best_sum(counts, room):
    taken = fill(sorted(counts), counts.__getitem__, room)
    assert all(0 < n <= counts[k] for k, n in taken.items())
    assert sum(k * n for k, n in taken.items()) == _best(counts, room)


def check_packing(rows, pieces, name, end, capacity):
    docs = {}
    for p in pieces:
        docs.setdefault(p.doc_id, []).append(p)
        assert p.length * 4 == len(p.ids) and p.length > 0
    want = _expected(rows, name, end)
    assert docs.keys() == want.keys()
    for key, texts in want.items():
        if len(texts) == 1:
            got = sorted(docs[key], key=lambda p: p.start)
            assert np.frombuffer(b"".join(p.ids for p in got), "<u4").tolist() == texts[0]
            assert [p.start for p in got] == np.cumsum([0] + [p.length for p in got])[:-1].tolist()
            assert {p.doc_tokens for p in got} == {len(texts[0])}
        assert sum(p.length for p in docs[key]) == sum(map(len, texts))
    seqs, padding = {}, 0
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append(p)
    for ps in seqs.values():
        ps.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in ps])
        assert [p.offset for p in ps] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else capacity - ends[-1]
    return padding


@pytest.mark.parametrize("capacity,pool", [(2048, 1 << 20), (64, 500), (100, 1), (1, 10)])
def test_packing(spark, docs, capacity, pool):
    rows, df = docs
    pieces = pack_documents(df, _spec(NAMES[0]), 1, capacity, pool_ids=pool).collect()
    waste = check_packing(rows, pieces, NAMES[0], 1, capacity)
    assert waste == 0


def test_packing_of_an_empty_table(spark, docs):
    assert pack_documents(docs[1].limit(0), _spec(NAMES[0]), 1).count() == 0


def test_op7_and_op9_over_whole_tables(spark):
    from scorewell.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = _expected(rows, NAMES[1], 2)
    at = 0
    for r in sorted(QUERIES["op9_token_files"](spark, SF).collect(), key=lambda r: r.doc_id):
        ids = np.array(want[r.doc_id][0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    want = _expected(rows, NAMES[0], 1)
    pieces = QUERIES["op7_packing"](spark, SF).collect()
    for p in pieces:
        ids = np.array(want[p.doc_id][0][p.start:p.start + p.length], "<u4")
        assert p.ids_crc32 == zlib.crc32(ids.tobytes())
    assert sum(p.length for p in pieces) == sum(len(v[0]) for v in want.values())
