"""Every stage of the pipeline against brute force on what its predecessor kept."""

import pytest

import corpus_pipeline as cp
from scorewell.llm.quality import judge_documents

from . import test_decontaminate as leaks
from . import test_line_dedup as lines
from . import test_ngram_join as grams
from . import test_tokens as tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows after each stage; stage 0 is the table."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, [docs.collect()]
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        assert i == len(cp.STAGES) - 1 or docs.columns == columns
        out.append(docs.collect())
    return out


def texts(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_quality(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = judge_documents(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    bad = {r.doc_id for r in judged.where("rejected").collect()}
    assert sorted(kept[1]) == sorted(r for r in kept[0] if r.doc_id not in bad)


def test_lines(kept):
    before = texts(kept[1])
    want = [(i, t) for i, t, n in lines.expected(before, lines.brute(before, least=1)) if not n or (t or "").split()]
    assert sorted(texts(kept[2])) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in kept[2] if r.text is not None)


def test_near_copies(kept):
    rows = texts(kept[2])
    group = {eval(x)[0]: eval(x)[2] for x in grams.brute(rows, 5, 4, 5)}
    blank = {i for i, t in rows if not grams.shingles(t, 5)}
    assert sorted(kept[3]) == sorted(r for r in kept[2] if group[r.doc_id] == r.doc_id or r.doc_id in blank)


def test_decontamination(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {d for d, t in texts(kept[3]) for _, x in items if leaks.normal(x) in leaks.normal(t)}
    gone = {r.doc_id for r in kept[3]} - {r.doc_id for r in kept[4]}
    assert exact and exact <= gone
    some = [(d, t) for d, t in texts(kept[3]) if d in gone or (d % 25 == 0 and len(t) < 3000)]
    assert {d for d, _, _ in leaks.brute(some, items[:40])} >= gone - exact
    assert not {d for d, _, _ in leaks.brute([x for x in some if x[0] not in gone], items[:40])}


def test_packing(kept):
    name, seen = tokens.NAMES[0], {}
    for p in kept[5]:
        seen[p.doc_id] = seen.get(p.doc_id, 0) + p.length
    want = tokens._expected(texts(kept[4]), name, 1)
    assert seen == {k: len(v[0]) for k, v in want.items()}


def test_run_is_registered(spark):
    from scorewell.llm.queries import QUERIES
    assert QUERIES["pipeline"] is cp.run and 4 <= len(cp.STAGES) <= 5


def test_near_copies_with_repeated_and_null_ids(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(3, words), (2, words + " x"), (2, "something else is in here today"), (None, words), (None, None),
            (5, ""), (5, ""), (2, words + " x")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, row string")
    got = [tuple(r)[:2] for r in cp.near_copies(spark, docs, SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        (None, words), (2, "something else is in here today"), (None, None), (5, ""), (5, "")]))
    for name, stage in cp.STAGES:
        empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
        assert stage(spark, empty, SF).count() == 0, name


def test_lines_and_decontamination_with_repeated_and_null_ids(spark, tmp_path):
    from scorewell.llm.queries import QUERIES
    item = "which of these two rivers is the longer one and where does it end"
    line = "one line of words that is said twice"
    rows = [(None, f"{line}\nclean words of a null id"), (None, f"other words here\n{line}"), (7, "seven\nfirst text of seven"),
            (7, f"eight things\n{line}\nseven"), (8, f"so {item}"), (8, "a clean text of eight"), (None, f"{item} is asked")]
    root = str(tmp_path)
    spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, row string").coalesce(1).write.parquet(
        f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    want = [*rows]
    want[1], want[3], want[4] = (None, "other words here"), (7, "eight things"), (8, "")
    for got, kept in ((QUERIES["op4_line_dedup"](spark, root), want), (
            cp.line_dedup(spark, docs, root), [x for x in want if x[1]])):
        assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted((str(i), t) for i, t in kept)
    got = cp.decontaminate(spark, docs, root)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted((str(i), t) for i, t in rows if item not in t)
