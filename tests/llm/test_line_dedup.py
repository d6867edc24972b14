"""Line dedup against a comparison of all lines with all earlier ones."""

import glob
import random
import re
import time
from fractions import Fraction

from scorewell.llm import line_dedup
from scorewell.llm.line_dedup import drop_repeated_lines, duplicate_lines
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def tokens(line):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", low) if w)


def brute(rows, up=4, down=5, least=5):
    """Removed (doc_id, line_no): Jaccard >= up / down with an earlier line."""
    lines = sorted({((i is not None, i or 0), n, tokens(x), i) for i, t in rows if t is not None
                    for n, x in enumerate(t.split("\n")) if len(tokens(x)) >= least},
                   key=lambda x: (x[0], x[1]))
    gone = set()
    for k, (key, n, a, i) in enumerate(lines):
        for key2, n2, b, _ in lines[:k]:
            if (key2, n2) < (key, n) and len(a & b) * down >= len(a | b) * up:
                gone.add((i, n))
                break
    return gone


def expected(rows, gone):
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        lines = t.split("\n")
        kept = [x for n, x in enumerate(lines) if (i, n) not in gone]
        out.append((i, "\n".join(kept), len(lines) - len(kept)))
    return out


def both(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, gone string, line_no int").repartition(3)
    out = drop_repeated_lines(df, **kw)
    assert out.columns == ["doc_id", "text", "gone", "line_no", "n_lines_removed"]
    return [(r.doc_id, r.text, r.n_lines_removed) for r in out.collect()]


def same(a, b):
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_near_copies_in_random_lines(spark):
    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(6)], [f"word{i}" for i in range(300)]
    base = [[rng.choice(common if rng.random() < .4 else rare) for _ in range(rng.randint(4, 40))]
            for _ in range(25)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 4)):
                line[rng.randrange(len(line))] = rng.choice(rare).upper()
            text.append(" ".join(line))
        rows.append((d, "\n".join(text)))
    gone = brute(rows)
    assert 40 < len(gone) < 400
    same(both(spark, rows), expected(rows, gone))


def test_edges(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(2, line), (1, line.upper() + "\n\n" + line), (3, None), (4, ""), (4, ""),
            (5, "a b c d\na b c d"), (None, "zero " + line), (6, "\n" + line + " x y\t\r\n"),
            (7, line + " x y z"), (8, "p q r s t\nu v w x y"), (8, "p q r s t\nu v w x y"),
            (9, "long " * 9000 + "a b c d e f\nend"), (10, "long a b c d e f"),
            (11, "k l m n o\nother words are in here"), (11, "k l m n o\nk l m n o")]
    gone = brute(rows)
    assert (1, 0) in gone and (1, 2) in gone and (2, 0) in gone and (None, 0) not in gone
    assert (10, 0) in gone and (8, 0) not in gone and (11, 1) in gone
    same(both(spark, rows), expected(rows, gone))


def test_other_thresholds(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 10))) for i in range(12)]
    for up, down in ((1, 2), (9, 11), (1, 1)):
        t = up / down if (up, down) != (9, 11) else 0.8
        want = brute(rows, up, down) if (up, down) != (9, 11) else brute(rows)
        same(both(spark, rows, threshold=t), expected(rows, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert drop_repeated_lines(df).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e", 7, "k", "l"), (2, "a b c d e", 8, "m", "n")],
                               "doc_id long, text string, n_lines_removed int, TEXT string, text string")
    out = drop_repeated_lines(df)
    assert out.columns == [*df.columns, "n_lines_removed_"]
    assert sorted(map(tuple, out.collect())) == [(1, "a b c d e", 7, "k", "l", 0), (2, "", 8, "m", "n", 1)]


def test_op4_over_the_whole_table(spark):
    from scorewell.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text").collect()]
    got = [(r.doc_id, r.text, r.n_lines_removed) for r in QUERIES["op4_line_dedup"](spark, SF).collect()]
    same(got, expected(rows, brute(rows, least=1)))


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    plan = drop_repeated_lines(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert duplicate_lines(df.select("doc_id", F.lit(0).alias("line_no"), F.col("text").alias(
        "line"))).collect() == [(2, 0)]


def test_short_lines_and_lines_without_blanks(spark, tmp_path):
    import corpus_pipeline
    from scorewell.llm.queries import QUERIES
    rows = [(1, "All rights reserved.\nx\n\n你好世界你好世界"), (2, "ALL rights  reserved.\n\nreserved. all rights\nX\ny"),
            (3, "a b c d\nalpha\n你好世界你好世界"), (4, "a b c d e\n \nd c b a\nalpha beta\nall rights"), (5, "y\n\t\ny"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = expected(rows, brute(rows, least=1))
    assert sum(n for _, _, n in want) == 8
    got = QUERIES["op4_line_dedup"](spark, str(tmp_path)).collect()
    same([(r.doc_id, r.text, r.n_lines_removed) for r in got], want)
    got = corpus_pipeline.line_dedup(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "").collect()
    same([tuple(r) for r in got], [(i, t) for i, t, n in want if not n or t.split()])


def test_rows_keep_their_keys_when_cores_come_and_go(spark, tmp_path):
    """The parallelism changes between building the query and reading it; so do the splits of the scan."""
    from scorewell.llm.common import with_row_key
    path = str(tmp_path / "documents.parquet")
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(path)
    conf = {"spark.sql.leafNodeDefaultParallelism": "2", "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.maxPartitionBytes": "64k"}
    keyed = with_row_key(spark.read.parquet(path), "row")
    plain = spark.read.parquet(path).withColumn("row", F.monotonically_increasing_id())
    before, loose = sorted(map(tuple, keyed.collect())), sorted(map(tuple, plain.collect()))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert sorted(map(tuple, spark.read.parquet(path).withColumn("row", F.monotonically_increasing_id()).collect())) != loose
        again = with_row_key(spark.read.parquet(path), "row")
        assert sorted(map(tuple, again.collect())) == before
        assert again.select("row").distinct().count() == len(before)
    finally:
        for k in conf:
            spark.conf.unset(k)
    copied = with_row_key(spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string"), "row")
    assert copied.columns == ["doc_id", "text", "row"] and copied.select("row").distinct().count() == 3


def test_near_copies_of_long_lines(spark):
    """Sizes on both sides of the limit for more parities, and similarities about the threshold."""
    rng = random.Random(5)
    rows, vocab = [], [f"w{i}" for i in range(500)]
    for size in (line_dedup.LONG - 4, line_dedup.LONG, line_dedup.LONG + 5, 160, 300):
        base = rng.sample(vocab, size)
        for _ in range(8):
            line = list(base)
            for _ in range(rng.randint(0, size // 6)):
                line[rng.randrange(len(line))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(line[rng.randint(0, size // 10):])))
    gone = brute(rows)
    assert 5 < len(gone) < len(rows) - 5
    same(both(spark, rows), expected(rows, gone))


def test_long_lines_with_few_common_words_are_no_candidates(spark):
    rng = random.Random(6)
    sets = [rng.sample(range(1 << 40), 180) for _ in range(2)]
    sets[1][:40] = sets[0][:40]
    keys = spark.createDataFrame([tuple(sets)], "a array<long>, b array<long>")
    half = [F.filter(c, lambda k: k.bitwiseAND(F.lit(64)) != 0) for c in "ab"]
    line = keys.select(*[F.lit(180).alias(c) for c in ("n", "n2")], *[F.lit(0).alias(c) for c in ("i", "i2")],
                       line_dedup._bits(F.col("a")).alias("bits"), line_dedup._bits(F.col("b")).alias("bits2"),
                       line_dedup._bits(half[0]).alias("half"), line_dedup._bits(half[1]).alias("half2"))
    t = Fraction(4, 5)
    assert not line.select(line_dedup._possible(t)).first()[0]
    none = F.lit(None).cast("long")
    assert line.withColumn("half", none).select(line_dedup._possible(t)).first()[0]


def test_shuffle_files_of_finished_steps_are_gone(spark):
    def files():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        return {f for d in env.blockManager().diskBlockManager().localDirsString()
                for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    lines = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(0).alias("line_no"), F.concat_ws(
        " ", *[(F.col("id") % (i + 2)).cast("string") for i in range(12)]).alias("line")).repartition(3)
    gone = duplicate_lines(lines)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(key) == setting
    assert gone.count()


def test_a_text_is_split_once_to_take_lines_out(spark):
    """Not again for each line that stays, as it was when the split stood within the lambda."""
    df = spark.createDataFrame([(1, "a b c d e\nf g\na b c d e"), (2, "f g")], "doc_id long, text string")
    out = drop_repeated_lines(df, min_tokens=1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_except" in plan
    assert not re.search(r"lambdafunction\((get\()?split\(", plan)
    assert sorted(map(tuple, out.collect())) == [(1, "a b c d e\nf g", 1), (2, "", 1)]


def test_only_ascii_letters_are_lowered(spark):
    lines = ["ABC xyz", "É Ab", "İI", "\u212a K", "ΑΣ B", "A\tB\x0bC\x0cD\rE\nF", "", " A  b "]
    want = [re.sub("[\t\x0b\x0c\r\n]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), x)) for x in lines]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    low = df.select("i", line_dedup._low(F.col("line")).alias("low"))
    assert [r.low for r in low.orderBy("i").collect()] == want
    sizes = low.select("i", F.size(line_dedup._hashes(F.col("low"))).alias("n")).orderBy("i").collect()
    assert [r.n for r in sizes] == [len(set(x.split(" ")) - {""}) for x in want]


def test_large_group_of_near_copies(spark):
    """Copies differ from the first and from each other; some match a later line only."""
    rng = random.Random(7)
    base, rows = [f"g{i}" for i in range(30)], []
    for d in range(150):
        line = list(base)
        for _ in range(rng.randint(0, 5)):
            line[rng.randrange(30)] = f"v{rng.randrange(400)}"
        rows.append((d, " ".join(line[:rng.randint(24, 30)])))
    gone = brute(rows)
    assert 60 < len(gone) < 150
    same(both(spark, rows), expected(rows, gone))


def test_files_that_no_later_step_reads_are_gone(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(line_dedup, "scratch_path", lambda spark, name: f"{tmp_path}/scorewell/{name}")
    lines = spark.createDataFrame([(1, 0, "a b"), (2, 0, "A b"), (3, 0, "c")], "doc_id long, line_no int, line string")
    assert duplicate_lines(lines, min_tokens=1).collect() == [(2, 0)]
    left = {p.split("/")[-1] for p in glob.glob(f"{tmp_path}/scorewell/line_dedup/*")}
    assert {"every", "first"} <= left and not left & {"hashed", "equal"}
