"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.session import scratch_path

#: ASCII white space; every other character is part of a word.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def word_array(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order, A-Z lower-cased; null gives none."""
    return F.filter(F.split(ascii_lower(F.coalesce(c, F.lit(""))), SPACE_CLASS),
                    lambda w: w != F.lit(""))


def byte_words(text: str | None) -> list[bytes]:
    """The words of ``word_array`` for Python tasks: ``bytes.split`` and
    ``bytes.lower`` know ASCII white space and A-Z only."""
    return text.encode().lower().split() if text else []


def numbered(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ...: whatever the input calls them, and if it
    does so twice or in another case, they never meet an operator's own."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> int:
    """Which column of ``df`` is meant: the first of exactly this name, else
    the first of this name in any case."""
    if name in df.columns:
        return df.columns.index(name)
    return [c.lower() for c in df.columns].index(name.lower())


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores put after it while a column is called so."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def two_columns(df: DataFrame, id_col: str, text_col: str,
                names: tuple[str, str] = ("doc_id", "text")) -> DataFrame:
    """Only the key and the text, under fixed names."""
    return numbered(df).select(*[F.col(f"c{place(df, c)}").alias(n)
                                 for c, n in zip((id_col, text_col), names)])


def whole_rows(df: DataFrame) -> Column:
    """A struct of all columns of ``numbered(df)``."""
    return F.struct(*[F.col(f"c{i}") for i in range(len(df.columns))])


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a long of its own for each row under ``name``, the same in
    every scan, however many cores or executors there are at the time.

    Rows of files are told apart by file (31 bits of a hash of its path, salted
    until no two files share one) and place in it.  Where rows do not come
    straight from files, or too many files share hashes, they are numbered
    in a copy written to the shared scratch folder.
    """
    try:
        path, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        for salt in range(4):
            file = F.xxhash64(path, F.lit(salt)).bitwiseAND(F.lit((1 << 31) - 1))
            seen = df.select(path.alias("path"), file.alias("file")).distinct()
            files, hashes, none = seen.agg(F.count(F.lit(1)), F.count_distinct("file"), F.count_if(F.col("path").isNull())).first()
            if files == hashes and not none:
                return df.select("*", F.shiftleft(file, 32).bitwiseOR(at).alias(name))
    except AnalysisException:
        pass
    copy = scratch_path(df.sparkSession, "rows")
    fields = df.columns
    numbered(df).select("*", F.monotonically_increasing_id().alias("key")).write.parquet(copy)
    return df.sparkSession.read.parquet(copy).toDF(*fields, name)
