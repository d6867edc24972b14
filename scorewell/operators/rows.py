"""Row and projection operators.

All are narrow transformations or single aggregates; none moves a whole
table through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.functions.scalars import stable_hash32


def _named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset`` (pushed to the scan)."""
    return df.na.drop(subset=list(subset))


def feature_columns(df: DataFrame, target: str, id_cols: Sequence[str] = ("id",)) -> list[str]:
    """R2: feature names by exclusion of the target and id columns."""
    drop = {target, *id_cols}
    return [c for c in df.columns if c not in drop]


def select_ordered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A fixed ordered column list; a missing column is an error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*cols)


def project_features_label(df: DataFrame, features: str | Column, target: str,
                           label: str = "label") -> DataFrame:
    """``features`` plus the target renamed to ``label``."""
    f = F.col(features) if isinstance(features, str) else features
    return df.select(f, F.col(target).alias(label))


def schema_table(df: DataFrame) -> DataFrame:
    """Schema as rows ``(position, col_name, data_type, nullable)``.

    Metadata only; no scan.
    """
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, col_name string, data_type string, nullable boolean")


def column_profile(df: DataFrame, cols: Sequence[str] | None = None,
                   exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """R4 with data: per column type, null count and distinct count.

    One aggregate job, then a tiny unpivot of the one-row result.  Exact
    distinct counts make Catalyst expand the rows once per column and
    shuffle the distinct values; ``exact=False`` uses HyperLogLog sketches
    (``approx_count_distinct``, relative error ``rsd``) that combine
    map-side into fixed-size buffers -- the choice for very large tables.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(cols):
        aggs.append((F.count(F.lit(1)) - F.count(_named(c))).alias(f"n{i}"))
        distinct = (F.count_distinct(_named(c)) if exact
                    else F.approx_count_distinct(_named(c), rsd))
        aggs.append(distinct.alias(f"d{i}"))
    wide = df.select(*[_named(c) for c in cols]).agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("col_name"), F.lit(types[c]).alias("data_type"),
                 F.col(f"n{i}").alias("n_null"), F.col(f"d{i}").alias("n_distinct"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")


def row_count(df: DataFrame) -> DataFrame:
    """``count(*)`` as a one-row frame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a stated order (top-k, no full sort)."""
    return df.orderBy(*order_by).limit(n)


def first_or_error(df: DataFrame):
    """The first row, or an error when there is none."""
    row = df.limit(1).first()
    if row is None:
        raise ValueError("no rows")
    return row


def random_split(df: DataFrame, test_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Seeded Bernoulli split, as ``randomSplit`` (layout dependent)."""
    return tuple(df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed))


def in_test(keys: Sequence[str], test_fraction: float) -> Column:
    """Whether a row goes to the test part, by the hash of its keys.

    Never null (a null key hashes as empty text), any fraction works to 32
    bits, and the answer depends on nothing but the keys.
    """
    return stable_hash32(*[_named(k) for k in keys]) >= F.lit((1.0 - test_fraction) * 2.0**32)


def hash_split(df: DataFrame, keys: str | Sequence[str],
               test_fraction: float) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash, stable under repartition and across engines."""
    test = in_test([keys] if isinstance(keys, str) else keys, test_fraction)
    return df.filter(~test), df.filter(test)


def with_split_flag(df: DataFrame, keys: str | Sequence[str], test_fraction: float,
                    name: str = "split") -> DataFrame:
    """Tag rows 'train'/'test' by key hash without separating them."""
    test = in_test([keys] if isinstance(keys, str) else keys, test_fraction)
    return df.withColumn(name, F.when(test, F.lit("test")).otherwise(F.lit("train")))
