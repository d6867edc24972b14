"""Least squares from mergeable Gram matrices (M6, M9, M10, §2.8).

A row is the vector z = (1, one-hot levels, numbers, label).  The Gram matrix
of z holds all that least squares asks of the data: X'X, X'y, y'y, the count
and the sums.  It is a table of (term, term, sum of products), built by one
aggregation that is combined in tasks before its shuffle, so matrices of
days, files or folds are added by a union and a sum, and taken off by a
difference, without a second look at the rows.

Cross-validation reads the data once: fold k is trained on all other folds'
matrices and tested on its own, from which the squared error of any
coefficients follows (z' G z with -1 for the label).

The solver is dense, in one task for each fold; more than ``MAX_WIDTH`` terms
are an error that names the way for wide models (``operators.additive``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.operators.encoding import Feature, as_features
from scorewell.session import ship_package

INTERCEPT, LABEL = "(intercept)", "(label)"
#: Terms of a dense solve, intercept and label included.
MAX_WIDTH = 2048
PAIR = ["feature", "value", "feature2", "value2"]
COEFFICIENTS = "feature string, value string, coefficient double"


def gram(df: DataFrame, features: Sequence[Feature | str], label: str, numeric: Sequence[str] = (),
         by: Sequence[str] = ()) -> DataFrame:
    """feature, value, feature2, value2, product: each pair of terms that meet
    in a row, once, per group of ``by``.

    ``features`` are categories (a null is a level of its own, as in the
    indexer's last slot); ``numeric`` columns enter as they are.  Rows with a
    null label or number are left out.
    """
    feats = as_features(features)
    names = [INTERCEPT, *[f.name for f in feats], *numeric, LABEL]
    if len(set(names)) < len(names):
        raise ValueError(f"a column is named twice: {names}")
    quoted = {c: F.col("`" + c.replace("`", "``") + "`").cast("double") for c in [*numeric, label]}
    none, one = F.lit(None).cast("string"), F.lit(1.0)
    terms: list[tuple[Column, Column, Column]] = [
        (F.lit(INTERCEPT), none, one), *[(F.lit(f.name), F.expr(f.coerce_sql()), one) for f in feats],
        *[(F.lit(c), none, quoted[c]) for c in numeric], (F.lit(LABEL), none, quoted[label])]
    whole = reduce(lambda a, b: a & b, [x.isNotNull() for x in quoted.values()])
    pairs = F.array(*[
        F.struct(f.alias("feature"), v.alias("value"), g.alias("feature2"), w.alias("value2"), (x * y).alias("product"))
        for i, (f, v, x) in enumerate(terms) for g, w, y in terms[i:]])
    rows = df.where(whole).select(*by, F.explode(pairs).alias("pair")).select(*by, "pair.*")
    return rows.groupBy(*by, *PAIR).agg(F.sum("product").alias("product"))


def merged(grams: Iterable[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The Gram table of all rows together."""
    return reduce(DataFrame.unionByName, grams).groupBy(*by, *PAIR).agg(F.sum("product").alias("product"))


def without(whole: DataFrame, part: DataFrame) -> DataFrame:
    """The Gram table of the rows of ``whole`` that are not in ``part``."""
    return merged([whole, part.withColumn("product", -F.col("product"))])


def _dense(rows: pd.DataFrame) -> tuple[list, np.ndarray]:
    """Terms, the intercept first and the label last, and their matrix."""
    left = list(zip(rows["feature"], rows["value"].where(rows["value"].notna(), None)))
    right = list(zip(rows["feature2"], rows["value2"].where(rows["value2"].notna(), None)))
    ends = [(INTERCEPT, None), (LABEL, None)]
    inner = sorted(set(left + right) - set(ends), key=str)
    if len(inner) + 2 > MAX_WIDTH:
        raise ValueError(f"{len(inner) + 2} terms; a dense solve takes {MAX_WIDTH}, use operators.additive")
    terms = [ends[0], *inner, ends[1]]
    at = {t: i for i, t in enumerate(terms)}
    m = np.zeros((len(terms), len(terms)))
    i, j = np.array([at[t] for t in left]), np.array([at[t] for t in right])
    np.add.at(m, (i, j), rows["product"].to_numpy())
    return terms, m + np.triu(m, 1).T + np.tril(m, -1).T


def _solved(m: np.ndarray) -> np.ndarray:
    """Coefficients of least norm; collinear blocks and terms without rows do no harm."""
    x, y = m[:-1, :-1], m[:-1, -1]
    size = np.sqrt(np.maximum(np.diag(x), 0))
    size[size < 1e-300] = 1.0
    return np.linalg.lstsq(x / np.outer(size, size), y / size, rcond=1e-10)[0] / size


def _errors(m: np.ndarray, beta: np.ndarray) -> tuple[float, float, float]:
    """Rows, squared error and squared deviation of the label."""
    z, n = np.append(beta, -1.0), m[0, 0]
    return n, float(max(z @ m @ z, 0.0)), float(m[-1, -1] - m[0, -1] ** 2 / n) if n else 0.0


def fit_gram(table: DataFrame) -> DataFrame:
    """M6: feature, value, coefficient of the least-squares fit (intercept
    among them), as ``operators.additive.score_additive`` takes them."""
    ship_package(table.sparkSession)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        terms, m = _dense(rows)
        return pd.DataFrame({"feature": [t[0] for t in terms[:-1]], "value": [t[1] for t in terms[:-1]],
                             "coefficient": _solved(m)})
    return table.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(solve, COEFFICIENTS)


def cross_validate(df: DataFrame, features: Sequence[Feature | str], label: str, fold: Column, folds: int,
                   numeric: Sequence[str] = ()) -> DataFrame:
    """§2.8: fold, n, rmse, r2 of each held-out fold, from one scan.

    ``fold``: a number from 0 to ``folds`` - 1 per row.  A fold without rows
    gives no row; a constant label in it gives null r2.
    """
    ship_package(df.sparkSession)
    parts = gram(df.withColumn("_fold", fold.cast("int")), features, label, numeric, ["_fold"])
    dealt = parts.select(F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"), "_fold", *PAIR, "product")

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        k = int(rows["fold"].iloc[0])
        terms, whole = _dense(rows)
        own = rows["_fold"] == k
        test = np.zeros_like(whole)
        if own.any():
            some, m = _dense(rows[own])
            at = [terms.index(t) for t in some]
            test[np.ix_(at, at)] = m
        n, sse, sst = _errors(test, _solved(whole - test))
        out = [(k, int(n), float(np.sqrt(sse / n)), 1.0 - sse / sst if sst > 0 else None)] if n else []
        return pd.DataFrame(out, columns=["fold", "n", "rmse", "r2"]).astype({"r2": "float64"})
    return dealt.groupBy("fold").applyInPandas(judge, "fold int, n long, rmse double, r2 double")
