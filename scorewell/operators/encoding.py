"""Categorical feature encoding (M1-M5).

Design
------
* Features are indexed as **canonical text** (K1): ``score`` features go
  through half-even rounding to integer text, ``category`` features are
  cast to text as they are.  The coercion is a ``SQLTransformer`` stage, so
  the fitted pipeline carries it and batch, stream and reloaded scoring all
  apply the same rule.
* Models use Spark's multi-column ``StringIndexer``.  For domains too large
  for a model's memory the relational **label table** holds the same order:
  one aggregation over all features (unpivot -> ``groupBy(column, value)``
  with map-side combine), ranked ``count desc, value asc`` per column with
  ``ordered_position`` so no single task sees a whole column's domain, and
  joined to the rows.
* Unseen and null values go to index ``numLabels`` (``handleInvalid=keep``);
  the one-hot block of a feature then has ``numLabels + 1`` slots and the
  unseen slot is a real slot (K3, K4).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StringIndexer,
                                StringIndexerModel, VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.operators.ranking import ordered_position

CAT_SUFFIX = "__cat"
INDEX_SUFFIX = "_indexed"
VECTOR_SUFFIX = "_vec"
FEATURES = "features"


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str = "score"  # "score": round half-even to integer text; "category": text as is

    def coerce_sql(self) -> str:
        q = f"`{self.name}`"
        if self.kind == "score":
            return f"CAST(TRY_CAST(BROUND(TRY_CAST({q} AS DOUBLE), 0) AS BIGINT) AS STRING)"
        if self.kind == "category":
            return f"CAST({q} AS STRING)"
        raise ValueError(f"unknown feature kind {self.kind!r}")


def as_features(features: Sequence[Feature | str], default_kind: str = "score") -> list[Feature]:
    return [f if isinstance(f, Feature) else Feature(f, default_kind) for f in features]


def cat_col(name: str) -> str:
    return name + CAT_SUFFIX


def index_col(name: str) -> str:
    return name + INDEX_SUFFIX


def vector_col(name: str) -> str:
    return name + VECTOR_SUFFIX


def coercion_stage(features: Sequence[Feature]) -> SQLTransformer:
    exprs = ", ".join(f"{f.coerce_sql()} AS `{cat_col(f.name)}`" for f in features)
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


def canonical_text(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Only the canonical text columns, named after the features."""
    return df.selectExpr(*[f"{f.coerce_sql()} AS `{f.name}`" for f in features])


def label_counts(df: DataFrame, features: Sequence[Feature | str]) -> DataFrame:
    """``(feature, value, n)`` for every non-null canonical value, one job."""
    feats = as_features(features)
    text = canonical_text(df, feats)
    long = text.unpivot(ids=[], values=[f.name for f in feats],
                        variableColumnName="feature", valueColumnName="value")
    return (long.where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def label_table(df: DataFrame, features: Sequence[Feature | str]) -> DataFrame:
    """M1, relational: ``(feature, value, n, idx)``; idx by n desc, value asc."""
    counts = label_counts(df, features)
    return ordered_position(counts, "feature", [F.col("n").desc(), F.col("value").asc()],
                            name="idx")


def encoder_stages(features: Sequence[Feature]) -> list:
    """M3 + M4: multi-column one-hot (keep, dropLast) and assembly."""
    enc = OneHotEncoder(inputCols=[index_col(f.name) for f in features],
                        outputCols=[vector_col(f.name) for f in features],
                        handleInvalid="keep", dropLast=True)
    asm = VectorAssembler(inputCols=[vector_col(f.name) for f in features], outputCol=FEATURES)
    return [enc, asm]


def preprocessor(features: Sequence[Feature | str]) -> Pipeline:
    """Unfitted pipeline: coercion, one multi-column ``StringIndexer``, one-hot, assembly."""
    feats = as_features(features)
    indexer = StringIndexer(inputCols=[cat_col(f.name) for f in feats],
                            outputCols=[index_col(f.name) for f in feats],
                            handleInvalid="keep", stringOrderType="frequencyDesc")
    return Pipeline(stages=[coercion_stage(feats), indexer, *encoder_stages(feats)])


def fit_preprocessor(df: DataFrame, features: Sequence[Feature | str]) -> PipelineModel:
    """M1-M5: fit coercion + index + one-hot + assembly on ``df``.

    The fitted model holds its labels in memory, as any ``StringIndexer``
    model does; for larger domains use ``label_table`` and
    ``apply_label_table``.  A feature without any label (all null or not
    numeric under its kind) is an error.
    """
    model = preprocessor(features).fit(df)
    dead = [name for name, n in num_labels(model).items() if not n]
    if dead and not df.isEmpty():
        raise ValueError(f"no labels in features {dead}; check their kind (score or category)")
    return model


def preprocessor_features(model: PipelineModel) -> list[Feature]:
    """Features (with kinds) a fitted preprocessor expects, from its stages."""
    sql = next(s for s in model.stages if isinstance(s, SQLTransformer)).getStatement()
    idx = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    out = []
    for c in idx.getInputCols():
        name = c[: -len(CAT_SUFFIX)]
        kind = "score" if f"BROUND(TRY_CAST(`{name}`" in sql else "category"
        out.append(Feature(name, kind))
    return out


def indexer_of(model: PipelineModel) -> StringIndexerModel:
    return next(s for s in model.stages if isinstance(s, StringIndexerModel))


def num_labels(model: PipelineModel) -> dict[str, int]:
    idx = indexer_of(model)
    feats = preprocessor_features(model)
    return {f.name: len(labels) for f, labels in zip(feats, idx.labelsArray)}


def vector_width(model: PipelineModel) -> int:
    """Assembled width: one block of ``numLabels + 1`` slots per feature."""
    return sum(n + 1 for n in num_labels(model).values())


def unseen_count(model: PipelineModel):
    """Column: how many features of a row fell into the unseen slot."""
    counts = num_labels(model)
    terms = [F.when(F.col(index_col(name)) == float(n), 1).otherwise(0) for name, n in counts.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast("int")


def apply_label_table(df: DataFrame, labels: DataFrame, feature: Feature,
                      out: str | None = None) -> DataFrame:
    """M2, relational: join ``df`` to the label table of one feature.

    Unseen/null -> numLabels.  Null keys stay out of the join, so they do not
    meet in one task; Spark chooses the join by the size of the label side,
    and AQE splits a hot key of a shuffle join.
    """
    out = out or index_col(feature.name)
    mine = labels.where(F.col("feature") == feature.name).select(
        F.col("value").alias("_v"), F.col("idx").alias("_i"))
    unseen = mine.agg(F.count(F.lit(1))).scalar()
    keyed = df.withColumn("_k", F.expr(feature.coerce_sql()))
    known = keyed.where(F.col("_k").isNotNull())
    joined = known.join(mine, known["_k"] == mine["_v"], "left").drop("_v")
    null = keyed.where(F.col("_k").isNull()).withColumn("_i", F.lit(None).cast("bigint"))
    return (joined.unionByName(null).withColumn(out, F.coalesce(F.col("_i"), unseen).cast("double"))
            .drop("_k", "_i"))
