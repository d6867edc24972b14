"""A fitted preprocessor + linear model as plain Catalyst expressions.

Every row of a one-hot block has exactly one active slot (the seen index,
or the unseen slot), so the model's prediction is

    intercept + sum over features of coef[block offset + index]

which needs no vectors: the index is a lookup in a literal map (value ->
index, missing/null -> numLabels) and the coefficient a lookup in a literal
array.  The terms are added in feature order and the intercept last, the
order the model's sparse dot product uses, so the result is the same
double.  The whole chain stays in one whole-stage-codegen projection (no
opaque ML UDFs).  Callers ask for it where label sets are small: a lookup
walks the literal map, and the literals are part of the plan.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from scorewell.operators.encoding import indexer_of, preprocessor_features

def can_compile(prep: PipelineModel, model) -> bool:
    if not isinstance(model, LinearRegressionModel):
        return False
    try:
        indexer_of(prep)
    except StopIteration:
        return False
    return True


def index_expressions(prep: PipelineModel) -> list[tuple[str, Column, int]]:
    """``(feature, index column, numLabels)`` per feature, from raw columns."""
    out = []
    for f, labels in zip(preprocessor_features(prep), indexer_of(prep).labelsArray):
        n = len(labels)
        text = F.expr(f.coerce_sql())
        if n:
            lookup = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))])
            idx = F.coalesce(F.try_element_at(lookup, text), F.lit(n))
        else:
            idx = F.lit(0)
        out.append((f.name, idx, n))
    return out


def prediction_expression(prep: PipelineModel, model: LinearRegressionModel) -> Column:
    coefs = [float(c) for c in model.coefficients.toArray()]
    offset = 0
    total = None
    for _, idx, n in index_expressions(prep):
        block = F.array(*[F.lit(c) for c in coefs[offset: offset + n + 1]])
        offset += n + 1
        term = block[idx]
        total = term if total is None else total + term
    if offset != len(coefs):
        raise ValueError("model width does not match the preprocessor")
    return total + F.lit(float(model.intercept))


def unseen_expression(prep: PipelineModel) -> Column:
    total = None
    for _, idx, n in index_expressions(prep):
        term = F.when(idx == n, 1).otherwise(0)
        total = term if total is None else total + term
    return total.cast("int")
