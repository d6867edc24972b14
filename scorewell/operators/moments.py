"""Evaluation as mergeable state.

A batch of predictions leaves one row of moments per group: rows, mean label,
squared deviation of the label, squared error.  Rows of any number of batches
merge to the metrics of all data without reading a prediction again.  The
merge adds each batch's own deviation and that of its mean from the common
mean, so nothing is lost when labels are large and lie close together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.operators.regression import PREDICTION


def error_moments(df: DataFrame, label_col: str = "label", prediction_col: str = PREDICTION,
                  by: Sequence[str] = ()) -> DataFrame:
    """``by``, n, mean, deviation, sse of the rows with a label and a prediction; groups without any give no row."""
    y, p = F.col(label_col).cast("double"), F.col(prediction_col).cast("double")
    rows = df.where(y.isNotNull() & p.isNotNull()).select(*by, y.alias("_y"), ((y - p) * (y - p)).alias("_e"))
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"),
                                (F.var_pop("_y") * F.count(F.lit(1))).alias("deviation"), F.sum("_e").alias("sse"))
    return out.where("n > 0")


def append_moments(moments: DataFrame, root: str, batch: str) -> None:
    """Store a batch's moments; the same batch again replaces its own rows."""
    moments.write.mode("overwrite").parquet(f"{root}/batch={batch}")


def read_moments(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("batch")


def merged_moments(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group, in the form of ``error_moments``: merging goes on from there."""
    keys = list(by)
    total = moments.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    renamed = total.select(*[F.col(k).alias(f"_{k}") for k in keys], "_mean")
    if keys:
        on = [moments[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
        met = moments.join(renamed, on)
    else:  # one row
        met = moments.withColumn("_mean", total.scalar())
    off = F.col("mean") - F.col("_mean")
    out = met.groupBy(*keys).agg(F.sum("n").alias("n"), F.first("_mean").alias("mean"),
                                 F.sum(F.col("deviation") + F.col("n") * off * off).alias("deviation"),
                                 F.sum("sse").alias("sse"))
    return out.where("n > 0")


def metrics_of(moments: DataFrame) -> DataFrame:
    """n, sse, rmse and r2 from moments; a constant label gives null r2."""
    keys = [c for c in moments.columns if c not in ("n", "mean", "deviation", "sse")]
    return moments.select(*keys, "n", "sse", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                          F.when(F.col("deviation") > 0, 1.0 - F.col("sse") / F.col("deviation")).alias("r2"))
