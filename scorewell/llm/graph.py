"""Connected components of an edge table, as Spark jobs.

Alternating star contraction: every node's larger neighbours move to the
smallest one, then its smaller ones do, until nothing changes.  A hub's
edges are never gathered: its smallest neighbour is an aggregate that is
combined before the shuffle, and a join brings it to the edges, which
adaptive execution splits where a hub is hot.  The driver sees two numbers
a round.  Each round's edges stand in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.session import scratch_path


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, root (smallest node of its component) for every node of ``edges``.

    ``edges``: two long columns u, v; direction, repeats and loops do not matter.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, "components")

    def kept(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        df.write.parquet(f"{root}/{name}")
        df = spark.read.parquet(f"{root}/{name}")
        mark = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return df, tuple(mark)

    e, mark = kept(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "0")
    for i in range(1, max_rounds + 1):
        if not mark[0]:
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        old, (e, mark) = mark, kept(small, str(i))
        if mark == old:
            break
    else:
        raise RuntimeError("components did not settle; allow more rounds")
    own = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own)
