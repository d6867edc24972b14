"""Distributed dense positions without a single-task window.

``row_number() over (partition by g order by k)`` sends each group ``g`` to
one task.  When a group can hold a large share of all rows, use
``ordered_position`` instead: range-partition on ``(g, k)``, sort inside each
partition, number rows with ``monotonically_increasing_id`` and add the
count of rows of the same group held by earlier partitions.  The only
small-side data is one row per (partition, group) pair, at most
``partitions + groups`` rows.

The range shuffle is sized by AQE (small inputs are coalesced to a few
partitions instead of ``spark.sql.shuffle.partitions`` mostly empty ones),
and the numbered rows are checkpointed to the shared checkpoint folder
before the offsets are joined back: partition ids and row ids are frozen,
so the two reads agree whatever coalescing happened, and a lost executor
re-reads the checkpoint instead of re-deriving ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.session import cut_lineage


def ordered_position(df: DataFrame, group_col: str, order: Sequence[Column],
                     name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row within ``group_col``.

    ``(group_col, *order)`` must be a total order (unique per row) so that
    the numbering is deterministic across recomputation; a null group is a
    group of its own.
    """
    keys = [F.col(group_col).asc_nulls_first(), *order]
    shuffled = (df.repartitionByRange(num_partitions, *keys) if num_partitions
                else df.repartitionByRange(*keys))
    ranged = cut_lineage(shuffled.sortWithinPartitions(*keys)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    stats = ranged.groupBy("_pid", group_col).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = (Window.partitionBy(group_col).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    s = stats.select(F.col("_pid").alias("_spid"), F.col(group_col).alias("_sgrp"),
                     "_off", "_first")
    # null-safe on the group, so a null group is numbered like any other
    joined = ranged.join(s, (ranged["_pid"] == s["_spid"])
                         & ranged[group_col].eqNullSafe(s["_sgrp"]), "inner")
    return (joined.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint"))
            .drop("_pid", "_mid", "_off", "_first", "_spid", "_sgrp"))
