"""Split with an exact test size (R8) by a distributed order statistic.

The test part is the round(fraction * n) rows with the smallest key hashes.
Their bound is found by histogram refinement: the rows of the bucket that
holds it are counted by the next 16 bits of the hash, four times, so the driver
sees 65,536 counts a step and no row is sorted.  Rows that share the bound's
hash (copies, or keys of equal hash) are ordered by key and numbered with
distributed positions, so a hot key is no single task's sort either.

Membership follows from the keys, not from partitions or cores; of equal rows
any may be taken, which no result can tell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.operators.ranking import ordered_position

_BITS = 16


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col("`" + k.replace("`", "``") + "`") for k in keys])


def order_bound(df: DataFrame, keys: Sequence[str], rank: int) -> tuple[int, int]:
    """(bound, rest): ``rank`` rows are those of a smaller hash than ``bound`` and ``rest`` of the bound's own."""
    h, inside, prefix = _hash(keys), F.lit(True), 0
    for shift in range(64 - _BITS, -1, -_BITS):
        part = F.shiftright(h, shift)  # signed, as the hash is compared
        counts = df.where(inside).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counts, key=lambda r: r["part"]):
            prefix = r["part"]
            if rank <= r["n"]:
                break
            rank -= r["n"]
        inside = part == F.lit(prefix)
    return prefix, rank


def exact_split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test); test has round(test_size * n) rows, halves rounded up."""
    if not 0 <= test_size <= 1:
        raise ValueError(f"test_size must lie in [0, 1]: {test_size}")
    wanted = int(test_size * df.count() + 0.5)
    if not wanted:
        return df, df.where(F.lit(False))
    bound, rest = order_bound(df, keys, wanted)
    h, columns = _hash(keys), df.columns
    below, equal, above = df.where(h < bound), df.where(h == bound), df.where(h > bound)
    if equal.count() == rest:  # the usual case: the bound is one row, and the last one
        return above, below.unionByName(equal)
    order = [F.col("`" + k.replace("`", "``") + "`").asc_nulls_first() for k in keys]
    placed = ordered_position(equal.withColumn("_all", F.lit(0)), "_all", order, name="_place")
    return (above.unionByName(placed.where(F.col("_place") >= rest).select(*columns)),
            below.unionByName(placed.where(F.col("_place") < rest).select(*columns)))
