"""Global positions and ranks without a single-task window.

`Window.orderBy(...)` with no partition sends every row to one task. Here rows are range-
partitioned, numbered inside each partition, and shifted by the sizes of the partitions before
theirs. The numbered rows are stored, because a partition number is only meaningful as
long as it is never computed a second time (a lost executor or a second reader would do that).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspan.operators.storage import keep


def dense_positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add 1-based consecutive positions in the given order (`order` should be total)."""
    placed = keep(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", 33)),
        "positions",
    )
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    # One row per shuffle partition, so this unpartitioned window is bounded by the cluster layout.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inside = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(shifts), "__part")
        .withColumn(name, inside + F.col("__shift") + 1)
        .drop("__part", "__id", "__shift")
    )


def dense_rank_desc(df: DataFrame, value: str, name: str) -> DataFrame:
    """`DENSE_RANK() OVER (ORDER BY value DESC)`: number the distinct values, then join back."""
    distinct = df.select(F.col(value).alias("__value")).distinct()
    ranked = dense_positions(distinct, F.col("__value").desc_nulls_last(), name=name)
    return df.join(ranked, df[value].eqNullSafe(ranked["__value"]), "left").drop("__value")
