"""Top-k, argmax and dense numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlens.session import cut_lineage


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                    k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their 1-based rank.

    Spark limits each group to ``k`` rows in every task before the shuffle
    (window group limit), so a hot group costs k rows per task, not its size.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_argmax(values: Column) -> Column:
    """0-based position of the largest element; the first one on a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def number_rows(df: DataFrame, order: Sequence[str], alias: str,
                partitions: int | None = None) -> DataFrame:
    """Add a 0-based gapless number in ``order``, a unique key, without one task for all.

    Rows are range-partitioned and sorted in place; the position inside a
    partition plus the sizes of the partitions before it is the number. The
    sorted rows are materialised once, so both uses see the same partitions.
    """
    ranges = [partitions, *order] if partitions else order
    at = F.monotonically_increasing_id()    # partition in the high bits, position in the low 33
    ordered = cut_lineage(df.repartitionByRange(*ranges).sortWithinPartitions(*order)
                            .withColumn("_at", at))
    placed = (ordered.withColumn("_part", F.shiftright("_at", 33))
                     .withColumn("_pos", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    # one row per partition
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(alias, F.col("_base") + F.col("_pos"))
            .drop("_at", "_part", "_pos", "_base"))
