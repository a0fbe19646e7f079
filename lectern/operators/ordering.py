"""Positions in a global order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut


def with_position(df: DataFrame, order: list[Column], name: str = "position", ties: Sequence[Column] = ()) -> DataFrame:
    """Adds the 0-based position of each row in the order of `order`, then of `ties`, by which no ranges are made (the sample leaves them out).

    Rows are dealt by range and sorted within partitions; a row's place there plus the number of rows in the partitions before
    it is its position. Only one number per partition meets in one task. Ranges come from a sample, so the dealt rows are written
    once and read twice.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order, *ties)
    dealt = cut(dealt.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "order")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    # as many rows as there are partitions
    return dealt.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def sequential_ids(df: DataFrame, source: str, order: list[str], name: str = "chunk_id") -> DataFrame:
    """Ids from 0 in the order of sources (each by its first row in `order`), then of `order`."""
    first = df.groupBy(source).agg(F.min(F.struct(*order)).alias("_first")).withColumnRenamed(source, "_first_of")
    placed = df.join(first, F.col(source).eqNullSafe(F.col("_first_of"))).drop("_first_of")
    return with_position(placed, [F.col("_first"), F.col(source), *map(F.col, order)], name).drop("_first")
