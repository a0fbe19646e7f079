"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node it reaches) of every node of links (u, v) that is not the smallest of its component.

    Alternates large-star (every larger neighbour of u moves to the smallest) and small-star (every smaller one does). Both keep the
    components; the rounds end when the links no longer change, as stars. Each round is written to the shared folder. Links are never
    brought to the driver, only their number and a sum of their hashes. Null ends and loops are left out.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    now = materialise(links.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).select(high.alias("u"), low.alias("v")).distinct(), "links")
    seen = _print_of(now)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of each join are plain exchanges, of which Spark splits the links of a node that many share
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        large = materialise(large, "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, seen = seen, _print_of(now)
        if before == seen:
            break
    else:
        raise RuntimeError(f"components have not settled in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
