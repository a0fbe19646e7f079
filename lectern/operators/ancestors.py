"""Paths from the root in a store of nodes and links."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut


#: Rows of a level that share a node from which on the node counts as hot: its own few rows go to every task, and its leaves stay where they are.
HOT = 10_000


def meet(rows: DataFrame, small: DataFrame, key: str, hot: list) -> DataFrame:
    """rows joined with small by key. Rows of hot keys are not exchanged, so no task gets all of one."""
    if not hot:
        return rows.join(small, key)
    keys = F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in hot], f"{key} {dict(rows.dtypes)[key]}"))
    few = F.broadcast(cut(small.join(keys, key, "left_semi"), "hot"))
    return rows.join(few, key).unionByName(rows.join(keys, key, "left_anti").join(small, key))


def climb(seeds: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """leaf_id, node_id, content, depth: each seed (leaf_id, content) at depth 0 and every node above it, once for each way up.

    One join by equality per level, for all seeds at once, each written to the shared folder; it ends when no parent is left.
    A way up ends where it would meet a node again, so cycles end. No limit of depth, and no row limit as recursive queries have.
    Near the root most rows share a few nodes: how many do is counted over the different nodes of a level, and such nodes are broadcast.
    """
    level = cut(seeds.select("leaf_id", F.col("leaf_id").alias("node_id"), "content", F.lit(0).alias("depth"), F.array("leaf_id").alias("_seen")), "climb")
    out = level.drop("_seen")
    up = links.select(F.col("child_id").alias("node_id"), F.col("parent_id").alias("_up"))
    parents = nodes.select(F.col("id").alias("_up"), F.col("content").alias("_content"))
    counts = level.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    shared = lambda: [r[0] for r in counts.where((F.col("n") >= HOT) & F.col("node_id").isNotNull()).select("node_id").collect()]
    hot = shared()
    for depth in count(1):
        met = meet(level.select("leaf_id", "node_id", "_seen"), up, "node_id", hot).where(~F.array_contains("_seen", F.col("_up")))
        counts = cut(counts.join(up, "node_id").groupBy(F.col("_up").alias("node_id")).agg(F.sum("n").alias("n")), "climb-counts")
        hot = shared()
        level = cut(meet(met, parents, "_up", hot).select("leaf_id", F.col("_up").alias("node_id"), F.col("_content").alias("content"), F.lit(depth).alias("depth"), F.concat("_seen", F.array("_up")).alias("_seen")), "climb")
        if level.isEmpty():
            break
        out = out.unionByName(level.drop("_seen"))
    return out


def paths(climbed: DataFrame, links: DataFrame, joint: str = " ") -> DataFrame:
    """leaf_id, path (from the root), breadcrumb, text, order_index. A path has as many entries as the tree is deep."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("d"), F.col("node_id").alias("i"), F.col("content").alias("c"))))
    rows = climbed.groupBy("leaf_id").agg(F.transform(ordered, lambda x: x["c"]).alias("path"))
    order = links.groupBy(F.col("child_id").alias("leaf_id")).agg(F.min("order_index").alias("order_index"))
    crumb = breadcrumb(F.col("path"), joint)
    rows = rows.join(order, "leaf_id", "left").withColumn("breadcrumb", crumb)
    own = F.element_at("path", -1)
    return rows.select("leaf_id", "path", "breadcrumb", F.when(F.col("breadcrumb") != "", F.concat(F.lit("["), F.col("breadcrumb"), F.lit("]\n"), own)).otherwise(own).alias("text"), "order_index")


def breadcrumb(path: Column, joint: str = " ") -> Column:
    """All but the last entry, stripped, the blank ones left out."""
    above = F.transform(F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0))), lambda t: F.trim(t))
    return F.array_join(F.filter(above, lambda t: t.isNotNull() & (t != "")), joint)


def leaves(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes that are no parent."""
    return nodes.join(links.select(F.col("parent_id").alias("id")), "id", "left_anti")
