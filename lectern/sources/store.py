"""The node store: documents, nodes and links as tables, insert-if-absent, text index, listing, reading back as chunks."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ancestors, vectors
from ..operators.chunking import metadata
from ..operators.ordering import with_position
from ..operators.tree import Node, node_rows
from ..plans import settings as S
from .scratch import cut

DOCUMENTS = "id string, bot_id string, name string, active boolean"
NODES = "id string, document_id string, content string, embedding array<float>, tsv array<string>"
LINKS = "parent_id string, child_id string, order_index int"
TABLES = {"documents": (DOCUMENTS, ["id"]), "nodes": (NODES, ["id"]), "links": (LINKS, ["parent_id", "child_id", "order_index"])}


def jdbc_options(env: dict[str, str] | None = None) -> dict[str, str]:
    """Options of spark.read.jdbc from environment variables with defaults; the password has none."""
    env = dict(os.environ) if env is None else env
    host, port, name = env.get("PG_HOST", "localhost"), env.get("PG_PORT", "5432"), env.get("PG_DATABASE", "postgres")
    out = {"url": f"jdbc:postgresql://{host}:{port}/{name}", "user": env.get("PG_USER", "postgres"), "driver": "org.postgresql.Driver"}
    return out | ({"password": env["PG_PASSWORD"]} if "PG_PASSWORD" in env else {})


def insert_absent(held: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of new whose keys are not held, one for each key (the least row): what an insert that ignores conflicts adds."""
    rest = [c for c in new.columns if c not in keys]
    orderable = F.min(F.struct(*[F.to_json(F.struct(c)).alias(f"_{c}") for c in rest], *rest)) if rest else F.min(F.lit(0))
    # what is held is left out first, so that rows are exchanged by their keys once, and only once each
    absent = new.join(held.select(*keys), list(keys), "left_anti")
    one = absent.groupBy(*keys).agg(orderable.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    return one.select(new.columns)


def with_text_index(nodes: DataFrame, leaves_only: bool = True) -> DataFrame:
    """Fills tsv where it is null: the lower-case words of the content. leaves_only: where there is an embedding; otherwise everywhere."""
    missing = F.col("tsv").isNull() & (F.col("embedding").isNotNull() if leaves_only else F.lit(True))
    return nodes.withColumn("tsv", F.when(missing, F.array_sort(X.tokens(F.col("content")))).otherwise(F.col("tsv")))


class Store:
    """Three Parquet tables in a folder. Appends are new files; tables are read with their schemas, so an empty store reads as empty tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def create(self) -> Store:
        for name, (schema, _) in TABLES.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{name}")
        return self

    def reset(self) -> Store:
        for name, (schema, _) in TABLES.items():
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name][0]).parquet(f"{self.path}/{name}")

    def add(self, name: str, rows: DataFrame) -> None:
        """Insert if absent. What is added is worked out and written aside before the table is touched.

        The keys alone are looked at first: where none is absent nothing is done, and where each row has an absent key of its own all
        rows are appended as they are, neither exchanged nor written aside; a job that fails leaves nothing in the table.
        """
        schema, keys = TABLES[name]
        columns = self.spark.createDataFrame([], schema).columns
        new = rows.select(columns)
        every = new.count()
        absent = new.groupBy(*keys).agg(F.lit(1).alias("one")).join(self.read(name).select(*keys), keys, "left_anti").count()
        if absent and absent < every:
            new = cut(insert_absent(self.read(name), new, keys), name)
        if absent:
            new.write.mode("append").parquet(f"{self.path}/{name}")

    def index(self, documents: DataFrame, nodes: DataFrame, links: DataFrame) -> None:
        """Adds documents, then nodes with their text index, then links; a run that ends half-way is mended by running it again."""
        self.add("documents", documents)
        self.add("nodes", with_text_index(nodes, leaves_only=False))
        self.add("links", links)


def index_trees(spark: SparkSession, roots: dict[str, tuple[str | None, str, Node]], embed: Callable[[list[str]], list[list[float]]] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """documents, nodes and links of a few trees {document_id: (bot_id, name, root)}; leaves are embedded as breadcrumb, line feed, content."""
    every = {d: node_rows(root, d) for d, (_, _, root) in roots.items()}
    documents = spark.createDataFrame([(d, bot, name, True) for d, (bot, name, _) in roots.items()], DOCUMENTS)
    rows = [n for nodes, _ in every.values() for n in nodes]
    nodes = spark.createDataFrame(rows, "id string, document_id string, content string, is_leaf boolean, breadcrumb string")
    vector = F.lit(None).cast("array<float>")
    if embed is not None:

        @F.pandas_udf("array<float>")
        def embedded(texts: pd.Series) -> pd.Series:
            return pd.Series(embed(list(texts)))

        vector = F.when(F.col("is_leaf"), embedded(F.concat_ws("\n", X.blank_is_null(F.col("breadcrumb")), F.col("content"))))
    nodes = nodes.select("id", "document_id", "content", vector.alias("embedding"), F.lit(None).cast("array<string>").alias("tsv"))
    return documents, nodes, spark.createDataFrame([x for _, links in every.values() for x in links], LINKS)


def list_documents(documents: DataFrame, bot_id: str | None = None, limit: int | None = S.LIST_DOCUMENTS, key: str = "id", name: str = "name") -> DataFrame:
    """Documents by name; of one bot, if one is named."""
    rows = documents.where(F.col("bot_id") == bot_id) if bot_id else documents
    rows = rows.orderBy(F.asc_nulls_last(name), key)
    return rows if limit is None else rows.limit(limit)


def choose_documents(documents: DataFrame, mode: str = "half", ids: Sequence[str] = (), key: str = "id", name: str = "name") -> DataFrame:
    """All documents, the first half of them by name, or those of given ids."""
    if mode == "all":
        return documents
    if mode == "half":
        half = documents.count() // 2
        return with_position(documents, [F.asc_nulls_last(name), F.col(key)], "_at").where(F.col("_at") < half).drop("_at")
    return documents.where(F.col(key).isin(list(ids)))


def leaf_chunks(wanted: DataFrame, documents: DataFrame, nodes: DataFrame, links: DataFrame, joint: str = " ") -> DataFrame:
    """Chunk rows of the leaves of wanted documents (document_id, ord), in that order: one set-based query for all.

    Leaves are nodes with an embedding; the name of a document that has no row is its id. Order within a document: the index among siblings, then the path.
    """
    leaves = nodes.where(F.col("embedding").isNotNull())
    # a document may have most of the leaves, which are not to meet in one task
    sizes = leaves.where(F.col("document_id").isNotNull()).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))
    hot = [r[0] for r in sizes.where(F.col("n") >= ancestors.HOT).select("document_id").collect()]
    seeds = ancestors.meet(leaves, wanted.select("document_id").distinct(), "document_id", hot)
    found = ancestors.paths(ancestors.climb(seeds.select(F.col("id").alias("leaf_id"), "content"), links, nodes), links, joint)
    owners = seeds.select(F.col("id").alias("leaf_id"), "document_id")
    names = documents.select(F.col("id").alias("document_id"), "name", F.lit(True).alias("_known"))
    rows = ancestors.meet(found.join(owners, "leaf_id"), wanted.join(names, "document_id", "left"), "document_id", hot)
    rows = rows.withColumn("source", F.when(F.col("_known"), F.col("name")).otherwise(F.col("document_id")))
    rows = with_position(rows, [F.col("ord"), F.asc_nulls_last("order_index"), F.col("path"), F.col("leaf_id")], "chunk_id")
    return rows.select("chunk_id", "text", metadata(source=F.col("source"), breadcrumb=F.col("breadcrumb"), node_id=F.col("leaf_id"), document_id=F.col("document_id")).alias("metadata"))


def search(query: Column, documents: DataFrame, nodes: DataFrame, links: DataFrame, top_k: int = S.TOP_K, bot_id: str | None = None, joint: str = " ") -> DataFrame:
    """Chunk rows of the nearest leaves, nearest first, with distance and source; the ways up of all hits in one pass."""
    only = None if not bot_id else documents.where(F.col("bot_id") == bot_id).select(F.col("id").alias("document_id"))
    hits = cut(vectors.nearest(nodes, "id", "embedding", query, top_k, only, "document_id").select(F.col("id").alias("leaf_id"), "document_id", "content", "distance"), "hits")
    found = ancestors.paths(ancestors.climb(hits.select("leaf_id", "content"), links, nodes), links, joint)
    names = documents.select(F.col("id").alias("document_id"), F.col("name").alias("source"))
    rows = hits.drop("content").join(found, "leaf_id").join(names, "document_id", "left")
    # top_k rows
    ranked = rows.withColumn("chunk_id", F.row_number().over(Window.orderBy(F.asc_nulls_last("distance"), "leaf_id")) - 1)
    return ranked.select(F.col("chunk_id").cast("long").alias("chunk_id"), "text", metadata(source=F.col("source"), breadcrumb=F.col("breadcrumb"), node_id=F.col("leaf_id"), document_id=F.col("document_id"), distance=F.col("distance")).alias("metadata"))


def search_text(text: str, embed: Callable[[list[str]], list[list[float]]], documents: DataFrame, nodes: DataFrame, links: DataFrame, top_k: int = S.TOP_K, bot_id: str | None = None, joint: str = " ") -> DataFrame:
    """`search` for the vector that the embedding model gives a text."""
    return search(vectors.vector(embed([text])[0]), documents, nodes, links, top_k, bot_id, joint)
