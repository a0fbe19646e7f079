"""Exact deduplication by an extendible-hash index on shared files. DataFrame functions only.

A text is normalised (each run of white space becomes one space) and hashed to a key of 64 bits. The directory is addressed by the leading
bits of the keys: beginning with one bucket, each bucket of more than `bucket_capacity` different keys is split, and the directory
doubled, until none is overfull. Different keys differ in some bit, so this always ends; beyond DIRECTORY_SLOTS slots the capacity is doubled
in place of the directory, which so stays small enough to be broadcast at any size of the corpus.

The directory routes every row to the owner of its bucket, a task that holds whole buckets. The owner compares the bytes of texts of one
key, chains those that differ (chain 0, 1, ...), and writes its buckets to the shared folder sorted by (bucket, key, chain). A document's
row is then looked up in its bucket by key and digest.

Keys of many rows would meet in one owner. They are known from the count of keys, and by number they are at most HOT_KEYS; their equal
texts are summed up before the exchange, so a group with a third of all rows costs one row per task, and their entries are broadcast to
the lookup.

Defined results: null text equals the empty text; a null id never stays while its group has another id; repeated rows
(same id, equal text) are one document, of which only one row is kept; an empty table gives no rows; other columns of any
name are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, materialise, one_space

BUCKET_CAPACITY = 2_000
DIRECTORY_SLOTS = 1 << 18
#: A key is hot with more rows than this, and than its share of all rows if HOT_KEYS keys had them all.
HOT_ROWS, HOT_KEYS = 200, 5_000


def _prefix(key: Column, depth: Column | int) -> Column:
    """The leading `depth` bits; depth 0 gives 0, as a shift by 64 is none."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", key, 64 - depth))


@dataclass(frozen=True)
class Directory:
    """slots: (slot, bucket, local_depth), slot being the leading `depth` bits of a key; a bucket is named by its least key, as an unsigned number."""

    slots: DataFrame
    depth: int

    def route(self, rows: DataFrame) -> DataFrame:
        """rows with bucket and local_depth. At most DIRECTORY_SLOTS rows of three numbers are broadcast: 10 MB."""
        return rows.withColumn("slot", _prefix(F.col("key"), self.depth)).join(F.broadcast(self.slots), "slot").drop("slot")


@dataclass(frozen=True)
class Index:
    """entries: bucket, local_depth, key, chain, text_sha256, keep_id, group_size."""

    entries: DataFrame
    directory: Directory


def directory(keys: DataFrame, bucket_capacity: int = BUCKET_CAPACITY, most_slots: int = DIRECTORY_SLOTS) -> Directory:
    """From the different keys. The depth of a slot's bucket is the least at which its prefix has few enough keys."""
    n = keys.count()
    capacity = max(bucket_capacity, -(-4 * n // most_slots))
    depth = max(0, math.ceil(math.log2(4 * n / capacity))) if n > capacity else 0
    while True:
        slots = keys.groupBy(_prefix(F.col("key"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        fullest, used = slots.agg(F.max("n"), F.count(F.lit(1))).first()
        if (fullest or 0) <= capacity:
            break
        if used * 2 > most_slots:
            capacity *= 2
        else:
            depth += 1
    at = slots.withColumn("local_depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    at = at.withColumn("prefix", F.call_function("shiftrightunsigned", F.col("slot"), depth - F.col("local_depth")))
    fitting = at.groupBy("local_depth", "prefix").agg(F.sum("n").alias("size")).where(F.col("size") <= capacity).drop("size")
    found = at.join(fitting, ["local_depth", "prefix"]).groupBy("slot").agg(F.min("local_depth").alias("local_depth"))
    start = F.when(F.col("local_depth") == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col("slot"), depth - F.col("local_depth")), 64 - F.col("local_depth")))
    return Directory(materialise(found.select("slot", start.alias("bucket"), "local_depth"), "directory"), depth)


def _texts(rows: DataFrame, *carry: str) -> DataFrame:
    """doc_id, norm and key of rows (doc_id, text), and the columns of carry."""
    return rows.select("doc_id", *carry, one_space(F.col("text")).alias("norm")).withColumn("key", F.xxhash64("norm"))


def _hot(sizes: DataFrame, size: str) -> DataFrame:
    """The rows of more than their share: HOT_KEYS at most, as more would have more rows in all than there are."""
    total = sizes.agg(F.sum(size)).first()[0] or 0
    return sizes.where(F.col(size) > max(HOT_ROWS, total // HOT_KEYS))


def _counts(keyed: DataFrame) -> DataFrame:
    return materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_capacity: int = BUCKET_CAPACITY, keys: DataFrame | None = None) -> Index:
    """keys: the keys of all rows, if they are at hand."""
    texts = _texts(id_and_text(docs, id_col, text_col))
    counts = _counts(texts if keys is None else keys)
    slots = directory(counts, bucket_capacity)
    hot = _hot(counts, "n").select("key")
    plain = texts.join(F.broadcast(hot), "key", "left_anti").select("key", "norm", F.col("doc_id").alias("low"), F.lit(1).cast("long").alias("n"))
    summed = texts.join(F.broadcast(hot), "key", "left_semi").groupBy("key", "norm").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    dealt = slots.route(plain if hot.isEmpty() else plain.unionByName(summed)).repartition("bucket")
    # in the owner: rows of one bucket are together, so that neither grouping nor numbering moves them again
    groups = dealt.groupBy("bucket", "local_depth", "key", "norm").agg(F.min("low").alias("keep_id"), F.sum("n").alias("group_size"))
    return Index(_written(groups.withColumn("text_sha256", F.sha2("norm", 256)).drop("norm")), slots)


def _written(groups: DataFrame) -> DataFrame:
    """Entries chained and written, from groups that lie with their owners."""
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256")) - 1
    entries = groups.withColumn("chain", chain).select("bucket", "local_depth", "key", "chain", "text_sha256", "keep_id", "group_size")
    return materialise(entries.sortWithinPartitions("bucket", "key", "chain"), "index")


def insert(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_capacity: int = BUCKET_CAPACITY) -> Index:
    """The index with the rows of docs besides. Overfull buckets are split anew; texts of the two batches meet by their digests, as the index holds no texts."""
    every = index.entries.unionByName(build_index(docs, id_col, text_col, bucket_capacity).entries).select("key", "text_sha256", "keep_id", "group_size")
    slots = directory(_counts(every), bucket_capacity)
    dealt = slots.route(every).repartition("bucket")
    return Index(_written(dealt.groupBy("bucket", "local_depth", "key", "text_sha256").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))), slots)


def look_up(index: Index, keys: DataFrame) -> DataFrame:
    """keys (doc_id, key, text_sha256) with keep_id, group_size, bucket and chain; texts that the index has not seen are left out."""
    on = ["bucket", "key", "text_sha256"]
    entries = index.entries.drop("local_depth")
    rows, hot = index.directory.route(keys).drop("local_depth"), F.broadcast(_hot(entries, "group_size"))
    return rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(entries, on))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_capacity: int = BUCKET_CAPACITY, index: Index | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain. index: one that holds these documents, if there is one."""
    texts = _texts(id_and_text(docs, id_col, text_col))
    keys = materialise(texts.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), "documents")
    index = build_index(docs, id_col, text_col, bucket_capacity, keys) if index is None else index
    found = look_up(index, keys).select("doc_id", "keep_id", "group_size", "text_sha256", "bucket", "chain")
    # repeated rows of one document are alike: they are counted and given out again, the first of them as the one that may stay
    counted = found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "bucket", "chain")


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one row of each different text, that of the smallest id.

    The owners hold whole rows here and give out those that stay, so no row is looked up. Of rows with one id and equal texts, or without an
    id where no copy has one, that of the smaller text as it is written stays.
    """
    held = id_and_text(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "doc_id", "text", "row")
    texts = _texts(held, "row", "text")
    counts = _counts(_texts(held))
    slots = directory(counts)
    hot = _hot(counts, "n").select("key")
    plain = texts.join(F.broadcast(hot), "key", "left_anti").select("key", "doc_id", "row")
    dealt = slots.route(plain).repartition("bucket").withColumn("text", F.coalesce(F.col("row.text").cast("string"), F.lit(""))).withColumn("norm", one_space(F.col("text")))
    first = F.row_number().over(Window.partitionBy("bucket", "key", "norm").orderBy(F.col("doc_id").asc_nulls_last(), "text"))
    owned = dealt.withColumn("place", first).where("place = 1").select("row.*")
    if hot.isEmpty():
        return owned
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text")
    best = texts.join(F.broadcast(hot), "key", "left_semi").groupBy("key", "norm").agg(F.min_by("row", order).alias("row"))
    return owned.unionByName(best.select("row.*"))
