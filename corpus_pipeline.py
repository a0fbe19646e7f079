"""A training corpus from raw documents: quality rules, toxicity, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of the next.
All but the last return the columns of documents. Rows that the first two reject go; of equal texts, and of each component of near
copies, one document stays; the last stage packs what is left.

Every stage judges each row by its own id and text and never drops a row for another one's sake: an id with two texts is two documents.
Defined results: a null or empty text fails the base rules, so it goes in the first stage; a stage that meets one all the same counts it as
empty. Rows without an id pass all filters; of equal ones one stays where no copy has an id, and they are near copies of nothing. Repeated
rows (one id, equal text) become one in the third stage. Of equal texts that of the smallest id stays, of a component its smallest id.
Very long texts are read whole. Columns of any name are carried along as they are, other columns of the names that stages use inside
included. Empty tables give no rows; without labels no document is kept for its score or rejected for it, but by the base rules alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.best_fit_packing import best_fit_packing
from lectern.llm.common import materialise, table
from lectern.llm.exact_dedup import keep_first_copies
from lectern.llm.jaccard_join import keep_one_each
from lectern.llm.quality_rules import keep_good
from lectern.llm.toxicity import keep_clean


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)


STAGES = [("quality_rules", quality), ("toxicity", toxicity), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies), ("best_fit_packing", packing)]

#: SQL expresses neither the models nor the tokenizer; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
