"""New files of pages as a stream: each micro-batch goes through the stages of the batch run and is added to the chunk table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as X
from ..operators import tree
from ..plans.pipeline import chunk_pages
from ..sources.sinks import write_batch

PAGES = "source string, file_name string, path string, page int, page_content string"


def stream_chunks(spark: SparkSession, folder: str, out: str, checkpoint: str, detector: tree.Detector | None = None, once: bool = True) -> StreamingQuery:
    """Chunks of the page files (JSON lines) that come into a folder. A file holds whole sources; ids count within a batch.

    A batch that is run again after a failure replaces its own part of the table, so each file counts once.
    """
    pages = spark.readStream.schema(PAGES).json(folder)

    def add(batch: DataFrame, number: int) -> None:
        chunks = chunk_pages(batch, X.first_given(F.col("source"), F.col("file_name"), F.col("path")), "page", "page_content", detector)
        write_batch(chunks, out, f"{number:012d}")

    writer = pages.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_terms(events: DataFrame, time: str, text: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """window, token, n of a stream of texts, with a watermark for late rows: the counts of the index, kept up over time."""
    rows = events.withWatermark(time, late).select(time, F.explode(X.tokens(F.col(text))).alias("token"))
    return rows.groupBy(F.window(time, window), "token").agg(F.count(F.lit(1)).alias("n"))
