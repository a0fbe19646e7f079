"""Pages and text items to chunks: grouping, lines, media, splitting, overlap, ids."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.splitting import Estimate, estimate, last_words, split_text, with_overlap
from ..plans import settings as S
from .ordering import sequential_ids

#: The central record. Metadata of all producers in one struct; what a source brings besides stays in `extra`.
METADATA = "struct<source:string,file_name:string,breadcrumb:string,node_id:string,document_id:string,distance:double,headings:array<string>,extra:map<string,string>>"
CHUNK = f"chunk_id long, text string, metadata {METADATA}"

#: Texts that a loop in Python holds at a time, of the many in an Arrow batch.
SLICE = 128


def metadata(**given: Column) -> Column:
    """The metadata struct; fields that are not given are null."""
    kind = T._parse_datatype_string(METADATA)
    return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


def page_source(source: str = "source", file_name: str = "file_name", path: str = "path") -> Column:
    return X.first_given(F.col(source), F.col(file_name), F.col(path))


def group_pages(pages: DataFrame, source: Column, order: str, content: str) -> DataFrame:
    """source, source_ord (its first page), text: the pages of a source joined by line feeds, null pages as empty ones."""
    rows = pages.select(source.alias("source"), F.col(order).alias("_o"), F.coalesce(F.col(content), F.lit("")).alias("_t"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_t"))), lambda x: x["_t"]), "\n")
    return rows.groupBy("source").agg(F.min("_o").alias("source_ord"), whole.alias("text"))


def page_lines(pages: DataFrame, source: Column, order: str, content: str) -> DataFrame:
    """source, page, line_in_page, line of all lines that are not blank.

    Pages are joined by line feeds before they are split at line feeds, so their lines are those of the pages one by one: no source
    has to meet in one row.
    """
    rows = pages.select(source.alias("source"), F.col(order).alias("page"), F.posexplode(X.lines(F.col(content))).alias("line_in_page", "line"))
    return rows


def text_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, line."""
    return df.select(key, F.posexplode(X.lines(F.col(text))).alias("line_no", "line"))


def pieces(text: Column, limit: int = S.PIECE_TOKENS, rows_apart: bool = True, count: Estimate = estimate) -> Column:
    """array<string>: the text in pieces of at most `limit` tokens. Splitting depends on what was packed before, so it is a loop.

    count: the tokens of a text; a tokenizer's own count goes here, as a function that loads it on the worker.
    """

    kind = pa.list_(pa.string())

    @F.arrow_udf("array<string>")
    def cut_up(texts: pa.Array) -> pa.Array:
        # few texts at a time are Python strings
        made = [pa.array([split_text(t, limit, count=count) for t in texts.slice(k, SLICE).to_pylist()], kind) for k in range(0, len(texts), SLICE)]
        return pa.concat_arrays(made) if made else pa.array([], kind)

    return cut_up(X.table_rows_apart(text) if rows_apart else text)


def split_items(items: DataFrame, text: str, source: Column, order: list[str], file_name: Column | None = None, extra: Column | None = None, overlap: int = S.OVERLAP_WORDS, limit: int = S.PIECE_TOKENS, count: Estimate = estimate) -> DataFrame:
    """Flat splitting: media whole, the rest in pieces, ids in order, then the overlap. Gives chunk rows."""
    given = F.lit(None).cast("string") if file_name is None else file_name
    rows = items.select(*order, source.alias("_source"), given.alias("_file"), (F.lit(None).cast("map<string,string>") if extra is None else extra).alias("_extra"), F.posexplode(X.media_segments(F.coalesce(F.col(text), F.lit("")))).alias("_segment", "_s"))
    parts = F.when(F.col("_media"), F.array("_t")).otherwise(pieces(F.col("_t"), limit, count=count))
    rows = rows.withColumns({"_t": F.col("_s.segment"), "_media": F.col("_s.is_media")}).withColumn("_parts", parts)
    rows = rows.select(*order, "_source", "_file", "_extra", "_segment", F.posexplode("_parts").alias("_piece", "text"))
    numbered = sequential_ids(rows, "_source", [*order, "_segment", "_piece"])
    chunks = numbered.select("chunk_id", "text", metadata(source=F.col("_source"), file_name=X.file_name(F.col("_source"), F.col("_file")), extra=F.col("_extra")).alias("metadata"))
    return apply_overlap(chunks, n_words=overlap) if overlap > 0 else chunks


def apply_overlap(chunks: DataFrame, position: str = "chunk_id", text: str = "text", n_words: int = S.OVERLAP_WORDS, block: int = 10_000) -> DataFrame:
    """Puts the last n words of the chunk before, as it is after this very step, in front of each chunk that does not begin with them.

    A chunk of n words or more fixes what follows it: its last words are its own. So rows fall into runs, each begun by such an
    anchor, and runs are folded on their own; an anchor takes its overlap from the end of the run before. Anchors are found per block of
    positions, then carried over blocks, so no window spans all rows. `position` is dense.
    """
    own = [c for c in chunks.columns if c != text]
    rows = chunks.withColumns({"_pos": F.col(position).cast("long"), "_block": F.floor(F.col(position) / block), "_anchor": F.when(F.size(X.words(F.col(text))) >= n_words, F.col(position).cast("long"))})
    ends = rows.groupBy("_block").agg(F.max("_anchor").alias("_last"))
    carried = ends.select("_block", F.last("_last", ignorenulls=True).over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    within = Window.partitionBy("_block").orderBy("_pos")
    rows = rows.withColumns({"_here": F.last("_anchor", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0)), "_prior": F.last("_anchor", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1))})
    rows = rows.join(carried, "_block").withColumns({"_run": F.coalesce("_here", "_carried", F.lit(-1)), "_before": F.coalesce("_prior", "_carried", F.lit(-1))})
    light = rows.select("_run", "_pos", F.col(text).alias("_text"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, tail = None, ""
        for batch in batches:
            for part in (batch.slice(k, SLICE) for k in range(0, batch.num_rows, SLICE)):
                texts, tails = [], []
                for r, value in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                    if r != run:
                        run, tail = r, ""
                    joined = with_overlap(tail, value)
                    tail = last_words(joined, n_words)
                    texts.append(joined)
                    tails.append(tail)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(tails, pa.string())], ["_run", "_pos", "_joined", "_tail"])

    folded = light.repartition("_run").sortWithinPartitions("_run", "_pos").mapInArrow(fold, "_run long, _pos long, _joined string, _tail string")
    tails = folded.groupBy("_run").agg(F.max_by("_tail", "_pos").alias("_end")).withColumnRenamed("_run", "_r")
    joined = rows.join(folded.drop("_run", "_tail"), "_pos").join(tails, F.col("_before") == F.col("_r"), "left")
    first = F.col("_pos") == F.col("_anchor")
    over = F.when(first & F.col("_end").isNotNull() & (F.col("_end") != "") & ~F.startswith(F.col("_joined"), F.col("_end")), F.concat(F.col("_end"), F.lit("\n"), F.col("_joined"))).otherwise(F.col("_joined"))
    return joined.select(*own, over.alias(text)).select(chunks.columns)
