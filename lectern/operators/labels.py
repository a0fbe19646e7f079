"""Labels: replies to graded chunk ids, tables that go on in the next chunk, enrichment."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.splitting import strict_json
from ..plans import settings as S

LABEL_PROMPT = 'Grade each chunk from 0 (of no use) to 3 (answers it) for the question.\nQuestion: {question}\n\nChunks:\n{chunks}\nReply with JSON only: {"results": [{"chunk_id": 0, "relevance": 0}]}'
LABELS = "array<struct<chunk_id:bigint,relevance:int>>"
PARSED = f"struct<labels:{LABELS},error:string>"
#: Pairs of a reply that is no JSON (fixed pattern).
_PAIR = re.compile(r"chunk_id\s*[\":=]*\s*([0-9]+).*?relevance\s*[\":=]*\s*([0-9]+)", re.IGNORECASE | re.DOTALL)


def label_items(reply: str | None) -> list[tuple[int | None, int]]:
    """(chunk_id, relevance) with a positive relevance: ids in text by their first digits, without digits left out; a relevance that is no number raises."""
    reply = reply or ""
    plain = reply.replace("```json", "").replace("```", "")
    a, b = plain.find("{"), plain.rfind("}")
    value, ok = strict_json(plain[a : b + 1] if a >= 0 and b >= 0 else plain.strip())
    if not ok:
        value = {"results": [{"chunk_id": int(m[1]), "relevance": int(m[2])} for m in _PAIR.finditer(reply)]}
    out = []
    for item in value.get("results", []):
        chunk_id, grade = item.get("chunk_id"), int(item.get("relevance", 0))
        if isinstance(chunk_id, str):
            digits = re.search(r"\d+", chunk_id)
            if not digits:
                continue
            chunk_id = int(digits[0])
        if grade > 0:
            out.append((chunk_id, grade))
    return out


def _parsed(replies: pd.Series) -> pd.DataFrame:
    rows = []
    for reply in replies:
        try:
            rows.append(([{"chunk_id": i, "relevance": r} for i, r in label_items(reply)], None))
        except Exception as e:  # the reply becomes a failed item
            rows.append((None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=["labels", "error"])


def parse_labels(reply: Column) -> Column:
    """struct<labels, error>: labels in the order of the reply, or the error."""
    return F.pandas_udf(_parsed, PARSED)(reply)


def table_neighbours(labels: DataFrame, candidates: DataFrame, chunks: DataFrame, question_id: str, chunk_id: str, source: str, window: int = S.TABLE_WINDOW, least: int = S.TABLE_LEAST, given: int = S.TABLE_GIVEN) -> DataFrame:
    """Labels (question_id, chunk_id, relevance, pos) with the candidates beside those of relevance `least` or more, of the same source and without a label.

    Added ones have relevance `given` and come after the others, by the label and step that find them first.
    """
    steps = F.explode(F.array(*map(F.lit, [d for d in range(-window, window + 1) if d])))
    sources = chunks.select(F.col(chunk_id).alias("_id"), F.col(source).alias("_source"))
    anchors = labels.where(F.col("relevance") >= least).join(sources, F.col(chunk_id) == F.col("_id")).select(question_id, "pos", F.col(chunk_id).alias("_at"), F.col("_source").alias("_of"), steps.alias("_step"))
    near = anchors.select(question_id, "pos", "_of", "_step", (F.col("_at") + F.col("_step")).alias(chunk_id))
    near = near.join(candidates.select(question_id, chunk_id), [question_id, chunk_id], "left_semi").join(labels.select(question_id, chunk_id), [question_id, chunk_id], "left_anti")
    near = near.join(sources, F.col(chunk_id) == F.col("_id")).where(F.col("_source").eqNullSafe(F.col("_of")))
    first = near.groupBy(question_id, chunk_id).agg(F.min(F.struct("pos", "_step")).alias("_found"))
    last = labels.groupBy(question_id).agg((F.max("pos") + 1).alias("_last"))
    place = (F.col("_last") + F.col("_found.pos") * (2 * window + 1) + F.col("_found._step") + window).cast("int")
    added = first.join(last, question_id).select(question_id, chunk_id, F.lit(given).alias("relevance"), place.alias("pos"))
    return labels.select(question_id, chunk_id, "relevance", F.col("pos").cast("int").alias("pos")).unionByName(added)


def sorted_labels(labels: DataFrame, question_id: str, chunk_id: str) -> DataFrame:
    """question_id, labels: by relevance, the best first, then as listed. A question has no more labels than candidates."""
    rows = labels.groupBy(question_id).agg(F.array_sort(F.collect_list(F.struct((-F.col("relevance")).alias("r"), "pos", F.col(chunk_id).cast("long").alias("i"), F.col("relevance").cast("int").alias("g")))).alias("xs"))
    return rows.select(question_id, F.transform("xs", lambda x: F.struct(x["i"].alias("chunk_id"), x["g"].alias("relevance"))).alias("labels"))


def enrich(labels: DataFrame, chunks: DataFrame, chunk_id: str, source: Column, file_name: Column, text: Column, document_id: Column | None = None, snippet: int = S.OUTPUT_SNIPPET) -> DataFrame:
    """Labels with source, file_name, document_id and the first characters of the text; unknown ids have nulls and an error."""
    known = chunks.select(F.col(chunk_id).alias("_id"), source.alias("source"), file_name.alias("file_name"), (F.lit(None).cast("string") if document_id is None else document_id).alias("document_id"), X.strip(F.substring(text, 1, snippet)).alias("text_snippet"))
    joined = labels.join(known, F.col(chunk_id) == F.col("_id"), "left")
    return joined.withColumn("error", F.when(F.col("_id").isNull(), F.lit("unknown chunk_id"))).drop("_id")
