"""Readers: paged documents through an injected parser, word-processor files from their XML, text pages."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

#: Names of the document format (fixed values).
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCKS = "path string, pos int, kind string, text string, cells array<array<string>>"
_TAG = re.compile(r"<[^>]+>")


def read_pages(spark: SparkSession, path: str, parse: Callable[[bytes], list[str]], glob: str = "*.pdf") -> DataFrame:
    """source, page, page_content of binary files; `parse` gives the pages of one file. A file that it cannot read raises, as a lost file would be silent."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [(p, i, text) for p, content in zip(part["path"], part["content"], strict=True) for i, text in enumerate(parse(bytes(content)))]
            yield pd.DataFrame(out, columns=["source", "page", "page_content"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInPandas(run, "source string, page int, page_content string")


def _text(element: ElementTree.Element) -> str:
    """Text of a paragraph, with tabs and breaks."""
    marks = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n"}
    return "".join((e.text or "") if e.tag == f"{_W}t" else marks.get(e.tag, "") for e in element.iter())


def docx_blocks(content: bytes) -> list[tuple[str, str | None, list[list[str]] | None]]:
    """(kind, text, cells) of the paragraphs and tables of the body, in order. A cell's paragraphs are joined by line feeds."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    out: list[tuple[str, str | None, list[list[str]] | None]] = []
    for child in body if body is not None else ():
        if child.tag == f"{_W}p":
            out.append(("paragraph", _text(child), None))
        elif child.tag == f"{_W}tbl":
            out.append(("table", None, [["\n".join(_text(p) for p in cell.iter(f"{_W}p")) for cell in row.findall(f"{_W}tc")] for row in child.findall(f"{_W}tr")]))
    return out


def read_docx(spark: SparkSession, path: str, glob: str = "*.docx") -> DataFrame:
    """The blocks of word-processor files: path, pos, kind, text, cells."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [(p, i, *block) for p, content in zip(part["path"], part["content"], strict=True) for i, block in enumerate(docx_blocks(bytes(content)))]
            yield pd.DataFrame(out, columns=["path", "pos", "kind", "text", "cells"])

    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content").mapInPandas(run, BLOCKS)


def table_html(cells):
    """A table as HTML: tags are removed from cells, which are then stripped."""
    row = lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda c: F.concat(F.lit("<td>"), strip(F.regexp_replace(c, _TAG.pattern, "")), F.lit("</td>"))), ""), F.lit("</tr>"))
    return F.concat(F.lit("<table>"), F.array_join(F.transform(cells, row), ""), F.lit("</table>"))


def docx_documents(blocks: DataFrame) -> DataFrame:
    """source, lines, tables: paragraphs that are not blank, tables as <tab>tN</tab>, and the HTML of each tN. One document in a row, as trees are made."""
    from pyspark.sql import Window

    numbered = blocks.withColumn("tid", F.concat(F.lit("t"), (F.count(F.when(F.col("kind") == "table", 1)).over(Window.partitionBy("path").orderBy("pos")) - 1).cast("string")))
    line = F.when(F.col("kind") == "table", F.concat(F.lit("<tab>"), F.col("tid"), F.lit("</tab>"))).otherwise(strip(F.col("text")))
    rows = numbered.withColumns({"line": line, "html": F.when(F.col("kind") == "table", table_html(F.col("cells")))}).where("line <> ''")
    every = rows.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "line", "tid", "html"))).alias("xs"))
    tables = F.map_from_entries(F.transform(F.filter("xs", lambda x: x["html"].isNotNull()), lambda x: F.struct(x["tid"], x["html"])))
    return every.select(F.substring_index("path", "/", -1).alias("source"), F.transform("xs", lambda x: x["line"]).alias("lines"), tables.alias("tables"))


def spread(df: DataFrame) -> DataFrame:
    """df, read from files, over as many tasks as there are cores at least: a file of one row group is one task, whatever is done to its rows.

    Only where there are fewer files than cores are their parts counted, from the footers; a large table is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or df.select(F.spark_partition_id().alias("part")).distinct().count() >= cores:
        return df
    return df.repartition(cores)
