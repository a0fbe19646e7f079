"""Headings by rule, and splitting by the hierarchy they make."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.splitting import Estimate, estimate
from ..plans import settings as S
from .chunking import metadata, pieces
from .ordering import sequential_ids

#: Headings of four levels (fixed patterns): parts, roman numbers and lines of capitals; "1." and "A."; "1.1"; "1.1.1" and "a)".
HEADINGS = (
    r"^\s*(?:#\s+|(?:PHẦN|CHƯƠNG|PART|SECTION)\s+[IVXLCDM\d]+[\.\:]?\s+.*|[IVXLCDM]+\.\s+[A-ZÀ-Ỵ].*|^[A-ZÀ-Ỵ0-9\s,\.\-]{8,}$)",
    r"^\s*(?:##\s+|\d+\.\s+[A-ZÀ-Ỵa-zà-ỵ].*|[A-Z]\.\s+[A-ZÀ-Ỵa-zà-ỵ].*)",
    r"^\s*(?:###\s+|\d+\.\d+\.?\s+.*)",
    r"^\s*(?:####\s+|\d+\.\d+\.\d+\.?\s+.*|[a-zđ]\)\s+.*)",
)
_BLOCK = "array<struct<titles:array<string>,body:string>>"


def find_headings(text: str, pattern: re.Pattern, gap: int = S.HEADING_GAP) -> list[tuple[int, int, str]]:
    """(start, end, title) of the headings of one level; a match that starts less than `gap` after the last one kept is left out.

    A heading is (part of) one line: white space of a pattern does not reach over a line feed, so "A." and the paragraph below it are no heading.
    """
    kept: list[tuple[int, int, str]] = []
    at = 0
    for line in text.split("\n"):
        for m in pattern.finditer(line):
            bare = m.group().strip()
            title = bare.lstrip("#").lstrip() if bare.startswith("#") else bare
            start = at + m.start() + (m.group().find(bare) if bare else 0)
            if title and (not kept or start - kept[-1][0] >= gap):
                kept.append((start, start + len(bare), title))
        at += len(line) + 1
    return kept


def split_level(text: str, pattern: re.Pattern) -> list[tuple[str | None, str]] | None:
    """(title, body) of what stands before the first heading and below each; None without headings."""
    found = find_headings(text, pattern)
    if not found:
        return None
    ends = [start for start, _, _ in found[1:]] + [len(text)]
    blocks = [(title, text[end:stop].strip()) for (_, end, title), stop in zip(found, ends, strict=True)]
    before = text[: found[0][0]].strip()
    return [(None, before), *blocks] if before else blocks


def split_hierarchy(text: str | None, patterns: Sequence[re.Pattern]) -> list[tuple[list[str], str]]:
    """(titles, body) of the blocks at the bottom, level by level; a heading without a body is dropped with its title.

    A level is cut into blocks whether or not the levels above had headings. If a level has none, or only text before
    them, the block goes on to the next level as it is.
    """
    now: list[tuple[list[str], str]] = [([], text or "")]
    for pattern in patterns:
        deeper = []
        for titles, body in now:
            blocks = split_level(body, pattern) if body.strip() else None
            if blocks is None or (len(blocks) == 1 and blocks[0][0] is None):
                deeper.append((titles, body))
            else:
                deeper += [([*titles, title] if title else titles, below) for title, below in blocks if below.strip()]
        now = deeper
    return now


def hierarchy_blocks(text: Column, patterns: Sequence[str] = HEADINGS) -> Column:
    """array<struct<titles, body>>; offsets of matches are needed, which regexp_extract_all does not give."""
    compiled = [re.compile(p, re.MULTILINE) for p in patterns]

    @F.pandas_udf(_BLOCK)
    def blocks(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"titles": t, "body": b} for t, b in split_hierarchy(x, compiled)] for x in texts])

    return blocks(text)


def split_by_hierarchy(docs: DataFrame, text: str, source: Column, order: list[str], patterns: Sequence[str] = HEADINGS, limit: int = S.PIECE_TOKENS, extra: Column | None = None, count: Estimate = estimate) -> DataFrame:
    """Chunk rows "[title > title]\\npiece" with headings, breadcrumb and ids."""
    rows = docs.select(*order, source.alias("_source"), (F.lit(None).cast("map<string,string>") if extra is None else extra).alias("_extra"), F.posexplode(hierarchy_blocks(F.coalesce(F.col(text), F.lit("")), patterns)).alias("_block", "_b"))
    rows = rows.select(*order, "_source", "_extra", "_block", F.col("_b.titles").alias("_titles"), F.posexplode(pieces(F.col("_b.body"), limit, count=count)).alias("_piece", "_text"))
    crumb = F.array_join("_titles", " > ")
    rows = rows.withColumns({"_crumb": crumb, "text": F.when(crumb != "", F.concat(F.lit("["), crumb, F.lit("]\n"), F.col("_text"))).otherwise(F.col("_text"))})
    numbered = sequential_ids(rows, "_source", [*order, "_block", "_piece"])
    return numbered.select("chunk_id", "text", metadata(source=F.col("_source"), file_name=X.file_name(F.col("_source")), breadcrumb=F.col("_crumb"), headings=F.col("_titles"), extra=F.col("_extra")).alias("metadata"))


def rule_level(line: Column, patterns: Sequence[str] = HEADINGS) -> Column:
    """Heading level of a line by the rules, -1 for body text; the finest level that fits counts, so that "1.1 x" is of level 3."""
    level = F.lit(-1)
    for k, pattern in enumerate(patterns):
        level = F.when(line.rlike("(?U)" + pattern), k + 1).otherwise(level)
    return level
