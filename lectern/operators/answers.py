"""Answers: the ladder from strict JSON down to the raw text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.splitting import balanced_object, strict_json
from ..plans import settings as S

ANSWER_PROMPT = 'Answer the question from the chunks alone.\nQuestion: {question}\n\nChunks:\n{chunks}\nReply with JSON only: {"answer": ""}'
#: Fixed patterns of the ladder: a quoted answer, a line that announces one, words that say there is none.
_QUOTED = re.compile(r'["\']?answer["\']?\s*[:=]\s*["\']([^"\']+)["\']', re.IGNORECASE)
_LINE = re.compile(r"^(?:Answer|Kết luận|Kết quả)[:\s-]*([^\n]+)", re.IGNORECASE | re.MULTILINE)
_NONE = re.compile(r"not enough information|không đủ|insufficient", re.IGNORECASE)


def answer_of(reply: str | None) -> str | None:
    """The answer of a reply; JSON that is no object raises, as its answer cannot be asked for."""
    reply = reply or ""
    value, ok = strict_json(balanced_object(reply))
    if ok:
        found = value.get("answer", S.NO_ANSWER)
        return found if found is None or isinstance(found, str) else json.dumps(found, ensure_ascii=False)
    for pattern in (_QUOTED, _LINE):
        if found := pattern.search(reply):
            return found[1].strip()
    return S.NO_ANSWER if _NONE.search(reply) or not reply.strip() else reply.strip()


def _answers(replies: pd.Series) -> pd.DataFrame:
    rows = []
    for reply in replies:
        try:
            rows.append((answer_of(reply), None))
        except Exception as e:  # the reply becomes a failed item
            rows.append((None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=["answer", "error"])


def parse_answer(reply: Column) -> Column:
    """struct<answer, error>. Balanced braces are no regular language, so this is a loop in Python."""
    return F.pandas_udf(_answers, "struct<answer:string,error:string>")(reply)
