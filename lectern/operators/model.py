"""The language model as a stage: an injected function, called with a budget, a timeout and retries; failures become rows."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.splitting import estimate
from ..plans import settings as S

Chat = Callable[[str], str]


class Overlong(Exception):
    """The prompt and the reply do not fit into the model's context."""


class Failure(Exception):
    """A failed call. status: of HTTP; None: the network. timeout: it took too long; empty: the reply was."""

    def __init__(self, message: str, status: int | None = None, timeout: bool = False, empty: bool = False):
        super().__init__(message)
        self.status, self.timeout, self.empty = status, timeout, empty


@dataclass(frozen=True)
class Retry:
    """Waits: doubled after server errors, timeouts and empty replies, growing by steps after other network errors; other HTTP errors end at once."""

    attempts: int = S.ATTEMPTS
    backoff: float = S.BACKOFF
    sleep: Callable[[float], None] = time.sleep

    def wait(self, attempt: int, error: Failure) -> float | None:
        if attempt >= self.attempts or (error.status is not None and error.status not in S.RETRY_STATUS):
            return None
        doubles = error.status is not None or error.timeout or error.empty
        return self.backoff * (2 ** (attempt - 1) if doubles else attempt)


def request_timeout(reply_tokens: int) -> float:
    return max(S.LEAST_TIMEOUT, S.SECONDS_PER_TOKEN * reply_tokens)


def guarded(call: Callable[[str, int, float], str], retry: Retry | None = None, limits: S.Limits | None = None) -> Callable[..., str]:
    """chat(prompt, reply_tokens=None) around call(prompt, reply_tokens, timeout)."""
    retry, limits = retry or Retry(), limits or S.Limits()

    def chat(prompt: str, reply_tokens: int | None = None) -> str:
        tokens = limits.reply if reply_tokens is None else reply_tokens
        needed = estimate(prompt) + S.REQUEST_TOKENS + tokens
        if needed > limits.context - limits.reserve:
            raise Overlong(f"the request needs {needed} tokens of {limits.context - limits.reserve}")
        attempt = 0
        while True:
            attempt += 1
            try:
                if reply := call(prompt, tokens, request_timeout(tokens)):
                    return reply
                raise Failure("empty reply", empty=True)
            except Failure as error:
                pause = retry.wait(attempt, error)
                if pause is None:
                    raise
                retry.sleep(pause)

    return chat


def assemble(events: Iterable[str]) -> tuple[str, str, str | None, dict | None]:
    """(content, reasoning, finish reason, usage) of server-sent events: "data:" lines with JSON deltas, up to [DONE]."""
    content, reasoning, reason, usage = [], [], None, None
    for line in events:
        if not line.startswith("data:"):
            continue
        body = line[5:].strip()
        if body == "[DONE]":
            break
        event, ok = json.loads(body) if body.startswith("{") else None, body.startswith("{")
        if not ok:
            continue
        usage = event.get("usage") or usage
        for choice in event.get("choices") or []:
            delta = choice.get("delta") or {}
            content.append(delta.get("content") or "")
            reasoning.append(delta.get("reasoning_content") or delta.get("reasoning") or "")
            reason = choice.get("finish_reason") or reason
    return "".join(content), "".join(reasoning), reason, usage


def ask(prompts: DataFrame, key: str, chat: Chat, prompt: str = "prompt", short_prompt: str | None = None, partitions: int | None = None) -> DataFrame:
    """key, prompt_hash, reply, error, short: one call per row; after a failure one with the short prompt, where there is one.

    The number of partitions bounds the calls at a time. Write the result before anything reads it twice: a plan that is run again asks
    again. The hash tells equal prompts.
    """
    rows = prompts.select(key, prompt, *([short_prompt] if short_prompt else []))
    rows = rows.repartition(partitions, key) if partitions else rows

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.itertuples(index=False):
                reply, error, short = None, None, False
                for k, text in enumerate(row[1:]):
                    short = k > 0
                    try:
                        reply, error = chat(text), None
                        break
                    except Exception as e:  # every failure of a connector becomes a failed item
                        error = f"{type(e).__name__}: {e}"
                out.append((row[0], hashlib.sha256((row[1] or "").encode()).hexdigest(), reply, error, short))
            yield pd.DataFrame(out, columns=[key, "prompt_hash", "reply", "error", "short"])

    return rows.mapInPandas(run, f"{key} {dict(prompts.dtypes)[key]}, prompt_hash string, reply string, error string, short boolean")


def calibration(asked: DataFrame, prompt: str, real_tokens: str) -> DataFrame:
    """How far the estimate of tokens is from the model's own count: n, mean_difference, most_under."""
    from pyspark.sql import functions as F

    from ..functions import text as X

    off = F.col(real_tokens) - X.payload_estimate(F.col(prompt))
    return asked.agg(F.count(F.lit(1)).alias("n"), F.avg(off).alias("mean_difference"), F.max(off).alias("most_under"))
