"""Text functions that need a loop, for Arrow-batched stages: token-aware splitting, greedy packing, overlap, balanced braces."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from ..plans import settings as S

Estimate = Callable[[str], int]


def estimate(text: str | None) -> int:
    """Tokens of a text where no tokenizer is at hand."""
    return int(len(text) / S.CHARS_PER_TOKEN) + 1 if text else 0


def split_text(text: str | None, limit: int = S.PIECE_TOKENS, separators: Sequence[str] = S.SEPARATORS, count: Estimate = estimate) -> list[str]:
    """Pieces of at most `limit` tokens, cut at the coarsest separator that does.

    Parts are packed greedily; what is packed and still too long is cut at the next separator. The empty separator cuts every
    `limit` words, so a long word stays whole. Separators at cuts are lost and blank pieces dropped. Works through a stack, so
    depth of recursion is no limit.
    """
    out: list[str] = []
    todo = [(text or "", 0)]
    while todo:
        piece, level = todo.pop()
        if not piece.strip():
            continue
        if level == len(separators) or count(piece) <= limit:
            out.append(piece)
        elif separators[level] == "":
            every = piece.split()
            out += [" ".join(every[i : i + limit]) for i in range(0, len(every), limit)]
        else:
            packed = pack(piece.split(separators[level]), limit, separators[level], count)
            todo += [(p, level + 1) for p in reversed(packed)]
    return out


def pack(parts: Iterable[str], limit: int, joint: str, count: Estimate = estimate) -> list[str]:
    """Neighbours joined while they fit; an empty run takes the next part without a joint."""
    runs: list[str] = []
    now = ""
    for part in parts:
        longer = now + joint + part if now else part
        if count(longer) <= limit:
            now = longer
            continue
        if now:
            runs.append(now)
        now = part
    return [*runs, now] if now else runs


def batches(sizes: Sequence[int], limit: int) -> list[int]:
    """The batch of each item: neighbours share one while their sizes sum to no more than limit; a larger item is alone."""
    out, batch, total = [], 0, 0
    for i, size in enumerate(sizes):
        if i and total + size > limit:
            batch, total = batch + 1, 0
        total += size
        out.append(batch)
    return out


def leaf_numbers(lengths: Sequence[int], limit: int = S.LEAF_TOKENS) -> list[int]:
    """The leaf of each line of a section: lines joined by line feeds stay together while their estimate is within limit."""
    out, leaf, held = [], -1, 0
    for n in lengths:
        joined = held + 1 + n if held else n
        if leaf < 0 or (int(joined / S.CHARS_PER_TOKEN) + 1 if joined else 0) > limit:
            leaf, joined = leaf + 1, n
        held = joined
        out.append(leaf)
    return out


def last_words(text: str, n: int = S.OVERLAP_WORDS) -> str:
    return " ".join(text.split()[-n:])


def with_overlap(before: str, text: str) -> str:
    """text after the tail of what stands before it, unless it begins with that tail."""
    return text if not before or text.startswith(before) else before + "\n" + text


def balanced_object(text: str) -> str:
    """The first balanced {...} of text without fences, braces in strings counted too; else what follows the first brace; else the text."""
    plain = text.replace("```json", "").replace("```", "")
    start = plain.find("{")
    if start < 0:
        return plain.strip()
    depth = 0
    for i in range(start, len(plain)):
        depth += (plain[i] == "{") - (plain[i] == "}")
        if not depth:
            return plain[start : i + 1]
    return plain[start:].strip()


def close_truncated(text: str) -> str | None:
    """A cut list of objects with its frame closed after the last whole object; None without any."""
    text = text.rstrip()
    at = text.rfind("},")
    at = at if at >= 0 else text.rfind("}")
    return text[: at + 1] + "]}" if at >= 0 else None


def strict_json(text: str | None):
    """(value, True), or (None, False) where the text is not JSON from end to end."""
    try:
        return json.loads(text or ""), True
    except ValueError:
        return None, False


def repaired_json(raw: str, repair: Callable[[str], str] | None = None):
    """The value of a reply: strict; repaired by `repair` if given; with its frame closed; both. None if all fail."""
    plain = raw.replace("```json", "").replace("```", "")
    a, b = plain.find("{"), plain.rfind("}")
    plain = plain[a : b + 1] if a >= 0 and b >= 0 else plain.strip()
    for text in (plain, close_truncated(plain)):
        for mend in (None, repair) if repair else (None,):
            if text is not None:
                try:
                    value, ok = strict_json(mend(text) if mend else text)
                except Exception:  # a repair function may fail in any way
                    ok = False
                if ok:
                    return value
    return None
