"""Best-fit packing of tokenised documents into sequences of at most `capacity` tokens, with a fixed number of open bins.

A document is its token ids and an end id. Only a document longer than a sequence is cut: into full pieces, after a first one that may be
shorter. Pieces arrive in windows of a fixed number, the longest of a window first; each goes to the open bin with the least free space
that holds it. Open bins are keyed by free space in a bitset (one integer of capacity + 1 bits), so that bin is the lowest set bit at or above the length. If
none fits, a bin is opened; if `open_bins` are open already, the fullest of them closes first.

Tasks pack on their own, so memory is bounded by the window and the open bins, and the result has no order to keep. Bins that are still
open and less than `full` filled when a task ends are taken apart, and their pieces go through a packer of as many open bins once more, in
groups of tasks: `gather` tasks share one second packer, and so the number of half-empty sequences falls by that factor. Spark sorts the
pieces of a group, the longest first, so the second packer holds its open bins only. Rows of a few numbers are written and exchanged,
never tokens.

Defined results: a null or empty text is its end id alone; a null id stays null; repeated rows are packed each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, in_slices, materialise, public_vocabulary

CAPACITY = 1024
OPEN_BINS = 1024
WINDOW = 4096
FULL = 0.97
GATHER = 8
END_ID = 2
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


class BestFit:
    """Bounded-space online best fit. Items are anything with a length; `add` returns the bin that closes, if one does."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f is set if a bin with f free tokens is open
        self.by_free: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0

    def _take(self, f: int) -> list:
        some = self.by_free[f]
        found = some.pop()
        if not some:
            self.free &= ~(1 << f)
        self.n_open -= 1
        return found

    def add(self, item, length: int) -> list | None:
        closed = None
        fitting = self.free >> length
        if fitting:
            f = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(f)
        else:
            f, bin_ = self.capacity, []
            if self.n_open >= self.open_bins:
                closed = self._take((self.free & -self.free).bit_length() - 1)
        bin_.append((item, self.capacity - f))
        f -= length
        if not f:
            return bin_ if closed is None else closed + [None] + bin_
        self.by_free[f].append(bin_)
        self.free |= 1 << f
        self.n_open += 1
        return closed

    def rest(self) -> Iterator[list]:
        while self.free:
            yield self._take((self.free & -self.free).bit_length() - 1)


class ByteEncoder:
    """Ids of the public byte-level vocabulary as its library gives them.

    Texts of Latin letters without the special string go through a faster library that holds the same ranks and splits at
    the same pattern; all others through the library itself, since the two may hold different tables of rare letters.
    """

    def __init__(self):
        import base64
        import os
        import re

        import public_tokenizers
        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_vocabulary("byte_bpe_50k.json"))
        with open(public_vocabulary("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile("[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u00ac\\u00ae-\\u017f]|<\\|endoftext\\|>")

    def encode(self, text: str) -> np.ndarray:
        if self.other.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False)


def pieces(ids: np.ndarray, end_id: int = END_ID, capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document."""
    ids = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
    start, stop = 0, len(ids) % capacity or capacity
    for k in range(-(-len(ids) // capacity)):
        yield k, start, stop - start, zlib.crc32(ids[start:stop].tobytes())
        start, stop = stop, stop + capacity


class _Out:
    """Rows by column."""

    def __init__(self, more: tuple[str, ...] = ()):
        self.names, self.columns = [*_NAMES, *more], [[] for _ in range(len(_NAMES) + len(more))]

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32()] + [pa.int64()] * (len(self.names) - 2)
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)], self.names)
        self.columns = [[] for _ in self.names]
        return out


def _bins(found: list | None) -> Iterator[list]:
    """The closed bins that BestFit.add returns: none, one, or two with None between them."""
    if found:
        at = found.index(None) if None in found else len(found)
        yield found[:at]
        if at < len(found):
            yield found[at + 1 :]


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, window: int = WINDOW, full: float = FULL, gather: int = GATHER, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs a task's pieces; `open` is the number of the group for the second packer, or -1 in a closed sequence."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, packer, out, made = ByteEncoder(), BestFit(capacity, open_bins), _Out(("open",)), part << 32

        def close(bin_: list, group: int) -> None:
            nonlocal made
            for item, offset in bin_:
                out.add(*item, made, offset, group)
            made += 1

        def pack(some: list[tuple]) -> None:
            for item in sorted(some, key=lambda x: -x[3]):
                for bin_ in _bins(packer.add(item, item[3])):
                    close(bin_, -1)
            some.clear()

        waiting: list[tuple] = []
        for batch in batches:
            for at, texts in enumerate(in_slices(batch.column(1))):
                for doc_id, text in zip(batch.column(0).slice(512 * at, 512).to_pylist(), texts, strict=True):
                    waiting += [(doc_id, *piece) for piece in pieces(encoder.encode(text), end_id, capacity)]
                    if len(waiting) >= window:
                        pack(waiting)
            yield out.batch()
        pack(waiting)
        for bin_ in packer.rest():
            close(bin_, -1 if sum(item[3] for item, _ in bin_) >= full * capacity else part // gather)
        yield out.batch()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs the pieces of each group, which come the longest first; the numbers of their sequences are negative."""
        group, packer, made, out = -1, BestFit(capacity, open_bins), 0, _Out()

        def close(bin_: list) -> None:
            nonlocal made
            for item, offset in bin_:
                out.add(*item, -1 - (group << 32) - made, offset)
            made += 1

        def end() -> None:
            for bin_ in packer.rest():
                close(bin_)

        for batch in batches:
            for *item, of in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != group:
                    end()
                    group, packer, made = of, BestFit(capacity, open_bins), 0
                for bin_ in _bins(packer.add(item, item[3])):
                    close(bin_)
            yield out.batch()
        end()
        yield out.batch()

    packed = materialise(id_and_text(docs, id_col, text_col).mapInArrow(first, f"{SCHEMA}, open long"), "packed")
    loose = packed.where("open >= 0").select(*_NAMES[:5], "open").repartition("open").sortWithinPartitions("open", F.desc("length"), "doc_id", "piece")
    return packed.where("open < 0").select(_NAMES).unionByName(loose.mapInArrow(second, SCHEMA))
