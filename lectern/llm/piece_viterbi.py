"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The best segmentation of a text is the one of the highest sum of piece scores. The automaton reads the text once; at each character it gives
every piece that ends there (its own and those along its output links), and each relaxes the best score at that place. A character
that no piece covers costs the lowest score less 10 and becomes its UTF-8 bytes. Of equal sums the longer last piece wins.
This is the segmentation of a unigram model with the file's scores; for a file of merges (whose scores are negative ranks) it differs
from the merge order by design, and only the vocabulary and scores are shared with the library's encoding.

Spaces become U+2581, with one in front of the text. If no piece has U+2581 after another character, which is checked when the model is
read, no piece crosses the start of a word, and the best segmentation of a text is that of its words, one after another. Words are kept in
a bounded cache, so a frequent one is segmented once. Otherwise texts are segmented whole.

Decoding joins the pieces and bytes, turns U+2581 into spaces and drops the one in front. It gives the text back, but for a U+2581
of the text itself, which is decoded as a space, as the library does.

Defined results: null and empty texts have no pieces; a null id stays null; lone surrogates count as "?"; repeated rows each give a row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, public_vocabulary

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 300_000
SCHEMA = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean"


class PieceModel:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: dict[int, int], unknown_id: int = 0):
        import ahocorasick

        self.unknown_id, self.byte_ids = unknown_id, byte_ids
        self.bytes_of: dict[int, bytes] = {i: bytes([b]) for b, i in byte_ids.items()}
        self.bytes_of |= {i: p.replace(SPACE, " ").encode() for i, p, _ in pieces}
        self.automaton = ahocorasick.Automaton()
        for i, piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score, i))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces
        self.unknown_score = min((s for _, _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for _, p, _ in pieces)
        self._cache: dict[str, bytes] = {}

    @classmethod
    def read(cls, model_file: str) -> PieceModel:
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=model_file)
        every = range(m.get_piece_size())
        byte_ids = {int(m.id_to_piece(i)[3:5], 16): i for i in every if m.is_byte(i)}
        plain = [(i, m.id_to_piece(i), m.get_score(i)) for i in every if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        return cls(plain, byte_ids, m.unk_id())

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of text, in which spaces are U+2581 already."""
        n = len(text)
        best = [0.0] + [-np.inf] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        at, low = 1, self.unknown_score
        found = iter(()) if self.empty else self.automaton.iter(text)
        # matches come by place of their end, the longest first; so ties keep the longer piece
        for end, (length, score, i) in found:
            end += 1
            while at < end:  # places that no piece reached on time
                if best[at - 1] + low > best[at]:
                    best[at], back[at] = best[at - 1] + low, (at - 1, -1)
                at += 1
            score += best[end - length]
            if score > best[end]:
                best[end], back[end] = score, (end - length, i)
        while at <= n:
            if best[at - 1] + low > best[at]:
                best[at], back[at] = best[at - 1] + low, (at - 1, -1)
            at += 1
        out: list[int] = []
        while n:
            start, i = back[n]
            if i >= 0:
                out.append(i)
            else:
                raw = text[start:n].encode("utf-8", "replace")
                out += [self.byte_ids[b] for b in reversed(raw)] if self.byte_ids else [self.unknown_id]
            n = start
        out.reverse()
        return out

    def _packed(self, word: str) -> bytes:
        found = self._cache.get(word)
        if found is None:
            if len(self._cache) >= CACHE_WORDS:
                self._cache.clear()
            found = np.array(self.segment(word), "<u4").tobytes()
            if len(word) <= 64:
                self._cache[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, "<u4")
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return np.array(self.segment(text), "<u4")
        packed = self._packed
        return np.frombuffer(b"".join([packed(w) for w in _WORD.findall(text)]), "<u4")

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text; unknown ids without bytes give U+2047."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        get = self.bytes_of.get
        raw = b"".join([get(i, b"\xe2\x81\x87") for i in ids])
        return raw.decode("utf-8", "replace").removeprefix(" ")


#: A run of U+2581 and what follows up to the next.
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


def piece_viterbi(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_pieces, n_byte_pieces, ids_crc32 and round_trip (decoding gave the text back); with_ids: ids too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.read(model_file or public_vocabulary("piece_bpe_32k.model"))
        is_byte = np.zeros(max([0, *model.byte_ids.values()]) + 2, bool)
        is_byte[list(model.byte_ids.values())] = True
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = model.encode(text)
                n_bytes = int(is_byte[np.minimum(ids, len(is_byte) - 1)].sum())
                rows.append((doc_id, len(ids), n_bytes, zlib.crc32(ids.tobytes()), model.decode(ids) == text.replace(SPACE, " "), ids))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
            width = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:width], kinds[:width], strict=True)], [*SCHEMA.replace(" boolean", "").replace(" long", "").split(", "), "ids"][:width])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA + ", ids array<long>" * with_ids)


def decode_pieces(rows: DataFrame, model_file: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows with an array of piece ids; a null array gives the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.read(model_file or public_vocabulary("piece_bpe_32k.model"))
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    from pyspark.sql import functions as F

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<long>").alias("ids")).mapInArrow(run, "doc_id long, text string")
