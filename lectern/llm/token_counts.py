"""Token counts of whole texts, with overlap resynchronisation for huge ones.

Short texts are encoded whole. A text of more than `chunk_chars` is encoded as chunks that overlap by `overlap_chars`; each
chunk gives its tokens with offsets, and two neighbours are spliced at a token that both contain at the same place.

Why such a splice is exact. In byte-pair encoding by merge priority, a sequence of tokens is the encoding of its text
if and only if every two adjacent tokens are the encoding of theirs: before the first merge across a boundary takes place, the
two tokens beside it have only merged within themselves, so the same merge would take place in their own text. A spliced
sequence takes every adjacent pair from one of two encodings, as the shared token ends the left part and starts the right
one; so it is the encoding of the whole. Tokens near a cut may be wrong; they are left out since the shared token lies inside.

If two neighbours share no token, the overlap is widened (doubled), in the end to both whole chunks, so any text ends.
This needs a normaliser that maps characters one by one; a model with another one is applied to whole texts.

Defined results: null text counts as empty (0 tokens); a null id stays null; repeated rows each give a row; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import id_and_text, public_vocabulary

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class ResyncEncoder:
    """Encodes as the model's library does, in memory bounded by the chunk size (but for the ids)."""

    def __init__(self, model_file: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        from sentencepiece import SentencePieceProcessor

        if not 0 < overlap_chars < chunk_chars:
            raise ValueError("the overlap must be shorter than a chunk")
        self.model = SentencePieceProcessor(model_file=model_file)
        self.chunk_chars, self.overlap_chars, self.widened = chunk_chars, overlap_chars, 0
        # a normaliser that drops spaces or folds letters would shift what is left of a cut
        probe = "  a  \uff41b \ufb01\t\u2460 "
        self.by_character = self.model.decode(self.model.encode(probe)) == probe

    def _chunk(self, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
        """(begin, end, id) of the tokens of text[start:end], in characters of text."""
        found = self.model.encode(text[start:end], return_type="offset_mapping")
        return [(b + start, e + start, x) for x, (b, e) in zip(found["ids"], found["offsets"], strict=True)]

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.chunk_chars or not self.by_character:
            return self.model.encode(text)
        end = self.chunk_chars
        tokens = self._chunk(text, 0, end)  # always the encoding of text[:end]
        while end < len(text):
            stop = min(end + self.chunk_chars - self.overlap_chars, len(text))
            overlap = self.overlap_chars
            while True:
                start = max(end - overlap, 0)
                right = self._chunk(text, start, stop)
                if not start:
                    tokens = right
                    break
                if (cut := self._common(tokens, right, start)) is not None:
                    tokens[cut[0] + 1 :] = right[cut[1] + 1 :]
                    break
                self.widened += 1
                overlap *= 2
            end = stop
        return [x[2] for x in tokens]

    @staticmethod
    def _common(left: list[tuple[int, int, int]], right: list[tuple[int, int, int]], start: int) -> tuple[int, int] | None:
        """Indexes of a token that both have from `start` on, the middle one of those."""
        at = {x: j for j, x in enumerate(right) if x[1] > x[0]}
        both, i = [], len(left) - 1
        while i >= 0 and left[i][0] >= start:
            if left[i] in at:
                both.append((i, at[left[i]]))
            i -= 1
        return both[len(both) // 2] if both else None


def count_tokens(docs: DataFrame, model_file: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. model_file: a path that every worker can read; None: the public 32k model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ResyncEncoder(model_file or public_vocabulary("piece_bpe_32k.model"), chunk_chars, overlap_chars)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [0] * len(texts)
            for at in range(0, len(texts), 256):
                short = [i for i in range(at, min(at + 256, len(texts))) if len(texts[i]) <= chunk_chars]
                for i, ids in zip(short, encoder.model.encode([texts[i] for i in short], num_threads=1, return_type="numpy"), strict=True):
                    counts[i] = len(ids)
            for i, text in enumerate(texts):
                if len(text) > chunk_chars:
                    counts[i] = len(encoder.encode(text))
            sizes = pc.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
