"""LM scoring by cross-entropy difference of a target and a background model.

Both are bigram models over all words of the corpus and one event for the bounds of a text. The background model counts every
document, the target model every labelled document of quality 1; neither is a sample, and no word or bigram is left out. Both are
smoothed alike: P(w | v) = (c(v, w) + m * P(w)) / (c(v) + m), with P(w) = (c(w) + 1) / (N + V), V the number of different events. A
document's score is the mean over its events of the loss in bits under the target model less that under the background model; lower
means nearer to the target. No document is scored by its own counts: they are taken off the models that counted it, so that targets
have no advantage over other documents.

Documents are encoded once, in chunks of about 260,000 tokens, in the shared folder. Words and bigrams have keys of 64 bits. A
chunk's different keys go with their counts to the owners of key ranges; an owner sums up what all chunks count and sends each chunk
the sums of its keys, in their order. So the tables lie with the owners and grow with the corpus, and a frequent key is one entry per
chunk. The driver sees the numbers of events and of words only. Two keys agree by chance with a probability of about n^2 / 2^65 for n
different ones.

Given a `vocabulary`, words outside the most frequent ones (ties by the word itself) count as the class of their shape.

Defined results: a null or empty text is the single event of an empty text (n_tokens 0); without target documents both models are the
background, so the difference is 0; a null id stays null and is never in the target; repeated rows each count and give a row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete, freed_shuffles, id_and_text, materialise, small_batches

MASS = 20.0
CHUNK_TOKENS = 1 << 18
CHUNK_DOCS = 1 << 12
#: Owners of keys: so many at least, and one for each so many events.
BUCKETS = 128
BUCKET_EVENTS = 1 << 22
#: Rows of an Arrow batch; a row is a whole chunk at most.
BATCH_ROWS = 8
FLUSH_WORDS = 200_000
#: Class 0 bounds a text; 1 to 6 are the classes of words outside a given vocabulary.
SHAPES = 7
SCHEMA = "doc_id long, n_tokens long, ce_target double, ce_background double, ce_difference double"
_TOKEN = re.compile(r"\w+|[^\w\s]+")


def shape(word: str) -> int:
    """The class of a word: digits, other marks, capitals, capitalised, short, or other."""
    if word[0].isdigit():
        return 1
    if not (word[0].isalpha() or word[0] == "_"):
        return 2
    if len(word) > 1 and word.isupper():
        return 3
    if word[0].isupper():
        return 4
    return 5 if len(word) <= 4 else 6


def frequent_words(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The `size` most frequent words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(_TOKEN.findall(text))
                if len(seen) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    words = id_and_text(docs, id_col, text_col).select("text").mapInArrow(count, "word string, n long")
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"] for r in top.collect()]


def _key(event: str) -> int:
    return int.from_bytes(hashlib.blake2b(event.encode(), digest_size=8).digest(), "little")


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in the least bytes, all first bytes before all second ones, compressed; the width comes first."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(values) or int(values.max()) < 256**w)
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], decompressed_size=n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.uint64)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data), dtype=np.uint64)


def encode(docs: DataFrame, words: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """chunk, doc_ids, lengths, keys of the chunk's different events (the bound first), and codes: for each token its place in keys."""
    known = None if words is None else docs.sparkSession.sparkContext.broadcast(frozenset(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None if known is None else known.value
        events: dict[str, int] = {}

        class Codes(dict):
            def __missing__(self, word: str) -> int:
                event = word if vocabulary is None or word in vocabulary else f" {shape(word)}"  # no word holds a space
                self[word] = code = events.setdefault(event, len(events))
                return code

        codes = Codes()
        ids: list[int | None] = []
        parts: list[np.ndarray] = []

        def clear() -> None:
            codes.clear(), events.clear(), ids.clear(), parts.clear()
            events[" 0"] = 0

        def flush() -> pa.RecordBatch:
            keys = np.fromiter(map(_key, events), np.uint64, len(events))
            columns = [pa.array([list(ids)], pa.list_(pa.int64())), pa.array([[len(x) for x in parts]], pa.list_(pa.int32()))]
            out = pa.RecordBatch.from_arrays([*columns, pa.array([keys.tobytes()], pa.binary()), pa.array([_pack(np.concatenate(parts))], pa.binary())], ["doc_ids", "lengths", "keys", "codes"])
            clear()
            return out

        clear()
        tokens = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _TOKEN.findall(text)
                ids.append(doc_id)
                parts.append(np.fromiter(map(codes.__getitem__, found), np.uint32, len(found)))
                tokens += len(found)
                if tokens >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                    yield flush()
                    tokens = 0
        if ids:
            yield flush()

    chunks = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_ids array<long>, lengths array<int>, keys binary, codes binary")
    return chunks.select(F.monotonically_increasing_id().alias("chunk"), "*")


class _Chunk:
    """A chunk's events in pairs, and its different keys, of bigrams and of single events, sorted."""

    def __init__(self, lengths: list[int], keys: bytes, codes: bytes):
        self.single = np.frombuffer(keys, "<u8")
        self.lengths = np.array(lengths, np.int64) + 1
        flat = np.zeros(int(self.lengths.sum()) + 1, np.int64)  # zeros bound the texts
        inner = np.ones(len(flat), bool)
        inner[0] = False
        inner[np.cumsum(self.lengths)] = False
        flat[inner] = _unpack(codes)
        self.first, self.second = flat[:-1], flat[1:]
        pairs, self.place = np.unique(self.single[self.first] * np.uint64(0x9E3779B97F4A7C15) + self.single[self.second], return_inverse=True)
        self.pairs = len(pairs)
        both = np.concatenate([pairs, self.single])
        self.order = np.argsort(both, kind="stable")
        self.keys = both[self.order]

    def counts(self, some: np.ndarray) -> np.ndarray:
        """How often each key stands in the texts of `some`, a flag for each text."""
        held = np.repeat(some, self.lengths)
        both = np.concatenate([np.bincount(self.place[held], minlength=self.pairs), np.bincount(self.second[held], minlength=len(self.single))])
        return both[self.order].astype(np.uint64)

    def own_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each event how often its pair, its first and its second event stand in its own text."""
        text = np.repeat(np.arange(len(self.lengths)), self.lengths)

        def within(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return np.unique(text * size + codes, return_inverse=True, return_counts=True)

        _, at, n = within(self.place, self.pairs)
        pair = n[at]
        keys, at, n = within(self.second, len(self.single))
        # each text begins and ends with the bound, so what stands first in a pair stands second in another as often
        return pair, n[np.searchsorted(keys, text * len(self.single) + self.first)], n[at]

    def means(self, sums: np.ndarray, events: int, size: int, mass: float, counted: np.ndarray) -> np.ndarray:
        """The mean loss of each text. sums: the corpus counts of self.keys; counted: a flag for each text, whether they hold its own."""
        counts = np.empty(len(sums))
        counts[self.order] = sums
        single = counts[self.pairs :]
        own = np.repeat(counted, self.lengths)
        pair, first, second = (own * x for x in self.own_counts())
        rest = events - own * np.repeat(self.lengths, self.lengths)
        loss = _loss(counts[: self.pairs][self.place] - pair, single[self.first] - first, single[self.second] - second, rest, size, mass)
        return np.add.reduceat(loss, np.cumsum(self.lengths) - self.lengths) / self.lengths


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Runs of rows with one value in the first column."""
    rows: list[dict] = []
    for batch in batches:
        name = batch.schema.names[0]
        for row in batch.to_pylist():
            if rows and rows[0][name] != row[name]:
                yield rows[0][name], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0][name], rows


def _slices(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted keys, those that have any."""
    step = (1 << 64) // buckets
    ends = [*np.searchsorted(keys, np.arange(1, buckets, dtype=np.uint64) * np.uint64(step)).tolist(), len(keys)]
    for bucket, (begin, end) in enumerate(zip([0, *ends], ends, strict=False)):
        if end > begin:
            yield bucket, slice(begin, end)


def count_events(chunks: DataFrame, buckets: int) -> int:
    """How many different events the corpus has."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                keys = np.sort(np.frombuffer(data, "<u8"))
                rows = [(b, _pack_sorted(keys[at])) for b, at in _slices(keys, buckets)]
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([k for _, k in rows], pa.binary())], ["bucket", "keys"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(np.unique(np.concatenate([_unpack_sorted(r["keys"]) for r in rows]))) for _, rows in _by_key(batches))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    dealt = chunks.select("keys").mapInArrow(deal, "bucket int, keys binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def corpus_counts(marked: DataFrame, buckets: int) -> DataFrame:
    """chunk, bucket, background and target: the counts in the corpus of the chunk's keys, in their order. marked: with `marks`, the places of targets."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row["lengths"], row["keys"], row["codes"])
                every, target = np.ones(len(chunk.lengths), bool), np.zeros(len(chunk.lengths), bool)
                target[row["marks"] or []] = True
                counts = chunk.counts(every), chunk.counts(target)
                rows = [(b, row["chunk"], _pack_sorted(chunk.keys[at]), *(_pack(c[at]) for c in counts)) for b, at in _slices(chunk.keys, buckets)]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "chunk", "keys", "background", "target"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_key(batches):
            keys = [_unpack_sorted(r["keys"]) for r in rows]
            ends = np.cumsum([len(k) for k in keys])[:-1]
            place = np.unique(np.concatenate(keys), return_inverse=True)[1]
            sums = []
            for name in ("background", "target"):
                # sums below 2^53 are exact
                counts = np.bincount(place, np.concatenate([_unpack(r[name]) for r in rows])).astype(np.uint64)
                sums.append(pa.array([_pack(x) for x in np.split(counts[place], ends)], pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()), *sums], ["chunk", "bucket", "background", "target"])

    dealt = marked.select("chunk", "lengths", "keys", "codes", "marks").mapInArrow(deal, "bucket int, chunk long, keys binary, background binary, target binary")
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(total, "chunk long, bucket int, background binary, target binary")


def _loss(pair: np.ndarray, first: np.ndarray, second: np.ndarray, events: np.ndarray | int, size: int, mass: float) -> np.ndarray:
    """-log2 P(w | v) from c(v, w), c(v), c(w), N and V."""
    return -np.log2((pair + mass * (second + 1) / (events + size)) / (first + mass))


def losses(counts: np.ndarray, mass: float = MASS) -> np.ndarray:
    """-log2 P(w | v) for a square table of counts."""
    return _loss(counts, counts.sum(1, keepdims=True), counts.sum(0), counts.sum(), len(counts), mass)


def lm_scoring(docs: DataFrame, labels: DataFrame, vocabulary: int | None = None, mass: float = MASS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ce_target, ce_background, ce_difference."""
    if vocabulary is not None and vocabulary <= SHAPES:
        raise ValueError("the vocabulary holds the classes and a word at least")
    words = None if vocabulary is None else frequent_words(docs, vocabulary - SHAPES, id_col, text_col)
    chunks = materialise(encode(docs, words, id_col, text_col), "chunks")
    trusted = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    texts = chunks.select("chunk", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("at", "x")).select("chunk", "at", F.col("x.doc_ids").alias("doc_id"), (F.col("x.lengths") + 1).alias("n"))
    # the labels grow with the corpus, so they are not broadcast at any size
    marks = texts.join(trusted.hint("merge"), "doc_id").groupBy("chunk").agg(F.collect_list("at").alias("marks"), F.sum("n").alias("n"))
    marks = materialise(marks, "marks")
    background = texts.agg(F.sum("n")).first()[0] or 0
    target = marks.agg(F.sum("n")).first()[0] or 0
    buckets = max(BUCKETS, background // BUCKET_EVENTS)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (own, *sums) in _by_key(batches):
            chunk = _Chunk(own["lengths"], own["keys"], own["codes"])
            of = lambda name, n, counted: chunk.means(np.concatenate([_unpack(r[name]) for r in sums]), n, size, mass, counted)  # noqa: B023, E731
            every, marked = np.ones(len(chunk.lengths), bool), np.zeros(len(chunk.lengths), bool)
            marked[own["marks"] or []] = True
            back = of("background", background, every)
            near = of("target", target, marked) if target else back
            yield pa.RecordBatch.from_arrays([pa.array(own["doc_ids"], pa.int64()), pa.array(chunk.lengths - 1), pa.array(near), pa.array(back), pa.array(near - back)], ["doc_id", "n_tokens", "ce_target", "ce_background", "ce_difference"])

    with small_batches(docs.sparkSession, BATCH_ROWS), freed_shuffles(docs.sparkSession):
        size = count_events(chunks, buckets) if vocabulary is None else vocabulary
        marked = materialise(chunks.join(marks.select("chunk", "marks").hint("merge"), "chunk", "left"), "marked")
        delete(chunks)  # all of it stands in marked
        sums = materialise(corpus_counts(marked, buckets), "sums")
        # a chunk stands before its sums, which come by bucket
        whole = marked.withColumn("bucket", F.lit(-1)).unionByName(sums, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "bucket")
        return materialise(whole.select("chunk", "bucket", "doc_ids", "lengths", "keys", "codes", "marks", "background", "target").mapInArrow(score, SCHEMA), "scores")
