"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

Characters are the code points of the lower-cased text, white space as one kind; n-grams of 3 to 7 of them are hashed to 2^20
buckets by a rolling product over the whole batch at once. Those that begin with a space tell how words begin. A feature is present in a
text or not. For each bucket the log-count ratio is r = ln((toxic + 1) / (all toxic + 2)) - ln((clean + 1) / (all clean + 2)) over the
training texts. The buckets whose ratio is furthest from zero in standard errors (MIN_STRENGTH at least, at most MAX_FEATURES buckets)
stay; regularised logistic regression then weights the features x * r. Any other bucket has weight zero, so the length of a text alone
moves no score.

Training reads labelled rows whose crc32(doc_id as text) mod 3 is not 1, and of these at most TRAIN_ROWS, those whose ids hash
lowest. Their texts are counted in TRAIN_TASKS tasks, which exchange counts of buckets; of each text only the numbers of its chosen
features, MAX_FEATURES at most, meet in the one task of the regression. Scoring is a narrow pass over whole texts with the model (4 MB
at most) in each task.

Defined results: null text counts as empty and scores the bias alone; a null id is not held out; without labels, or with labels of one
kind only, every text scores the smoothed share of toxic labels; repeated rows each give a row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, in_slices, materialise, small_batches

TRAIN_ROWS = 16_000
TRAIN_TASKS = 8
MAX_FEATURES = 8_192
MIN_STRENGTH = 3.5
DECAY = 0.1
ORDERS = (3, 4, 5, 6, 7)
BITS = 20
BLOCK_BITS = 14
THRESHOLD = 0.7
BATCH_CHARS = 1 << 19
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _buckets(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order n, the bucket of the n-gram at each place."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    rolled = codes
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            if len(rolled) < 2:
                return
            rolled = rolled[:-1] * _STEP + codes[n - 1 :]
        if n in ORDERS:
            yield n, (((rolled + np.uint64(n)) * _MIX) >> np.uint64(64 - BITS)).astype(np.int32)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, with one space around each, and where each starts; the last entry is the end."""
    lower = [t.lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lower) + " ").encode("utf-32-le", "replace"), "<u4")
    starts = np.cumsum([1] + [len(t) + 1 for t in lower])
    return np.where((codes >= 9) & (codes <= 13), np.uint32(32), codes), starts


def present(texts: list[str], chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of the n-grams present, each once. chosen: only buckets where it is true."""
    codes, starts = _joined(texts)
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), np.diff(starts))])  # the space before a text is its own or of the one before
    keys = []
    for n, bucket in _buckets(codes):
        at = np.arange(len(bucket)) if chosen is None else np.flatnonzero(chosen[bucket])
        who = owner[at + 1]  # the text of the second character
        inside = at + n <= starts[who + 1]  # to the space after the text at most
        keys.append((who[inside].astype(np.int64) << BITS) | bucket[at[inside]])
    unique = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    unique.sort()  # quicker than np.unique, which hashes
    unique = unique[np.concatenate([[True], unique[1:] != unique[:-1]])] if len(unique) else unique
    return unique >> BITS, unique & ((1 << BITS) - 1)


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about BATCH_CHARS; a longer text is a run of its own."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > BATCH_CHARS:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, texts[at:]


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.chosen = weights, bias, weights != 0

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if self.chosen.any():
            for at, some in _slices(texts):
                who, bucket = present(some, self.chosen)
                out[at : at + len(some)] += np.bincount(who, self.weights[bucket], len(some))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def count_texts(texts: list[str], toxic: np.ndarray) -> np.ndarray:
    """[label, bucket]: in how many texts of each label a bucket is present."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for at, some in _slices(texts):
        who, bucket = present(some)
        for label in (0, 1):
            counts[label] += np.bincount(bucket[toxic[at + who] == label], minlength=1 << BITS)
    return counts


def strengths(counts: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratios of buckets, and how many standard errors they are from zero; 0 for buckets of fewer than three texts."""
    ratio = np.log((counts[1] + 1) / (sizes[1] + 2)) - np.log((counts[0] + 1) / (sizes[0] + 2))
    error = np.sqrt(1 / (counts[1] + 1) + 1 / (counts[0] + 1))
    return ratio, np.abs(ratio) / error * (counts.sum(0) >= 3)


def choose(buckets: np.ndarray, strength: np.ndarray, most: int) -> np.ndarray:
    """Places of the strongest buckets, ties by bucket."""
    order = np.lexsort((buckets, -strength))
    return order[strength[order] > MIN_STRENGTH][:most]


def regress(row: np.ndarray, column: np.ndarray, ratio: np.ndarray, y: np.ndarray, decay: float = DECAY, steps: int = 12, inner: int = 30) -> tuple[np.ndarray, float]:
    """Weights of the features (those of text `row` are `column`, of value ratio[column]) and the bias.

    Logistic regression with a penalty of decay / 2 on the squared weights, but not on the bias, by Newton steps that conjugate gradients solve.
    """
    n, k = len(y), len(ratio)
    scaled = ratio[column]
    forth = lambda v: np.bincount(row, v[column] * scaled, n) + v[k]
    back = lambda r: np.append(np.bincount(column, r[row] * scaled, k), r.sum())
    penalty = np.append(np.full(k, decay), 1e-6)
    start = np.log((y.sum() + 1) / (n - y.sum() + 1))
    loss = lambda v, z: np.logaddexp(0, z).sum() - y @ z + (penalty * v) @ v / 2
    w = np.append(np.zeros(k), start)
    z = forth(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        gradient, curve = back(p - y) + penalty * w, p * (1 - p) + 1e-9
        step, rest = np.zeros(k + 1), -gradient
        way, size = rest.copy(), float(rest @ rest)
        if size < 1e-10:
            break
        first = size
        for _ in range(inner):
            turned = back(curve * forth(way)) + penalty * way
            length = size / float(way @ turned)
            step, rest = step + length * way, rest - length * turned
            size, before = float(rest @ rest), size
            if size < 1e-8 * first:
                break
            way = rest + size / before * way
        along, now, scale = forth(step), loss(w, z), 1.0
        while loss(w + scale * step, z + scale * along) > now and scale > 1e-4:
            scale /= 2
        w, z = w + scale * step, z + scale * along
    return w[:k], float(w[k])


def fit(texts: list[str], toxic: list[int], max_features: int = MAX_FEATURES) -> Model:
    """The model of texts at hand, as `train` learns it from tables."""
    y, size = np.array(toxic, np.int64), 1 << BITS
    weights, n = np.zeros(size, np.float32), (int((y == 0).sum()), int((y == 1).sum()))
    if not all(n):
        return Model(weights, float(np.log((n[1] + 1) / (n[0] + 1))))
    ratio, strength = strengths(count_texts(texts, y), n)
    best = choose(np.arange(size), strength, max_features)
    place, chosen = np.zeros(size, np.int64), np.zeros(size, bool)
    place[best], chosen[best] = np.arange(len(best)), True
    found = [(at + who, place[bucket]) for at, some in _slices(texts) for who, bucket in [present(some, chosen)]]
    w, bias = regress(*(np.concatenate(x) for x in zip(*found, strict=True)), ratio[best], y.astype(float))
    weights[best] = w * ratio[best]
    return Model(weights, bias)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, toxic of the training texts, written in TRAIN_TASKS parts."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # at most train_rows pairs of numbers
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic")
    return materialise(rows.repartition(TRAIN_TASKS, "doc_id"), "labelled")


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", max_features: int = MAX_FEATURES) -> Model:
    """Learns from at most train_rows labelled rows that are not held out, and their repetitions."""
    texts = sample(docs, labels, train_rows, id_col, text_col)
    by_label = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n, size, step = (by_label.get(0, 0), by_label.get(1, 0)), 1 << BITS, 1 << BLOCK_BITS
    weights = np.zeros(size, np.float32)
    if not all(n):
        return Model(weights, float(np.log((n[1] + 1) / (n[0] + 1))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            toxic, at = np.asarray(batch.column(1)), 0
            for some in in_slices(batch.column(0)):
                total += count_texts(some, toxic[at : at + len(some)])
                at += len(some)
        if total.any():
            blocks = total.astype("<u4").reshape(2, -1, step)
            yield pa.RecordBatch.from_arrays([pa.array(range(size // step), pa.int32()), pa.array([blocks[:, k].tobytes() for k in range(size // step)], pa.binary())], ["block", "counts"])

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block the buckets that may be chosen."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, "<u4").reshape(2, step).astype(np.int64)
        for block, counts in sums.items():
            ratio, strength = strengths(counts, n)
            buckets = block * step + np.arange(step)
            best = choose(buckets, strength, max_features)
            yield pa.RecordBatch.from_arrays([pa.array(buckets[best].astype(np.int32)), pa.array(ratio[best]), pa.array(strength[best])], ["bucket", "ratio", "strength"])

    with small_batches(docs.sparkSession):
        blocks = texts.select("text", "toxic").mapInArrow(count, "block int, counts binary").repartition("block")
        best = blocks.mapInArrow(strongest, "bucket int, ratio double, strength double").orderBy(F.desc("strength"), "bucket").limit(max_features).collect()
    buckets, ratio = np.array([r["bucket"] for r in best], np.int64), np.array([r["ratio"] for r in best], float)
    place = np.full(size, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    # the chosen buckets, max_features at most
    shipped = docs.sparkSession.sparkContext.broadcast((buckets, ratio))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, chosen = np.zeros(size, np.int32), np.zeros(size, bool)
        place[shipped.value[0]], chosen[shipped.value[0]] = np.arange(len(shipped.value[0])), True
        for batch in batches:
            found = []
            for texts in in_slices(batch.column(1)):
                for _, some in _slices(texts):
                    who, bucket = present(some, chosen)
                    parts = np.split(place[bucket], np.searchsorted(who, np.arange(1, len(some))))
                    found += [np.sort(p).astype("<u2" if len(shipped.value[0]) <= 1 << 16 else "<u4").tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "toxic", "features"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shipped.value[1]
        rows = sorted(r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        kind = "<u2" if len(ratio) <= 1 << 16 else "<u4"
        parts = [np.frombuffer(r[2], kind).astype(np.int64) for r in rows]
        w, bias = regress(np.repeat(np.arange(len(rows)), [len(p) for p in parts]), np.concatenate(parts), ratio, np.array([r[1] for r in rows], float))
        # the bias stands in a row of its own
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(w)), -1).astype(np.int32)), pa.array(np.append(w, bias))], ["feature", "weight"])

    reduced = texts.mapInArrow(features, "doc_id long, toxic int, features binary")
    bias = 0.0
    for feature, weight in reduced.repartition(1).mapInArrow(solve, "feature int, weight double").collect():
        if feature < 0:
            bias = weight
        else:
            weights[buckets[feature]] = weight * ratio[feature]
    return Model(weights, bias)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""
    load = _shipped(docs, train(docs, labels, train_rows, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            scores = np.concatenate([np.zeros(0), *(model.scores(texts) for texts in in_slices(batch.column(1)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return id_and_text(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(run, SCHEMA)


def _shipped(docs: DataFrame, model: Model):
    """A function that gives the model in a task; what is broadcast has MAX_FEATURES weights at most."""
    used = np.flatnonzero(model.weights).astype(np.int32)
    shipped = docs.sparkSession.sparkContext.broadcast((used, model.weights[used], model.bias))

    def load() -> Model:
        at, values, bias = shipped.value
        weights = np.zeros(1 << BITS, np.float32)
        weights[at] = values
        return Model(weights, bias)

    return load


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns; nothing is joined or shuffled."""
    load, text_at = _shipped(docs, train(docs, labels)), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            scores = np.concatenate([np.zeros(0), *(model.scores([t or "" for t in texts]) for texts in in_slices(batch.column(text_at)))])
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
