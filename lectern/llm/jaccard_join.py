"""N-gram Jaccard join: components of documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

The join is a sparse product of the document by shingle incidence matrix with its transpose, done in blocks of shingles, on the part of
the matrix that the bounds leave over:

1. Sets. A shingle is a 64-bit hash; documents of equal sets have one signature and count as one row of the matrix from here on.
2. Order. A sketch of fixed size counts in how many sets the shingles of each slot occur. It gives a total order of shingles, the
   rarest first. Any total order is right; this one keeps shared passages out of the next step.
3. Rows are cut to their first n - ceil(0.8 n) + 1 shingles: two sets that are similar enough share one of those. These entries, packed in
   binary, are dealt to blocks of shingles, and each block lists the rows of each of its shingles.
4. Stars. In each list every row is paired with the list's first one, and whole sets decide a row's few pairs of most overlap. So most of
   a group of thousands of near copies becomes one component by as many pairs as it has members.
5. The product. Lists whose rows are all in one component are done, as more links cannot change it. In the others all pairs of rows of
   different components are looked at where they stand: 512 bits of parity of each set bound its difference from another one from
   below, and only pairs that this bound lets reach 0.8 are noted, as packed partners of a row. Overlaps are then summed
   over all blocks, and a pair is dropped if they plus all that the cut shingles could add stay below 4/9 of the two sizes,
   which is what 0.8 needs. Whole sets decide the rest. Nothing is lost by step 4.

A shingle that the sketch finds in more than `list_rows` sets is split: its rows are salted, and each pair of salts is a list of
its own, so no task holds more than about twice that number of rows of one shingle.

Defined results: null text, no words: an empty set (n_shingles 0), linked with nothing; fewer than five words: one shingle, the whole
sequence; a null id has its n_shingles, but no component; repeated rows are copies of each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import delete, freed_shuffles, id_and_text, in_slices, materialise
from .components import components

WIDTH = 5
SLOT_BITS = 18
SKETCH_BLOCK = 1 << 14
LIST_ROWS = 50_000
PARITY_BITS = 512
STAR_PAIRS = 3
#: Bits of the filter of ids: by their number, from FILTER_BITS[0] to FILTER_BITS[1] (32 MB); beyond what that holds, ids are joined.
FILTER_BITS = (24, 28)
#: Entries of a bucket: 48 MB.
BUCKET_ENTRIES = 1 << 21
_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
_ENTRY = np.dtype([("h", "<u8"), ("sig", "<u8"), ("n", "<u4"), ("cell", "<u4")])


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the different shingles; bytes.lower and bytes.split know A-Z and the six white characters only."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    width = min(width, len(words))
    mixed = h[: len(h) - width + 1] + np.uint64(width)
    for k in range(1, width):
        mixed = mixed * _P1 + h[k : len(h) - width + 1 + k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _P2
    mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def signature(found: np.ndarray, salt: int = 0) -> int:
    """64 bits of a set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes(), seed=len(found) + (salt << 40))).astype(np.int64))


def parity(found: np.ndarray) -> bytes:
    """For each of PARITY_BITS slots, whether an odd number of the shingles falls there. Two sets differ in at least as many shingles as their bits do."""
    odd = np.bincount((found & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def kept_entries(n):
    """How many of a set's n shingles the prefix bound needs."""
    return n - (4 * n + 4) // 5 + 1


def _sets(docs: DataFrame, salt: int = 0) -> DataFrame:
    """doc_id, n, sig, bits of each row; and, where block is not null, the counts of a part of the sketch."""
    names, kinds = ["doc_id", "n", "sig", "bits", "block", "counts"], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << SLOT_BITS, np.int64), set()
        for batch in batches:
            sizes, sigs, bits = [], [], []
            for texts in in_slices(batch.column(1)):
                slots = []
                for text in texts:
                    found = shingles(text)
                    sizes.append(len(found))
                    sigs.append(signature(found, salt) if len(found) else None)
                    bits.append(parity(found) if len(found) else None)
                    if len(found) and sigs[-1] not in seen:
                        seen.add(sigs[-1])
                        slots.append((found >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
                if slots:
                    sketch += np.bincount(np.concatenate(slots), minlength=len(sketch))
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip((sizes, sigs, bits, none, none), kinds[1:], strict=True))], names)
        if sketch.any():
            parts = sketch.astype("<u4").reshape(-1, SKETCH_BLOCK)
            none = [None] * len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((none, none, none, none, list(range(len(parts))), [p.tobytes() for p in parts]), kinds, strict=True)], names)

    return docs.mapInArrow(run, "doc_id long, n long, sig long, bits binary, block int, counts binary")


def _sketch(sets: DataFrame) -> np.ndarray:
    """The counts of all slots: a table of fixed size, summed by tasks of which each has some blocks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "counts"])

    out = np.zeros((1 << SLOT_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.int64).reshape(-1, SKETCH_BLOCK)
    for row in sets.where("block IS NOT NULL").select("block", "counts").repartition("block").mapInArrow(add, "block int, counts binary").collect():
        out[row["block"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def _splits(sketch: np.ndarray, list_rows: int) -> np.ndarray:
    """By slot, into how many salts a shingle is split: from what its slot has above the noise of all slots."""
    usual = float(np.median(sketch))
    above = sketch - usual - 4 * np.sqrt(usual)
    return np.maximum(1, np.ceil(above / list_rows)).astype(np.int64)


def _entries(docs: DataFrame, sketch: np.ndarray, list_rows: int, buckets: int, salt: int = 0) -> DataFrame:
    """bucket and packed entries of the cut rows of the matrix."""
    shipped = docs.sparkSession.sparkContext.broadcast((sketch, _splits(sketch, list_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, splits = shipped.value
        seen: set[int] = set()

        def dealt(parts: list[np.ndarray]) -> pa.RecordBatch:
            every = np.concatenate(parts) if parts else np.zeros(0, _ENTRY)
            split = splits[every["h"] >> np.uint64(64 - SLOT_BITS)]
            hot = split > 1
            if hot.any():  # a row of salt s stands in the lists of the pairs of salts (s, t) for all t
                more = [every[~hot]]
                for e, r in zip(every[hot], split[hot].tolist(), strict=True):
                    s = int(e["sig"]) % r
                    own = np.repeat(e, r)
                    t = np.arange(r)
                    own["cell"] = 1 + np.minimum(s, t) * r + np.maximum(s, t)
                    more.append(own)
                every = np.concatenate(more)
            bucket = ((every["h"] + every["cell"] * _P1) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            every, bucket = every[order], bucket[order]
            bounds = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, int)
            return pa.RecordBatch.from_arrays([pa.array(bucket[bounds[:-1]]), pa.array([every[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["bucket", "entries"])

        for batch in batches:
            parts, held = [], 0
            for text in (t for texts in in_slices(batch.column(1)) for t in texts):
                found = shingles(text)
                if not len(found) or (sig := signature(found, salt)) in seen:
                    continue
                seen.add(sig)
                rarest = np.argsort(counts[found >> np.uint64(64 - SLOT_BITS)], kind="stable")[: kept_entries(len(found))]
                own = np.zeros(len(rarest), _ENTRY)
                own["h"], own["sig"], own["n"] = found[rarest], np.int64(sig).astype(np.uint64), len(found)
                parts.append(own)
                held += len(own)
                if held > 250_000:
                    yield dealt(parts)
                    parts, held = [], 0
            yield dealt(parts)

    return docs.mapInArrow(run, "bucket int, entries binary")


def _counted(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different pairs (a, b) with their sizes and how often they occur."""
    order = np.lexsort((b, a))
    a, b, na, nb = a[order], b[order], na[order], nb[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, int)
    return a[first], b[first], na[first], nb[first], np.diff(np.concatenate([first, [len(a)]]))


def _lists(entries: DataFrame) -> DataFrame:
    """The lists of two rows or more (h, cell, sig, n); and star pairs (sig, n, leader, leader_n, overlap), where h is null."""
    names = ["h", "cell", "sig", "n", "leader", "leader_n", "overlap"]

    def block(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        every = np.frombuffer(b"".join(parts), _ENTRY)
        every = every[np.lexsort((every["sig"], every["cell"], every["h"]))]
        same = (every["h"][1:] == every["h"][:-1]) & (every["cell"][1:] == every["cell"][:-1])
        every = every[np.concatenate([[True], ~(same & (every["sig"][1:] == every["sig"][:-1]))])]
        new = np.concatenate([[True], (every["h"][1:] != every["h"][:-1]) | (every["cell"][1:] != every["cell"][:-1])])
        start = np.flatnonzero(new)
        length = np.diff(np.concatenate([start, [len(every)]]))
        many = np.repeat(length > 1, length)
        leader = every[np.repeat(start, length)][many]
        every, first = every[many], new[many]
        signed = lambda x: pa.array(x.astype(np.int64))
        none = pa.nulls(len(every), pa.int64())
        yield pa.RecordBatch.from_arrays([signed(every["h"]), signed(every["cell"]), signed(every["sig"]), signed(every["n"]), none, none, none], names)
        n, m = every["n"].astype(np.int64), leader["n"].astype(np.int64)
        ok = ~first & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m))
        a, b, na, nb, c = _counted(every["sig"][ok], leader["sig"][ok], n[ok], m[ok])
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, signed(a), signed(na), signed(b), signed(nb), signed(c)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now and parts:
                    yield from block(parts)
                    parts = []
                now = bucket
                parts.append(packed)
        if parts:
            yield from block(parts)

    return entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ", ".join(f"{n} long" for n in names))


_PARTNER = np.dtype([("b", "<i8"), ("nb", "<i4"), ("c", "<i4")])


def _partners(rows: DataFrame) -> DataFrame:
    """a, na, partners (packed): per block of lists the rows of other components that stand in a list with a, have a larger id, and may be
    similar enough by size and parity, with the number of such lists; from rows (h, cell, node, n, component, bits)."""

    def pairs(keys: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Of whole lists, all at once: rows are sorted by list and size, so the partners of a row are those up to 5/4 of its size."""
        start = np.flatnonzero(np.concatenate([[True], (keys[1:, :2] != keys[:-1, :2]).any(1)]))
        length = np.diff(np.concatenate([start, [len(keys)]]))
        node, n, component = keys[:, 2], keys[:, 3], keys[:, 4]
        base = np.repeat(np.arange(len(start)), length) * (8 * int(n.max(initial=0)) + 8)
        count = np.searchsorted(base + 4 * n, base + 5 * n, "right") - np.arange(len(n)) - 1
        sums, at = np.cumsum(count), 0
        while at < len(n):
            done = sums[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sums, done + 100_000, "right")))
            i = np.repeat(np.arange(at, to), count[at:to])
            j = i + 1 + np.arange(len(i)) - np.repeat(sums[at:to] - count[at:to] - done, count[at:to])
            apart = component[i] != component[j]
            i, j = i[apart], j[apart]
            differ = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            near = 9 * ((n[i] + n[j] - differ) // 2) >= 4 * (n[i] + n[j])
            i, j = i[near], j[near]
            swap = node[i] > node[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            yield node[i], node[j], n[i], n[j]
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            a, b, na, nb, c = _counted(*(np.concatenate(x) for x in zip(*held, strict=True))) if held else (np.zeros(0, np.int64),) * 5
            held.clear()
            packed = np.zeros(len(a), _PARTNER)
            packed["b"], packed["nb"], packed["c"] = b, nb, c
            bounds = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1], [True]])) if len(a) else np.zeros(1, int)
            first = bounds[:-1]
            return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(na[first].astype(np.int64)), pa.array([packed[x:y].tobytes() for x, y in zip(first, bounds[1:], strict=True)], pa.binary())], ["a", "na", "partners"])

        def of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            keys, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
            for found in pairs(keys, bits) if len(keys) else ():
                held.append(found)
                if sum(len(x[0]) for x in held) > 500_000:
                    yield flush()

        rest: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the last list so far
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(c) for c in batch.columns[:5]], 1)
            bits = np.frombuffer(b"".join(batch.column(5).to_pylist()), "<u8").reshape(len(keys), -1)
            other = (keys[:, :2] != keys[-1, :2]).any(1)
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if whole or (rest and (rest[-1][0][-1, :2] != keys[0, :2]).any()):
                yield from of([*rest, (keys[:whole], bits[:whole])])
                rest = []
            rest.append((keys[whole:], bits[whole:]))
        if rest:
            yield from of(rest)
        yield flush()

    dealt = rows.select("h", "cell", "node", "n", "component", "bits").repartition("h", "cell").sortWithinPartitions("h", "cell", "n", "node")
    return dealt.mapInArrow(run, "a long, na long, partners binary")


def _summed(partners: DataFrame) -> DataFrame:
    """a, b of the pairs whose overlap over all blocks may be enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(a: int, na: int, parts: list[bytes]) -> pa.RecordBatch:
            every = np.frombuffer(b"".join(parts), _PARTNER)
            every = every[np.argsort(every["b"], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], every["b"][1:] != every["b"][:-1]]))
            b, nb = every["b"][first], every["nb"][first].astype(np.int64)
            shared = np.add.reduceat(every["c"].astype(np.int64), first)
            good = 9 * (shared + np.maximum(na, nb) - kept_entries(np.maximum(na, nb))) >= 4 * (na + nb)
            return pa.RecordBatch.from_arrays([pa.array(np.full(int(good.sum()), a)), pa.array(b[good])], ["a", "b"])

        now, parts = None, []
        for batch in batches:
            for a, na, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (a, na):
                    if parts:
                        yield of(*now, parts)
                    now, parts = (a, na), []
                parts.append(packed)
        if parts:
            yield of(*now, parts)

    return partners.repartition("a").sortWithinPartitions("a").mapInArrow(run, "a long, b long")


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """u, v of the pairs (a, b) of ids, a written table, whose whole sets are similar enough."""
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    n_ids = ids.count()
    docs = docs.where("doc_id IS NOT NULL")
    if 4 * n_ids > 1 << FILTER_BITS[1]:
        docs, whole, size = docs.join(ids.hint("merge"), "doc_id", "left_semi").withColumn("slot", F.lit(0).cast("long")), np.ones(1, np.uint8), 1
    else:
        size = 1 << min(max((16 * n_ids).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(size))
        # a filter, in rows of 32,768 bits; what it lets through in error meets no pair
        bits = ids.select((slot + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
        whole = np.zeros(size // 8 + 4096, np.uint8)
        for row in bits:  # Spark numbers bits from 1, and rows too
            at = (row["k"] - 1) * 4096
            whole[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
        docs = docs.withColumn("slot", slot)
    shipped = docs.sparkSession.sparkContext.broadcast(whole)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            slots = np.asarray(batch.column(2))
            hit = np.flatnonzero((known[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
            some = batch.take(pa.array(hit))
            for at in range(0, len(hit), 512):
                texts = some.column(1).slice(at, 512).to_pylist()
                yield pa.RecordBatch.from_arrays([some.column(0).slice(at, 512), pa.array([shingles(t).tobytes() for t in texts], pa.binary())], ["doc_id", "shingles"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= 80 * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    found = docs.mapInArrow(sets, "doc_id long, shingles binary")
    x, y = found.withColumnsRenamed({"doc_id": "a", "shingles": "x"}), found.withColumnsRenamed({"doc_id": "b", "shingles": "y"})
    # the side of many different ids first: a leader of thousands meets one copy of its set, and Spark may split its rows
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(decide, "u long, v long")


def _signed(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The sets; sig, node, n, bits of the different ones; and the salt of the signatures.

    Sets of one signature are told apart by their sizes and parities, 512 bits that do not depend on it. If such sets meet, all
    signatures are made anew with another salt.
    """
    for salt in range(16):
        found = materialise(_sets(docs, salt), "sets")
        own = F.struct("n", "bits")
        grouped = found.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("node"), F.min(own).alias("x"), F.max(own).alias("y"))
        rows = materialise(grouped.select("sig", "node", "x.n", "x.bits", (F.col("x") == F.col("y")).alias("alike")), "rows")
        if rows.where("NOT alike").isEmpty():
            return found, rows.drop("alike"), salt
    raise RuntimeError("different sets have one signature under each salt")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", list_rows: int = LIST_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id."""
    with freed_shuffles(docs.sparkSession):
        sets, named = _components(id_and_text(docs, id_col, text_col), list_rows)
    out = sets.join(named, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _components(docs: DataFrame, list_rows: int) -> tuple[DataFrame, DataFrame]:
    """The sets (doc_id, n, sig), and the component of each signature. What was written is deleted where nothing reads it any more."""
    found, rows, salt = _signed(docs)
    sets = found.where("block IS NULL").select("doc_id", "n", "sig")
    named = rows.select("sig", "node")
    kept = rows.agg(F.sum(F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1)).first()[0] or 0
    buckets = max(8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), kept // BUCKET_ENTRIES)
    lists = materialise(_lists(_entries(docs.where("doc_id IS NOT NULL"), _sketch(found), list_rows, buckets, salt)), "lists")

    stars = lists.where("h IS NULL").groupBy("sig", "leader").agg(F.sum("overlap").alias("overlap"))
    # the leaders of one row: as many as it has entries at most
    stars = stars.withColumn("k", F.row_number().over(Window.partitionBy("sig").orderBy(F.desc("overlap"), "leader"))).where(F.col("k") <= STAR_PAIRS)
    stars = stars.join(named, "sig").withColumnRenamed("node", "a").join(named.select(F.col("sig").alias("leader"), F.col("node").alias("b")), "leader").select("a", "b")
    linked = materialise(_verified(docs, materialise(stars, "stars")), "linked")
    near = components(linked)

    member = lists.where("h IS NOT NULL").select("h", "cell", "sig", "n").join(rows.select("sig", "node", "bits"), "sig").join(near, "node", "left")
    member = materialise(member.select("h", "cell", "node", "n", F.coalesce("component", "node").alias("component"), "bits"), "members")
    delete(lists)
    mixed = member.groupBy("h", "cell").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("h", "cell")
    apart = materialise(_summed(_partners(member.join(mixed, ["h", "cell"], "left_semi"))), "apart")
    delete(member)
    final = materialise(components(linked.unionByName(_verified(docs, apart))), "components")
    return sets, materialise(named.join(final, "node", "left").select("sig", F.coalesce("component", "node").alias("component")), "named")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of docs whose id is that of their component, and those without an id, with all their columns.

    Of an id that has several texts, one text keeps the id and each other one gets a number above all ids for the join, so that it is judged by itself.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.struct(*columns).alias("row"))
    texts = held.where("doc_id IS NOT NULL").select("doc_id", own.alias("h")).groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    several = materialise(texts.where("low <> high").select("doc_id", "low"), "several")
    if several.isEmpty():
        named = held.withColumn("node", F.col("doc_id"))
    else:
        top = held.agg(F.max("doc_id")).first()[0]
        others = held.select("doc_id", own.alias("h")).join(several, "doc_id").where("h <> low").select("doc_id", "h").distinct()
        others = materialise(others, "others").select("doc_id", "h", (F.lit(top + 1) + F.monotonically_increasing_id()).alias("other"))
        others = materialise(others, "numbered")
        named = held.withColumn("h", own).join(others, ["doc_id", "h"], "left").select("text", "row", F.coalesce("other", "doc_id").alias("node"))
        named = materialise(named, "nodes")
    dropped = jaccard_join(named, "node").where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("node")).distinct()
    return named.join(dropped, "node", "left_anti").select("row.*")
