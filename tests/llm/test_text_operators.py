import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import best_fit_packing as pack
from lectern.llm import lm_scoring as lm
from lectern.llm import piece_viterbi as pv
from lectern.llm import quality_rules as quality
from lectern.llm import token_counts as counts
from lectern.llm import toxicity as tox
from lectern.llm.common import public_vocabulary

WHITE = "[\x20\x09-\x0d]+"


def words_of(text):
    return [w for w in re.split(WHITE, text or "") if w]


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=public_vocabulary("piece_bpe_32k.model"))


def test_spliced_chunks_equal_the_library(library):
    rng = random.Random(4)
    alphabets = ["ab ", "the and of  ", "日本語テキスト", "aaaaaaaa", "é😀\n\t x", "0123456789abcdef", " "]
    for n in range(150):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 1500)))
        encoder = counts.ResyncEncoder(public_vocabulary("piece_bpe_32k.model"), rng.choice([40, 100, 300]), rng.choice([4, 12, 30]))
        assert encoder.encode(text) == library.encode(text), n


def test_overlap_is_widened(library):
    encoder = counts.ResyncEncoder(public_vocabulary("piece_bpe_32k.model"), 30, 2)
    text = "hello world " * 40 + "一" * 50 + "a" * 300
    assert encoder.encode(text) == library.encode(text) and encoder.widened > 0


def test_count_tokens(spark, odd_docs, empty_docs, library):
    got = counts.count_tokens(odd_docs, chunk_chars=1000, overlap_chars=50).collect()
    texts = [r.text or "" for r in odd_docs.collect()]
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for t in texts)
    assert counts.count_tokens(empty_docs).count() == 0


# ---------------------------------------------------------------- quality rules


def plain_base(text):
    w = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def plain_buckets(text):
    h = [xxhash.xxh64(t.encode(), seed=42).intdigest() for t in re.findall(r"[^\W_]+|[^\s\w]+|_+|[^\w\s]*_[^\w\s]*", text)]
    both = [((a << 1) & (2**64 - 1)) ^ b for a, b in zip(h, h[1:], strict=False)]
    return [x >> 48 for x in h + both]


def test_base_statistics(spark, odd_docs):
    more = spark.createDataFrame([(11, "a b a b a b a b\n\n \na b\na b", None, None, None), (12, "x y z x y z", None, None, None), (13, " é # $ %\t\x0b\x0c a", None, None, None), (14, "a a a a " * 30, None, None, None)], odd_docs.schema)
    docs = odd_docs.unionByName(more)
    got = Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.base_stats(docs).collect())
    assert got == Counter(plain_base(r.text) for r in docs.collect())


def test_ratio_matches_a_plain_count(spark):
    rng = random.Random(6)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta."]) for _ in range(60 + i)) for i in range(20)]
    junk = [" ".join(rng.choice(["%%%", "x%%", "$$$ beta"]) for _ in range(60 + i)) for i in range(5)]
    texts = good + junk
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 10), 0) for i in range(12)], "doc_id long, quality int, toxic int")
    target, raw = Counter(), Counter()
    for i, text in enumerate(texts):
        raw.update(plain_buckets(text))
        if i < 10:
            target.update(plain_buckets(text))
    t, r, b = sum(target.values()), sum(raw.values()), quality.BUCKETS
    weight = lambda k: np.log((target[k] + 1) / (t + b)) - np.log((raw[k] + 1) / (r + b))
    for row in quality.quality_rules(docs, labels).collect():
        grams = plain_buckets(texts[row.doc_id])
        assert row.n_grams == len(grams) and abs(row.score - np.mean([weight(k) for k in grams])) < 1e-6


def test_quality_odd_inputs(spark, odd_docs, empty_docs, no_labels):
    rows = quality.quality_rules(odd_docs, no_labels).collect()
    assert len(rows) == 9 and all(r.score == 0 for r in rows)
    assert quality.quality_rules(empty_docs, no_labels).count() == 0
    kept = quality.keep_good(odd_docs, no_labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in rows)


# ---------------------------------------------------------------- pieces


def plain_segment(model, scores, text):
    best = [(0.0, ())]
    for end in range(1, len(text) + 1):
        found = (best[end - 1][0] + model.unknown_score, best[end - 1][1] + tuple(model.byte_ids[b] for b in text[end - 1].encode()))
        for start in range(end):
            piece = scores.get(text[start:end])
            if piece and best[start][0] + piece[0] > found[0]:
                found = (best[start][0] + piece[0], best[start][1] + (piece[1],))
        best.append(found)
    return list(best[-1][1])


def test_viterbi_matches_all_splits(library):
    model = pv.PieceModel.read(public_vocabulary("piece_bpe_32k.model"))
    scores = {library.id_to_piece(i): (library.get_score(i), i) for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}
    rng = random.Random(8)
    for _ in range(60):
        text = "".join(rng.choice("thewordsand  éü日\n\t.") for _ in range(rng.randint(0, 60)))
        marked = (pv.SPACE + text.replace(" ", pv.SPACE)) if text else ""
        want = plain_segment(model, scores, marked)
        assert model.encode(text).tolist() == want == model.segment(marked)
        assert model.decode(want) == text


def test_pieces_over_frames(spark, odd_docs, empty_docs):
    rows = pv.piece_viterbi(odd_docs, with_ids=True)
    assert all(r.round_trip and r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows.collect())
    texts = sorted(r.text for r in pv.decode_pieces(rows).collect())
    assert texts == sorted(r.text or "" for r in odd_docs.collect())
    assert pv.piece_viterbi(empty_docs).count() == 0


# ---------------------------------------------------------------- language models


def test_lm_matches_a_plain_model(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["red", "blue", "green", "odd1", "Big", "42", "!!"]) for _ in range(rng.randint(0, 25))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    size = lm.SHAPES + 3
    top = [w for w, _ in sorted(Counter(w for t in texts for w in lm._TOKEN.findall(t)).items(), key=lambda x: (-x[1], x[0]))[:3]]
    code = lambda w: lm.SHAPES + top.index(w) if w in top else lm.shape(w)
    events = [[0, *map(code, lm._TOKEN.findall(t)), 0] for t in texts]
    tables = np.zeros((2, size, size))
    for i, e in enumerate(events):
        for v, w in zip(e, e[1:], strict=False):
            tables[0, v, w] += 1
            tables[1, v, w] += i < 20 and i % 2
    for r in lm.lm_scoring(docs, labels, vocabulary=size).collect():
        e = events[r.doc_id]
        own = np.zeros((size, size))
        for v, w in zip(e, e[1:], strict=False):
            own[v, w] += 1
        loss = [lm.losses(tables[0] - own), lm.losses(tables[1] - own * (r.doc_id < 20 and r.doc_id % 2))]
        want = [np.mean([m[v, w] for v, w in zip(e, e[1:], strict=False)]) for m in loss]
        assert r.n_tokens == len(e) - 2 and abs(r.ce_background - want[0]) < 1e-4 and abs(r.ce_target - want[1]) < 1e-4 and abs(r.ce_difference - (want[1] - want[0])) < 1e-4


def test_quality_target_has_every_labelled_row(spark):
    n = 20_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("alpha").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    weights = quality.ratio_model(docs.unionByName(docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit("beta").alias("text"))), labels).first()["weights"]
    # of 2n rows the half are targets, and all of these are alike
    assert abs(max(weights) - (np.log((n + 1) / (n + quality.BUCKETS)) - np.log((n + 1) / (2 * n + quality.BUCKETS)))) < 1e-9


def test_lm_counts_every_word(spark):
    rng = random.Random(13)
    texts = [" ".join(f"word{int(rng.random() ** 3 * 4000)}" for _ in range(rng.randint(0, 90))) for _ in range(200)]
    texts += ["common zebra", "common tiger", "common zebra"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([*((i, i % 2, 0) for i in range(60)), (200, 1, 0)], "doc_id long, quality int, toxic int")
    names = sorted({w for t in texts for w in lm._TOKEN.findall(t)})
    assert len(names) > 2048
    code = {w: i + 1 for i, w in enumerate(names)}
    events = [[0, *(code[w] for w in lm._TOKEN.findall(t)), 0] for t in texts]
    size, pairs, single = len(names) + 1, (Counter(), Counter()), (Counter(), Counter())
    for i, e in enumerate(events):
        for k in (0, 1) if i == 200 or i < 60 and i % 2 else (0,):
            pairs[k].update(zip(e, e[1:], strict=False))
            single[k].update(e[1:])
    total = [sum(c.values()) for c in single]
    rows = {r.doc_id: r for r in lm.lm_scoring(docs, labels).collect()}
    assert len(rows) == len(texts)
    for i, e in enumerate(events):
        pair, one, want = Counter(zip(e, e[1:], strict=False)), Counter(e[1:]), []
        for k, own in ((0, 1), (1, int(i == 200 or i < 60 and i % 2))):  # no text is scored by its own counts
            n = total[k] - own * len(e[1:])
            p = lambda v, w: (pairs[k][v, w] - own * pair[v, w] + lm.MASS * (single[k][w] - own * one[w] + 1) / (n + size)) / (single[k][v] - own * one[v] + lm.MASS)  # noqa: B023, E731
            want.append(np.mean([-np.log2(p(v, w)) for v, w in zip(e, e[1:], strict=False)]))
        assert rows[i].n_tokens == len(e) - 2 and abs(rows[i].ce_background - want[0]) < 1e-9 and abs(rows[i].ce_target - want[1]) < 1e-9
    assert rows[200].ce_difference != rows[201].ce_difference  # words of one shape
    assert rows[200].ce_background == rows[202].ce_background and rows[202].ce_target < rows[200].ce_target
    assert rows[200].ce_background < rows[201].ce_background  # a text that occurs twice is known to the model, its single likes are not


def test_lm_odd_inputs(spark, odd_docs, empty_docs, no_labels):
    rows = lm.lm_scoring(odd_docs, no_labels, vocabulary=64).collect()
    assert len(rows) == 9 and all(r.ce_difference == 0 for r in rows)
    assert lm.lm_scoring(empty_docs, no_labels, vocabulary=64).count() == 0
    p = 2.0 ** -lm.losses(np.random.default_rng(0).integers(0, 9, (12, 12)))
    assert np.allclose(p.sum(1), 1)


# ---------------------------------------------------------------- packing


def plain_best_fit(lengths, capacity, open_bins):
    bins, closed = [], []
    for item, n in enumerate(lengths):
        fitting = [b for b in bins if b[0] >= n]
        if fitting:
            bin_ = min(fitting, key=lambda b: b[0])
        else:
            if len(bins) >= open_bins:
                fullest = min(bins, key=lambda b: b[0])
                bins.remove(fullest)
                closed.append(fullest)
            bins.append(bin_ := [capacity, []])
        bin_[0] -= n
        bin_[1].append(item)
        if not bin_[0]:
            bins.remove(bin_)
            closed.append(bin_)
    return closed + bins


def test_best_fit_matches_a_scan():
    rng = random.Random(3)
    for _ in range(40):
        lengths = [rng.randint(1, 50) for _ in range(200)]
        packer, done = pack.BestFit(50, 4), []
        for i, n in enumerate(lengths):
            done += pack._bins(packer.add(i, n))
        done += packer.rest()
        want = plain_best_fit(lengths, 50, 4)
        assert sorted(i for b in done for i, _ in b) == list(range(200))
        assert sorted(50 - sum(lengths[i] for i, _ in b) for b in done) == sorted(b[0] for b in want)
        for b in done:
            assert [o for _, o in b] == list(np.cumsum([0] + [lengths[i] for i, _ in b])[:-1])


def test_packing_round_trip(spark, odd_docs, empty_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_vocabulary("byte_bpe_50k.json"))
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["word", "été", "x1", "Abc,", "日本"]) for _ in range(rng.choice([1, 5, 80, 900]))), None, None, None) for i in range(100, 200)]
    rows.append((200, "before <|endoftext|> after", None, None, None))
    docs = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(spark.createDataFrame(rows, odd_docs.schema)).repartition(5)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = pack.best_fit_packing(docs, open_bins=3, window=7, gather=2).collect()
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in texts.items()}
    by_doc, by_bin = {}, {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length <= 1024 and zlib.crc32(part.tobytes()) == r.ids_crc32
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, parts in by_doc.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[2] for p in parts) == len(ids[d])
        assert len(parts) == -(-len(ids[d]) // 1024) and all(p[2] == 1024 for p in parts[1:])
    for parts in by_bin.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(n for _, n in parts) <= 1024
    assert by_doc.keys() == texts.keys()
    assert len(by_bin) <= 1.2 * sum(map(len, ids.values())) / 1024 + 3
    assert pack.best_fit_packing(empty_docs).count() == 0
    assert pack.best_fit_packing(odd_docs).where("piece = 0").count() == 9


def test_both_encoders_give_the_ids_of_the_library():
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(public_vocabulary("byte_bpe_50k.json")), pack.ByteEncoder()
    rng = random.Random(12)
    latin = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x180)]))
    for n in range(400):
        alphabet = latin if n % 4 else latin + "日本語😀\u00ad\x00αβ"
        text = "".join(rng.choice(rng.choice((alphabet, "  the and of", "aaaa\n\n", "it's we'll 1234"))) for _ in range(rng.randint(0, 300)))
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


# ---------------------------------------------------------------- toxicity


def plain_grams(text):
    codes = [32 if c in range(9, 14) else c for c in map(ord, f" {text.lower()} ")]
    out = set()
    for n in tox.ORDERS:
        for k in range(len(codes) - n + 1):
            h = 0
            for c in codes[k : k + n]:
                h = (h * 0x100000001B3 + c + 1) % 2**64
            out.add(((h + n) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - tox.BITS))
    return out


def test_present_matches_a_scan():
    texts = ["Abc dEf\n", "", "abc def ghi", "é" * 9, "日本語 😀 テスト"]
    who, bucket = tox.present(texts)
    assert set(zip(who.tolist(), bucket.tolist(), strict=True)) == {(i, h) for i, t in enumerate(texts) for h in plain_grams(t)}


def plain_toxicity(texts, labels):
    """(features, weights, bias): counts in sets, ratios one by one, and the regression by plain descent on dense rows until it rests."""
    sets, size = [plain_grams(t) for t in texts], Counter(labels)
    ratio = {}
    for g in set().union(*sets):
        toxic, clean = (sum(g in s for s, y in zip(sets, labels, strict=True) if y == label) for label in (1, 0))
        r = np.log((toxic + 1) / (size[1] + 2)) - np.log((clean + 1) / (size[0] + 2))
        if toxic + clean >= 3 and abs(r) / np.sqrt(1 / (toxic + 1) + 1 / (clean + 1)) > tox.MIN_STRENGTH:
            ratio[g] = r
    names = sorted(ratio)
    x = np.array([[ratio[g] if g in s else 0.0 for g in names] + [1.0] for s in sets])
    y, w = np.array(labels, float), np.zeros(len(names) + 1)
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    penalty = np.append(np.full(len(names), tox.DECAY), 0)
    rate = 1 / (np.linalg.norm(x, 2) ** 2 / 4 + tox.DECAY)
    now, speed = w.copy(), 0
    for k in range(60_000):
        ahead = now + (k / (k + 3)) * speed
        new = ahead - rate * (x.T @ (1 / (1 + np.exp(-x @ ahead)) - y) + penalty * ahead)
        now, speed = new, new - now
    return dict(zip(names, now[:-1] * [ratio[g] for g in names], strict=True)), now[-1]


def toxic_corpus(rng, n):
    plain = ["river", "stone", "garden", "window", "bread", "music", "letter"]
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(3, 9))]
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "grim"]))
        yield i, " ".join(words), int(i % 4 == 0) if rng.random() < 0.9 else 1 - int(i % 4 == 0)


def test_model_matches_a_plain_one(spark):
    rows = list(toxic_corpus(random.Random(9), 120))
    weights, bias = plain_toxicity([t for _, t, _ in rows], [y for *_, y in rows])
    model = tox.fit([t for _, t, _ in rows], [y for *_, y in rows])
    assert set(np.flatnonzero(model.weights)) <= set(weights) and len(weights) > 5
    assert abs(model.bias - bias) < 0.02 and all(abs(model.weights[g] - w) < 0.02 for g, w in weights.items())
    # the tables give the model of the texts, whatever tasks count them
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    want = tox.fit([t for _, t, _ in learnt], [y for *_, y in learnt])
    got = tox.train(docs, marks)
    assert np.allclose(got.weights, want.weights, atol=1e-4) and abs(got.bias - want.bias) < 1e-4


def test_toxicity_is_learnt(spark, odd_docs, empty_docs, no_labels):
    rng = random.Random(5)
    plain = ["river", "stone", "garden", "window", "bread", "music", "letter"]
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["vileword", "grimslur"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in tox.toxicity(docs, marks).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(900))
    held = [(got[i].predicted, labels[i][2], got[i].score) for i in range(900) if got[i].held_out]
    assert sum(p == t for p, t, _ in held) >= 0.98 * len(held) and all(0 <= s <= 1 for *_, s in held)
    kept = tox.keep_clean(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got.values())
    # labels that are held out are never read
    flipped = spark.createDataFrame([(i, 1, 1 - t if got[i].held_out else t) for i, _, t in labels], marks.schema)
    assert {r.doc_id: r.score for r in tox.toxicity(docs, flipped).collect()} == {i: r.score for i, r in got.items()}
    rows = tox.toxicity(odd_docs, no_labels).collect()
    assert len(rows) == 9 and len({r.score for r in rows}) == 1
    assert tox.toxicity(empty_docs, no_labels).count() == 0 and tox.keep_clean(odd_docs, no_labels).count() == 9
