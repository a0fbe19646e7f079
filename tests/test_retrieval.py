import math
import random
import re

from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import chunking, ordering, retrieval
from lectern.plans import settings as S


def plain_score(question, text, texts):
    words = lambda t: set(re.findall(r"\w+", t.lower()))
    df = lambda w: sum(w in words(t) for t in texts)
    score = 0.0
    for w in words(question):
        weight = math.log((len(texts) + 1) / (df(w) + 1)) + 1 if df(w) else 1.0
        score += text.lower().count(w) * weight
    for p in re.findall(X.PROPER_NOUN, question):
        if len(p.strip()) > 3 and p.strip().lower() in text.lower():
            score += S.PHRASE_BONUS
    return score


def test_scores_match_the_definition(spark):
    rng = random.Random(5)
    words = ["a", "aa", "aaa", "ab", "ba", "bab", "Foo", "Bar", "foobar", "aabaa"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(30)]
    asked = ["aa b", "see Foo Bar now", "zzz", "Foo Bar and Bar Foo", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    qs = spark.createDataFrame(list(enumerate(asked)), "q long, question string")
    found = {(r.q, r.doc): r.score for r in retrieval.scores(qs, docs, "q", "question", "doc").collect()}
    for q, question in enumerate(asked):
        for d, text in enumerate(texts):
            assert abs(found.get((q, d), 0.0) - plain_score(question, text, texts)) < 1e-5, (question, text)


def test_phrases_that_end_inside_a_word(spark, monkeypatch):
    """Phrases have no letters but those of PROPER_NOUN, so their longest word may be no word of the question."""
    texts = ["the foo queci\u00e7\u00e3o", "foo quecix foo", "foo", "bar2 foo b", "", "the foo bar9"]
    asked = ["see Foo Queci\u00e7\u00e3o", "Foo Bar9", "Foo Queci\u00e7\u00e3o and Foo Bar9"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    qs = spark.createDataFrame(list(enumerate(asked)), "q long, question string")
    want = {(q, d): round(plain_score(question, text, texts), 5) for q, question in enumerate(asked) for d, text in enumerate(texts)}
    for scanned in (retrieval.SCANNED, 0):
        monkeypatch.setattr(retrieval, "SCANNED", scanned)
        for least in (0.0, 50.0):
            found = {(r.q, r.doc): round(r.score, 5) for r in retrieval.scores(qs, docs, "q", "question", "doc", least=least).collect()}
            assert found == {k: v for k, v in want.items() if v > 0 and v >= least}
            assert sum(v >= 50 for v in found.values()) == 6


def test_prefilter_branches(spark):
    docs = spark.createDataFrame([(i, i, "apple " * (i % 3)) for i in range(10)], "doc long, position long, text string")
    qs = spark.createDataFrame([(0, "apple"), (1, "pear"), (2, "")], "q long, question string")
    some = retrieval.prefilter(qs, docs, "q", "question", "doc", "position", limit=4)
    ids = lambda df, q: [r.doc for r in df.where(F.col("q") == q).orderBy("rank").collect()]
    assert ids(some, 0) == [2, 5, 8, 1] and ids(some, 1) == [0, 1, 2, 3] and ids(some, 2) == [0, 1, 2, 3]
    every = retrieval.prefilter(qs, docs, "q", "question", "doc", "position", limit=10)
    assert ids(every, 0) == list(range(10))


def plain_neighbours(cands, sources, most, cap):
    out, seen = list(cands), set(cands)
    for c in cands:
        for d in S.NEIGHBOUR_STEPS:
            n = c + d
            if 0 <= n < len(sources) and n not in seen and sources[n] == sources[c] and len(out) < len(cands) + most:
                seen.add(n)
                out.append(n)
    return out[:cap]


def test_neighbours_match_a_loop(spark):
    rng = random.Random(9)
    sources = [rng.choice("ab") for _ in range(40)]
    chunks = spark.createDataFrame([(i, i, s) for i, s in enumerate(sources)], "doc long, position long, source string")
    cands = {q: rng.sample(range(40), rng.randint(1, 8)) for q in range(25)}
    rows = spark.createDataFrame([(q, d, d, k + 1) for q, ds in cands.items() for k, d in enumerate(ds)], "q long, doc long, position long, rank int")
    got: dict[int, list[int]] = {}
    for r in retrieval.neighbours(rows, chunks, "q", "doc", "position", "source", most=6, cap=10).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.doc)
    assert got == {q: plain_neighbours(ds, sources, 6, 10) for q, ds in cands.items()}


def test_budget():
    texts = ["w " * 400 for _ in range(30)]
    n, words, prompt = retrieval.fit_budget(texts, "q?", 150, 3_000)
    assert n < 30 and words == 150 and prompt.count("ID: ") == n
    n, words, prompt = retrieval.fit_budget(texts, "q?", 150, 300)
    assert n == 5 and words < 150
    assert retrieval.fit_budget(texts, "q?", 150, 1)[:2] == (5, 20)
    assert retrieval.fit_budget([], "q?", 150, 1)[0] == 0


def test_local_ids(spark):
    rows = spark.createDataFrame([(0, 'x {"candidate_chunks":[1,1,99,"a",0]} y', [7, 8]), (1, "none", [7]), (2, '{"candidate_chunks": []}', [7]), (3, '{"candidate_chunks": ["1", 0, 1.0, true, null, [1], 2e0, 99999999999]}', [7, 8, 9]), (4, '{"candidate_chunks": {"0": 1}}', [7])], "k int, reply string, used array<long>")
    got = {r.k: r.ids for r in rows.select("k", retrieval.real_ids(retrieval.local_ids(F.col("reply")), F.col("used")).alias("ids")).collect()}
    assert got[0] == [8, 7] and not got[1] and got[2] == [] and not got[4]
    assert got[3] == [7, 8]  # no quoted numbers, no fractions; true is 1


def test_scores_by_scan_and_by_joins_are_alike(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["Hà Nội aaa", "hà nội aaaa", None, ""]
    asked = [" ".join(word() for _ in range(rng.randint(0, 6))) for _ in range(25)] + ["Where is Hà Nội aa", "", None]
    chunks = spark.createDataFrame(list(enumerate(texts)), "c int, text string").repartition(3)
    questions = spark.createDataFrame(list(enumerate(asked)), "q long, question string")
    found = lambda most: {(r.q, r.c): r.score for r in retrieval.scores(questions, chunks, "q", "question", "c", most=most).collect()}
    whole, best = found(None), found(3)
    monkeypatch.setattr(retrieval, "SCANNED", 0)
    joined = found(None)
    assert whole.keys() == joined.keys() and all(abs(whole[k] - joined[k]) < 1e-5 for k in whole)
    assert len(whole) > 500 and whole[25, 60] > 50 and whole[25, 61] > 50
    for q in range(len(asked)):
        top = sorted((s for (k, _), s in whole.items() if k == q), reverse=True)[:3]
        assert sorted((s for (k, _), s in best.items() if k == q), reverse=True)[:3] == top


def test_a_counter_of_ones_own(spark):
    rows = spark.createDataFrame([(0, "a b c d e f")], "k int, text string")
    words = lambda t: len(t.split())
    assert rows.select(chunking.pieces(F.col("text"), 2, count=words).alias("p")).first().p == ["a b", "c d", "e f"]
    got = chunking.split_items(rows, "text", F.lit("s"), ["k"], overlap=0, limit=4, count=words)
    assert [r.text for r in got.orderBy("chunk_id").collect()] == ["a b c d", "e f"]


def test_limits(spark):
    rows = spark.createDataFrame([("one-hop", "easy"), ("multi-hop", "easy"), ("table", "hard"), (None, None)], "a string, b string")
    assert [r[0] for r in rows.select(retrieval.candidate_limit(F.col("a"), F.col("b"))).collect()] == [100, 120, 120, 100]


def test_positions_and_overlap(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 30, 0]))) for _ in range(300)]
    for i in range(1, 300, 7):
        texts[i] = texts[i - 1] + " q"
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string").repartition(7)
    placed = ordering.with_position(frame, [F.col("k")], "at").collect()
    assert all(r.k == r.at for r in placed)
    want, before = [], None
    for t in texts:
        if before is not None and before.split():
            tail = " ".join(before.split()[-10:])
            t = t if t.startswith(tail) else tail + "\n" + t
        want.append(t)
        before = t
    got = {r.k: r.text for r in chunking.apply_overlap(frame, "k", "text", n_words=10, block=37).collect()}
    assert [got[i] for i in range(300)] == want


def test_text_columns(spark):
    rows = spark.createDataFrame([("  a b\n c ", None, "in/x.pdf"), ("", "n", "")], "t string, f string, s string")
    got = rows.select(X.strip(F.col("t")).alias("t"), X.words(F.col("t")).alias("w"), X.file_name(F.col("s"), F.col("f")).alias("f"), X.first_given(F.col("s"), F.col("f")).alias("s"), X.payload_estimate(F.col("t"), F.col("s")).alias("n")).collect()
    assert got[0].w == ["a", "b", "c"] and got[0].f == "x.pdf" and got[1].f == "n" and got[1].s == "n" and got[1].n == 50
    media = rows.limit(1).select(X.media_segments(F.lit("a<img x><TABLE>\n<img></table>")).alias("m")).first().m
    assert [(m.segment, m.is_media) for m in media] == [("a", False), ("<img x>", True), ("<TABLE>\n<img></table>", True)]
    assert rows.limit(1).select(X.fill("{a}-{b}", a=F.lit("{b}"), b=F.lit("$1\\"))).first()[0] == "$1\\-$1\\"
    assert rows.limit(1).select(X.table_rows_apart(F.lit("x 1. 12345678 A 12. 87654321 B"))).first()[0] == "x \n1. 12345678 A \n12. 87654321 B"
