import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.functions import splitting as P
from lectern.plans import settings as S

TEXT = st.text(alphabet="ab .\n\té", max_size=400)


def test_estimate():
    assert [P.estimate(x) for x in (None, "", "a", "ab", "abc", "x" * 22)] == [0, 0, 1, 1, 2, 11]


@given(TEXT, st.integers(3, 40))
@settings(max_examples=200, deadline=None)
def test_pieces_keep_all_words_in_order(text, limit):
    pieces = P.split_text(text, limit)
    assert all(p.strip() for p in pieces)
    glued = "".join("".join(p.split()) for p in pieces)
    whole = "".join(text.split())
    # only ". " loses a mark where it is cut
    assert glued.replace(".", "") == whole.replace(".", "")
    assert all(P.estimate(p) <= limit or len(p.split()) <= limit for p in pieces)


def test_pieces_by_separator():
    assert P.split_text("aaaa\n\nbbbb\n\ncc", 4) == ["aaaa", "bbbb\n\ncc"]
    assert P.split_text("aaaa\n\nb", 4) == ["aaaa\n\nb"]
    assert P.split_text("  \n ", 5) == []
    assert P.split_text("x" * 50, 5) == ["x" * 50]  # a long word stays whole
    assert P.split_text("one two three", 100) == ["one two three"]


def test_batches_and_leaves():
    assert P.batches([3, 3, 3, 9, 1], 6) == [0, 0, 1, 2, 3]
    assert P.batches([], 6) == []
    lengths = [random.Random(1).randint(1, 400) for _ in range(50)]
    groups: dict[int, list[str]] = {}
    for n, leaf in zip(lengths, P.leaf_numbers(lengths, 100), strict=True):
        groups.setdefault(leaf, []).append("x" * n)
    assert sorted(groups) == list(range(len(groups)))
    assert all(P.estimate("\n".join(g)) <= 100 or len(g) == 1 for g in groups.values())
    firsts = list(groups.values())
    assert all(P.estimate("\n".join([*a, b[0]])) > 100 for a, b in zip(firsts, firsts[1:], strict=False))


def test_balanced_object():
    assert P.balanced_object('x {"a": {"b": 1}} y}') == '{"a": {"b": 1}}'
    assert P.balanced_object(" none ") == "none"
    assert P.balanced_object('{"a": 1 ') == '{"a": 1'
    assert P.balanced_object('```json {"a": 1}```') == '{"a": 1}'


def test_repair():
    assert P.repaired_json('{"items": [1]}') == {"items": [1]}
    assert P.repaired_json('{"items":[{"id":0,"level":1},{"id":1,"lev') == {"items": [{"id": 0, "level": 1}]}
    assert P.repaired_json("no json") is None
    assert P.repaired_json("{bad}", lambda t: '{"fixed": true}') == {"fixed": True}
    assert P.close_truncated("abc") is None


def test_overlap():
    assert P.with_overlap("a b", "a b c") == "a b c"
    assert P.with_overlap("a b", "c") == "a b\nc"
    assert P.with_overlap("", "c") == "c"
    assert P.last_words(" ".join(map(str, range(80))), 3) == "77 78 79"
    assert S.Limits().prompt == 60_512


def test_loops_hold_few_texts_at_a_time(spark, monkeypatch):
    """Of an Arrow batch SLICE texts are Python strings at a time, and runs go on from slice to slice."""
    from pyspark.sql import functions as F

    from lectern.operators import chunking

    monkeypatch.setattr(chunking, "SLICE", 3)
    texts = [" ".join(f"w{i}x{k}" for k in range(i % 7)) for i in range(40)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string").repartition(2)
    want, tail = [], ""
    for t in texts:
        want.append(P.with_overlap(tail, t))
        tail = P.last_words(want[-1], 5)
    got = {r.k: r.text for r in chunking.apply_overlap(frame, "k", "text", n_words=5, block=11).collect()}
    assert got == dict(enumerate(want))
    pieces = {r.k: r.p for r in frame.select("k", chunking.pieces(F.col("text"), 4).alias("p")).collect()}
    assert pieces == {i: P.split_text(t, 4) for i, t in enumerate(texts)}
