import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from lectern.operators import answers, labels, model, questions, vectors
from lectern.operators.tree import Node
from lectern.plans import pipeline
from lectern.plans import settings as S
from lectern.sources import readers, sinks, store


@pytest.mark.parametrize(
    ("reply", "n"),
    [
        ('{"questions":[{"question":"q","type":"table","difficulty":"easy","source_chunk_ids":["1"]}]}', 1),
        ('```json\n{"questions":[{"question":"q","type":"table","difficulty":"easy"}]}\n```', 1),
        ('Sure: "questions": [ {"question":"q","type":"one-hop","difficulty":"hard"} ] done', 1),
        ('{"questions":[{"question":"q","type":"other","difficulty":"easy"}, 3, {"type":"table","difficulty":"easy"}]}', 0),
        ("", 0),
        (None, 0),
        ("[]", 0),
    ],
)
def test_question_replies(reply, n):
    assert len(questions.question_items(reply)) == n


def test_source_ids(spark):
    rows = spark.createDataFrame([(["1", "1", "x", "2"], "table"), ([], "multi-hop"), (None, "one-hop"), (["9"], "table")], "l array<string>, k string")
    got = rows.select(questions.normal_source_ids(F.col("l"), F.lit(1), F.array(F.lit("2"), F.lit("3")), F.col("k")).alias("x")).collect()
    assert [r.x for r in got] == [["1", "2"], ["1", "2", "3"], ["1"], ["1"]]


def test_related(spark):
    rows = [(0, "a", "alpha beta gamma"), (1, "a", "delta"), (2, "b", "alpha beta"), (3, "b", "alpha beta"), (4, "", "gamma zeta"), (5, "c", "none1")]
    chunks = spark.createDataFrame([(i, i, s, t) for i, s, t in rows], "id long, pos long, source string, text string")
    got: dict[int, list[int]] = {}
    for r in questions.related_chunks(chunks, "id", "pos", "source").orderBy("id", "slot").collect():
        got.setdefault(r.id, []).append(r.related_id)
    assert got == {0: [1, 2], 1: [0], 2: [3, 0], 3: [2, 0], 4: [0]}
    pair = chunks.where("id = 0").crossJoin(chunks.where("id = 2").select(F.col("text").alias("other")))
    assert pair.select(questions.overlap_score(F.col("text"), F.col("other"))).first()[0] == 2


def test_best_elsewhere_is_the_same_in_both_ways(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, 500 - i, rng.choice(["a", "b", "c", "", None]), " ".join(f"word{int(rng.random() ** 2 * 60)}" for _ in range(rng.randint(0, 25)))) for i in range(150)]
    chunks = spark.createDataFrame(rows, "id long, pos long, source string, text string").repartition(3)
    words = {i: set(t.split()) for i, _, _, t in rows}
    want = {}
    for i, _, s, _ in rows:
        others = [(len(words[i] & words[j]), -p, j) for j, p, z, _ in rows if j != i and not (s and s == z)]
        n, _, j = max(others)
        if n:
            want[i] = (j, n)
    found = lambda: {r.id: (r.other_id, r.overlap) for r in questions.best_elsewhere(chunks, "id", "pos", "source").collect()}
    assert found() == want
    monkeypatch.setattr(questions, "BLOCK_CHUNKS", 40)
    assert found() == want
    monkeypatch.setattr(questions, "BLOCKED_CHUNKS", 0)
    assert found() == want


def test_best_elsewhere_in_passes_over_blocks(spark, monkeypatch):
    """With many chunks a block at a time meets all of them: no pair of blocks is exchanged, and blocks, bits and bounds change no result."""
    rng = random.Random(4)
    rows = [(i, 500 - i, rng.choice(["a", "b", "c", "", None]), " ".join(f"word{int(rng.random() ** 3 * 400)}" for _ in range(int(rng.random() ** 2 * 90)))) for i in range(240)]
    rows += [(300 + i, i, "ab"[i % 2], rows[i][3]) for i in range(40)]
    chunks = spark.createDataFrame(rows, "id long, pos long, source string, text string").repartition(3)
    words = {i: set(t.split()) for i, _, _, t in rows}
    want = {}
    for i, _, s, _ in rows:
        n, _, j = max((len(words[i] & words[j]), -p, j) for j, p, z, _ in rows if j != i and not (s and s == z))
        if n:
            want[i] = (j, n)
    monkeypatch.setattr(questions, "BLOCKED_CHUNKS", 0)
    for block, bits in ((1_000_000, 2_048), (1_500, 64), (300, 150)):
        monkeypatch.setattr(questions, "BLOCK_WORDS", block)
        monkeypatch.setattr(questions, "BIT_WORDS", bits)
        best = questions.best_elsewhere(chunks, "id", "pos", "source")
        found = {r.id: (r.other_id, r.overlap) for r in best.collect()}
        assert {i: n for i, (_, n) in found.items()} == {i: n for i, (_, n) in want.items()}
        place = {i: p for i, p, _, _ in rows}
        assert {i: place[j] for i, (j, _) in found.items()} == {i: place[j] for i, (j, _) in want.items()}


def test_store_exchanges_no_rows_that_are_all_new_or_all_held(spark, tmp_path, monkeypatch):
    aside = []
    monkeypatch.setattr(store, "cut", lambda df, label, cut=store.cut: aside.append(label) or cut(df, label))
    held = store.Store(spark, str(tmp_path)).create()
    rows = lambda *xs: spark.createDataFrame([(i, "b", n, True) for i, n in xs], store.DOCUMENTS)
    names = lambda: sorted((r.id, r.name) for r in held.read("documents").collect())
    held.add("documents", rows(("1", "a"), ("2", "b")))
    held.add("documents", rows(("1", "x"), ("2", "y"), ("2", "z")))
    assert names() == [("1", "a"), ("2", "b")] and aside == []
    held.add("documents", rows(("2", "y"), ("3", "d"), ("3", "c"), ("4", "e")))
    assert names() == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "e")] and aside == ["documents"]


def test_label_replies():
    assert labels.label_items("chunk_id: 3, relevance: 2; chunk_id: 5, relevance: 1") == [(3, 2), (5, 1)]
    assert labels.label_items('{"results":[{"chunk_id":"Chunk 2","relevance":3},{"chunk_id":"x","relevance":3},{"chunk_id":4,"relevance":0},{"relevance":"1"}]}') == [(2, 3), (None, 1)]
    with pytest.raises(ValueError):
        labels.label_items('{"results":[{"chunk_id":1,"relevance":"many"}]}')


def test_answer_replies():
    cases = {
        '{"answer":"a"} trailing }': "a",
        "answer = 'forty two'": "forty two",
        "Answer: forty two": "forty two",
        "There is insufficient data": S.NO_ANSWER,
        "  ": S.NO_ANSWER,
        " plain ": "plain",
        '{"other": 1}': S.NO_ANSWER,
    }
    assert {k: answers.answer_of(k) for k in cases} == cases
    with pytest.raises(AttributeError):
        answers.answer_of("[1]")


def test_retries():
    waits, calls = [], []

    def call(prompt, tokens, timeout):
        calls.append((tokens, timeout))
        raise model.Failure("busy", status=503) if len(calls) < 3 else model.Failure("gone", status=404)

    chat = model.guarded(call, model.Retry(sleep=waits.append))
    with pytest.raises(model.Failure):
        chat("hi")
    assert waits == [5.0, 10.0] and calls[0] == (4000, 200.0)
    with pytest.raises(model.Overlong):
        chat("x" * 200_000)
    waits.clear()
    with pytest.raises(model.Failure):
        model.guarded(lambda *a: "", model.Retry(sleep=waits.append))("hi")
    assert waits == [5, 10, 20, 40]
    r = model.Retry()
    assert [r.wait(n, model.Failure("net")) for n in (1, 2, 5)] == [5.0, 10.0, None]
    events = ['data: {"choices":[{"delta":{"content":"a","reasoning_content":"r"}}]}', ": ping", 'data: {"choices":[{"delta":{"content":"b"},"finish_reason":"stop"}],"usage":{"n":1}}', "data: [DONE]", 'data: {"choices":[{"delta":{"content":"no"}}]}']
    assert model.assemble(events) == ("ab", "r", "stop", {"n": 1})


def test_store(spark, tmp_path):
    held = store.Store(spark, str(tmp_path)).create()
    root = Node("Doc", [Node("A", [Node("apple pie"), Node("pear")]), Node("plum")])
    tables = store.index_trees(spark, {"d1": ("bot", "doc.pdf", root)}, embed=lambda texts: [[float(len(t)), 1.0] for t in texts])
    held.index(*tables)
    held.index(*tables)  # again: nothing is added
    assert [held.read(n).count() for n in ("documents", "nodes", "links")] == [1, 5, 4]
    wanted = spark.createDataFrame([("d1", 0), ("gone", 1)], "document_id string, ord int")
    chunks = store.leaf_chunks(wanted, held.read("documents"), held.read("nodes"), held.read("links")).orderBy("chunk_id").collect()
    assert [c.chunk_id for c in chunks] == [0, 1, 2]
    assert {c.text for c in chunks} == {"[Doc A]\napple pie", "[Doc A]\npear", "[Doc]\nplum"} and chunks[0].metadata.source == "doc.pdf"
    hits = store.search(vectors.vector([14.0, 1.0]), held.read("documents"), held.read("nodes"), held.read("links"), 2).collect()
    assert len(hits) == 2 and all(h.metadata.distance is not None for h in hits)
    assert store.search(vectors.vector([1.0, 1.0]), held.read("documents"), held.read("nodes"), held.read("links"), 2, "other").count() == 0
    assert [r.id for r in store.list_documents(held.read("documents"), "bot").collect()] == ["d1"]
    assert store.jdbc_options({"PG_HOST": "h"})["url"] == "jdbc:postgresql://h:5432/postgres"
    assert held.reset().read("nodes").count() == 0


def test_zero_vectors_come_last(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None)], "id int, e array<float>")
    assert [r.id for r in vectors.nearest(rows, "id", "e", vectors.vector([1.0, 0.0]), 5).collect()] == [2, 1]


def docx(paragraphs):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    body = "".join(p(x) if isinstance(x, str) else "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in row) + "</w:tr>" for row in x) + "</w:tbl>" for x in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<?xml version="1.0"?><w:document {w}><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_docx(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(docx(["1. One", "  ", [[" x &lt;b&gt;y&lt;/b&gt; ", "2"]], "end", [["z"]]]))
    got = readers.docx_documents(readers.read_docx(spark, str(tmp_path))).first()
    assert got.source == "a.docx" and got.lines == ["1. One", "<tab>t0</tab>", "end", "<tab>t1</tab>"]
    assert got.tables == {"t0": "<table><tr><td>x y</td><td>2</td></tr></table>", "t1": "<table><tr><td>z</td></tr></table>"}
    docs = readers.docx_documents(readers.read_docx(spark, str(tmp_path)))
    chunk = pipeline.chunk_documents(docs).first()
    assert chunk.text == "[a.docx]\n1. One\n<table><tr><td>x y</td><td>2</td></tr></table>\nend\n<table><tr><td>z</td></tr></table>" and chunk.metadata.file_name is None


def test_pages_by_parser(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one\x0ctwo")
    got = readers.read_pages(spark, str(tmp_path), lambda b: b.decode().split("\x0c")).orderBy("page").collect()
    assert [(r.page, r.page_content) for r in got] == [(0, "one"), (1, "two")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "é")], "a int, b string")
    assert sinks.export_array(rows.orderBy("a"), str(tmp_path / "x/y.json")) == 2
    assert json.loads((tmp_path / "x/y.json").read_text(encoding="utf-8")) == [{"a": 1, "b": None}, {"a": 2, "b": "é"}]
    assert sinks.export_array(rows.limit(0), str(tmp_path / "e.json")) == 0 and json.loads((tmp_path / "e.json").read_text()) == []
    sinks.write_json(rows, str(tmp_path / "lines"))
    for _ in range(2):
        sinks.write_batch(rows, str(tmp_path / "batches"), "1")
    sinks.write_batch(rows, str(tmp_path / "batches"), "2")
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 4


def test_whole_run(spark):
    from lectern.plans.queries import stand_in
    from lectern.operators.chunking import metadata

    texts = [f"Chunk {i} is about topic{i % 5} and number{i} in Some Place" for i in range(24)]
    chunks = spark.createDataFrame([(i, t, f"s{i % 3}") for i, t in enumerate(texts)], "chunk_id long, text string, s string").select("chunk_id", "text", metadata(source=F.col("s")).alias("metadata"))
    out = pipeline.generate(chunks, stand_in, base=8, most=10)
    retrieved, answered, failed = out.retrieval.collect(), out.qa.collect(), out.failed.collect()
    assert len(retrieved) == len(answered) and len(retrieved) + len(failed) == 24
    for r in retrieved:
        assert all(c.error is None and c.source in {"s0", "s1", "s2"} and c.relevance > 0 for c in r.ground_truth_chunks)
        grades = [c.relevance for c in r.ground_truth_chunks]
        assert grades == sorted(grades, reverse=True)
    none = [r for r in answered if not r.supporting_chunks]
    assert all(r.ground_truth_answer == S.NO_ANSWER for r in none)

    refused = pipeline.generate(chunks, lambda p: 1 / 0, base=8, most=10)
    assert refused.retrieval.count() == 0 and {r.stage for r in refused.failed.collect()} == {"generate_questions"} and refused.failed.count() == 24


def test_a_broken_run_goes_on(spark, tmp_path):
    from lectern.operators.chunking import metadata
    from lectern.plans.queries import stand_in

    log = tmp_path / "log"
    rows = [(i, f"chunk {i} of the river and the stone number {i % 3}") for i in range(8)]
    chunks = spark.createDataFrame(rows, "chunk_id long, text string").withColumn("metadata", metadata(source=F.lit("in/a")))

    def chat(prompt):
        with open(log, "a") as out:
            out.write(prompt[:5] + "\n")
        if prompt.startswith("Grade") and not (tmp_path / "up").exists():
            import os

            os.kill(os.getpid(), 9)
        return stand_in(prompt)

    whole = pipeline.generate(chunks, stand_in).qa.orderBy("question_id").collect()
    with pytest.raises(Exception):  # noqa: B017, PT011
        pipeline.generate(chunks, chat, folder=str(tmp_path / "run")).qa.count()
    (tmp_path / "up").touch()
    before = log.read_text().split().count("Write")
    assert pipeline.generate(chunks, chat, folder=str(tmp_path / "run")).qa.orderBy("question_id").collect() == whole
    said = log.read_text().split()
    assert said.count("Write") == before == 8  # nothing that was answered is asked again
    again = pipeline.generate(chunks, chat, folder=str(tmp_path / "run"))
    assert again.qa.count() == len(whole) and log.read_text().split() == said


def test_calibration(spark):
    rows = spark.createDataFrame([("abcd" * 11, 90), ("", 40)], "p string, n int")
    assert tuple(model.calibration(rows, "p", "n").first()) == (2, (90 - 71 + 40 - 50) / 2, 19)


def test_search_by_text(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(store, "search", lambda query, *rest: (asked.append(spark.range(1).select(query).first()[0]), rest)[1])
    assert store.search_text("q", lambda texts: [[1.0, 2.0] for _ in texts], "d", "n", "l", 3, "b") == ("d", "n", "l", 3, "b", " ")
    assert asked == [[1.0, 2.0]]


def test_stream(spark, tmp_path):
    from lectern.streaming.files import stream_chunks

    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(json.dumps({"source": name, "page": p, "page_content": f"1. {name}\nline {p}"}) for p in range(2)))
        stream_chunks(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.metadata.source for r in rows} == {"a", "b"} and len({r.batch for r in rows}) == 2
