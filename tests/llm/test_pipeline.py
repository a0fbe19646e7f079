import random

import corpus_pipeline


def test_stages_drop_what_they_should(spark, tmp_path):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in ("river", "stone", "garden", "window", "bread") for b in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, text(rng.randint(60, 200))) for i in range(240)]
    toxic = set(range(0, 240, 6))
    rows = [(i, t + " vileword grimslur " + text(3) if i in toxic else t) for i, t in rows]
    short, junk = (1000, "too short"), (1001, " ".join(f"w{i}%%%" for i in range(90)))
    copy, near = (1002, "  ".join(rows[1][1].split(" "))), (1003, " ".join([*rows[2][1].split(" ")[:-1], "changed"]))
    every = [*rows, short, junk, copy, near, (1004, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in every], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        seen.append({r.doc_id for r in now.select("doc_id").collect()})
        if k < 4:
            assert now.columns == docs.columns
    clean = set(range(240)) - toxic
    assert not seen[0] & {1000, 1001, 1004} and clean <= seen[0]
    assert not seen[1] & toxic and clean <= seen[1]
    assert 1002 not in seen[2] and 1003 in seen[2] and clean <= seen[2]
    assert 1003 not in seen[3] and seen[3] == clean == seen[4]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(tuple, now.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_odd_tables(spark, odd_docs, empty_docs, no_labels, tmp_path):
    text = lambda i: " ".join(f"word{i}x{k}" for k in range(70))
    schema = "doc_id long, text string, key long, bucket string, slot string, row string, norm string, score string"
    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (2, text(2).replace(" ", "  ", 3)), (3, text(3)), (3, text(3)), (None, text(1)), (None, text(4)), (5, None), (6, ""), (7, text(7) + " end"), (8, text(7)), (9, " ".join(f"word9x{k}" for k in range(60_000)))]
    docs = spark.createDataFrame([(i, t, 1, "b", None, "r", "n", "s") for i, t in rows], schema)
    for k, (now, want) in enumerate(((docs, [(1, 1), (2, 2), (3, 3), (7, 7), (9, 9), (None, 4)]), (docs.limit(0), []))):
        path = tmp_path / str(k)
        now.write.parquet(str(path / "documents.parquet"))
        no_labels.write.parquet(str(path / "labels.parquet"))
        kept = spark.read.parquet(str(path / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(path))
            assert kept.dtypes == docs.dtypes
        got = [(r.doc_id, int(r.text.split()[0].split("x")[0][4:])) for r in kept.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        packed = corpus_pipeline.run(spark, str(path))
        assert {r.doc_id for r in packed.collect()} == {i for i, _ in want}
