import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import chat_format as chat
from lectern.llm import exact_dedup as dedup
from lectern.llm import jaccard_join as jaccard
from lectern.llm import url_filters as urls
from lectern.llm.components import components


# ---------------------------------------------------------------- exact dedup


def plain_dedup(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    first = {}
    for (i, _), n in zip(rows, norm, strict=True):
        if i is not None:
            first[n] = min(i, first.get(n, i))
    size = Counter(norm)
    return Counter((i, first.get(n), size[n], hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm, strict=True))


def test_exact_dedup(spark, odd_docs, empty_docs):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a  b", "a b", "a\tb ", "c", "", None, "d\n\ne", "x" * 5000])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = dedup.exact_dedup(docs, bucket_capacity=1).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain_dedup(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    kept = dedup.keep_first_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({r.keep_id for r in got})
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = dedup.exact_dedup(odd_docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain_dedup(odd)
    assert sum(r.kept for r in got if r.doc_id == 2) == 1  # of repeated rows one stays
    nulls = spark.createDataFrame([(None, "a b"), (None, "a  b"), (None, "z"), (None, "z "), (9, "a b")], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in dedup.keep_first_copies(nulls).collect()} == {(9, "a b"), (None, "z"), (None, "z ")}
    assert [(r.doc_id, r.kept) for r in dedup.exact_dedup(nulls).where("kept").orderBy(F.col("keep_id").asc_nulls_first()).collect()] == [(None, True), (None, True), (9, True)]
    respelt = spark.createDataFrame([(None, "a b"), (None, "a  b")], "doc_id long, text string")
    assert [r.text for r in dedup.keep_first_copies(respelt).collect()] == ["a  b"]  # of equal texts one row stays, as the index says
    assert dedup.exact_dedup(empty_docs).count() == 0 and dedup.keep_first_copies(odd_docs).columns == odd_docs.columns


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    rows = [(3, "A"), (5, "A"), (5, "B"), (6, "c  d"), (6, "c d"), (7, "c d")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    kept = [(r.doc_id, " ".join(r.text.split())) for r in dedup.keep_first_copies(docs).collect()]
    assert sorted(kept) == [(3, "A"), (5, "B"), (6, "c d")]
    words = lambda k: " ".join(f"{k}{i}" for i in range(40))
    near = [(3, words("a")), (5, words("a") + " end"), (5, words("b")), (8, words("b") + " end"), (9, words("c")), (5, words("d")), (None, words("a"))]
    docs = spark.createDataFrame(near, "doc_id int, text string").repartition(3)
    kept = [(r.doc_id, r.text[:2]) for r in jaccard.keep_one_each(docs).collect()]
    assert Counter(t for i, t in kept if i is not None) == Counter(["a0", "b0", "c0", "d0"])
    assert (3, "a0") in kept and (5, "d0") in kept and (None, "a0") in kept and jaccard.keep_one_each(docs).dtypes == docs.dtypes


def test_directory_splits_overfull_buckets(spark):
    index = dedup.build_index(spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")), bucket_capacity=50)
    rows = index.entries.collect()
    sizes = Counter(r.bucket for r in rows)
    assert len(rows) == 2000 and max(sizes.values()) <= 50 and len(sizes) >= 40
    unsigned = lambda x: x % (1 << 64)
    depth = {unsigned(r.bucket): r.local_depth for r in rows}
    starts = sorted(depth)
    assert all(unsigned(r.key) >> (64 - r.local_depth) == unsigned(r.bucket) >> (64 - r.local_depth) for r in rows)
    assert all(a + (1 << (64 - depth[a])) <= b for a, b in zip(starts, starts[1:], strict=False))  # buckets do not overlap
    one = dedup.build_index(spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")), bucket_capacity=1)
    assert max(Counter(r.bucket for r in one.entries.collect()).values()) == 1
    tight = dedup.directory(spark.range(5000).select(F.xxhash64("id").alias("key")), bucket_capacity=1, most_slots=64)
    assert tight.slots.count() <= 64  # the capacity grows in place of the directory


def test_rows_are_found_through_the_directory_alone(spark):
    docs = spark.createDataFrame([(i, f"text {i % 40}") for i in range(100)], "doc_id long, text string")
    index = dedup.build_index(docs, bucket_capacity=4)
    astray = dedup.Directory(index.directory.slots.withColumn("bucket", F.col("bucket") + 1), index.directory.depth)
    assert dedup.exact_dedup(docs, index=index).count() == 100
    assert dedup.exact_dedup(docs, index=dedup.Index(index.entries, astray)).count() == 0


def test_a_second_batch_goes_into_the_index(spark):
    rows = [(i, f"text  {i % 70}") for i in range(60, 260)]
    more = [(i, f"text {i % 90} ") for i in range(60)] + [(None, "text 3 ")]
    make = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    index = dedup.insert(dedup.build_index(make(rows), bucket_capacity=8), make(more), bucket_capacity=8)
    whole = dedup.build_index(make(rows + more), bucket_capacity=8)
    assert sorted(map(tuple, index.entries.collect())) == sorted(map(tuple, whole.entries.collect()))
    got = dedup.exact_dedup(make(more), index=index).collect()
    want = plain_dedup(rows + more)
    assert len(got) == 61 and all((r.doc_id, r.keep_id, r.group_size, r.text_sha256) in want for r in got)


def test_texts_of_one_key_are_told_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(dedup.F, "xxhash64", lambda c: F.length(c).cast("long") * F.lit(1 << 60))
    rows = [(i, t) for i, t in enumerate(["ab", "cd", "ab", "e", "cd", "xyz", "ab "] * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dedup.exact_dedup(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain_dedup(rows)
    assert sorted({(r.text_sha256, r.chain) for r in got}, key=str) and {r.chain for r in got} == {0, 1}
    assert sorted(r.doc_id for r in dedup.keep_first_copies(docs).collect()) == [0, 1, 3, 5, 6]


def test_stage_keeps_the_rows_that_the_index_keeps(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(200)]), rng.choice(["a b", "a  b", "c", None, "", "d e f", "d e\tf"]) if rng.random() < 0.7 else f"own {i % 90}", i) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(4)
    want = Counter((r.doc_id, r.text_sha256) for r in dedup.exact_dedup(docs).where("kept").collect())
    kept = dedup.keep_first_copies(docs).select("doc_id", F.sha2(dedup.one_space(F.coalesce("text", F.lit(""))), 256)).collect()
    assert Counter(map(tuple, kept)) == want


# ---------------------------------------------------------------- near copies


def plain_sets(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", w) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    sets = {i: plain_sets(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, n):
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 150))] for _ in range(12)]
    for i in range(n):
        kind = rng.random()
        if kind < 0.6:  # near copies at all distances around the threshold, in chains
            words = list(rng.choice(base))
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                base.append(words)
        elif kind < 0.8:  # a passage that many share
            words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 100))]
            words = words + passage if rng.random() < 0.7 else passage + words[:4]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 7))]
        text = " ".join(words)
        rows.append((i, text.upper() if rng.random() < 0.1 else text.replace(" ", "\n", 2)))
    return rows


def test_components_match_all_pairs(spark):
    for seed, list_rows in ((1, jaccard.LIST_ROWS), (2, 8)):  # the second splits frequent shingles into salted lists
        rows = near_copies(random.Random(seed), 350)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs, list_rows=list_rows).collect()}
        assert got == plain_components(rows)


def test_sets_of_one_signature_are_told_apart(spark, monkeypatch):
    rows = near_copies(random.Random(4), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).select(F.col("doc_id"), F.col("text"))
    assert jaccard._signed(docs)[2] == 0
    found = jaccard._sets(docs)
    weak = lambda d, salt=0: found.withColumn("sig", F.col("sig") % 7) if salt < 2 else jaccard_sets(d, salt)
    jaccard_sets = jaccard._sets
    monkeypatch.setattr(jaccard, "_sets", weak)
    assert jaccard._signed(docs)[2] == 2
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs).collect()}
    assert got == plain_components(rows)


def test_ids_beyond_the_filter_are_joined(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FILTER_BITS", (3, 5))
    rows = near_copies(random.Random(5), 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs).collect()} == plain_components(rows)


def test_salted_lists_cover_all_pairs():
    sketch = np.full(1 << jaccard.SLOT_BITS, 100)
    sketch[5] = 100 + 40 + 950
    assert jaccard._splits(sketch, 100)[5] == 10 and jaccard._splits(sketch, 100)[6] == 1


def test_bounds():
    rng = random.Random(0)
    for _ in range(300):
        a = set(rng.sample(range(400), rng.randint(1, 120)))
        b = set(rng.sample(sorted(a), rng.randint(1, len(a)))) | set(rng.sample(range(400), rng.randint(0, 20)))
        x, y = (np.array(sorted(jaccard.shingles(f"s{i}")[0] for i in s), np.uint64) for s in (a, b))
        differ = sum(bin(p ^ q).count("1") for p, q in zip(jaccard.parity(x), jaccard.parity(y), strict=True))
        assert differ <= len(a ^ b)
        if 100 * len(a & b) >= 80 * len(a | b):
            pa, pb = (set(sorted(s)[: jaccard.kept_entries(len(s))]) for s in (a, b))
            assert pa & pb and 9 * len(a & b) >= 4 * (len(a) + len(b))
            most = max(len(a), len(b))
            assert len(a & b) <= len(pa & pb) + most - jaccard.kept_entries(most)


def test_jaccard_odd_inputs(spark, odd_docs, empty_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(odd_docs).collect()), key=str)
    texts = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None]
    want = plain_components(dict(texts).items())
    assert len(got) == 9 and all((n, c) == want[i] for i, n, c in got if i is not None)
    assert [(n, c) for i, n, c in got if i is None] == [(5, None)]
    assert jaccard.jaccard_join(empty_docs).count() == 0
    kept = jaccard.keep_one_each(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, None, 6, 7}


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 199)] + [(300, 301), (301, 302), (400, 400), (None, 5)] + [(500, 500 + k) for k in range(1, 80)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 200)}, 301: 300, 302: 300, **{500 + k: 500 for k in range(1, 80)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---------------------------------------------------------------- transcripts


def plain_viterbi(model, symbols):
    v = model.initial + model.emission[:, symbols[0]]
    back = []
    for s in symbols[1:]:
        through = v[:, None] + model.step
        back.append(through.argmax(0))
        v = through.max(0) + model.emission[:, s]
    out = [int(v.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1], float(v.max())


def talk(rng, conv):
    rows, line = [], 0
    for turn in range(rng.randint(1, 30)):
        role = turn % 2 + 1 if turn or rng.random() < 0.6 else 0
        for k in range(rng.randint(1, 4)):
            mark = {0: "System: ", 1: "User: ", 2: "Assistant: "}[role] if k == 0 and rng.random() < 0.9 else ""
            rows.append((conv, line, mark + "x " * rng.randint(0, 60), 2 * role + (k > 0)))
            line += rng.randint(1, 3)
    return rows


def test_states_are_the_viterbi_path_over_any_blocks(spark):
    rng = random.Random(11)
    rows = [r for c in range(25) for r in talk(rng, c)]
    lines = spark.createDataFrame(rows, "conv_id long, line_no long, line string, state int")
    model = chat.fit(lines)
    assert np.allclose(np.exp(model.step).sum(1), 1) and np.allclose(np.exp(model.emission).sum(1), 1)
    for block in (4, 1000):
        got: dict[int, list] = {}
        for r in chat.recover_states(lines, model, block).orderBy("conv_id", "line_no").collect():
            got.setdefault(r.conv_id, []).append(r.state)
        for c in range(25):
            symbols = [chat.symbol(line) for conv, _, line, _ in rows if conv == c]
            want, best = plain_viterbi(model, symbols)
            path = got[c]
            score = model.initial[path[0]] + model.emission[path[0], symbols[0]] + sum(model.step[a, b] + model.emission[b, s] for a, b, s in zip(path, path[1:], symbols[1:], strict=False))
            assert len(path) == len(want) and abs(score - best) < 1e-6
    turns = chat.turns(lines, model, 4)
    assert turns.agg(F.sum("n_lines")).first()[0] == len(rows)
    right = sum(a == b for c in range(25) for a, b in zip(got[c], [s for conv, _, _, s in rows if conv == c], strict=True))
    assert right > 0.85 * len(rows)


def test_rendering(spark):
    lines = spark.createDataFrame([(1, 0, "User: hi there", 2), (1, 1, "more", 3), (1, 2, "Assistant: yes", 4), (None, 0, "User: q", 2), (1, None, "lost", 3), (2, 0, None, None)], "conv_id long, line_no long, line string, state int")
    model = chat.fit(lines)
    got = {(r.conv_id, r.first_line): (r.role, r.rendered) for r in chat.turns(lines, model).collect()}
    assert got[1, 0] == ("user", "<|user|>\nhi there\nmore\n<|end|>\n") and got[1, 2] == ("assistant", "<|assistant|>\nyes\n<|end|>\n")
    assert got[None, 0] == ("user", "<|user|>\nq\n<|end|>\n") and len(got) == 4
    assert chat.turns(lines.limit(0), model).count() == 0
    assert chat.symbol("### User: a") != chat.symbol("Bob: a") != chat.symbol("plain a")


def test_odd_transcripts(spark):
    long = [(7, i, ("User: " if i % 40 == 0 else "Assistant: " if i % 40 == 20 else "") + f"line {i}", 2 if i % 40 == 0 else 4 if i % 40 == 20 else 3 if i % 40 < 20 else 5) for i in range(9000)]
    rows = [*long, (8, 0, "User: one", 2), (8, 0, "User: one", 2), (8, 1, "Assistant: " + "x" * 1_000_000, 4), (9, 1 << 40, "User: far", 2)]
    lines = spark.createDataFrame([(*r, "c", 1, "r") for r in rows], "conv_id long, line_no long, line string, state int, block string, pos_ long, symbol_ string").repartition(6)
    model = chat.fit(lines, 100)
    whole, cut = (sorted((r.conv_id, r.first_line, r.n_lines, r.rendered) for r in chat.turns(lines, model, n).collect()) for n in (1 << 30, 64))
    assert whole == cut and sum(k[0] == 7 for k in whole) == 450 and sum(k[2] for k in whole) == len(rows)
    same = chat.fit(lines, 1 << 30)
    assert np.array_equal(same.step, model.step) and np.array_equal(same.emission, model.emission) and np.array_equal(same.initial, model.initial)
    right = {r.conv_id: (r.n_lines, r.n_right) for r in chat.role_accuracy(lines, model).collect()}
    assert right[7] == (9000, 9000) and right[8][0] == 3 and right[9] == (1, 1)


def test_transcripts_have_the_states_of_their_turns(spark):
    schema = "conv_id long, turn long, role string, text string, line string"
    rows = [(4, 0, "system", "be kind", "x"), (4, 1, "user", "hi\nthere", None), (4, 2, "assistant", None, "x"), (5, 1, "user", "q", "x"), (5, 2, "other", "z", "x"), (6, None, "user", "lost", "x"), (None, 1, "user", "n", "x"), (7, 1, "user", "plain?", "x"), (7, 2, "assistant", "bare", "x")]
    got = {(r.conv_id, r.line_no >> 32, r.line_no & 0xFFFFFFFF): (r.line, r.state) for r in chat.transcripts(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        (4, 0, 0): ("System: be kind", 0), (4, 1, 0): ("User: hi", 2), (4, 1, 1): ("there", 3), (4, 2, 0): ("Assistant: ", 4), (5, 1, 0): ("Human: q", 2),
        (5, 2, 0): ("z", None), (None, 1, 0): ("User: n", 2), (7, 1, 0): ("### User: plain?", 2), (7, 2, 0): ("bare", 4),
    }
    assert chat.transcripts(spark.createDataFrame([], schema)).count() == 0


# ---------------------------------------------------------------- URLs


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = max(((len(h + p), d, h + p) for d, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    if best:
        return host, path, best[2], best[1]
    weights, bias = urls.own_model()
    grams = urls._grams(f"^{host}${path}")
    z = bias + sum(weights[k] for k in grams) / max(len(grams), 1) ** 0.5
    return host, path, None, "block" if 1 / (1 + np.exp(-z)) >= 0.5 else "allow"


def test_url_filters(spark):
    rows = ["http://WWW.Example.com/en/1", "https://example.com/en/", "http://a.example.com/en", "http://a.com", "http://x.net/es/?q", "http://x.net/fr", "ftp://spam-farm.example.org/en/1#x", "http://news.example.org/de/2", None, "", "no scheme", "http://", "http://a.com:80/en/", "http://ÄÖ.com/Ü", "http://a.b://c/d", "http://h?x=/en/", "http://x.com\n/en/"]
    pages = spark.createDataFrame([(i, u, "html") for i, u in enumerate(rows)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filters(pages).collect()}
    assert got == {i: plain_verdict(u) for i, u in enumerate(rows)}
    assert urls.url_filters(pages.limit(0)).count() == 0


def test_url_model_knows_its_table():
    weights, bias = urls.own_model()
    right = [(urls.probability_of(host, path, weights, bias) >= urls.THRESHOLD) == bool(label) for host, path, label in urls.labelled()]
    assert sum(right) >= 0.98 * len(right) and len({host for host, _, _ in urls.labelled()}) > 100
    found, left = urls.holdout_accuracy()
    assert found >= 0.8 and left >= 0.9
    assert urls.train([]) == ([0.0] * urls.BUCKETS, 0.0)


def test_a_table_of_ones_own(spark):
    rows = [(f"tea{i}.org", "/", 0) for i in range(20)] + [(f"gin{i}.org", "/", 1) for i in range(20)]
    pages = spark.createDataFrame([(1, "http://tea99.org/x"), (2, "http://gin98.org/x"), (3, None)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.url_filters(pages, rows=rows).collect()}
    assert got[1] == "allow" and got[2] == "block" and got[3] == "block"  # even odds reach the threshold


def test_long_urls_take_linear_time(spark):
    import time

    url = "http://long.example.org/" + "".join(random.Random(1).choice("abcdefgh/é😀") for _ in range(1_000_000))
    pages = spark.createDataFrame([(1, url), (2, url[:200])], "page_id long, url string")
    began = time.time()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filters(pages).collect()}
    assert time.time() - began < 60 and got == {1: plain_verdict(url), 2: plain_verdict(url[:200])}


def test_rules_match_sql(spark, tmp_path):
    import duckdb

    rows = ["http://WWW.Example.com/en/1", "http://a.example.com/en/", "http://x.net/es/1?q", "http://x.net/fr", "ftp://h.org#x", None, "", "x", "http://", "http://a.b://c/d", "http://x.net/fr/", "HTTP://NET/es/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    sql = "SELECT page_id, coalesce(lower(regexp_extract(rest, '^[^/?#]*')), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)"
    rules = "SELECT h.page_id, h.host, h.path, max_by(r.rule, r.size) AS rule FROM h LEFT JOIN (SELECT *, length(host) + length(path) AS size, host || path AS rule FROM rules) r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path) GROUP BY ALL"
    values = ", ".join(f"('{h}', '{p}')" for _, h, p in urls.RULES)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    con.execute(f"CREATE VIEW h AS {sql}")
    con.execute(f"CREATE TABLE rules AS SELECT * FROM (VALUES {values}) t(host, path)")
    got = sorted((r.page_id, r.host, r.path, r.rule) for r in urls.url_filters(pages).collect())
    assert got == sorted(con.execute(rules).fetchall())
