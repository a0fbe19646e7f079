import random

from pyspark.sql import functions as F

from lectern.functions.splitting import estimate
from lectern.operators import hierarchy, tree
from lectern.operators.tree import Node


def stack_depths(levels):
    """Depth of each heading and what is open above it, by a stack."""
    open_titles, out = [], []
    for i, level in enumerate(levels):
        depth = min(level, len(open_titles) + 1)
        open_titles = [*open_titles[: depth - 1], f"h{i}"]
        out.append((depth, list(open_titles[:-1])))
    return out


def test_depth_and_breadcrumb_match_a_stack(spark):
    rng = random.Random(3)
    rows, wanted = [], {}
    for source in range(40):
        levels = [rng.randint(1, 5) for _ in range(rng.randint(1, 30))]
        for i, (level, (depth, above)) in enumerate(zip(levels, stack_depths(levels), strict=True)):
            rows.append((str(source), i, level, f"h{i}"))
            wanted[str(source), i] = (depth, " > ".join([str(source), *above]))
    lines = spark.createDataFrame(rows, "source string, line_no int, level int, line string")
    found = tree.breadcrumbs(tree.heading_depth(lines, "source", "line_no"), "source", "line_no", "line", 6).collect()
    assert {(r.source, r.line_no): (r.depth, r.breadcrumb) for r in found} == wanted


def test_build_clamps_and_packs():
    root = tree.build(["intro", "A", "x" * 900, "y" * 900, "deep", "z"], {0: -1, 1: 1, 4: 3}, "s")
    assert [c.content for c in root.children] == ["intro", "A"]
    a = root.children[1]
    assert [c.content[0] for c in a.children] == ["x", "y", "d"]  # two leaves, then the heading at one below
    assert a.children[2].children == [Node("z")]


def test_parent_merge_and_siblings():
    root = Node("s", [Node("A", [Node("a"), Node("b")]), Node("c")])
    assert tree.process(root) == Node("s", [Node("A\na\nb\nc")])
    big = "x" * 1500
    kept = Node("s", [Node("A", [Node(big), Node("B", [Node(big), Node(big)])])])
    done = tree.process(kept)
    assert estimate(big) > 500 and not done.is_leaf


def test_siblings_stop_at_inner_nodes():
    big = "w " * 700
    inner = Node("T", [Node(big), Node(big)])
    merged = tree.merge_siblings(Node("s", [Node("a"), Node("b"), inner, Node("c"), Node("d")]))
    assert [c.content[:3] for c in merged.children] == ["a\nb", "T", "c\nd"]


def test_header_goes_into_its_only_child():
    big = Node("x" * 3000)
    root = Node("s", [Node("A", [Node("B", [big, Node("y" * 3000)])])])
    assert tree.merge_headers(root).children[0].content == "A\nB"
    assert tree.with_leaves(root).children[0].content == ""


def test_tables_are_put_in_and_cut():
    long = "word " * 3000
    root = Node("s", [Node("<tab>t0</tab> <tab>t9</tab>"), Node("<tab>t1</tab>")])
    done = tree.put_tables_in(root, {"t0": "<table/>", "t1": long})
    assert done.children[0].content == "<table/> <tab>t9</tab>"
    assert len(done.children) > 2 and sum(len(c.content.split()) for c in done.children[1:]) == 3000
    only = tree.put_tables_in(Node(long), {})
    assert len(only.children) > 1  # nothing of a lone leaf is lost


def test_leaves_and_rows():
    root = Node("src", [Node("A", [Node("x"), Node("  ")]), Node("y")])
    assert tree.leaf_rows(root) == [("src > A", "x"), ("src", "y")]
    nodes, links = tree.node_rows(root, "d")
    assert len(nodes) == 5 and len(links) == 4 and len({n[0] for n in nodes}) == 5
    assert tree.node_rows(root, "d") == (nodes, links)


def test_model_detector():
    asked = []

    def chat(prompt, tokens):
        asked.append(tokens)
        return '{"items": [{"id": 0, "level": 1}, {"id": 7, "level": 1}, {"id": 1, "lev'

    detect = tree.model_detector(chat)
    assert detect(["T", "body", "more"]) == {0: 1, 1: -1, 2: -1}
    assert asked == [tree.reply_budget(3)] == [int((3 * 22 + 100) * 1.25)]
    assert tree.model_detector(lambda p, n: "[1]")(["a", "b"]) == {0: -1, 1: -1}
    assert tree.model_detector(lambda p, n: 1 / 0)(["a"]) == {0: -1}
    assert tree.model_detector(chat)([]) == {}


def test_rule_levels(spark):
    lines = ["PART I. Start", "1. One", "1.2 Two", "1.2.3 Three", "a) four", "plain text", "A. Alpha", "ALL CAPITALS"]
    by_rule = tree.rule_detector()(lines)
    assert [by_rule[i] for i in range(8)] == [1, 2, 3, 4, 4, -1, 2, 1]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    found = {r.i: r.level for r in frame.select("i", hierarchy.rule_level(F.col("line")).alias("level")).collect()}
    assert found == by_rule


def test_hierarchy():
    import re

    patterns = [re.compile(p, re.MULTILINE) for p in hierarchy.HEADINGS]
    text = "before\n1. One\nalpha\n1.1 Sub\nbeta\n2. Two\n\n3. Three\ngamma"
    assert hierarchy.split_hierarchy(text, patterns) == [([], "before"), (["1. One"], "alpha"), (["1. One", "1.1 Sub"], "beta"), (["3. Three"], "gamma")]
    assert hierarchy.split_hierarchy("nothing here", patterns) == [([], "nothing here")]
    assert hierarchy.split_hierarchy(None, patterns) == [([], "")]
    assert hierarchy.find_headings("# Title", patterns[0]) == []  # the mark alone has no title


def test_headings_are_single_lines():
    import re

    patterns = [re.compile(p, re.MULTILINE) for p in hierarchy.HEADINGS]
    text = "1. One\nA.\nAnd so on.\n1.1 Sub\n1.\nbeta\nABCD EF\nGH\nABCDEFGH\ngamma"
    assert hierarchy.split_hierarchy(text, patterns) == [(["1. One"], "A.\nAnd so on."), (["1. One", "1.1 Sub"], "1.\nbeta\nABCD EF\nGH"), (["ABCDEFGH"], "gamma")]


def test_chunk_documents(spark):
    rows = [("b", ["1. One", "text", "1.1 Two", "more"], {"t0": "x"}), ("a", [], None), ("c", None, None)]
    docs = spark.createDataFrame(rows, "source string, lines array<string>, tables map<string,string>")
    found = tree.chunk_documents(docs).collect()
    assert [(r.source, r.breadcrumb, r.content) for r in found] == [("b", "b", "1. One\ntext\n1.1 Two\nmore")]


def lines_at_random(rng):
    """Lines around the sizes at which nodes are merged or cut, and their levels."""
    sizes = rng.choice([[1, 5, 20], [20, 200, 1000], [900, 1100, 2200], [219, 220, 221, 440, 441, 109, 110, 111], [530, 545, 2, 274], [10, 9000]])
    deep, share = rng.choice([2, 4, 8]), rng.choice([0.05, 0.3, 0.7])
    lines, levels = [], {}
    for i in range(rng.randint(1, rng.choice([6, 40, 120]))):
        n = max(1, rng.choice(sizes) + rng.randint(-2, 2))
        lines.append(rng.choice(["a" * n, ("ab. c 1. 12345678 x " * n)[:n].strip(), "x" + " " * n + "y", "\x1c"]))
        levels[i] = rng.choice([rng.randint(1, deep), rng.randint(1, deep), 0]) if rng.random() < share else -1
    return lines, levels


def by_line(lines, levels, source):
    """leaf_rows from a SourceTree."""
    made = tree.SourceTree()
    for i, line in enumerate(lines):
        made.add(*tree._mark(i, levels[i], line))
    made.end()
    assert not made.titles
    inner = {position: (title, absorbed) for leaf, position, _, _, title, absorbed in made.rows if leaf is None}
    out = {}
    for leaf, position, piece, path, _, _ in made.rows:
        if leaf is not None:
            crumb, texts = out.setdefault(leaf, (tree.breadcrumb(source, *zip(*[inner[p] for p in path])) if path else source, []))
            texts.append(tree.cut_leaf(lines[position])[piece])
    return [(crumb, "\n".join(texts)) for crumb, texts in out.values()]


def test_a_tree_line_by_line_is_the_tree_of_the_whole_source():
    rng = random.Random(11)
    for _ in range(100):
        lines, levels = lines_at_random(rng)
        assert by_line(lines, levels, "a/b") == tree.leaf_rows(tree.document_tree(lines, levels, "a/b"))
    # a parent that becomes a leaf in the second round, as merged siblings count a token less, and then merges with its neighbours
    found = [tree.settle(Node(tree.Span(2, ((0, 0),)), [Node(tree.Span(n, ((1, 0),))), Node(tree.Span(n, ((2, 0),)))]))[1] for n in (545, 548, 549)]
    assert found == [1, 2, None]
    lines, levels = ["T", "A", "a" * 548, "B", "b" * 548, "c", "C", "d"], [-1, 1, 2, 2, 3, -1, 1, -1]
    assert by_line(lines, dict(enumerate(levels)), "s") == tree.leaf_rows(tree.document_tree(lines, dict(enumerate(levels)), "s"))


def test_a_tree_line_by_line_holds_no_more_for_a_longer_source():
    rng = random.Random(5)
    for share in (0.0, 0.001, 0.4):
        made, most = tree.SourceTree(), 0
        for i in range(20_000):
            made.add(i, rng.randint(1, 3) if rng.random() < share else -1, rng.randint(1, 90), title="t")
            made.rows.clear()
            held = [n for o in made.open for c in o.children for n, _ in c.walk()]
            spans = [n.content for n in held] + [s for o in made.open if o.run for s in o.run.held if s] + ([made.packed] if made.packed else [])
            most = max(most, sum(len(s) for s in spans), len(made.titles) * 10)
        assert most < 12_000


def test_chunk_pages_keeps_order_and_matches_the_plain_trees(spark, monkeypatch):
    """No source meets in one row: the plain version, which takes lists of lines, is not called."""
    from lectern.plans import pipeline

    rng = random.Random(7)
    head = lambda: rng.choice(["", "", "1. Part\n", "1.2 Section\n", "a) item\n"])
    body = lambda: rng.choice(["w" * 300, "s " * 600, "\x1c", " x ", "1. 12345678 n " * 900])
    pages = [(rng.choice(["in/b", "a", "c"]), rng.choice([1, 2, 3, 4, 5, None]), "\n".join(head() + body() for _ in range(rng.randint(0, 5)))) for _ in range(60)] + [("a", 1, None), ("none", 0, " ")]
    frame = spark.createDataFrame(pages, "source string, page int, text string")
    wanted = []
    strip = lambda x: x.strip(" ")
    lines = {}
    for source, page, text in pages:
        numbered = enumerate(x for x in map(strip, (text or "").split("\n")) if x)
        lines.setdefault(source, []).extend((page is not None, page or 0, i, x) for i, x in numbered)
    firsts = {s: min((p for given, p, _, _ in xs if given), default=-1) for s, xs in lines.items() if xs}
    for source in sorted(firsts, key=lambda s: (firsts[s], s)):
        ordered = [x for *_, x in sorted(lines[source])]
        wanted += [(source, crumb, f"[{crumb}]\n{text}") for crumb, text in tree.leaf_rows(tree.document_tree(ordered, tree.rule_detector()(ordered), source))]
    monkeypatch.setattr(tree, "chunk_documents", None)
    for detector in (None, tree.rule_detector()):
        found = pipeline.chunk_pages(frame, F.col("source"), "page", "text", detector).orderBy("chunk_id").collect()
        assert [(r.metadata.source, r.metadata.breadcrumb, r.text) for r in found] == wanted
        assert [r.chunk_id for r in found] == list(range(len(wanted)))
    assert len(wanted) > 30 and any(" > " in crumb for _, crumb, _ in wanted)


def test_climb_reaches_the_root_of_a_deep_tree_and_ends_in_cycles(spark):
    from lectern.operators import ancestors

    nodes = spark.createDataFrame([(f"n{i}", f"t{i}") for i in range(68)] + [("x", "x"), ("y", "y")], "id string, content string")
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 0) for i in range(67)] + [("x", "y", 0), ("y", "x", 0)], "parent_id string, child_id string, order_index int")
    seeds = nodes.where("id IN ('n67', 'y')").select(nodes["id"].alias("leaf_id"), "content")
    found = {(r.leaf_id, r.depth, r.node_id) for r in ancestors.climb(seeds, links, nodes).collect()}
    assert found == {("n67", 67 - i, f"n{i}") for i in range(68)} | {("y", 0, "y"), ("y", 1, "x")}


def test_climb_exchanges_no_rows_of_a_node_that_many_share(spark, monkeypatch):
    """The same rows with every node hot, with some and with none; the rows of hot nodes meet them by a broadcast."""
    from lectern.operators import ancestors

    nodes = spark.createDataFrame([("r", "root"), ("a", "A"), ("b", "B"), ("lost", "L")] + [(f"n{i}", f"t{i}") for i in range(30)], "id string, content string")
    links = [("r", "a", 0), ("r", "b", 1), ("none", "lost", 0), ("a", "r", 5)] + [("ab"[i % 3 == 0], f"n{i}", i) for i in range(30)]
    links = spark.createDataFrame(links, "parent_id string, child_id string, order_index int")
    seeds = nodes.where("id LIKE 'n%' OR id = 'lost'").select(nodes["id"].alias("leaf_id"), "content")
    joined = []
    own = ancestors.meet
    monkeypatch.setattr(ancestors, "meet", lambda rows, small, key, hot: joined.append(sorted(hot)) or own(rows, small, key, hot))
    found = {}
    for least in (10_000, 15, 1):
        monkeypatch.setattr(ancestors, "HOT", least)
        found[least] = sorted(tuple(r) for r in ancestors.climb(seeds, links, nodes).collect())
    assert found[10_000] == found[15] == found[1] and len(found[1]) == 31 + 30 + 30 + 10
    assert ["a"] in joined or ["b"] in joined
