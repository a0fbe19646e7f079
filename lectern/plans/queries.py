"""The registered queries: one or more for each operator, over whole tables.

Tables stand in for the records of the data model: documents for pages and chunks (source = file, doc_id = position), benchmark for
questions, labels for graded chunks, embeddings for leaf vectors, and region, nation, customer and orders for a tree of nodes.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.splitting import repaired_json
from ..operators import ancestors as A
from ..operators import answers, hierarchy, labels, model, ordering, questions, retrieval, tree, vectors
from ..operators import chunking as C
from ..sources import readers, store
from ..sources.scratch import cut, own_folder
from . import pipeline
from . import settings as S


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return readers.spread(rows) if name == "documents" else rows


# ---------------------------------------------------------------- text and chunks


def token_estimate(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", X.token_estimate(F.col("text")).alias("n_tokens"))


def payload_budget(spark, sf_dir):
    n = X.payload_estimate(F.col("text"), F.col("source"))
    rows = t(spark, sf_dir, "documents").select("doc_id", n.alias("payload_tokens"))
    return rows.select("doc_id", "payload_tokens", (F.col("payload_tokens") + S.REPLY_TOKENS <= S.CONTEXT_TOKENS - S.CONTEXT_RESERVE).alias("fits"))


def group_pages(spark, sf_dir):
    pages = t(spark, sf_dir, "documents")
    rows = C.group_pages(pages, X.first_given(F.col("source")), "doc_id", "text")
    return rows.select("source", "source_ord", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def text_to_lines(spark, sf_dir):
    return C.text_lines(t(spark, sf_dir, "documents"), "doc_id", "text")


def page_lines(spark, sf_dir):
    """Lines of whole sources without joining their pages, with the line's number in its source."""
    rows = C.page_lines(t(spark, sf_dir, "documents"), X.first_given(F.col("source")), "doc_id", "text")
    per_page = rows.groupBy("source", "page").agg(F.count(F.lit(1)).alias("n"))
    start = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = per_page.select("source", "page", start.alias("start"))
    return rows.join(starts, ["source", "page"]).select("source", (F.col("start") + F.col("line_in_page")).alias("line_no"), "line")


def source_file_name(spark, sf_dir):
    rows = t(spark, sf_dir, "pages").select("page_id", X.first_given(F.lit(""), F.lit(None).cast("string"), F.col("url")).alias("source"))
    return rows.select("page_id", "source", X.file_name(F.col("source")).alias("file_name"))


def sequential_ids(spark, sf_dir):
    return ordering.sequential_ids(t(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"]).select("doc_id", "source", "chunk_id")


def table_rows_apart(spark, sf_dir):
    """Rows "N. dddddddd name" in running text, each put on a line of its own."""
    row = lambda k: F.concat(F.lit(f"{k}. "), F.lpad(F.col("page_id").cast("string"), 8, "0"), F.lit(f" Name{k} "))
    rows = t(spark, sf_dir, "pages").select("page_id", F.concat(row(1), row(2), F.lit("\n"), row(3), row(12)).alias("text"))
    return rows.select("page_id", X.table_rows_apart(F.col("text")).alias("text"))


def tla_split(spark, sf_dir):
    docs = t(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(C.pieces(F.col("text"))).alias("piece_no", "piece"))


def media_blocks(spark, sf_dir):
    pages = t(spark, sf_dir, "pages")
    own = F.concat(F.lit("intro <img src='a.png'> of "), F.col("url"), F.lit("<TABLE border=1>\n<tr><td><img src='in'>"), F.col("page_id").cast("string"), F.lit("</td></tr>\n</table><IMG x>tail "), F.col("page_id").cast("string"))
    return pages.select("page_id", F.posexplode(X.media_segments(own)).alias("pos", "s")).select("page_id", "pos", "s.segment", "s.is_media")


def split_items(spark, sf_dir):
    rows = C.split_items(t(spark, sf_dir, "documents"), "text", X.first_given(F.col("source")), ["doc_id"])
    return rows.select("chunk_id", "metadata.source", "metadata.file_name", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def overlap_tail(spark, sf_dir):
    """Questions as short chunks, whose overlap reaches back over several of them."""
    return C.apply_overlap(t(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id").select("item_id", "text")


def documents_overlap(spark, sf_dir):
    rows = C.apply_overlap(t(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def hierarchical_split(spark, sf_dir):
    docs = _with_headings(t(spark, sf_dir, "documents"))
    rows = hierarchy.split_by_hierarchy(docs, "text", X.first_given(F.col("source")), ["doc_id"])
    return rows.select("chunk_id", "metadata.source", "metadata.breadcrumb", F.array_join("metadata.headings", "|").alias("headings"), F.md5("text").alias("text_md5"))


def _with_headings(docs: DataFrame) -> DataFrame:
    """Documents with numbered headings put in before their lines."""
    lines = F.split("text", "\n")
    head = lambda x, i: F.concat(F.when(i % 7 == 0, F.concat((i / 7 + 1).cast("int").cast("string"), F.lit(". Part\n"))).when(i % 3 == 1, F.concat(F.lit("1."), i.cast("string"), F.lit(" Section\n"))).otherwise(F.lit("")), x)
    return docs.withColumn("text", F.array_join(F.transform(lines, head), "\n"))


# ---------------------------------------------------------------- trees


def _levels(spark, sf_dir) -> DataFrame:
    orders = t(spark, sf_dir, "orders")
    return orders.select((F.col("o_custkey") % 50).alias("source"), F.col("o_orderkey").alias("line_no"), (F.lit(1) + F.col("o_custkey") % 4).cast("int").alias("level"), F.concat_ws(" ", F.trim("o_orderpriority"), F.col("o_orderkey").cast("string")).alias("line"))


def heading_depth(spark, sf_dir):
    return tree.heading_depth(_levels(spark, sf_dir), "source", "line_no").select("source", "line_no", "level", "depth")


def section_breadcrumb(spark, sf_dir):
    body = F.when(F.col("line_no") % 3 == 0, F.lit(-1)).otherwise(F.col("level"))
    lines = tree.heading_depth(_levels(spark, sf_dir).withColumn("level", body), "source", "line_no")
    return tree.breadcrumbs(lines, "source", "line_no", "line", 4).select("source", "line_no", "depth", "breadcrumb")


def _line_arrays(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "documents").select("doc_id", X.lines(F.col("text")).alias("lines"))


def leaf_pack(spark, sf_dir):
    rows = _line_arrays(spark, sf_dir).select("doc_id", F.posexplode(tree.pack_leaves(F.transform("lines", F.length))).alias("line_no", "leaf"))
    return rows


def heading_batches(spark, sf_dir):
    sizes = F.transform("lines", X.token_estimate)
    return _line_arrays(spark, sf_dir).select("doc_id", F.posexplode(tree.batch_lines(sizes, 400)).alias("line_no", "batch"))


def rule_headings(spark, sf_dir):
    docs = _with_headings(t(spark, sf_dir, "documents"))
    rows = C.text_lines(docs, "doc_id", "text")
    return rows.select("doc_id", "line_no", hierarchy.rule_level(F.col("line")).alias("level")).where("level <> -1")


def tree_process(spark, sf_dir):
    docs = _with_headings(t(spark, sf_dir, "documents")).select(F.col("doc_id").cast("string").alias("source"), X.lines(F.col("text")).alias("lines"), F.lit(None).cast("map<string,string>").alias("tables"))
    rows = tree.chunk_documents(docs)
    return rows.select("source", "leaf", "breadcrumb", F.md5("content").alias("content_md5"))


def chunk_pages(spark, sf_dir):
    rows = pipeline.chunk_pages(_with_headings(t(spark, sf_dir, "documents")), X.first_given(F.col("source")), "doc_id", "text")
    return rows.select("chunk_id", "metadata.source", "metadata.file_name", "metadata.breadcrumb", F.md5("text").alias("text_md5"))


def docx_tables(spark, sf_dir):
    """Blocks of a document for each nation: a paragraph, a table of its suppliers, a blank paragraph."""
    nation, supplier = t(spark, sf_dir, "nation"), t(spark, sf_dir, "supplier")
    rows = supplier.groupBy("s_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda x: F.array(F.concat(F.lit(" <b>"), x["s_name"], F.lit("</b> ")), x["s_suppkey"].cast("string"))).alias("cells"))
    joined = nation.join(rows, F.col("n_nationkey") == F.col("s_nationkey"))
    block = lambda pos, kind, text, cells: F.struct(F.lit(pos).alias("pos"), F.lit(kind).alias("kind"), text.alias("text"), cells.alias("cells"))
    none, text = F.lit(None).cast("array<array<string>>"), F.lit(None).cast("string")
    blocks = joined.select(F.concat(F.lit("in/"), F.col("n_name")).alias("path"), F.explode(F.array(block(0, "paragraph", F.col("n_name"), none), block(1, "table", text, F.col("cells")), block(2, "paragraph", F.lit("  "), none), block(3, "table", text, F.slice("cells", 1, 1)))).alias("b")).select("path", "b.*")
    out = readers.docx_documents(blocks)
    return out.select("source", F.array_join("lines", "|").alias("lines"), F.md5(F.col("tables")["t0"]).alias("t0_md5"), F.col("tables")["t1"].alias("t1"))


# ---------------------------------------------------------------- the store


def _tree_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """nodes (id, content) and links of region > nation > customer > order."""
    r, n, c, o = (t(spark, sf_dir, x) for x in ("region", "nation", "customer", "orders"))
    key = lambda kind, col: F.concat(F.lit(kind), F.col(col).cast("string"))
    nodes = r.select(key("r", "r_regionkey").alias("id"), F.col("r_name").alias("content"))
    nodes = nodes.unionByName(n.select(key("n", "n_nationkey").alias("id"), F.col("n_name").alias("content")))
    nodes = nodes.unionByName(c.select(key("c", "c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 == 0, F.lit("  ")).otherwise(F.col("c_name")).alias("content")))
    nodes = nodes.unionByName(o.select(key("o", "o_orderkey").alias("id"), F.col("o_orderpriority").alias("content")))
    links = n.select(key("r", "n_regionkey").alias("parent_id"), key("n", "n_nationkey").alias("child_id"), F.col("n_nationkey").cast("int").alias("order_index"))
    links = links.unionByName(c.select(key("n", "c_nationkey").alias("parent_id"), key("c", "c_custkey").alias("child_id"), F.col("c_custkey").cast("int").alias("order_index")))
    links = links.unionByName(o.select(key("c", "o_custkey").alias("parent_id"), key("o", "o_orderkey").alias("child_id"), (F.col("o_orderkey") % 1000).cast("int").alias("order_index")))
    return nodes, links


def ancestors_path(spark, sf_dir):
    nodes, links = _tree_tables(spark, sf_dir)
    seeds = nodes.where(F.startswith("id", F.lit("o"))).select(F.col("id").alias("leaf_id"), "content")
    rows = A.paths(A.climb(seeds, links, nodes), links)
    return rows.select("leaf_id", F.array_join("path", "/").alias("path"), "breadcrumb", "text", "order_index")


def leaf_nodes(spark, sf_dir):
    return A.leaves(*_tree_tables(spark, sf_dir))


def _listed(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("id"), F.col("source").alias("bot_id"), F.md5("text").alias("name"), F.lit(True).alias("active"))


def document_listing(spark, sf_dir):
    return store.list_documents(_listed(spark, sf_dir), "src3").select("id", "bot_id", "name")


def document_half(spark, sf_dir):
    return store.choose_documents(_listed(spark, sf_dir), "half").select("id", "name")


def idempotent_append(spark, sf_dir):
    """The customers of odd keys are held; all are inserted, twice."""
    new = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    held = new.where(F.col("c_custkey") % 2 == 1).withColumn("c_name", F.lit("held"))
    return held.unionByName(store.insert_absent(held, new.unionByName(new), ["c_custkey"]))


def store_links(spark, sf_dir):
    """Links of nations and customers put into a store twice, in two batches that overlap."""
    _, links = _tree_tables(spark, sf_dir)
    held = store.Store(spark, f"{own_folder(spark)}/store-{uuid.uuid4().hex}").create()
    for kind in ("n%", "c%", "n%", "%"):
        held.add("links", links.where(F.col("child_id").like(kind) & ~F.col("child_id").like("o%")))
    return held.read("links")


def store_index(spark, sf_dir):
    """Documents as nodes of one document each, indexed twice: nothing is held twice, and every node has its words."""
    docs = t(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string")
    documents = docs.select(key.alias("id"), F.col("source").alias("bot_id"), F.md5("text").alias("name"), F.lit(True).alias("active"))
    nodes = docs.select(F.concat(F.lit("n"), key).alias("id"), key.alias("document_id"), F.col("text").alias("content"), F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("array<string>").alias("tsv"))
    links = docs.select(F.concat(F.lit("n"), key).alias("parent_id"), F.concat(F.lit("n"), (F.col("doc_id") + 1).cast("string")).alias("child_id"), F.lit(0).alias("order_index"))
    held = store.Store(spark, f"{own_folder(spark)}/store-{uuid.uuid4().hex}").create()
    for _ in range(2):
        held.index(documents, nodes, links)
    nodes = held.read("nodes").select("id", "document_id", F.size("tsv").alias("n_words"), F.md5(F.array_join("tsv", " ")).alias("tsv_md5"))
    return nodes.join(held.read("documents").select(F.col("id").alias("document_id"), "bot_id"), "document_id").select("id", "document_id", "bot_id", "n_words", "tsv_md5")


def stable_ids(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", X.stable_id(F.col("source"), F.col("doc_id")).alias("id"))


def token_calibration(spark, sf_dir):
    """The estimate against counts that a model might have given: a token for every three characters."""
    asked = t(spark, sf_dir, "documents").select("text", F.floor(F.length("text") / 3).cast("int").alias("real"))
    return model.calibration(asked, "text", "real").select("n", F.round("mean_difference", 6).alias("mean_difference"), "most_under")


def conditional_tsv(spark, sf_dir):
    """Every third document is a parent without a vector, every fifth has its words already."""
    docs = t(spark, sf_dir, "documents")
    vector = F.when(F.col("doc_id") % 3 != 0, F.array(F.lit(1.0).cast("float")))
    nodes = docs.select(F.col("doc_id").cast("string").alias("id"), F.lit("d").alias("document_id"), F.col("text").alias("content"), vector.alias("embedding"), F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("held"))).alias("tsv"))
    return store.with_text_index(nodes).select("id", F.array_join("tsv", " ").alias("tsv"))


def _query_vector(spark, sf_dir):
    first = t(spark, sf_dir, "embeddings").where(F.col("vec_id") == 0).select("embedding").first()
    return vectors.vector(first[0] if first else [])


def vector_topk(spark, sf_dir):
    return vectors.nearest(t(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vector(spark, sf_dir), 10).select("vec_id", "label", "distance")


def vector_topk_filtered(spark, sf_dir):
    wanted = spark.range(3, 6).select(F.col("id").cast("int").alias("label"))
    return vectors.nearest(t(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vector(spark, sf_dir), 10, wanted, "label").select("vec_id", "label", "distance")


def vector_topk_path(spark, sf_dir):
    """Vectors as leaves below their labels, labels below one root; the nearest leaves come back as chunks with paths."""
    e = t(spark, sf_dir, "embeddings")
    leaf, group = F.concat(F.lit("v"), F.col("vec_id").cast("string")), F.concat(F.lit("l"), F.col("label").cast("string"))
    vector = lambda c: c.cast("array<float>").alias("embedding")
    node = lambda rows, key, content, emb: rows.select(key.alias("id"), F.concat(F.lit("d"), (F.col("label") % 2).cast("string")).alias("document_id"), content.alias("content"), vector(emb))
    groups = e.select("label").distinct()
    nodes = node(e, leaf, F.concat(F.lit("leaf "), F.col("vec_id").cast("string")), F.col("embedding")).unionByName(node(groups, group, F.concat(F.lit("label "), F.col("label").cast("string")), F.lit(None)))
    nodes = nodes.unionByName(spark.range(1).select(F.lit("root").alias("id"), F.lit("d0").alias("document_id"), F.lit(" root ").alias("content"), vector(F.lit(None))))
    links = e.select(group.alias("parent_id"), leaf.alias("child_id"), F.col("vec_id").cast("int").alias("order_index")).unionByName(groups.select(F.lit("root").alias("parent_id"), group.alias("child_id"), F.col("label").cast("int").alias("order_index")))
    documents = spark.range(2).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("id"), F.lit("bot").alias("bot_id"), F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"))
    rows = store.search(_query_vector(spark, sf_dir), documents, nodes, links, 5, "bot")
    return rows.select("chunk_id", "text", "metadata.source", "metadata.breadcrumb", "metadata.node_id", "metadata.distance")


def store_chunks(spark, sf_dir):
    """Orders as leaves of two documents, one of which has no row of its own."""
    nodes, links = _tree_tables(spark, sf_dir)
    number = F.regexp_extract("id", r"(\d+)", 1).cast("long")
    nodes = nodes.select("id", F.concat(F.lit("doc"), (number % 3).cast("string")).alias("document_id"), "content", F.when(F.startswith("id", F.lit("o")), F.array(F.lit(1.0).cast("float"))).alias("embedding"))
    wanted = spark.createDataFrame([("doc2", 0), ("doc1", 1)], "document_id string, ord int")
    documents = spark.createDataFrame([("doc1", "bot", "First", True)], store.DOCUMENTS)
    rows = store.leaf_chunks(wanted, documents, nodes, links)
    return rows.select("chunk_id", "text", "metadata.source", "metadata.breadcrumb", "metadata.node_id", "metadata.document_id")


# ---------------------------------------------------------------- retrieval


def idf_index(spark, sf_dir):
    return retrieval.idf(t(spark, sf_dir, "documents")).select("token", "df", F.round("idf", 6).alias("idf"))


def proper_noun_phrases(spark, sf_dir):
    return t(spark, sf_dir, "benchmark").select("item_id", F.posexplode(X.phrases(_named(F.col("text")))).alias("pos", "phrase"))


def _named(text):
    """Words 2 to 4 of a text with capitals, as a question."""
    own = F.transform(F.slice(X.words(text), 2, 3), lambda x: F.concat(F.translate(F.substring(x, 1, 1), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lower(F.substr(x, F.lit(2)))))
    return F.concat(F.lit("see "), F.array_join(own, " "))


def _top(spark, sf_dir, limit: int) -> DataFrame:
    docs, asked = t(spark, sf_dir, "documents"), t(spark, sf_dir, "benchmark")
    return retrieval.prefilter(asked, docs.withColumn("position", F.col("doc_id")), "item_id", "text", "doc_id", "position", limit=limit)


def score_topk(spark, sf_dir):
    return _top(spark, sf_dir, S.PREFILTER).select("item_id", "doc_id", "rank", "score")


def phrase_bonus(spark, sf_dir):
    """Questions that are the first words of a document with capitals, which that document then contains as a phrase."""
    docs = t(spark, sf_dir, "documents")
    asked = docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("item_id"), _named(F.col("text")).alias("question"))
    rows = retrieval.scores(asked, docs, "item_id", "question", "doc_id", least=50.0)
    return rows.select("item_id", "doc_id", "score")


def candidate_limits(spark, sf_dir):
    kinds = t(spark, sf_dir, "benchmark").select("item_id", F.element_at(F.array(*map(F.lit, S.QUESTION_TYPES)), (F.col("item_id") % 3 + 1).cast("int")).alias("type"), F.element_at(F.array(*map(F.lit, S.DIFFICULTIES)), (F.col("item_id") % 4 % 3 + 1).cast("int")).alias("difficulty"))
    return kinds.select("item_id", retrieval.candidate_limit(F.col("type"), F.col("difficulty")).alias("n"), retrieval.candidate_limit(F.col("type"), F.col("difficulty"), 40, 60).alias("small"))


def neighbour_expand(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").withColumn("position", F.col("doc_id"))
    first = cut(_top(spark, sf_dir, 20), "candidates")
    rows = retrieval.neighbours(first, docs, "item_id", "doc_id", "position", "source", cap=24)
    return rows.select("item_id", "doc_id", "rank", "is_neighbour")


def snippet(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.md5(X.snippet(F.col("text"))).alias("snippet_md5"), X.snippet(F.col("text"), 5).alias("short"))


def candidate_prompt(spark, sf_dir):
    docs, asked = t(spark, sf_dir, "documents"), t(spark, sf_dir, "benchmark")
    rows = retrieval.candidate_prompts(_top(spark, sf_dir, 5), asked, docs, "item_id", "text", "doc_id", words=20)
    return rows.select("item_id", "prompt")


def budget_fit(spark, sf_dir):
    """Prompts of twenty candidates in a budget that most do not fit."""
    docs, asked = t(spark, sf_dir, "documents"), t(spark, sf_dir, "benchmark").withColumnRenamed("text", "question")
    rows = _top(spark, sf_dir, 20).join(docs.select("doc_id", "text"), "doc_id").join(asked, "item_id")
    out = retrieval.budgeted_prompts(rows, "item_id", "question", "text", "rank", F.lit(S.SNIPPET_WORDS), allowed=3000)
    return out.select("item_id", "n_chunks", "n_words", F.length("prompt").alias("n_chars"))


def map_local_ids(spark, sf_dir):
    """Replies with repeated, foreign, quoted and broken numbers, over the five best documents."""
    used = _top(spark, sf_dir, 5).groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"]).alias("used"))
    reply = F.concat(F.lit('```json x {"candidate_chunks": ['), (F.col("item_id") % 5).cast("string"), F.lit(", \"2\", 1.0, 1, 1, 99, -1, \"a\", null, "), (F.col("item_id") % 3).cast("string"), F.lit("]} y```"))
    return used.select("item_id", F.posexplode(retrieval.real_ids(retrieval.local_ids(reply), F.col("used"))).alias("pos", "doc_id"))


# ---------------------------------------------------------------- questions, labels, answers


def related_chunks(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").withColumn("position", F.col("doc_id"))
    return questions.related_chunks(docs, "doc_id", "position", "source")


def related_prompt(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").withColumn("position", F.col("doc_id"))
    rows = questions.format_related(questions.related_chunks(docs, "doc_id", "position", "source"), docs, "doc_id", "source")
    prompts = docs.join(rows, "doc_id", "left").select("doc_id", questions.question_prompt(F.col("doc_id"), F.col("text"), F.col("related_chunks"), "{chunk_id}|{chunk}|{related_chunks}").alias("prompt"))
    return prompts.select("doc_id", F.length("prompt").alias("n_chars"), F.md5("prompt").alias("prompt_md5"))


def question_validation(spark, sf_dir):
    """A reply for each benchmark item: fenced, with prose around it, broken, or with items that fail the checks."""
    items = t(spark, sf_dir, "benchmark").select("item_id", F.to_json(F.struct(F.col("text").alias("q"))).alias("j"))
    q = F.regexp_extract("j", r'^\{"q":(.*)\}$', 1)
    item = lambda kind, hard, ids: F.concat(F.lit('{"question": '), q, F.lit(f', "type": "{kind}", "difficulty": "{hard}", "source_chunk_ids": '), F.lit(ids), F.lit("}"))
    listed = F.concat_ws(", ", item("one-hop", "easy", '["7", 7, "x"]'), item("two-hop", "easy", "[]"), item("multi-hop", "hard", "[]"), item("table", "medium", '["8", "7"]'), F.lit('{"type": "table", "difficulty": "easy"}'))
    body = F.concat(F.lit('{"questions": ['), listed, F.lit("]}"))
    reply = F.when(F.col("item_id") % 4 == 0, body).when(F.col("item_id") % 4 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(F.col("item_id") % 4 == 2, F.concat(F.lit("Sure: "), body)).otherwise(F.lit("no questions"))
    rows = items.select(F.lit(7).cast("long").alias("chunk_id"), "item_id", reply.alias("reply"), F.array(F.lit("8"), F.lit("9")).alias("related_ids"))
    found = rows.select("item_id", "chunk_id", "related_ids", F.posexplode(questions.parse_questions(F.col("reply"))).alias("item_no", "x"))
    return found.select("item_id", "item_no", "x.question", "x.type", "x.difficulty", F.array_join(questions.normal_source_ids(F.col("x.source_chunk_ids"), F.col("chunk_id"), F.col("related_ids"), F.col("x.type")), ",").alias("source_chunk_ids"))


def label_parse(spark, sf_dir):
    """A reply for each label: JSON, JSON with textual ids, text with pairs, grades of zero, a grade that is no number."""
    rows = t(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("g"))
    i, g = F.col("doc_id").cast("string"), F.col("g").cast("string")
    json_reply = lambda ident: F.concat(F.lit('{"results": [{"chunk_id": '), ident, F.lit(', "relevance": '), g, F.lit('}, {"chunk_id": 5, "relevance": 1}]}'))
    textual = F.concat(F.lit('"Chunk '), i, F.lit('"'))
    reply = F.when(F.col("doc_id") % 4 == 0, json_reply(i)).when(F.col("doc_id") % 4 == 1, json_reply(textual)).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("chunk_id: "), i, F.lit(", relevance: "), g, F.lit("; chunk_id: 5, relevance: 1"))).otherwise(F.lit('{"results": [{"chunk_id": "none", "relevance": 2}, {"chunk_id": 1, "relevance": "many"}]}'))
    found = rows.select("doc_id", labels.parse_labels(reply).alias("p"))
    return found.select("doc_id", F.col("p.error").isNotNull().alias("failed"), F.coalesce(F.array_join(F.transform("p.labels", lambda x: F.concat_ws(":", x["chunk_id"].cast("string"), x["relevance"].cast("string"))), ","), F.lit("")).alias("labels"))


def _graded(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels of questions (one for each source), the documents of its source as its candidates, and documents."""
    docs = t(spark, sf_dir, "documents")
    rows = t(spark, sf_dir, "labels").join(docs.select("doc_id", "source"), "doc_id")
    graded = rows.select(F.col("source").alias("question_id"), "doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("relevance"))
    graded = graded.where("relevance > 0").withColumn("pos", F.row_number().over(Window.partitionBy("question_id").orderBy("doc_id")) - 1)
    return graded, docs.select(F.col("source").alias("question_id"), "doc_id"), docs


def table_neighbour_labels(spark, sf_dir):
    graded, candidates, docs = _graded(spark, sf_dir)
    rows = labels.table_neighbours(graded, candidates, docs, "question_id", "doc_id", "source")
    return rows.select("question_id", "doc_id", "relevance")


def sorted_labels(spark, sf_dir):
    graded, _, _ = _graded(spark, sf_dir)
    return labels.sorted_labels(graded, "question_id", "doc_id").select("question_id", F.array_join(F.transform("labels", lambda x: F.concat_ws(":", x["chunk_id"].cast("string"), x["relevance"].cast("string"))), ",").alias("labels"))


def enrich_labels(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").withColumnRenamed("doc_id", "chunk_id")
    graded = t(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("chunk_id"), "quality")
    rows = labels.enrich(graded, docs, "chunk_id", F.col("source"), X.file_name(F.concat(F.lit("in/"), F.col("source"))), F.col("text"))
    return rows.select("chunk_id", "quality", "source", "file_name", "text_snippet", "error")


def answer_parse(spark, sf_dir):
    """A reply for each turn of a conversation: one for each rung of the ladder."""
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.translate("text", "\"'\n{}", "").alias("x"), ((F.col("conv_id") + F.col("turn")) % 7).alias("k"))
    x = F.col("x")
    reply = (
        F.when(F.col("k") == 0, F.concat(F.lit('```json {"answer": "'), x, F.lit('"} trailing }```')))
        .when(F.col("k") == 1, F.concat(F.lit("answer = '"), x, F.lit("'")))
        .when(F.col("k") == 2, F.concat(F.lit("So.\nAnswer: "), x))
        .when(F.col("k") == 3, F.lit("There is insufficient data"))
        .when(F.col("k") == 4, F.concat(F.lit("  "), x, F.lit("  ")))
        .when(F.col("k") == 5, F.lit("  "))
        .otherwise(F.lit('{"other": 1}'))
    )
    found = rows.select("conv_id", "turn", answers.parse_answer(reply).alias("p"))
    return found.select("conv_id", "turn", F.col("p.answer").alias("answer"))


def outer_braces(spark, sf_dir):
    """The guarded and the unguarded cleaner over replies with and without braces."""
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.when((F.col("conv_id") + F.col("turn")) % 2 == 0, F.concat(F.lit("```json a {"), F.col("text"), F.lit("{}} b```"))).otherwise(F.concat(F.lit(" "), F.col("text"), F.lit(" "))).alias("reply"))
    return rows.select("conv_id", "turn", X.outer_braces(F.col("reply")).alias("guarded"), X.outer_braces(F.col("reply"), guarded=False).alias("bare"))


def truncated_json(spark, sf_dir):
    """Replies about headings that were cut at different places, closed again."""
    @F.pandas_udf("array<struct<id:int,level:int>>")
    def repaired(replies: pd.Series) -> pd.Series:
        return pd.Series([[{"id": x["id"], "level": x["level"]} for x in (repaired_json(r) or {}).get("items", [])] for r in replies])

    full = F.concat(F.lit('{"items": ['), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.concat(F.lit('{"id": '), i.cast("string"), F.lit(', "level": 1}'))), ", "), F.lit("]}"))
    rows = t(spark, sf_dir, "benchmark").select("item_id", F.substr(full, F.lit(1), (F.lit(20) + F.col("item_id") % 130).cast("int")).alias("reply"))
    return rows.select("item_id", F.size(repaired(F.col("reply"))).alias("n_items"))


def props_json(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").alias("n_chars"))


# ---------------------------------------------------------------- whole runs with a stand-in model


def stand_in(prompt: str) -> str:
    """A model that is a function of its prompt, so that runs can be repeated."""
    import hashlib
    import json
    import re

    seed = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16)
    ids = re.findall(r"^ID: (\d+)$", prompt, re.MULTILINE)
    if prompt.startswith("Write three"):
        main = re.search(r"Main chunk (\d+):\n(.*)", prompt)
        if seed % 17 == 0:
            raise RuntimeError("the stand-in refuses this chunk")
        return json.dumps({"questions": [{"question": main[2][:60], "type": S.QUESTION_TYPES[seed % 3], "difficulty": S.DIFFICULTIES[seed % 5 % 3], "source_chunk_ids": [main[1]]}]})
    if prompt.startswith("Choose up"):
        return json.dumps({"candidate_chunks": [int(i) for i in ids[:5]]}) if seed % 19 else "none"
    if prompt.startswith("Grade each"):
        return json.dumps({"results": [{"chunk_id": f"Chunk {i}", "relevance": (seed + int(i)) % 4} for i in ids]})
    return json.dumps({"answer": f"from {' '.join(ids)}"})


def _datasets(spark, sf_dir) -> pipeline.Datasets:
    """A run over the benchmark texts, ten to a source, with as many candidates as make sense among so few chunks."""
    source = F.floor(F.col("item_id") / 10).cast("string")
    chunks = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("chunk_id"), "text", C.metadata(source=F.concat(F.lit("in/"), source), file_name=source).alias("metadata"))
    return pipeline.generate(chunks, stand_in, base=15, most=18)


def retrieval_dataset(spark, sf_dir):
    rows = _datasets(spark, sf_dir).retrieval
    one = lambda x: F.concat_ws(":", x["chunk_id"].cast("string"), x["relevance"].cast("string"), x["source"], x["file_name"], F.md5(x["text_snippet"]), x["error"])
    return rows.select("question_id", "question.question", "question.type", F.array_join(F.transform("ground_truth_chunks", one), ",").alias("chunks"))


def qa_dataset(spark, sf_dir):
    rows = _datasets(spark, sf_dir).qa
    return rows.select("question_id", "question.question", "ground_truth_answer", F.size("supporting_chunks").alias("n_chunks"))


def failed_items(spark, sf_dir):
    rows = _datasets(spark, sf_dir).failed
    return rows.select("stage", "chunk_id", "question.question", "error")


def failing_model(spark, sf_dir):
    """Every call fails, so every chunk is a failed item."""

    def refuse(prompt: str) -> str:
        raise ValueError("no")

    prompts = t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return model.ask(prompts, "item_id", refuse).select(F.lit("generate_questions").alias("stage"), "item_id", "prompt_hash", "error")


QUERIES = {
    f.__name__: f
    for f in (
        token_estimate, payload_budget, group_pages, text_to_lines, page_lines, source_file_name, sequential_ids, table_rows_apart, tla_split, media_blocks,
        split_items, overlap_tail, documents_overlap, hierarchical_split, heading_depth, section_breadcrumb, leaf_pack, heading_batches, rule_headings, tree_process,
        chunk_pages, docx_tables, ancestors_path, leaf_nodes, document_listing, document_half, idempotent_append, store_links, store_index, stable_ids, token_calibration, conditional_tsv, vector_topk, vector_topk_filtered,
        vector_topk_path, store_chunks, idf_index, proper_noun_phrases, score_topk, phrase_bonus, candidate_limits, neighbour_expand, snippet, candidate_prompt,
        budget_fit, map_local_ids, related_chunks, related_prompt, question_validation, label_parse, table_neighbour_labels, sorted_labels, enrich_labels, answer_parse,
        outer_braces, truncated_json, props_json, retrieval_dataset, qa_dataset, failed_items, failing_model,
    )
}
