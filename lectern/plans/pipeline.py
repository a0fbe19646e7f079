"""Whole runs: documents to chunks, chunks to a retrieval and a question-answering dataset, with what failed beside them.

Each stage that asks the model is written before and after, so what reads its replies does not ask again, and no result is rewritten for
each question. With a folder of its own a run that was broken off goes on with the first stage that is not written to its end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import answers, labels, model, questions, retrieval, tree
from ..operators.chunking import metadata
from ..operators.ordering import sequential_ids, with_position
from ..sources import scratch
from . import settings as S


def chunk_pages(pages: DataFrame, source, order: str, content: str, detector: tree.Detector | None = None) -> DataFrame:
    """Chunk rows of paged text: lines by source, trees, leaves with breadcrumbs, ids in the order of sources and leaves.

    No source meets in one row: trees are worked out from the lengths of lines, then lines meet in their leaves.
    """
    from ..operators.chunking import page_lines

    ranges = [F.col(c) for c in ("source", "page", "line_in_page")]
    # the lines' exchange is not read once they are written
    with scratch.freed_shuffles(pages.sparkSession):
        lines = with_position(page_lines(pages, source, order, content), ranges, ties=[F.col("line")])
        placed = scratch.cut(tree.place_lines(tree.mark_lines(lines, detector)), "tree")
    first = lines.groupBy("source").agg(F.min("page").alias("ord"))
    leaves = placed.where("path IS NOT NULL").select("source", "leaf").join(first, "source")
    titles, contents = tree.paged_leaves(lines, placed)
    numbered = sequential_ids(leaves, "source", ["ord", "leaf"]).drop("ord").join(titles, ["source", "leaf"], "left")
    numbered = numbered.select("chunk_id", "source", "leaf", tree.joined_titles(F.col("source"), F.col("titles")).alias("breadcrumb"))
    return _chunk_rows(numbered.join(contents, ["source", "leaf"]), F.substring_index("source", "/", -1))


def chunk_documents(documents: DataFrame, detector: tree.Detector | None = None) -> DataFrame:
    """Chunk rows of documents (source, lines, tables), as a word-processor file gives them; sources in their own order."""
    return _chunks(tree.chunk_documents(documents, detector), documents.select("source", F.col("source").alias("ord")), F.lit(None).cast("string"))


def _chunks(leaves: DataFrame, order: DataFrame, name) -> DataFrame:
    return _chunk_rows(sequential_ids(leaves.join(order, "source"), "source", ["ord", "leaf"]), name)


def _chunk_rows(placed: DataFrame, name) -> DataFrame:
    meta = metadata(source=F.col("source"), file_name=F.coalesce(name, F.lit(None).cast("string")), breadcrumb=F.col("breadcrumb"), node_id=X.stable_id(F.col("source"), F.col("leaf")))
    return placed.select("chunk_id", tree.chunk_text(F.col("breadcrumb"), F.col("content")).alias("text"), meta.alias("metadata"))


@dataclass(frozen=True)
class Datasets:
    retrieval: DataFrame
    qa: DataFrame
    failed: DataFrame


def generate(chunks: DataFrame, chat: model.Chat, base: int = S.PREFILTER, most: int = S.PREFILTER_MOST, partitions: int | None = None, folder: str | None = None) -> Datasets:
    """Questions for every chunk, candidates, labels and an answer for every question.

    folder: a folder of the run's own, in which its stages stay; a run with the same folder goes on where the one before was broken off.

    chunks: chunk_id, text, metadata. A chunk or a question whose stage fails is a row of `failed`, and the rest goes on.
    """
    cut = scratch.cut if folder is None else scratch.kept(folder)
    flat = cut(chunks.select("chunk_id", "text", F.col("metadata.source").alias("source"), F.col("metadata.file_name").alias("file_name"), F.col("metadata.document_id").alias("document_id")), "chunks")

    # questions
    related = questions.related_chunks(flat, "chunk_id", "chunk_id", "source")
    shown = questions.format_related(related, flat, "chunk_id", "source")
    asked = flat.join(shown, "chunk_id", "left").withColumn("prompt", questions.question_prompt(F.col("chunk_id"), F.col("text"), F.col("related_chunks")))
    asked = cut(asked.select("chunk_id", "related_ids", "prompt"), "question-prompts")
    replies = cut(model.ask(asked, "chunk_id", chat, partitions=partitions).join(asked.select("chunk_id", "related_ids"), "chunk_id"), "question-replies")
    items = questions.expand_questions(replies.where("error IS NULL"), "chunk_id", "reply", "related_ids")
    items = cut(items.withColumn("question_id", F.col("chunk_id") * 1000 + F.col("item_no")), "questions")

    # candidates
    deep = retrieval.is_deep(F.col("type"), F.col("difficulty"))
    limit = retrieval.candidate_limit(F.col("type"), F.col("difficulty"), base, most)
    placed = flat.withColumn("position", F.col("chunk_id"))
    first = cut(retrieval.prefilter(items, placed, "question_id", "question", "chunk_id", "position", limit=limit).drop("score"), "candidates")
    wide = items.where((F.col("type") == "table") | deep).select("question_id")
    widened = retrieval.neighbours(first.join(wide, "question_id", "left_semi"), placed, "question_id", "chunk_id", "position", "source", cap=most)
    found = cut(first.join(wide, "question_id", "left_anti").withColumn("is_neighbour", F.lit(False)).unionByName(widened), "widened")
    rows = found.join(flat.select("chunk_id", "text"), "chunk_id").join(items.select("question_id", "question", F.when(deep, 2 * S.SNIPPET_WORDS).otherwise(S.SNIPPET_WORDS).alias("words")), "question_id")
    prompts = cut(retrieval.budgeted_prompts(rows, "question_id", "question", "text", "rank", F.col("words")), "candidate-prompts")
    picked = cut(model.ask(prompts, "question_id", chat, short_prompt="short_prompt", partitions=partitions), "candidate-replies")
    used = found.groupBy("question_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "chunk_id"))), lambda x: x["chunk_id"]).alias("ids")).join(prompts.select("question_id", "n_chunks"), "question_id")
    used = used.select("question_id", F.slice("ids", F.lit(1), F.col("n_chunks")).alias("ids"))
    # the short prompt shows the first few only
    shown = F.when(F.col("short"), F.slice("ids", 1, S.LEAST_CANDIDATES)).otherwise(F.col("ids"))
    # a reply without a JSON object fails its question
    listed = retrieval.local_ids(F.col("reply"))
    chosen = picked.join(used, "question_id").withColumn("listed", listed).withColumn("ids", shown)
    broken = F.col("error").isNull() & F.get_json_object(X.outer_braces(F.col("reply"), guarded=False), "$").isNull()
    chosen = cut(chosen.select("question_id", F.when(broken, F.lit("the reply holds no JSON object")).otherwise(F.col("error")).alias("error"), retrieval.real_ids(F.coalesce("listed", F.array().cast("array<int>")), F.col("ids")).alias("ids")), "chosen")

    # labels
    candidates = chosen.where("error IS NULL").select("question_id", F.posexplode("ids").alias("k", "chunk_id"))
    texts = candidates.join(flat.select("chunk_id", "text"), "chunk_id")
    blocks = retrieval.shown_blocks(texts, "question_id", F.col("k"), F.col("chunk_id"), F.col("text"))
    to_label = items.join(chosen.where("error IS NULL").select("question_id"), "question_id").join(blocks, "question_id", "left")
    to_label = cut(to_label.select("question_id", "type", X.fill(labels.LABEL_PROMPT, question=F.col("question"), chunks=F.col("chunks")).alias("prompt")), "label-prompts")
    graded = model.ask(to_label, "question_id", chat, partitions=partitions)
    graded = cut(graded.withColumn("p", labels.parse_labels(F.col("reply"))).join(to_label.select("question_id", "type"), "question_id").select("question_id", "type", F.coalesce("error", "p.error").alias("error"), "p.labels"), "label-replies")
    plain = graded.where("error IS NULL").select("question_id", "type", F.posexplode("labels").alias("pos", "x")).select("question_id", "type", "pos", "x.chunk_id", "x.relevance")
    tables = labels.table_neighbours(plain.where("type = 'table'"), candidates, flat, "question_id", "chunk_id", "source")
    whole = cut(plain.where("type <> 'table'").select("question_id", "chunk_id", "relevance", F.col("pos").cast("int").alias("pos")).unionByName(tables), "labels")
    ordered = labels.sorted_labels(whole, "question_id", "chunk_id")

    # answers
    ranked = ordered.select("question_id", F.posexplode("labels").alias("k", "x")).select("question_id", "k", "x.chunk_id", "x.relevance")
    blocks = retrieval.shown_blocks(ranked.join(flat.select("chunk_id", "text"), "chunk_id"), "question_id", F.col("k"), F.col("chunk_id"), F.col("text"))
    to_answer = items.join(ordered.select("question_id"), "question_id").join(blocks, "question_id", "left")
    to_answer = cut(to_answer.select("question_id", X.fill(answers.ANSWER_PROMPT, question=F.col("question"), chunks=F.col("chunks")).alias("prompt")), "answer-prompts")
    answered = cut(model.ask(to_answer, "question_id", chat, partitions=partitions).withColumn("p", answers.parse_answer(F.col("reply"))).select("question_id", F.coalesce("error", "p.error").alias("error"), "p.answer"), "answer-replies")

    # datasets; a question without labels is not asked for an answer
    done = graded.where("error IS NULL").select("question_id").join(answered.withColumnRenamed("error", "failure"), "question_id", "left").where("failure IS NULL")
    done = done.join(ordered.select("question_id", F.lit(True).alias("labelled")), "question_id", "left").select("question_id", F.when(F.col("labelled"), F.col("answer")).otherwise(F.lit(S.NO_ANSWER)).alias("answer"))
    shown = labels.enrich(ranked, flat, "chunk_id", F.col("source"), F.col("file_name"), F.col("text"), F.col("document_id"))
    truth = shown.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("k", "chunk_id", "relevance", "source", "file_name", "document_id", "text_snippet", "error"))).alias("xs"))
    truth = truth.select("question_id", F.transform("xs", lambda x: x.dropFields("k")).alias("ground_truth_chunks"))
    question = F.struct("question", "type", "difficulty", "source_chunk_ids").alias("question")
    kind = dict(truth.dtypes)["ground_truth_chunks"]
    every = items.join(done, "question_id").join(truth, "question_id", "left").select("question_id", question, "answer", F.coalesce("ground_truth_chunks", F.array().cast(kind)).alias("ground_truth_chunks"))
    every = cut(every, "samples")

    failed = replies.where("error IS NOT NULL").select(F.lit("generate_questions").alias("stage"), "chunk_id", F.lit(None).cast(dict(every.dtypes)["question"]).alias("question"), "error")
    for stage in (chosen, graded, answered):
        lost = stage.where("error IS NOT NULL").select("question_id", "error").join(items, "question_id")
        failed = failed.unionByName(lost.select(F.lit("retrieve/label/answer").alias("stage"), F.lit(None).cast("long").alias("chunk_id"), question, "error"))
    return Datasets(
        every.select("question_id", "question", "ground_truth_chunks"),
        every.select("question_id", "question", F.col("answer").alias("ground_truth_answer"), F.col("ground_truth_chunks").alias("supporting_chunks")),
        failed,
    )
