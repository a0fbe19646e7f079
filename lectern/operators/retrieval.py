"""Retrieval: postings, weights, scores by joins, the best documents of each question, neighbours, prompts, local ids."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import text as X
from ..functions.splitting import estimate
from ..plans import settings as S
from ..sources.scratch import cut


def idf(chunks: DataFrame, text: str = "text") -> DataFrame:
    """token, df, idf = ln((N + 1) / (df + 1)) + 1."""
    return _weighed(chunks.select(F.explode(X.tokens(F.col(text))).alias("token")), chunks)


def _weighed(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """The weights of tokens, of which `found` has one row for each chunk that holds them."""
    # N is one number, put in as a scalar subquery
    total = chunks.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = found.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return counted.select("token", "df", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def postings(chunks: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, word, tf: how often each lower-case word occurs in each chunk."""
    found = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({X.WORD})"), F.lit(1))
    return chunks.select(key, F.explode(found).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("tf"))


def tokens_in_words(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """token, word, inside: the words that have a token as a part, and how often.

    Each word is taken apart into its substrings of the lengths that tokens have, and these meet the tokens by equality; no token
    is held against every word.
    """
    lengths = tokens.agg(F.array_sort(F.collect_set(F.length("token"))).alias("n")).scalar()
    words = vocabulary.select("word", F.explode(lengths).alias("n")).where(F.col("n") <= F.length("word"))
    parts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - F.col("n") + 1), lambda i: F.substr(F.col("word"), i, F.col("n"))))
    met = words.select("word", F.explode(parts).alias("token")).join(tokens, "token")
    return met.select("token", "word", X.count_in(F.col("token"), F.col("word")).alias("inside"))


#: Question tokens that go to every task; with more of them, scores are joins.
SCANNED = 1 << 17
_SLICE_CELLS, _QUESTION_BLOCK = 1 << 21, 256


def scores(questions: DataFrame, chunks: DataFrame, question_id: str, question: str, chunk_id: str, text: str = "text", most: int | None = None, least: float = 0.0) -> DataFrame:
    """question_id, chunk_id, score of every pair with a positive score. most: of each question the best ones are enough, so many and ties.
    least: pairs with less are not given.

    The score is the sum over the question's different tokens of (occurrences as a substring of the lower-case text) x idf, plus PHRASE_BONUS for
    each proper-noun phrase that the text contains. A token has word characters only, so each occurrence lies in one word, and its count is
    the sum over words of tf x (occurrences in the word). A token that is no word of the corpus weighs 1. Scores are rounded to 6 places, which
    makes ties independent of the order of sums.

    With SCANNED tokens of questions at most, one scan of the chunks scores all questions, as a product of matrices; with more, words meet
    tokens in joins by equality, with counts summed per chunk and token before questions come in.
    """
    asked = questions.select(F.col(question_id).alias("q"), F.explode(X.tokens(F.col(question))).alias("token"))
    asked = cut(asked, "asked")
    if asked.count() <= SCANNED:
        found = _scanned(asked, questions, chunks, question_id, question, chunk_id, text, most, least)
    else:
        found = _joined(asked, questions, chunks, question_id, question, chunk_id, text)
    total = found.select("q", "c", F.round("s", 6).alias("score"))
    total = total.where(F.col("score") >= least) if least > 0 else total
    return total.select(F.col("q").alias(question_id), F.col("c").alias(chunk_id), "score")


def _joined(asked: DataFrame, questions: DataFrame, chunks: DataFrame, question_id: str, question: str, chunk_id: str, text: str) -> DataFrame:
    tokens = asked.select("token").distinct()
    # texts are taken apart once: words, weights, counts and phrases all read the postings
    posted = cut(postings(chunks.select(F.col(chunk_id).alias("c"), F.col(text).alias("text")), "c"), "postings")
    phrases = _phrases_by_token(questions, question_id, question)
    inside = tokens_in_words(tokens.unionByName(phrases.select("token")).distinct(), posted.select("word").distinct())
    counts = posted.join(inside, "word").groupBy("c", "token").agg(F.sum(F.col("tf") * F.col("inside")).alias("n"))
    known = _weighed(posted.select(F.col("word").alias("token")), chunks)
    weights = tokens.join(known.select("token", "idf"), "token", "left").select("token", F.coalesce("idf", F.lit(1.0)).alias("idf"))
    weighted = asked.join(weights, "token").join(counts, "token").select("q", "c", (F.col("n") * F.col("idf")).alias("s"))
    bonus = _phrase_bonus(phrases, chunks, inside, posted, chunk_id, text)
    return weighted.unionByName(bonus).groupBy("q", "c").agg(F.sum("s").alias("s"))


class _Asked:
    """Questions as matrices: for each block of them the places of its tokens, and a table of token by question."""

    def __init__(self, pairs: list[tuple], idf: dict[str, float], phrases: list[tuple]):
        self.questions = sorted({q for q, _ in pairs})
        weighed = sorted({t for _, t in pairs})
        # a phrase's words need not be tokens of its question; those that are none are looked up, and weigh nothing
        longest = [max(re.findall(r"\w+", p), key=len) for _, p in phrases]
        self.tokens = weighed + sorted(set(longest).difference(weighed))
        self.place = {t: i for i, t in enumerate(self.tokens)}
        self.bordered = np.array([any(t.startswith(t[k:]) for k in range(1, len(t))) for t in self.tokens], bool)
        self.automaton = ahocorasick.Automaton()
        for t, i in self.place.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.idf = np.array([idf.get(t, 1.0) for t in weighed] + [0.0] * (len(self.tokens) - len(weighed)))
        number = {q: i for i, q in enumerate(self.questions)}
        own: list[list[int]] = [[] for _ in self.questions]
        for q, t in pairs:
            own[number[q]].append(self.place[t])
        self.blocks = []
        for at in range(0, len(own), _QUESTION_BLOCK):
            some = own[at : at + _QUESTION_BLOCK]
            used = np.unique(np.concatenate([np.array(x, np.int64) for x in some]))
            table = np.zeros((len(used), len(some)))
            for k, x in enumerate(some):
                table[np.searchsorted(used, x), k] = 1.0
            self.blocks.append((at, used, table))
        self.phrases = [(number[q], p, self.place[t]) for (q, p), t in zip(phrases, longest, strict=True)]

    def counts(self, texts: list[str]) -> np.ndarray:
        """[text, token]: occurrences without overlap, in one pass over each text."""
        out = np.zeros((len(texts), len(self.tokens)))
        for row, text in zip(out, texts, strict=True):
            found = [i for _, i in self.automaton.iter(text)]
            if found:
                row += np.bincount(found, minlength=len(row))
                # of a token that may overlap itself not every place counts
                for i in np.flatnonzero(self.bordered & (row > 1)).tolist():
                    row[i] = text.count(self.tokens[i])
        return out

    def scores(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the first question, scores by text and question) for each block."""
        counts = self.counts(texts)
        bonus: dict[int, list[tuple[int, int]]] = {}
        for q, phrase, token in self.phrases:
            for row in np.flatnonzero(counts[:, token]).tolist():
                if phrase in texts[row]:
                    bonus.setdefault(q // _QUESTION_BLOCK, []).append((row, q % _QUESTION_BLOCK))
        weighted = counts * self.idf
        for block, (at, used, table) in enumerate(self.blocks):
            found = weighted[:, used] @ table
            for row, q in bonus.get(block, ()):
                found[row, q] += S.PHRASE_BONUS
            yield at, found


def _scanned(asked: DataFrame, questions: DataFrame, chunks: DataFrame, question_id: str, question: str, chunk_id: str, text: str, most: int | None, lowest: float) -> DataFrame:
    """q, c, s in one scan of the chunks; what is shipped has SCANNED tokens at most."""
    spark = chunks.sparkSession
    pairs = [(r["q"], r["token"]) for r in asked.collect()]
    tokens = F.broadcast(asked.select("token").distinct())
    held = chunks.select(F.explode(X.tokens(F.col(text))).alias("token")).join(tokens, "token")
    idf = {r["token"]: r["idf"] for r in _weighed(held, chunks).collect()}
    phrases = questions.select(F.col(question_id).alias("q"), F.explode(F.transform(X.phrases(F.col(question)), F.lower)).alias("p")).where("q IS NOT NULL")
    shipped = spark.sparkContext.broadcast((pairs, idf, [(r["q"], r["p"]) for r in phrases.collect()]))
    rows = chunks.select(F.col(chunk_id).alias("c"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    pairs_given = bool(pairs)
    kinds = [to_arrow_type(asked.schema["q"].dataType), to_arrow_type(rows.schema["c"].dataType), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not pairs_given:
            return
        known = _Asked(*shipped.value)
        step = max(16, _SLICE_CELLS // max(1, len(known.tokens)))
        least = np.zeros(len(known.questions))  # what a chunk needs to be among the best so far
        best = np.zeros((len(known.questions), most)) if most else None
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                ids = batch.column(0).slice(at, step)
                for first, found in known.scores(batch.column(1).slice(at, step).to_pylist()):
                    own = slice(first, first + found.shape[1])
                    if most:
                        every = np.concatenate([best[own], found.T], 1)
                        best[own] = -np.partition(-every, most - 1, 1)[:, :most]
                        least[own] = best[own].min(1) - 1e-5
                    # sums in another order may differ in their last places, so what is near the bound is left to the caller
                    row, q = np.nonzero((found > 0) & (found >= np.maximum(least[own], lowest - 1e-5)))
                    names = [known.questions[i] for i in (q + first).tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(names, kinds[0]), ids.take(pa.array(row)).cast(kinds[1]), pa.array(found[row, q])], ["q", "c", "s"])

    return rows.mapInArrow(run, f"q {asked.schema['q'].dataType.simpleString()}, c {rows.schema['c'].dataType.simpleString()}, s double")


def _phrases_by_token(questions: DataFrame, question_id: str, question: str) -> DataFrame:
    """q, k, phrase, token: the phrases of each question, in lower case, and the longest word of each.

    A phrase ends where a word goes on with a letter that phrases do not have, so its words need not be tokens of the question.
    """
    found = questions.select(F.col(question_id).alias("q"), F.posexplode(F.transform(X.phrases(F.col(question)), F.lower)).alias("k", "phrase"))
    longest = lambda p: F.element_at(F.array_sort(F.transform(X.tokens(p), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), 1)["t"]
    return found.select("q", "k", "phrase", longest(F.col("phrase")).alias("token"))


def _phrase_bonus(phrases: DataFrame, chunks: DataFrame, inside: DataFrame, posted: DataFrame, chunk_id: str, text: str) -> DataFrame:
    """q, c, s: the bonus of each phrase and chunk. A chunk with a phrase has the phrase's longest token in a word, which finds the chunks to look at."""
    near = phrases.join(inside, "token").join(posted, "word").select("q", "k", "phrase", "c").distinct()
    texts = chunks.select(F.col(chunk_id).alias("c"), F.lower(F.col(text)).alias("t"))
    return near.join(texts, "c").where(F.contains("t", "phrase")).select("q", "c", F.lit(S.PHRASE_BONUS).alias("s"))


def candidate_limit(kind: Column, difficulty: Column, base: int = S.PREFILTER, most: int = S.PREFILTER_MOST) -> Column:
    """How many candidates a question gets: twice the base for multi-hop and hard ones, at most `most`."""
    return F.least(F.when((kind == "multi-hop") | (difficulty == "hard"), 2 * base).otherwise(base), F.lit(most))


def is_deep(kind: Column, difficulty: Column) -> Column:
    return F.coalesce((kind == "multi-hop") | (difficulty == "hard"), F.lit(False))


def prefilter(questions: DataFrame, chunks: DataFrame, question_id: str, question: str, chunk_id: str, position: str, text: str = "text", limit: Column | int = S.PREFILTER) -> DataFrame:
    """question_id, chunk_id, position, score, rank (from 1): the best chunks of each question, ties by position.

    With no more chunks than the limit all are candidates, in order, without scores. A question that no chunk scores for takes the first chunks.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    asked = questions.select(question_id, limit.alias("_limit"))
    placed = chunks.select(chunk_id, position)
    best = Window.partitionBy(question_id).orderBy(F.desc("score"), position)
    total, most = chunks.count(), questions.agg(F.max(limit)).first()[0] or 0
    scored = scores(questions, chunks, question_id, question, chunk_id, text, int(most) or None).where("score > 0").join(placed, chunk_id)
    # a constant bound first, for which Spark keeps only the best rows of each task before the exchange
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    ranked = ranked.join(asked, question_id).where((F.col("rank") <= F.col("_limit")) & (total > F.col("_limit"))).select(question_id, chunk_id, position, "score", "rank")
    # at most `most` rows a question; scored once, though read twice
    ranked = cut(ranked, "ranked")
    # the first chunks by position: at most `most` rows of two numbers
    head = placed.orderBy(position).limit(int(most)).withColumn("rank", F.row_number().over(Window.orderBy(position)))
    rest = asked.join(ranked.select(question_id).distinct(), question_id, "left_anti")
    plain = rest.join(F.broadcast(head), F.col("rank") <= F.col("_limit")).select(question_id, chunk_id, position, F.lit(0.0).alias("score"), "rank")
    return ranked.unionByName(plain)


def neighbours(candidates: DataFrame, chunks: DataFrame, question_id: str, chunk_id: str, position: str, source: str, most: int = S.NEIGHBOURS, cap: int = S.PREFILTER_MOST, steps: tuple[int, ...] = S.NEIGHBOUR_STEPS) -> DataFrame:
    """Candidates with up to `most` chunks beside them, of the same source, in the order candidates and steps find them; cut at `cap`.

    Each candidate gives one row per step, and rows meet chunks by position: no range join. Of the rows of one chunk the first counts.
    Gives question_id, chunk_id, position, rank, is_neighbour.
    """
    tried = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(d).alias("delta")) for i, d in enumerate(steps)]))
    placed = chunks.select(F.col(chunk_id), F.col(position), F.col(source).alias("_source"))
    own = candidates.select(question_id, chunk_id, position, "rank")
    sourced = own.join(placed.select(chunk_id, "_source"), chunk_id)
    near = sourced.select(question_id, "rank", F.col("_source").alias("_of"), F.col(position).alias("_at"), tried.alias("t"))
    near = near.select(question_id, "rank", "_of", F.col("t.step").alias("step"), (F.col("_at") + F.col("t.delta")).alias(position))
    near = near.join(placed, position).where(F.col("_source").eqNullSafe(F.col("_of"))).join(own.select(question_id, chunk_id), [question_id, chunk_id], "left_anti")
    first = near.groupBy(question_id, chunk_id, position).agg(F.min(F.struct("rank", "step")).alias("_found"))
    placed_new = first.withColumn("_n", F.row_number().over(Window.partitionBy(question_id).orderBy("_found"))).where(F.col("_n") <= most)
    sizes = own.groupBy(question_id).agg(F.count(F.lit(1)).alias("_had"))
    added = placed_new.join(sizes, question_id).select(question_id, chunk_id, position, (F.col("_had") + F.col("_n")).cast("int").alias("rank"), F.lit(True).alias("is_neighbour"))
    return own.withColumn("is_neighbour", F.lit(False)).unionByName(added).where(F.col("rank") <= cap)


# ---------------------------------------------------------------- prompts and replies

#: How a chunk is shown to the model (fixed format).
SHOWN = "\nID: {id}\n\nContent:\n{text}\n\n------------------------\n"
CANDIDATE_PROMPT = "Choose up to {top_k} chunks that help to answer the question. Reply with JSON only, as in the last line.\n\nQuestion: {question}\n\nChunks:\n{chunks}\n"


def shown(chunk_id: Column, text: Column) -> Column:
    """One chunk as the model sees it."""
    return F.concat(F.lit("\nID: "), chunk_id.cast("string"), F.lit("\n\nContent:\n"), text, F.lit("\n\n------------------------\n"))


def shown_blocks(rows: DataFrame, key: str, rank: Column, shown_id: Column, text: Column) -> DataFrame:
    """key, chunks: the chunks of each key in order of rank, one block after the other. A key has as many chunks as candidates are allowed."""
    parts = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(rank.alias("r"), shown(shown_id, text).alias("b")))).alias("_p"))
    return parts.select(key, F.array_join(F.transform("_p", lambda x: x["b"]), "\n").alias("chunks"))


def candidate_prompts(candidates: DataFrame, questions: DataFrame, chunks: DataFrame, question_id: str, question: str, chunk_id: str, text: str = "text", words: int = S.SNIPPET_WORDS, top_k: int = S.TOP_K, template: str = CANDIDATE_PROMPT) -> DataFrame:
    """question_id, prompt: candidates by local number from 0, cut to `words` words each."""
    rows = candidates.join(chunks.select(chunk_id, F.col(text).alias("_t")), chunk_id)
    blocks = shown_blocks(rows, question_id, F.col("rank"), F.col("rank") - 1, X.snippet(F.col("_t"), words))
    return questions.join(blocks, question_id).select(question_id, X.fill(template, question=F.col(question), chunks=F.col("chunks"), top_k=F.lit(str(top_k))).alias("prompt"))


def fit_budget(texts: list[str], question: str, words: int, allowed: int, top_k: int = S.TOP_K, template: str = CANDIDATE_PROMPT, count=estimate) -> tuple[int, int, str]:
    """(chunks, words, prompt): a fifth of the chunks goes again and again down to five, then words are halved down to twenty, until the prompt fits."""

    def prompt(n: int, w: int) -> str:
        cut = lambda t: t if len(t.split()) <= w else " ".join(t.split()[:w]) + " ..."
        blocks = "\n".join(SHOWN.replace("{id}", str(i)).replace("{text}", cut(t)) for i, t in enumerate(texts[:n]))
        return template.replace("{question}", question).replace("{chunks}", blocks).replace("{top_k}", str(top_k))

    n, least = len(texts), min(S.LEAST_CANDIDATES, len(texts))
    tried = prompt(n, words)
    fits = lambda: count(tried) + S.REQUEST_TOKENS <= allowed
    while not fits() and n > least:
        n -= max(1, n // 5)
        tried = prompt(n, words)
    while not fits() and words > S.SNIPPET_LEAST:
        words = max(S.SNIPPET_LEAST, words // 2)
        tried = prompt(n, words)
    if not fits():
        n, words = min(n, least), S.SNIPPET_LEAST
        tried = prompt(n, words)
    return n, words, tried


def budgeted_prompts(candidates: DataFrame, question_id: str, question: str, text: str, rank: str, words: Column, allowed: int | None = None, top_k: int = S.TOP_K, template: str = CANDIDATE_PROMPT) -> DataFrame:
    """question_id, n_chunks, n_words, prompt, short_prompt (the retry with the fewest chunks). One row per question, at most PREFILTER_MOST chunks in it."""
    limit = S.Limits().prompt if allowed is None else allowed
    rows = candidates.groupBy(question_id).agg(F.first(question).alias("question"), F.max(words).alias("words"), F.transform(F.array_sort(F.collect_list(F.struct(rank, text))), lambda x: x[text]).alias("texts"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for key, asked, w, texts in part.itertuples(index=False):
                n, used, prompt = fit_budget(list(texts), asked or "", int(w), limit, top_k, template)
                out.append((key, n, used, prompt, fit_budget(list(texts)[: S.LEAST_CANDIDATES], asked or "", S.SNIPPET_LEAST, 1 << 62, top_k, template)[2]))
            yield pd.DataFrame(out, columns=[question_id, "n_chunks", "n_words", "prompt", "short_prompt"])

    kind = dict(candidates.dtypes)[question_id]
    return rows.mapInPandas(run, f"{question_id} {kind}, n_chunks int, n_words int, prompt string, short_prompt string")


def local_ids(reply: Column) -> Column:
    """array<int>: the integers that the reply lists as candidate_chunks, true and false as 1 and 0; null where it lists nothing.

    Numbers in quotes and fractions are no integers, though they could be read as such.
    """
    body = X.outer_braces(reply, guarded=False)
    listed = F.try_variant_get(F.try_parse_json(F.get_json_object(body, "$.candidate_chunks")), "$", "array<variant>")

    def integer(x: Column) -> Column:
        kind = F.schema_of_variant(x)
        return F.when(kind == "BIGINT", F.try_variant_get(x, "$", "int")).when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("int"))

    return F.filter(F.transform(listed, integer), lambda n: n.isNotNull())


def real_ids(listed: Column, used: Column) -> Column:
    """The used ids at the listed local numbers: numbers out of range are left out, repeats too."""
    valid = F.filter(listed, lambda n: (n >= 0) & (n < F.size(used)))
    return F.array_distinct(F.transform(valid, lambda n: F.get(used, n)))
