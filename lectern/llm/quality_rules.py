"""Quality rules: word and line statistics, then a log-likelihood ratio of hashed n-grams. DataFrame functions only.

A document fails the base rules if it has fewer than 50 words or if more than half of its words stand in 3-word windows that
occur twice or more in it. The others are judged by importance weights: the tokens of a text (runs of letters and digits, runs of
other marks) give uni- and bigrams, hashed to 2^16 buckets. One multinomial over the buckets is estimated from a trusted target,
another from the whole raw corpus, both with add-one smoothing. The score of a document is the mean over its n-grams of
ln(p_target / p_raw); it stays if the score is at least `threshold`. No part is random, so each document always gets the
same verdict.

The raw multinomial counts every document, the target every labelled document of quality 1. The labels grow with the corpus, so they are
not broadcast: texts are dealt by id to meet them. From there tasks exchange one row for each bucket and task.

Defined results: a null or empty text has no words and fails the base rules; a document with no n-grams scores 0; an empty target
or an empty table gives score 0 throughout; repeated rows each give a row; other columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_WHITE, WHITE, constant_array, fence, id_and_text

BITS = 16
BUCKETS = 1 << BITS
THRESHOLD = -0.5
MIN_WORDS = 50
#: Letters and digits, or any other marks.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: a column used inside a lambda would otherwise be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(h: Column, n: Column) -> Column:
    """The mixed hash of each 3-word window. h: hashes of the words, a column."""
    some = F.greatest(n - 2, F.lit(0))
    two = F.zip_with(F.slice(h, 1, some), F.slice(h, 2, some), lambda a, b: F.shiftleft(a, 2).bitwiseXOR(F.shiftleft(b, 1)))
    return F.zip_with(two, F.slice(h, 3, some), lambda a, b: a.bitwiseXOR(b))


def _sorted_windows(mixed: Column) -> Column:
    """34 bits of the mixed hash of each window, then its place in 30 bits, sorted; none where all windows differ, as most texts have it."""
    placed = F.sort_array(F.transform(mixed, lambda x, i: F.shiftleft(x, 30).bitwiseOR(i.cast("long"))))
    return F.when(F.size(F.array_distinct(mixed)) < F.size(mixed), placed).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(words: Column, windows: Column) -> Column:
    """Words that stand in a 3-word window found twice or more: windows of one hash, of which the words are then compared."""
    like = lambda x, y: F.shiftrightunsigned(x, 30) == F.shiftrightunsigned(y, 30)
    maybe = F.filter(windows, lambda x, j: like(x, F.get(windows, j - 1)) | like(x, F.get(windows, j + 1)))

    def covered(some: Column) -> Column:
        at = F.transform(some, lambda x: x.bitwiseAND(F.lit((1 << 30) - 1)).cast("int"))
        texts = F.array_sort(F.transform(at, lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("k"), i.alias("i"))))
        twice = _let(texts, lambda t: F.filter(t, lambda x, j: (x["k"] == F.get(t, j - 1)["k"]) | (x["k"] == F.get(t, j + 1)["k"])))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return _let(maybe, lambda some: F.when(F.size(some) > 0, covered(some)).otherwise(0))


def base_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the columns of carry."""
    rows = id_and_text(docs, id_col, text_col, *carry)
    rows = rows.withColumns(
        {
            "words": fence(F.array_remove(F.split("text", WHITE), "")),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_WHITE)),
            "n_symbols": F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long"),
        }
    ).withColumns({"n": F.size("words"), "word_chars": F.length(F.array_join("words", "")).cast("long"), "word_hashes": fence(F.transform("words", lambda w: F.xxhash64(w)))})
    rows = rows.withColumn("mixed", fence(_windows(F.col("word_hashes"), F.col("n")))).drop("word_hashes")
    rows = rows.withColumn("windows", fence(_sorted_windows(F.col("mixed")))).drop("mixed")
    stats = rows.select(
        "doc_id",
        "text",
        *carry,
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words"), F.col("windows")).cast("long").alias("n_repeat_words"),
    )
    return stats.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _bucket(h: Column) -> Column:
    """The leading bits of a hash."""
    return F.shiftrightunsigned(h, 64 - BITS)


def _pair(a: Column, b: Column) -> Column:
    """The hash of a bigram, from those of its tokens."""
    return F.shiftleft(a, 1).bitwiseXOR(b)


def _grams(rows: DataFrame, *keep: str) -> DataFrame:
    """A row with `bucket` for each uni- and bigram, from rows with `hashes`. Rows in place of arrays, as Spark compiles what makes rows."""
    each = rows.select(*keep, "hashes", F.posexplode("hashes").alias("i", "h"))
    both = each.select(*keep, F.explode(F.array("h", _pair(F.col("h"), F.get("hashes", F.col("i") + 1)))).alias("h"))
    return both.where(F.col("h").isNotNull()).select(*keep, _bucket(F.col("h")).alias("bucket"))


def _mean_weight(h: Column, n: Column, weights: Column) -> Column:
    """Mean of the weights of all uni- and bigrams; 0 without any."""
    weight = lambda x: F.get(weights, _bucket(x))
    some = F.greatest(n - 1, F.lit(0))
    # a token with the bigram that it begins; the last token begins none
    sums = F.zip_with(F.slice(h, 1, some), F.slice(h, 2, some), lambda a, b: weight(a) + weight(_pair(a, b)))
    total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x) + weight(F.element_at(h, -1))
    return F.when(n < 1, F.lit(0.0)).otherwise(total / (2 * n - 1))


def _tokens(rows: DataFrame, *keep: str) -> DataFrame:
    tokens = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    return rows.select(*keep, fence(F.transform(tokens, lambda x: F.xxhash64(x))).alias("hashes")).withColumn("n", F.size("hashes"))


def target_ids(labels: DataFrame) -> DataFrame:
    """The different ids of quality 1."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def ratio_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row with `weights`: ln(p_target / p_raw) for each bucket."""
    trusted = target_ids(labels).withColumn("trusted", F.lit(1))
    # a task hashes its share of the ids, so that no text is sorted
    rows = id_and_text(docs, id_col, text_col).join(trusted.hint("shuffle_hash"), "doc_id", "left")
    counts = _grams(_tokens(rows, "trusted"), "trusted").groupBy("bucket").agg(F.coalesce(F.sum("trusted"), F.lit(0)).alias("target"), F.count(F.lit(1)).alias("raw"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket")).join(counts, "bucket", "left").na.fill(0)
    # a fixed number of rows, BUCKETS, meets here
    total = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "target", "raw"))).alias("all"), F.sum("target").alias("t"), F.sum("raw").alias("r"))
    weight = lambda x: F.log((x["target"] + 1) / (F.col("t") + BUCKETS)) - F.log((x["raw"] + 1) / (F.col("r") + BUCKETS))
    return total.select(F.when(F.col("t") > 0, F.transform("all", weight)).otherwise(F.array_repeat(F.lit(0.0), BUCKETS)).alias("weights"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: the base statistics, base_failed, kept, score (mean log ratio), n_grams, and the columns of carry."""
    weights = constant_array(ratio_model(docs, labels, id_col, text_col).first()["weights"])
    stats = base_stats(docs, id_col, text_col, carry)
    names = [c for c in stats.columns if c != "text"]
    hashed = _tokens(stats, *names)
    # the model is a literal of fixed size, which every task has once
    scored = hashed.select(*names, (F.greatest(2 * F.col("n") - 1, F.lit(0))).cast("long").alias("n_grams"), _mean_weight(F.col("hashes"), F.col("n"), weights).alias("score"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns; nothing is joined, so repeated and null ids do no harm."""
    held = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return quality_rules(held, labels, carry=("row",)).where("kept").select("row.*")
