"""Token counts, collocations and document vectors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.html import page_parts
from affinis.functions.measures import log_likelihood_ratio
from affinis.functions.text import (
    STOP_WORDS,
    adjacent_pairs,
    analyze,
    lines,
    message_text,
    sentence_terms,
    words,
)
from affinis.operators.tfidf import term_counts, tfidf
from affinis.session import by_id, cut_lineage


def analyzed_tokens(docs: DataFrame, id: str = "doc_id", stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``(id, token, n)``: analyzed words of each document."""
    own = by_id(docs.select(id, "text"), id)
    tokens = own.select(id, F.explode(analyze(F.col("text"), stop_words)).alias("token"))
    return term_counts(tokens, id, "token")


def sentence_term_counts(docs: DataFrame, ids: list[str], stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``(ids, term, n)``: letter-only terms of each sentence."""
    terms = docs.select(*ids, F.explode(sentence_terms(F.col("text"), stop_words)).alias("term"))
    return terms.groupBy(*ids, "term").agg(F.count("*").alias("n"))


def without_listed(rows: DataFrame, term: str, stop_words: DataFrame, word: str) -> DataFrame:
    """Rows whose term is not in a table of stop words, for lists too long for an expression.

    Spark sends the list to all tasks where its size allows it, and joins by the term otherwise.
    """
    listed = stop_words.select(F.col(word).alias(term)).distinct()
    return rows.join(listed, term, "left_anti")


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``(word)``: one stop word per line; blank lines and lines that start with ``#`` don't count."""
    word = F.lower(F.trim("value"))
    return spark.read.text(path).select(word.alias("word")).filter((F.col("word") != "") & ~F.col("word").startswith("#"))


def message_words(messages: DataFrame, id: str = "doc_id") -> DataFrame:
    """``(id, word, n)``: words of the header values and of the body."""
    # Each step stands on its own: what is read several times inside a row is computed once.
    split = by_id(messages.select(id, "text"), id).select(id, lines(F.col("text")).alias("_lines"))
    counted = split.select(id, message_text(F.col("_lines")).alias("_text"))
    return term_counts(counted.select(id, F.explode(words(F.col("_text"))).alias("word")), id, "word")


def message_features(messages: DataFrame, id: str = "doc_id") -> DataFrame:
    """``(id, feature, value)``: intercept, line counts, and ``log(1 + count)`` per word."""
    count = F.col("_count")
    shape = messages.select(id, F.size(lines(F.col("text"))).alias("_count")).select(
        id,
        F.inline(F.array(
            F.struct(F.lit("intercept").alias("feature"), F.lit(1.0).alias("value")),
            F.struct(F.lit("line").alias("feature"), F.floor(count / 30).cast("double").alias("value")),
            F.struct(F.lit("log(line)").alias("feature"), F.ln((count + 1).cast("double")).alias("value")),
        )),
    )
    counted = message_words(messages, id).select(
        id, F.concat(F.lit("body="), "word").alias("feature"), F.log1p(F.col("n")).alias("value")
    )
    return shape.unionByName(counted)


def bigrams(docs: DataFrame, min_count: int = 2, min_llr: float = 50.0) -> DataFrame:
    """``(first, second, n, llr)``: neighbouring words that come together more than by chance."""
    # The words are read several times inside a row: a step of its own, the text is analyzed once.
    pairs = docs.select(analyze(F.col("text")).alias("_words")).select(F.inline(adjacent_pairs(F.col("_words"))))
    # Read four times below: counted once, the texts are analyzed once.
    counts = cut_lineage(pairs.groupBy("first", "second").agg(F.count("*").alias("n")))
    heads = counts.groupBy("first").agg(F.sum("n").alias("n_first"))
    tails = counts.groupBy("second").agg(F.sum("n").alias("n_second"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    n, a, b = F.col("n"), F.col("n_first"), F.col("n_second")
    scored = (
        counts.filter(n >= min_count)
        .join(heads, "first")
        .join(tails, "second")
        .withColumn("llr", log_likelihood_ratio(n, a - n, b - n, total - a - b + n))
    )
    return scored.filter(F.col("llr") >= min_llr).select("first", "second", "n", "llr")


def term_table(docs: DataFrame, kept_bigrams: DataFrame | None = None, id: str = "doc_id") -> DataFrame:
    """``(id, token, n)`` of words, and of the kept bigrams as ``first second``."""
    counts = analyzed_tokens(docs, id)
    if kept_bigrams is None:
        return counts
    words_of = by_id(docs.select(id, "text"), id).select(id, analyze(F.col("text")).alias("_words"))
    pairs = words_of.select(id, F.inline(adjacent_pairs(F.col("_words"))))
    kept = pairs.groupBy(id, "first", "second").agg(F.count("*").alias("n")).join(
        kept_bigrams.select("first", "second"), ["first", "second"], "left_semi"
    )
    return counts.unionByName(kept.select(id, F.concat_ws(" ", "first", "second").alias("token"), "n"))


def doc_tfidf(
    counts: DataFrame, docs: DataFrame, id: str = "doc_id", min_df: int = 5, max_df_pct: float = 95.0
) -> DataFrame:
    """Unit TF-IDF rows ``(id, token, weight)`` with ``log(1 + tf)``; N is the number of documents.

    ``counts`` is read twice and should be a table.
    """
    n_docs = docs.agg(F.count("*").alias("n")).scalar()
    return tfidf(counts, id, "token", n_docs, min_df, max_df_pct, log_tf=True)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, author, body and error of each page; the page itself is dropped."""
    parsed = pages.withColumn("_parts", page_parts(F.col(html)))
    others = [c for c in pages.columns if c != html]
    return parsed.select(*others, "_parts.*")


def sentence_words(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """``(id, sentence, position, word)`` by Spark's locale-aware sentence splitter, dealt out by id."""
    split = by_id(docs, id).select(id, F.posexplode(F.sentences(F.col("text"))).alias("sentence", "_words"))
    return split.select(id, "sentence", F.posexplode("_words").alias("position", "word"))
