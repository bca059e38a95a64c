"""Counts and ratios of whole texts, in SQL expressions, one pass and no shuffle.

Words are runs of anything but white space (``[^\\x20\\x09-\\x0D]+``). A null text has none, and all its counts
and ratios are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The signs that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "distinct_share", "long_word_share", "stop_end_share",
)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more in the text.

    Windows are 64-bit hashes, sorted with their starts; the starts of equal neighbours, sorted again, cover
    ``WINDOW`` words each, or up to the next start.
    """
    n = F.size(words)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = _let(hashes, lambda h: F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))
    ))

    def covered(found: Column) -> Column:
        pairs = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        starts = _let(pairs, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda p, k: (p["x"] == F.get(s, k - 1)["x"]) | (p["x"] == F.get(s, k + 1)["x"])),
            lambda p: p["i"],
        )))
        return _let(starts, lambda s: F.aggregate(
            s, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("end")),
            lambda a, i: F.struct(
                (a["n"] + (i + WINDOW - F.greatest(i, a["end"]))).alias("n"), (i + WINDOW).alias("end")
            ),
            lambda a: a["n"],
        ))

    repeated = _let(windows, lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), covered(w)
    ).otherwise(F.lit(0).cast("long")))
    return F.when(n > WINDOW, repeated).otherwise(F.lit(0).cast("long"))


def with_stats(docs: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    """``docs`` with a struct ``out`` of all ``COUNTS`` (long) and ``RATIOS`` (double). It replaces a column of its name."""
    names = [c for c in docs.columns if c != out]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), body.alias("body"),
        F.array_remove(F.split(body, "[ \\t-\\r]+"), "").alias("words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("lines"),
    )
    without = lambda signs: F.length("body") - F.length(F.regexp_replace("body", signs, ""))
    long = lambda c: c.cast("long")
    counted = parts.select(
        "row", "words", "lines",
        long(F.size("words")).alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        long(without("[#*$%&|<>]+")).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        long(without("[A-Z\\u00C0-\\u00DE]+")).alias("n_upper"), long(without("[0-9]+")).alias("n_digits"),
        long(without("[!?;:=_/{}()\\[\\]\\\\@~^+-]+")).alias("n_marks"),
        long(F.size(F.array_distinct("words"))).alias("n_distinct"),
        long(F.size(F.filter("words", lambda w: F.length(w) > 12))).alias("n_long"),
        long(F.size(F.filter("words", lambda w: w.endswith(".") | w.endswith(",")))).alias("n_ends"),
    )
    share = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b).cast("double"), F.lit(1.0))
    stats = F.struct(
        *COUNTS,
        share("word_chars", "n_words").alias("mean_word_chars"), share("n_symbols", "n_words").alias("symbols_per_word"),
        (F.col("n_dup_lines").cast("double") / F.greatest(F.size("lines").cast("double"), F.lit(1.0))).alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("n_upper", "word_chars").alias("upper_share"),
        share("n_digits", "word_chars").alias("digit_share"), share("n_marks", "word_chars").alias("mark_share"),
        share("n_distinct", "n_words").alias("distinct_share"), share("n_long", "n_words").alias("long_word_share"),
        share("n_ends", "n_words").alias("stop_end_share"),
    )
    return counted.select(*[F.col("row").getField(c).alias(c) for c in names], stats.alias(out))
