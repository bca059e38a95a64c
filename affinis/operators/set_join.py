"""Exact set-similarity join: pairs of ids whose key sets have a Tanimoto similarity of at least a threshold.

Keys of a set stand by rarity. Two sets of the wanted similarity share one of their first few keys, so only these
prefixes are joined, and rare keys make few pairs. Sizes that differ too much, and positions that leave too few keys in
common, drop a pair before its sets are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.operators.joins import block_rows, grid_join
from affinis.session import cut_lineage

_MARGIN = 1e-9  # every filter leaves room for rounding; the last comparison decides


def _sized(rows: DataFrame) -> DataFrame:
    """``(id, key, df, n)``: every key with its number of ids, every id with its number of keys."""
    keys = rows.groupBy("key").agg(F.count("*").alias("df"))
    sizes = rows.groupBy("id").agg(F.count("*").alias("n"))
    return cut_lineage(rows.join(keys, "key").join(sizes, "id"))


def _prefixes(sized: DataFrame, threshold: float) -> DataFrame:
    """``(id, key, n, after)``: the first keys of every set and how many follow each of them.

    A set larger than a block gives all its keys, and all of it may follow: it is not sorted in one task.
    """
    limit = block_rows(sized)
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "key"))
    length = F.col("n") - F.ceil(F.col("n") * threshold - _MARGIN) + 1
    small = sized.filter(F.col("n") <= limit).withColumn("place", place).filter(F.col("place") <= length)
    large = sized.filter(F.col("n") > limit)
    return small.select("id", "key", "n", (F.col("n") - F.col("place")).alias("after")).unionByName(
        large.select("id", "key", "n", F.col("n").alias("after"))
    )


def _candidates(sized: DataFrame, threshold: float) -> DataFrame:
    first = cut_lineage(_prefixes(sized, threshold))
    left = first.select("key", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("after").alias("after_a"))
    right = first.select("key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("after").alias("after_b"))
    pairs = grid_join(left, right, ["key"], "a", "b", self_rows=first.select("key")).filter("a < b")
    common = F.col("n_a") + F.col("n_b")
    return pairs.filter(
        (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold - _MARGIN)
        & (1 + F.least("after_a", "after_b") >= common * (threshold / (1 + threshold)) - _MARGIN)
    ).select("a", "b", "n_a", "n_b").distinct()


def set_candidates(rows: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, n_a, n_b)``: pairs ``a < b`` that the filters leave for comparison, from ``rows(id, key)``."""
    return _candidates(_sized(rows.select("id", "key").distinct()), threshold)


def set_neighbours(rows: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, n, score)``: all pairs ``a < b`` of ``rows(id, key)`` with a similarity of at least ``threshold`` (above 0).

    ``n`` keys are shared. A pair is compared by joining the keys of its smaller set to the other one.
    """
    sized = _sized(rows.select("id", "key").distinct())
    pairs = cut_lineage(_candidates(sized, threshold))
    small = F.when(F.col("n_a") <= F.col("n_b"), F.struct(F.col("a").alias("one"), F.col("b").alias("two"))).otherwise(
        F.struct(F.col("b").alias("one"), F.col("a").alias("two"))
    )
    keys = sized.select(F.col("id").alias("one"), "key")
    spread = grid_join(pairs.select("a", "b", "n_a", "n_b", small.alias("s")).select("a", "b", "n_a", "n_b", "s.*"),
                       keys, ["one"], "two", "key")
    met = spread.join(sized.select(F.col("id").alias("two"), "key"), ["two", "key"])
    counted = met.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("n"))
    score = F.col("n").cast("double") / (F.col("n_a") + F.col("n_b") - F.col("n"))
    return counted.select("a", "b", "n", score.alias("score")).filter(F.col("score") >= threshold)
