"""Pair statistics and similarity tables over one long table ``(key, id, value)``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.measures import Measure, as_measure
from affinis.operators.joins import grid_join


def distinct_total(rows: DataFrame, column: str) -> Column:
    """Number of distinct values as a scalar subquery: one row, evaluated inside the job."""
    return rows.agg(F.countDistinct(column).alias("total")).scalar()


def pair_stats(
    rows: DataFrame,
    key: str,
    id: str,
    value: str,
    marginals: bool = True,
    left_ids: DataFrame | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Statistics of every pair of ids that share a key; one row per ``a < b``.

    ``rows`` holds one row per (key, id). Pairs are summed inside the join stage (partial
    aggregation), so the shuffle carries pair sums and not joined rows. With ``left_ids`` (one
    column) the left side is cut to those ids before the join, and pairs are directed.
    """
    x = rows.select(
        F.col(key).alias("key"), F.col(id).alias("id"), F.col(value).cast("double").alias("v")
    )
    carried = ["n", "ss"] if marginals else []
    if marginals:
        # Joined to the rows, which are far fewer than the pairs.
        sizes = x.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.col("v") * F.col("v")).alias("ss"))
        x = x.join(sizes, "id")
    names = {"id": "{s}", "v": "v_{s}", "n": "n_{s}", "ss": "ss_{s}"}

    def side(df: DataFrame, s: str) -> DataFrame:
        columns = [F.col(col).alias(names[col].format(s=s)) for col in ["id", "v", *carried]]
        return df.select("key", *columns)

    left = x
    if left_ids is not None:
        left = x.join(left_ids.toDF("id").distinct(), "id", "left_semi")
    one_table = rows.select(F.col(key).alias("key")) if left_ids is None else None
    joined = grid_join(side(left, "a"), side(x, "b"), ["key"], "a", "b", rows_per_block, one_table)
    joined = joined.filter(F.col("a") < F.col("b") if left_ids is None else F.col("a") != F.col("b"))
    va, vb = F.col("v_a"), F.col("v_b")
    return joined.groupBy("a", "b").agg(
        F.count("*").alias("n"),
        F.sum(va).alias("sum_a"),
        F.sum(vb).alias("sum_b"),
        F.sum(va * va).alias("sum_aa"),
        F.sum(vb * vb).alias("sum_bb"),
        F.sum(va * vb).alias("sum_ab"),
        *[F.max(f"{m}_{s}").alias(f"{m}_{s}") for m in carried for s in ("a", "b")],
    )


def _other_way(stats: DataFrame) -> list[Column]:
    def swap(name: str) -> str:
        head, _, tail = name.rpartition("_")
        flip = {"a": "b", "b": "a", "aa": "bb", "bb": "aa"}
        if name in ("a", "b"):
            return flip[name]
        return f"{head}_{flip[tail]}" if head and tail in flip else name

    return [F.col(swap(col)).alias(col) for col in stats.columns]


def directed(stats: DataFrame) -> DataFrame:
    """Both directions of each ``a < b`` row, by swapping the ``a`` and ``b`` columns."""
    same = F.struct(*[F.col(col) for col in stats.columns])
    return stats.select(F.inline(F.array(same, F.struct(*_other_way(stats)))))


def turned(stats: DataFrame) -> DataFrame:
    """Each row the other way round: ``a`` is ``b`` and ``b`` is ``a``."""
    return stats.select(*_other_way(stats))


def score_pairs(
    stats: DataFrame, measure: str | Measure | Callable[[Column], Column], total: Column | None = None
) -> DataFrame:
    """``(a, b, n, score)`` for one measure; pairs without a defined score drop out."""
    m = as_measure(measure)
    score = m.score(total if total is not None else F.lit(None).cast("bigint"))
    return stats.select("a", "b", "n", score.alias("score")).filter(F.col("score").isNotNull())


def similarity_table(
    ratings: DataFrame,
    by: str,
    measure: str | Measure | Callable[[Column], Column],
    both_directions: bool = False,
    left_ids: DataFrame | None = None,
) -> DataFrame:
    """Similarities of users or of items from ``(user_id, item_id, rating)``.

    A named measure of many ids is taken in cells of blocks, so that no sums of pairs are shuffled.
    """
    from affinis.operators.pair_cells import many_ids, scored_pairs

    m = as_measure(measure)
    key, id = ("user_id", "item_id") if by == "item" else ("item_id", "user_id")
    if isinstance(measure, str) and left_ids is None and many_ids(ratings, id):
        return scored_pairs(ratings, key, id, "rating", measure, both_directions)
    stats = pair_stats(ratings, key, id, "rating", m.needs_marginals, left_ids)
    if (both_directions or m.directed) and left_ids is None:
        stats = directed(stats)
    return score_pairs(stats, m, distinct_total(ratings, key) if m.needs_total else None)


def similarity_grid(
    ratings: DataFrame, by: str, measures: Iterable[str], left_ids: DataFrame | None = None,
    right_ids: DataFrame | None = None,
) -> DataFrame:
    """``(measure, a, b, score)`` for several measures from one pass over the pairs.

    ``left_ids`` or ``right_ids`` (one column) cut ``a`` or ``b`` to those ids before any pair arises.
    """
    key, id = ("user_id", "item_id") if by == "item" else ("item_id", "user_id")
    if left_ids is not None:
        stats = pair_stats(ratings, key, id, "rating", left_ids=left_ids)
    elif right_ids is not None:
        stats = turned(pair_stats(ratings, key, id, "rating", left_ids=right_ids))
    else:
        stats = directed(pair_stats(ratings, key, id, "rating"))
    total = distinct_total(ratings, key)
    cells = [
        F.struct(F.lit(name).alias("measure"), as_measure(name).score(F.col("_total")).alias("score"))
        for name in measures
    ]
    scored = stats.withColumn("_total", total).select("a", "b", F.inline(F.array(*cells)))
    return scored.filter(F.col("score").isNotNull()).select("measure", "a", "b", "score")


def centred(ratings: DataFrame, positive_only: bool = False) -> DataFrame:
    """Ratings minus the user's mean: ``(user_id, item_id, rating, mean, centred)``."""
    kept = ratings.filter(F.col("rating") > 0) if positive_only else ratings
    means = user_means(kept)
    return kept.join(means, "user_id").select(
        "user_id", "item_id", "rating", F.col("mean_rating").alias("mean"),
        (F.col("rating") - F.col("mean_rating")).alias("centred"),
    )


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("mean_rating"))


def centred_cosine(
    centred_ratings: DataFrame, by: str, left_ids: DataFrame | None = None, both_directions: bool = True
) -> DataFrame:
    """Cosine of mean-centred ratings: dot over shared keys, norms over all keys.

    ``(a, b, n, score)``, both directions or ``a < b``. For users an undefined cosine is 0, for items the
    pair drops out.
    """
    from affinis.operators.pair_cells import many_ids, scored_pairs

    key, id = ("user_id", "item_id") if by == "item" else ("item_id", "user_id")
    if left_ids is None and many_ids(centred_ratings, id):
        none = 0.0 if by == "user" else None
        return scored_pairs(centred_ratings, key, id, "centred", "full_cosine", both_directions, undefined=none)
    stats = pair_stats(centred_ratings, key, id, "centred", True, left_ids)
    if left_ids is None and both_directions:
        stats = directed(stats)
    score = as_measure("full_cosine").score(F.lit(None))
    if by == "user":
        score = F.coalesce(score, F.lit(0.0))
    return stats.select("a", "b", "n", score.alias("score")).filter(F.col("score").isNotNull())


def vector_norms(rows: DataFrame, id: str, value: str) -> DataFrame:
    """L2 norm per id of a long table."""
    return rows.groupBy(id).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))
