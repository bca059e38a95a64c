"""Recommenders over ``ratings(user_id, item_id, rating)``, one row per (user, item)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.operators.dictionary import dictionary
from affinis.operators.joins import grid_join
from affinis.operators.neighbour_sums import Method, neighbour_sums
from affinis.operators.neighbours import nearest_holders, neighbours
from affinis.operators.pairs import (
    centred,
    directed,
    pair_stats,
    similarity_table,
    user_means,
)
from affinis.operators.search import BLOCK_ROWS, search_top
from affinis.operators.topk import above, top_k
from affinis.session import cut_lineage

# Weights that sum to less than this have no defined mean.
MIN_WEIGHT = 1e-9
PAIR = ["user_id", "item_id"]


def unseen(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    """Candidates without the (user, item) pairs that are already rated."""
    return candidates.join(ratings.select(*PAIR), PAIR, "left_anti")


def associated_items(ratings: DataFrame, n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top ``n`` items per item by the share of its users who have the other item too.

    Equals ``similar_items`` with basic association, but builds no table of all pairs: items are searched in
    blocks of about ``block_rows`` ratings, see ``search_top``.
    """
    prefs = cut_lineage(ratings.select("user_id", "item_id"))
    one = F.lit(1.0)
    found = search_top(
        prefs.select(F.col("item_id").alias("query"), F.col("user_id").alias("key"), one.alias("q")),
        prefs.select(F.col("item_id").alias("other"), F.col("user_id").alias("key"), one.alias("impact")),
        n, block_rows=block_rows,
    )
    sizes = prefs.groupBy(F.col("item_id").alias("query")).agg(F.count("*").alias("_n"))
    return found.join(sizes, "query").select(
        F.col("query").alias("item_id"), F.col("other").alias("other_id"),
        (F.col("score") / F.col("_n")).alias("score"), "rank",
    )


def similar_items(ratings: DataFrame, n: int, measure="assoc_basic") -> DataFrame:
    """Top ``n`` similar items per item: ``(item_id, other_id, score, rank)``; no table of all pairs arises."""
    return top_items(neighbours(ratings, "item", measure, n=n), n)


def top_items(sims: DataFrame, n: int) -> DataFrame:
    renamed = sims.select(
        F.col("a").alias("item_id"), F.col("b").alias("other_id"), "score"
    )
    return top_k(renamed, ["item_id"], "score", ["other_id"], n)


def similar_centred_items(ratings: DataFrame, n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top ``n`` items per item by the cosine of mean-centred ratings: ``(item_id, other_id, score, rank)``.

    Equals ``top_items`` over ``centred_cosine``: with every item's rows at length 1 the cosine is a sum of
    products, so ``search_top`` finds it. Items whose centred ratings are all 0 have no similarity.
    """
    rows = centred(ratings, positive_only=True)
    squares = rows.groupBy("item_id").agg(F.sum(F.col("centred") * F.col("centred")).alias("_ss")).filter("_ss > 0")
    units = cut_lineage(rows.join(squares, "item_id").select(
        "item_id", F.col("user_id").alias("key"), (F.col("centred") / F.sqrt("_ss")).alias("w")
    ))
    found = search_top(
        units.select(F.col("item_id").alias("query"), "key", F.col("w").alias("q")),
        units.select(F.col("item_id").alias("other"), "key", F.col("w").alias("impact")), n, block_rows=block_rows,
    )
    return found.select(F.col("query").alias("item_id"), F.col("other").alias("other_id"), "score", "rank")


def fill_lists(
    lists: DataFrame, taken: DataFrame, ids: DataFrame, n: int, owner: str = "item_id", other: str = "other_id"
) -> DataFrame:
    """Lists of fewer than ``n`` entries filled up with score-0 ids: ``(owner, other, score, rank)``.

    ``lists(owner, other, score)``; every owner of ``lists`` or ``taken(owner, other)`` has one. A list gets the
    lowest of ``ids`` (one column) that are neither in it nor in ``taken``. Ids are numbered in order, so the taken
    ones of an owner leave gaps of known length between each other, and the lowest free ids are read off the
    first gaps, as many as the list lacks: nothing of the size owners x ids arises.
    """
    rows = cut_lineage(lists.select(owner, other, "score"))
    have = rows.groupBy(owner).agg(F.count("*").alias("_have"))
    owners = taken.select(owner).unionByName(rows.select(owner)).distinct()
    short = cut_lineage(
        owners.join(have, owner, "left").select(owner, (n - F.coalesce("_have", F.lit(0))).alias("_lack")).filter("_lack > 0")
    )
    numbered = cut_lineage(dictionary(ids.toDF("_id").distinct(), "_id", "_place"))
    size = numbered.agg(F.count("*").alias("n")).first()["n"]
    both = taken.select(owner, other).unionByName(rows.select(owner, other)).distinct().join(short, owner)
    placed = both.join(numbered, F.col(other) == F.col("_id")).select(owner, "_place", "_lack")
    order = Window.partitionBy(owner).orderBy("_place")
    # taken places with as many free ones before them as the list lacks end the search
    ends = placed.withColumn("_free", F.col("_place") - F.row_number().over(order) + 1)
    before = ends.withColumn("_from", F.coalesce(F.lag("_place").over(order) + 1, F.lit(0))).withColumn(
        "_free_before", F.coalesce(F.lag("_free").over(order), F.lit(0))
    ).filter((F.col("_free") > F.col("_free_before")) & (F.col("_free_before") < F.col("_lack")))
    gaps = before.select(owner, "_from", F.col("_place").alias("_to"), (F.col("_lack") - F.col("_free_before")).alias("_want"))
    # behind the last taken place, or from 0 on where nothing is taken
    last = placed.groupBy(owner).agg(F.max("_place").alias("_last"), F.count("*").alias("_n"))
    tails = short.join(last, owner, "left").select(
        owner, (F.coalesce("_last", F.lit(-1)) + 1).alias("_from"), F.lit(size).alias("_to"),
        (F.col("_lack") - (F.coalesce("_last", F.lit(-1)) + 1 - F.coalesce("_n", F.lit(0)))).alias("_want"),
    )
    open_gaps = gaps.unionByName(tails).filter((F.col("_from") < F.col("_to")) & (F.col("_want") > 0))
    free = open_gaps.select(owner, F.explode(
        F.sequence("_from", F.least(F.col("_to"), F.col("_from") + F.col("_want")) - 1)
    ).alias("_place"))
    extra = free.join(numbered, "_place").select(owner, F.col("_id").alias(other), F.lit(0.0).alias("score"))
    return top_k(rows.unionByName(extra), [owner], "score", [other], n)


def fill_with_unrelated(
    top: DataFrame, sims: DataFrame, items: DataFrame, item_ids: list[int] | None, n: int
) -> DataFrame:
    """Short top lists filled with score-0 items, lowest ids first: those of the named items, or all for None.

    ``sims(a, b, score)`` names the items that have a score with ``a``; lists cut from it at ``n`` may stand for it,
    because a list that is short has all of them.
    """
    named = items.select("item_id") if item_ids is None else items.select("item_id").filter(F.col("item_id").isin(item_ids))
    named = cut_lineage(named.distinct())
    own = top.select("item_id", "other_id", "score")
    taken = named.select("item_id", F.col("item_id").alias("other_id")).unionByName(
        sims.select(F.col("a").alias("item_id"), F.col("b").alias("other_id")).join(named, "item_id", "left_semi")
    )
    filled = fill_lists(own.join(named, "item_id", "left_semi"), taken, items.select("item_id"), n)
    rest = top.join(named, "item_id", "left_anti").select("item_id", "other_id", "score", "rank")
    return filled.select("item_id", "other_id", "score", "rank").unionByName(rest)


def fill_recommendations(recs: DataFrame, ratings: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Short lists of recommendations filled with unrated items at score 0, lowest ids first; every rater has a list."""
    return fill_lists(recs.select(*PAIR, "score"), ratings.select(*PAIR), items.select("item_id"), n, *PAIR)


def weighted_mean(contributions: DataFrame, by: list[str], min_neighbours: int) -> DataFrame:
    """``sum(s * r) / sum(s)`` per key over rows ``(s, r)``; undefined means drop out."""
    sums = contributions.groupBy(*by).agg(
        F.sum(F.col("s") * F.col("r")).alias("_num"),
        F.sum("s").alias("_den"),
        F.count("*").alias("neighbours"),
    )
    kept = sums.filter(
        (F.col("neighbours") >= min_neighbours) & (F.abs(F.col("_den")) > MIN_WEIGHT)
    )
    return kept.select(*by, (F.col("_num") / F.col("_den")).alias("score"), "neighbours")


def _centred_prediction(neighbours: DataFrame, means: DataFrame) -> DataFrame:
    """User mean plus the weighted mean deviation, weights by absolute similarity."""
    sums = neighbours.groupBy(*PAIR).agg(
        F.sum(F.col("sim") * F.col("deviation")).alias("_num"),
        F.sum(F.abs(F.col("sim"))).alias("_den"),
    )
    return (
        sums.filter(F.col("_den") > MIN_WEIGHT)
        .join(means, "user_id")
        .select(*PAIR, (F.col("mean_rating") + F.col("_num") / F.col("_den")).alias("prediction"))
    )


def user_user_predict(ratings: DataFrame, targets: DataFrame, k: int = 30, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Ratings predicted from the ``k`` most similar users who rated the item.

    Every rater of the item is a candidate; one who shares nothing with the user has
    similarity 0 and may take a place.
    """
    rows = centred(ratings)
    near = nearest_holders(
        rows.select(F.col("user_id").alias("id"), F.col("item_id").alias("key"), F.col("centred").alias("value")),
        targets.select(F.col("user_id").alias("id"), F.col("item_id").alias("key")), k, block_rows,
    )
    neighbours_of = near.select(F.col("id").alias("user_id"), F.col("key").alias("item_id"), "sim", F.col("value").alias("deviation"))
    return _centred_prediction(neighbours_of, user_means(ratings))


def item_item_predict(ratings: DataFrame, targets: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Ratings predicted from the user's ``k`` rated items nearest to the target item.

    Non-positive ratings count as missing. Items whose centred ratings are all 0 have no
    similarity and drop out; a rated item that shares no rater with the target has 0.
    """
    rows = centred(ratings, positive_only=True)
    defined = rows.groupBy("item_id").agg(
        F.sum(F.col("centred") * F.col("centred")).alias("_ss")
    ).filter(F.col("_ss") > 0).select("item_id")
    near = nearest_holders(
        rows.join(defined, "item_id", "left_semi").select(
            F.col("item_id").alias("id"), F.col("user_id").alias("key"), F.col("centred").alias("value")
        ),
        targets.select(F.col("item_id").alias("id"), F.col("user_id").alias("key")), k, block_rows,
    )
    neighbours_of = near.select(F.col("key").alias("user_id"), F.col("id").alias("item_id"), "sim", F.col("value").alias("deviation"))
    return _centred_prediction(neighbours_of, user_means(ratings.filter(F.col("rating") > 0)))


def _rated_neighbours(ratings: DataFrame, sims: DataFrame) -> DataFrame:
    """``(user_id, item_id, other, s, r)``: each rating spread to the items similar to it."""
    rated = ratings.select("user_id", F.col("item_id").alias("other"), F.col("rating").alias("r"))
    # The table is read twice, for its key counts and for the join; it is computed once.
    table = cut_lineage(
        sims.select(F.col("b").alias("other"), F.col("a").alias("item_id"), F.col("score").alias("s"))
    )
    return grid_join(rated, table, ["other"], "user_id", "item_id")


def item_based_scores(ratings: DataFrame, sims: DataFrame, min_neighbours: int = 2) -> DataFrame:
    """Estimates for every unrated item that is similar to at least ``min_neighbours`` rated ones.

    ``sims(a, b, score)`` in both directions.
    """
    scores = weighted_mean(_rated_neighbours(ratings, sims), PAIR, min_neighbours)
    return unseen(scores, ratings)


def target_neighbours(ratings: DataFrame, sims: DataFrame, targets: DataFrame) -> DataFrame:
    """``(user_id, item_id, other, s, r)`` for given pairs: the user's ratings of items similar to the target.

    ``sims(a, b, score)`` with ``a`` the target items.
    """
    wanted = targets.select(*PAIR).distinct()
    rated = ratings.select("user_id", F.col("item_id").alias("other"), F.col("rating").alias("r"))
    candidates = grid_join(wanted, rated, ["user_id"], "item_id", "other")
    table = sims.select(F.col("a").alias("item_id"), F.col("b").alias("other"), F.col("score").alias("s"))
    return candidates.join(table, ["item_id", "other"])


def item_based_estimate(
    ratings: DataFrame, sims: DataFrame, targets: DataFrame, min_neighbours: int = 2
) -> DataFrame:
    """Estimates for given pairs only. Build ``sims`` with ``left_ids`` of the target items."""
    return weighted_mean(target_neighbours(ratings, sims, targets), PAIR, min_neighbours)


def recommend(
    scores: DataFrame,
    n: int,
    rescore: Callable[[Column], Column] | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Top ``n`` items per user; ``rescore`` changes scores and ``keep`` filters, before the cut."""
    if keep is not None:
        scores = scores.filter(keep)
    if rescore is not None:
        scores = scores.withColumn("score", rescore(F.col("score")))
    return top_k(scores, ["user_id"], "score", ["item_id"], n).select(*PAIR, "score", "rank")


def item_based_recommend(ratings: DataFrame, n: int = 100, measure="pearson", **options) -> DataFrame:
    sims = similarity_table(ratings, "item", measure, both_directions=True)
    return recommend(item_based_scores(ratings, sims), n, **options)


def neighbourhood_size(ratings: DataFrame) -> int:
    """A tenth of the users, or all of them where there are no more than 10."""
    users = ratings.agg(F.countDistinct("user_id").alias("n")).first()["n"]
    return users // 10 if users > 10 else users


def user_neighbours(
    sims: DataFrame, nearest: int | None = None, threshold: float | None = None
) -> DataFrame:
    """``(user_id, other, s)`` from ``sims(a, b, score)``: the nearest n, or all above a threshold."""
    if nearest is not None:
        kept = top_k(sims, ["a"], "score", ["b"], nearest)
    else:
        kept = above(sims, "score", threshold)
    return kept.select(F.col("a").alias("user_id"), F.col("b").alias("other"), F.col("score").alias("s"))


def neighbour_ratings(ratings: DataFrame, neighbours: DataFrame) -> DataFrame:
    """``(user_id, item_id, other, s, r)``: the ratings of each user's neighbours."""
    theirs = ratings.select(F.col("user_id").alias("other"), "item_id", F.col("rating").alias("r"))
    return grid_join(cut_lineage(neighbours), theirs, ["other"], "user_id", "item_id")


def user_based_scores(ratings: DataFrame, neighbours: DataFrame, min_neighbours: int = 2) -> DataFrame:
    """Similarity-weighted mean of the neighbours' ratings, for unrated items."""
    scores = weighted_mean(neighbour_ratings(ratings, neighbours), PAIR, min_neighbours)
    return unseen(scores, ratings)


def user_based_boolean_scores(prefs: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Sum of the similarities of the neighbours that have the item, for unseen items."""
    scores = neighbour_ratings(prefs, neighbours).groupBy(*PAIR).agg(
        F.sum("s").alias("score"), F.count("*").alias("neighbours")
    )
    return unseen(scores, prefs)


def defined_means(sums: DataFrame, min_neighbours: int) -> DataFrame:
    """``score``, the weighted mean of sums ``(num, den, neighbours)``; undefined means drop out."""
    kept = sums.filter((F.col("neighbours") >= min_neighbours) & (F.abs("den") > MIN_WEIGHT))
    return kept.withColumn("score", F.col("num") / F.col("den")).drop("num", "den")


def near_user_scores(ratings: DataFrame, method: Method, min_neighbours: int = 2) -> DataFrame:
    """Equals ``user_based_scores`` over the users that ``method`` names, without a table of neighbours."""
    sums = neighbour_sums(ratings, [method]).select(
        F.col("id").alias("user_id"), F.col("key").alias("item_id"), "num", "den", "neighbours"
    )
    return unseen(defined_means(sums, min_neighbours), ratings)


def near_user_boolean_scores(prefs: DataFrame, method: Method) -> DataFrame:
    """Equals ``user_based_boolean_scores`` over the users that ``method`` names, without a table of neighbours."""
    sums = neighbour_sums(prefs, [method]).select(
        F.col("id").alias("user_id"), F.col("key").alias("item_id"), F.col("den").alias("score"), "neighbours"
    )
    return unseen(sums, prefs)


def slope_one(ratings: DataFrame, weighted: bool = True, targets: DataFrame | None = None) -> DataFrame:
    """Slope one: rated value plus the mean difference of the two items, averaged over rated items.

    Weighted by the number of users behind each difference, or unweighted. Predicts every
    unrated pair with a common rater, or the ``targets`` only.
    """
    if targets is None:
        stats = directed(pair_stats(ratings, "user_id", "item_id", "rating", marginals=False))
    else:
        stats = pair_stats(ratings, "user_id", "item_id", "rating", marginals=False, left_ids=targets.select("item_id"))
    diffs = stats.select(
        F.col("a").alias("item_id"), F.col("b").alias("other"),
        ((F.col("sum_a") - F.col("sum_b")) / F.col("n")).alias("dev"),
        (F.col("n") if weighted else F.lit(1)).cast("double").alias("w"),
    )
    rated = ratings.select("user_id", F.col("item_id").alias("other"), "rating")
    if targets is None:
        rows = grid_join(rated, cut_lineage(diffs), ["other"], "user_id", "item_id")
    else:
        wanted = targets.select(*PAIR).distinct()
        rows = grid_join(wanted, rated, ["user_id"], "item_id", "other").join(diffs, ["item_id", "other"])
    scores = rows.groupBy(*PAIR).agg(
        (F.sum((F.col("dev") + F.col("rating")) * F.col("w")) / F.sum("w")).alias("score")
    )
    return scores if targets is not None else unseen(scores, ratings)


def item_knn_predict(ratings: DataFrame, k: int = 10, measure="llr", targets: DataFrame | None = None) -> DataFrame:
    """Mean of the user's ``k`` rated items nearest to each unrated item, weighted by similarity.

    With ``targets`` for these pairs only; other items are cut before any pair of items arises.
    """
    if targets is None:
        sims = similarity_table(ratings, "item", measure, both_directions=True)
        candidates = unseen(_rated_neighbours(ratings, sims), ratings)
    else:
        sims = similarity_table(ratings, "item", measure, left_ids=targets.select("item_id"))
        candidates = target_neighbours(ratings, sims, targets)
    return weighted_mean(top_k(candidates, PAIR, "s", ["other"], k), PAIR, 1)


def als_model(ratings: DataFrame, rank: int = 10, reg: float = 0.5, steps: int = 10, seed: int = 42):
    """Matrix factorisation by alternating least squares."""
    from pyspark.ml.recommendation import ALS

    als = ALS(
        rank=rank, regParam=reg, maxIter=steps, seed=seed, userCol="user_id", itemCol="item_id",
        ratingCol="rating", coldStartStrategy="drop",
    )
    return als.fit(ratings.select(*PAIR, F.col("rating").cast("float").alias("rating")))


def als_predict(ratings: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """Predictions for the targets whose user and item are known.

    The factorisation takes int ids, so users and items get dense ids first.
    """
    rows = cut_lineage(ratings.select(*PAIR, "rating"))
    users = dictionary(rows, "user_id", "_user")
    items = dictionary(rows, "item_id", "_item")

    def encoded(df: DataFrame, *others: str) -> DataFrame:
        named = df.join(users, "user_id").join(items, "item_id")
        ids = [F.col("_user").cast("int").alias("u"), F.col("_item").cast("int").alias("i")]
        return named.select(*PAIR, *ids, *others)

    train = encoded(rows, "rating").select(F.col("u").alias("user_id"), F.col("i").alias("item_id"), "rating")
    wanted = encoded(targets.select(*PAIR)).select(
        F.struct(*PAIR).alias("ids"), F.col("u").alias("user_id"), F.col("i").alias("item_id")
    )
    predicted = als_model(train, **options).transform(wanted)
    return predicted.select("ids.*", F.col("prediction").cast("double").alias("prediction"))
