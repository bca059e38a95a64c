"""Queries and oracles over ratings: sources, samples, similarities, recommenders."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions.numbers import rounded
from affinis.operators import neighbours as N
from affinis.operators import pairs as P
from affinis.operators import recommend as R
from affinis.operators import sampling as S
from affinis.operators.neighbour_sums import Method
from affinis.operators.topk import top_k
from affinis.plans import views as V
from affinis.plans.sql import SCORES, define, r6, top, with_
from affinis.session import cut_lineage
from affinis.sources import ratings as src

PAIR = ["user_id", "item_id"]


def _scored(sims):
    return sims.select("a", "b", "n", rounded("score").alias("score"))


def _sim(by, measure):
    return lambda spark, sf: _scored(P.similarity_table(V.ratings(spark, sf), by, measure))


def _sim_sql(by, measure, both=False):
    view = f"{by}_stats2" if both else f"{by}_stats"
    return with_(
        [view],
        f"SELECT a, b, n, {r6('score', 'score')} FROM (SELECT *, {SCORES[measure]} AS score FROM {view}) "
        "WHERE score IS NOT NULL",
    )


def ratings_latest(spark, sf):
    return V.latest_ratings(spark, sf)


def boolean_prefs(spark, sf):
    return src.to_boolean(V.preference_events(spark, sf))


def ratings_overlay(spark, sf):
    return src.apply_overlay(V.clicks(spark, sf), V.preference_changes(spark, sf))


def sample_exact(spark, sf):
    return S.sample_rows(V.ratings(spark, sf), 10, PAIR, seed="7")


def split_holdout(spark, sf):
    train, test = S.split_ratings(V.ratings(spark, sf), 0.7)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def unseen_items(spark, sf):
    """Sparse (customer, part) pairs that are no dense rating: an anti join on both keys."""
    return R.unseen(V.ratings_sparse(spark, sf), V.latest_ratings(spark, sf))


def item_cooccurrence(spark, sf):
    return P.pair_stats(V.ratings(spark, sf), *["user_id", "item_id", "rating"], marginals=False).select("a", "b", "n")


def user_means(spark, sf):
    return P.user_means(V.latest_ratings(spark, sf)).select("user_id", rounded("mean_rating").alias("mean_rating"))


def centered_ratings(spark, sf):
    return P.centred(V.ratings(spark, sf)).select(*PAIR, rounded("centred").alias("centred"))


def vector_norms(spark, sf):
    rows = P.centred(V.ratings(spark, sf))
    return P.vector_norms(rows, "item_id", "centred").select("item_id", rounded("norm").alias("norm"))


def topk_per_key(spark, sf):
    return top_k(V.latest_ratings(spark, sf), ["user_id"], "rating", ["item_id"], 5).select(*PAIR, "rating", "rank")


def threshold_neighbors(spark, sf):
    return _scored(N.neighbours(V.ratings(spark, sf), "user", "pearson", threshold=0.2))


def recommend_with_titles(spark, sf):
    recs = R.item_based_recommend(V.ratings(spark, sf), 5)
    named = src.with_titles(recs, V.titles(spark, sf))
    return named.select(*PAIR, "title", rounded("score").alias("score"), "rank")


def _top_similar(measure, n):
    def query(spark, sf):
        return R.similar_items(V.ratings(spark, sf), n, measure).select(
            "item_id", "other_id", rounded("score").alias("score"), "rank"
        )

    return query


def nonpersonalized_topn(spark, sf):
    return R.associated_items(V.ratings(spark, sf), 5).select(
        "item_id", "other_id", rounded("score").alias("score"), "rank"
    )


def nonpersonalized_filled(spark, sf):
    """Lists of 60 for every item, filled with the lowest ids that it shares no user with."""
    ratings = V.ratings(spark, sf)
    lists = cut_lineage(R.associated_items(ratings, 60))
    pairs = lists.select(F.col("item_id").alias("a"), F.col("other_id").alias("b"), "score")
    return R.fill_with_unrelated(lists, pairs, ratings, None, 60).select(
        "item_id", "other_id", rounded("score").alias("score"), "rank"
    )


def sim_user_centered(spark, sf):
    return _scored(P.centred_cosine(P.centred(V.ratings(spark, sf)), "user", both_directions=False))


def sim_item_centered(spark, sf):
    rows = P.centred(V.ratings(spark, sf), positive_only=True)
    return _scored(P.centred_cosine(rows, "item", both_directions=False))


def item_item_similar(spark, sf):
    return R.similar_centred_items(V.ratings(spark, sf), 10).select(
        "item_id", "other_id", rounded("score").alias("score"), "rank"
    )


def _predictions(df, column="prediction"):
    return df.select(*PAIR, rounded(column).alias("prediction"))


def user_user_predict(spark, sf):
    rows = V.ratings(spark, sf)
    return _predictions(R.user_user_predict(rows, rows, 30))


def item_item_predict(spark, sf):
    rows = V.ratings(spark, sf)
    return _predictions(R.item_item_predict(rows, rows, 20))


def _ranked(df):
    return df.select(*PAIR, rounded("score").alias("score"), "rank")


def item_based_topn(spark, sf):
    return _ranked(R.item_based_recommend(V.ratings(spark, sf), 100))


def item_based_estimate(spark, sf):
    train, test = V.holdout(spark, sf)
    sims = P.similarity_table(train, "item", "pearson", left_ids=test.select("item_id"))
    return _predictions(R.item_based_estimate(train, sims, test), "score")


def rescored_topn(spark, sf):
    """Scores halved for even items, items below 10 filtered out, then the cut."""
    boost = lambda s: F.when(F.col("item_id") % 2 == 0, s / 2).otherwise(s)
    recs = R.item_based_recommend(V.ratings(spark, sf), 10, rescore=boost, keep=F.col("item_id") >= 10)
    return _ranked(recs)


def user_based_topn(spark, sf):
    rows = V.ratings(spark, sf)
    near = Method("pearson", nearest=R.neighbourhood_size(rows))
    return _ranked(R.recommend(R.near_user_scores(rows, near), 10))


def user_based_boolean(spark, sf):
    prefs = cut_lineage(src.to_boolean(V.preference_events(spark, sf)))
    return _ranked(R.recommend(R.near_user_boolean_scores(prefs, Method("tanimoto", threshold=0.3)), 10))


def _slope(weighted):
    return lambda spark, sf: _predictions(R.slope_one(V.ratings(spark, sf), weighted), "score")


def item_knn_predict(spark, sf):
    return _predictions(R.item_knn_predict(V.ratings(spark, sf)), "score")


def als_predict(spark, sf):
    """A finite prediction for every held-out pair of a known user and item."""
    train, test = V.holdout(spark, sf)
    found = R.als_predict(train, test)
    finite = F.abs("prediction") < float("inf")
    return found.select("user_id", "item_id", (finite & ~F.isnan("prediction")).alias("finite"))


QUERIES = {
    "ratings_latest": ratings_latest,
    "boolean_prefs": boolean_prefs,
    "ratings_overlay": ratings_overlay,
    "sample_exact": sample_exact,
    "split_holdout": split_holdout,
    "unseen_items": unseen_items,
    "item_cooccurrence": item_cooccurrence,
    "user_means": user_means,
    "centered_ratings": centered_ratings,
    "vector_norms": vector_norms,
    "topk_per_key": topk_per_key,
    "threshold_neighbors": threshold_neighbors,
    "recommend_with_titles": recommend_with_titles,
    "assoc_basic": _sim("item", "assoc_basic"),
    "assoc_advanced": _sim("item", "assoc_advanced"),
    "nonpersonalized_topn": nonpersonalized_topn,
    "nonpersonalized_filled": nonpersonalized_filled,
    "nonpersonalized_advanced_topn": _top_similar("assoc_advanced", 5),
    "sim_pearson": _sim("item", "pearson"),
    "sim_pearson_weighted": _sim("user", "pearson_w"),
    "sim_euclidean": _sim("item", "euclidean"),
    "sim_cosine_corated": _sim("item", "cosine"),
    "sim_cosine_weighted": _sim("user", "cosine_w"),
    "sim_cityblock": _sim("user", "manhattan"),
    "sim_tanimoto": _sim("item", "tanimoto"),
    "sim_llr": _sim("user", "llr"),
    "sim_user_centered": sim_user_centered,
    "sim_item_centered": sim_item_centered,
    "item_item_similar": item_item_similar,
    "user_user_predict": user_user_predict,
    "item_item_predict": item_item_predict,
    "item_based_topn": item_based_topn,
    "item_based_estimate": item_based_estimate,
    "rescored_topn": rescored_topn,
    "user_based_topn": user_based_topn,
    "user_based_boolean": user_based_boolean,
    "slope_one_weighted": _slope(True),
    "slope_one_unweighted": _slope(False),
    "item_knn_predict": item_knn_predict,
    "als_predict": als_predict,
}

# ---------------------------------------------------------------- oracle

define(
    "item_sims", f"SELECT a, b, score FROM (SELECT *, {SCORES['pearson']} AS score FROM item_stats2) "
    "WHERE score IS NOT NULL", "item_stats2",
)
define(
    "user_sims", f"SELECT a, b, n, score FROM (SELECT *, {SCORES['pearson']} AS score FROM user_stats2) "
    "WHERE score IS NOT NULL", "user_stats2",
)
define(
    "item_scores",
    """
    SELECT g.user_id, g.item_id, num / den AS score FROM (
      SELECT r.user_id, s.a AS item_id, sum(s.score * r.rating) AS num, sum(s.score) AS den, count(*) AS k
      FROM ratings r JOIN item_sims s ON s.b = r.item_id GROUP BY 1, 2) g
    LEFT JOIN ratings x ON x.user_id = g.user_id AND x.item_id = g.item_id
    WHERE x.user_id IS NULL AND k >= 2 AND abs(den) > 1e-9""",
    "ratings", "item_sims",
)
define(
    "user_dots",
    """
    SELECT a.user_id AS a, b.user_id AS b, count(*) AS n, sum(a.cr * b.cr) AS dot
    FROM centred a JOIN centred b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY 1, 2""",
    "centred",
)
define("user_norms", "SELECT user_id AS id, sqrt(sum(cr * cr)) AS norm FROM centred GROUP BY 1", "centred")
define(
    "user_centred",
    """
    SELECT a, b, d.n, coalesce(dot / nullif(x.norm * y.norm, 0), 0e0) AS score
    FROM user_dots d JOIN user_norms x ON x.id = a JOIN user_norms y ON y.id = b""",
    "user_dots", "user_norms",
)
define(
    "item_dots",
    """
    SELECT a.item_id AS a, b.item_id AS b, count(*) AS n, sum(a.cr * b.cr) AS dot
    FROM centred a JOIN centred b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2""",
    "centred",
)
define("item_norms", "SELECT item_id AS id, sqrt(sum(cr * cr)) AS norm FROM centred GROUP BY 1", "centred")
define(
    "item_centred",
    """
    SELECT a, b, d.n, dot / nullif(x.norm * y.norm, 0) AS score
    FROM item_dots d JOIN item_norms x ON x.id = a JOIN item_norms y ON y.id = b""",
    "item_dots", "item_norms",
)
define(
    "slope_scores",
    """
    SELECT g.* FROM (
      SELECT r.user_id, d.a AS item_id, sum((d.dev + r.rating) * d.n) / sum(d.n) AS by_n,
             avg(d.dev + r.rating) AS plain
      FROM ratings r JOIN (SELECT a, b, n, (sa - sb) / n AS dev FROM item_stats2) d ON d.b = r.item_id
      GROUP BY 1, 2) g
    LEFT JOIN ratings x ON x.user_id = g.user_id AND x.item_id = g.item_id WHERE x.user_id IS NULL""",
    "ratings", "item_stats2",
)

_RANKED = f"SELECT user_id, item_id, {r6('score', 'score')}, rank FROM"


def _topn(source, k):
    return f"{_RANKED} ({top(source, 'user_id', 'score', 'item_id', k, 'user_id, item_id, score')})"


_SIMILAR = f"SELECT a AS item_id, b AS other_id, {r6('score', 'score')}, rank FROM"
_BASIC = f"(SELECT *, {SCORES['assoc_basic']} AS score FROM item_stats2)"
_ADVANCED = f"(SELECT *, {SCORES['assoc_advanced']} AS score FROM item_stats2)"

_USER_BASED = """
    SELECT g.user_id, g.item_id, {score} AS score FROM (
      SELECT s.a AS user_id, r.item_id, sum(s.score * r.rating) AS num, sum(s.score) AS den, count(*) AS k
      FROM near s JOIN {table} r ON r.user_id = s.b GROUP BY 1, 2) g
    LEFT JOIN {table} x ON x.user_id = g.user_id AND x.item_id = g.item_id
    WHERE x.user_id IS NULL {extra}"""

ORACLE = {
    "ratings_latest": with_(["ratings"], "SELECT * FROM ratings"),
    "boolean_prefs": with_(["pref_events"], "SELECT DISTINCT user_id, item_id, 1e0 AS rating FROM pref_events"),
    "ratings_overlay": with_(
        ["pref_events"],
        """
        SELECT user_id, item_id, rating FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY seq DESC) AS rn FROM (
            SELECT user_id, item_id, rating, event_type, event_id AS seq FROM pref_events WHERE event_type <> 'click'
            UNION ALL
            SELECT user_id, item_id, rating, event_type, -1 FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) AS k
              FROM pref_events WHERE event_type = 'click') WHERE k = 1))
        WHERE rn = 1 AND event_type <> 'error'""",
    ),
    "sample_exact": with_(
        ["ratings"],
        """
        SELECT user_id, item_id, rating FROM (
          SELECT *, row_number() OVER (ORDER BY md5('7:' || user_id || ':' || item_id), user_id, item_id) AS rn,
                 count(*) OVER () AS n FROM ratings)
        WHERE rn <= greatest(1, ceil(n * 10 / 100))""",
    ),
    "als_predict": with_(
        ["train", "heldout"],
        """
        SELECT user_id, item_id, true AS finite FROM heldout
        WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
    ),
    "split_holdout": with_(
        ["train", "heldout"],
        "SELECT *, 'train' AS part FROM train UNION ALL SELECT *, 'test' AS part FROM heldout",
    ),
    "unseen_items": with_(
        ["ratings"],
        """
        SELECT s.user_id, s.item_id, s.rating FROM (
          SELECT o_custkey AS user_id, l_partkey AS item_id, 5e-1 * ceil(l_quantity / 5) AS rating,
                 row_number() OVER (PARTITION BY o_custkey, l_partkey
                   ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
        LEFT JOIN ratings r ON r.user_id = s.user_id AND r.item_id = s.item_id
        WHERE rn = 1 AND r.user_id IS NULL""",
    ),
    "item_cooccurrence": with_(["item_pairs"], "SELECT a, b, n FROM item_pairs"),
    "user_means": with_(["means"], f"SELECT user_id, {r6('mean_rating', 'mean_rating')} FROM means"),
    "centered_ratings": with_(["centred"], f"SELECT user_id, item_id, {r6('cr', 'centred')} FROM centred"),
    "vector_norms": with_(["item_norms"], f"SELECT id AS item_id, {r6('norm', 'norm')} FROM item_norms"),
    "topk_per_key": with_(
        ["ratings"], top("ratings", "user_id", "rating", "item_id", 5, "user_id, item_id, rating")
    ),
    "threshold_neighbors": with_(
        ["user_sims"], f"SELECT a, b, n, {r6('score', 'score')} FROM user_sims WHERE score >= 2e-1"
    ),
    "recommend_with_titles": with_(
        ["item_scores"],
        f"SELECT user_id, item_id, p_name AS title, score, rank FROM ({_topn('item_scores', 5)}) "
        "JOIN part ON p_partkey = item_id",
    ),
    "assoc_basic": _sim_sql("item", "assoc_basic", True),
    "assoc_advanced": _sim_sql("item", "assoc_advanced", True),
    "nonpersonalized_topn": with_(
        ["item_stats2"], f"{_SIMILAR} ({top(_BASIC, 'a', 'score', 'b', 5, 'a, b, score')})"
    ),
    "nonpersonalized_filled": with_(
        ["item_stats2"],
        f"{_SIMILAR} ({top('every', 'a', 'score', 'b', 60, 'a, b, score')})",
        {
            "items": "SELECT DISTINCT item_id FROM ratings",
            "every": "SELECT x.item_id AS a, y.item_id AS b, coalesce(s.score, 0e0) AS score FROM items x "
                     f"JOIN items y ON x.item_id <> y.item_id LEFT JOIN {_BASIC} s ON s.a = x.item_id AND s.b = y.item_id",
        },
    ),
    "nonpersonalized_advanced_topn": with_(
        ["item_stats2"], f"{_SIMILAR} ({top(_ADVANCED, 'a', 'score', 'b', 5, 'a, b, score')})"
    ),
    "sim_pearson": _sim_sql("item", "pearson"),
    "sim_pearson_weighted": _sim_sql("user", "pearson_w"),
    "sim_euclidean": _sim_sql("item", "euclidean"),
    "sim_cosine_corated": _sim_sql("item", "cosine"),
    "sim_cosine_weighted": _sim_sql("user", "cosine_w"),
    "sim_cityblock": _sim_sql("user", "manhattan"),
    "sim_tanimoto": _sim_sql("item", "tanimoto"),
    "sim_llr": _sim_sql("user", "llr"),
    "sim_user_centered": with_(
        ["user_centred"], f"SELECT a, b, n, {r6('score', 'score')} FROM user_centred WHERE a < b"
    ),
    "sim_item_centered": with_(
        ["item_centred"], f"SELECT a, b, n, {r6('score', 'score')} FROM item_centred WHERE a < b AND score IS NOT NULL"
    ),
    "item_item_similar": with_(
        ["item_centred"], f"{_SIMILAR} ({top('item_centred', 'a', 'score', 'b', 10, 'a, b, score')})"
    ),
    "user_user_predict": with_(
        ["user_centred", "centred", "means"],
        f"""
        SELECT user_id, item_id, {r6('mean_rating + num / den', 'prediction')} FROM (
          SELECT user_id, item_id, sum(s * cr) AS num, sum(abs(s)) AS den FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round(s, 9) DESC, v) AS rn FROM (
              SELECT t.user_id, t.item_id, c.user_id AS v, c.cr, coalesce(x.score, 0e0) AS s
              FROM ratings t JOIN centred c ON c.item_id = t.item_id AND c.user_id <> t.user_id
              LEFT JOIN user_centred x ON x.a = t.user_id AND x.b = c.user_id))
          WHERE rn <= 30 GROUP BY 1, 2) JOIN means USING (user_id) WHERE den > 1e-9""",
    ),
    "item_item_predict": with_(
        ["item_centred", "centred", "means"],
        f"""
        SELECT user_id, item_id, {r6('mean_rating + num / den', 'prediction')} FROM (
          SELECT user_id, item_id, sum(s * cr) AS num, sum(abs(s)) AS den FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round(s, 9) DESC, j) AS rn FROM (
              SELECT t.user_id, t.item_id, c.item_id AS j, c.cr, coalesce(x.score, 0e0) AS s
              FROM ratings t JOIN centred c ON c.user_id = t.user_id AND c.item_id <> t.item_id
              JOIN item_norms n1 ON n1.id = t.item_id AND n1.norm > 0
              JOIN item_norms n2 ON n2.id = c.item_id AND n2.norm > 0
              LEFT JOIN item_centred x ON x.a = t.item_id AND x.b = c.item_id))
          WHERE rn <= 20 GROUP BY 1, 2) JOIN means USING (user_id) WHERE den > 1e-9""",
    ),
    "item_based_topn": with_(["item_scores"], _topn("item_scores", 100)),
    "item_based_estimate": with_(
        ["train", "heldout"],
        f"""
        SELECT user_id, item_id, {r6('num / den', 'prediction')} FROM (
          SELECT h.user_id, h.item_id, sum(s.score * t.rating) AS num, sum(s.score) AS den, count(*) AS k
          FROM heldout h JOIN train t ON t.user_id = h.user_id
          JOIN (SELECT a, b, {SCORES['pearson']} AS score FROM tp) s ON s.a = h.item_id AND s.b = t.item_id
          WHERE s.score IS NOT NULL GROUP BY 1, 2)
        WHERE k >= 2 AND abs(den) > 1e-9""",
        {"tp": """
          SELECT a.item_id AS a, b.item_id AS b, count(*) AS n, sum(a.rating) AS sa, sum(b.rating) AS sb,
                 sum(a.rating * a.rating) AS saa, sum(b.rating * b.rating) AS sbb, sum(a.rating * b.rating) AS sab
          FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2"""},
    ),
    "rescored_topn": with_(
        ["item_scores"],
        _topn(
            "(SELECT user_id, item_id, CASE WHEN item_id % 2 = 0 THEN score / 2 ELSE score END AS score "
            "FROM item_scores WHERE item_id >= 10)", 10,
        ),
    ),
    "user_based_topn": with_(
        ["user_sims", "ratings"],
        _topn("(" + _USER_BASED.format(
            score="num / den", table="ratings", extra="AND k >= 2 AND abs(den) > 1e-9") + ")", 10),
        {"near": top(
            "user_sims", "a", "score", "b",
            "(SELECT CASE WHEN count(DISTINCT user_id) > 10 THEN count(DISTINCT user_id) // 10 "
            "ELSE count(DISTINCT user_id) END FROM ratings)", "a, b, score")},
    ),
    "user_based_boolean": with_(
        ["user_stats2", "ratings"],
        _topn("(" + _USER_BASED.format(score="den", table="ratings", extra="") + ")", 10),
        {"near": f"SELECT a, b, score FROM (SELECT a, b, {SCORES['tanimoto']} AS score FROM user_stats2) "
                 "WHERE score >= 3e-1"},
    ),
    "slope_one_weighted": with_(
        ["slope_scores"], f"SELECT user_id, item_id, {r6('by_n', 'prediction')} FROM slope_scores"
    ),
    "slope_one_unweighted": with_(
        ["slope_scores"], f"SELECT user_id, item_id, {r6('plain', 'prediction')} FROM slope_scores"
    ),
    "item_knn_predict": with_(
        ["item_stats2", "ratings"],
        f"""
        SELECT user_id, item_id, {r6('num / den', 'prediction')} FROM (
          SELECT user_id, item_id, sum(s * rating) AS num, sum(s) AS den FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round(s, 9) DESC, j) AS rn FROM (
              SELECT r.user_id, l.a AS item_id, l.b AS j, l.score AS s, r.rating
              FROM ratings r JOIN (SELECT a, b, {SCORES['llr']} AS score FROM item_stats2) l ON l.b = r.item_id
              LEFT JOIN ratings x ON x.user_id = r.user_id AND x.item_id = l.a WHERE x.user_id IS NULL))
          WHERE rn <= 10 GROUP BY 1, 2) WHERE abs(den) > 1e-9""",
    ),
}
