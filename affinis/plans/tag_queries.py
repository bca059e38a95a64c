"""Queries and oracles over item tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions.numbers import rounded
from affinis.operators import recommend as R
from affinis.operators import tags as T
from affinis.operators.tfidf import document_frequency, term_counts
from affinis.plans import views as V
from affinis.plans.sql import define, r6, top, with_

PAIR = ["user_id", "item_id"]


def _weights(df):
    return df.withColumn("weight", rounded("weight"))


def tag_tf(spark, sf):
    return term_counts(V.tags(spark, sf), "item_id", "tag")


def tag_df(spark, sf):
    return document_frequency(tag_tf(spark, sf), "tag")


def normalize_tags(spark, sf):
    return term_counts(T.normalize_tags(V.tags(spark, sf)), "item_id", "tag")


def tag_tfidf(spark, sf):
    return _weights(T.tag_tfidf(V.tags(spark, sf), V.ratings(spark, sf)))


def _profile(spark, sf, weighted):
    ratings = V.ratings(spark, sf)
    return T.user_profile(ratings, T.tag_tfidf(V.tags(spark, sf), ratings), weighted)


def user_profile_unweighted(spark, sf):
    return _weights(_profile(spark, sf, False))


def user_profile_weighted(spark, sf):
    return _weights(_profile(spark, sf, True))


def _content(weighted):
    def query(spark, sf):
        ratings = V.ratings(spark, sf)
        rows = T.tag_tfidf(V.tags(spark, sf), ratings)
        recs = T.content_lists(ratings, rows, 5, weighted)
        return recs.select(*PAIR, rounded("score").alias("score"), "rank")

    return query


def content_topn_filled(spark, sf):
    """Content lists of 5 for every user; users with short ones, or with none, get the lowest unrated ids."""
    ratings = V.ratings(spark, sf)
    rows = T.tag_tfidf(V.tags(spark, sf), ratings)
    recs = T.content_lists(ratings, rows, 5)
    filled = R.fill_recommendations(recs, ratings, rows.select("item_id").distinct(), 5)
    return filled.select(*PAIR, rounded("score").alias("score"), "rank")


def sim_tag_cosine(spark, sf):
    tags = T.normalize_tags(V.tags(spark, sf))
    return T.tag_cosine(tags).select("a", "b", "n", rounded("score").alias("score"))


def sim_tag_tanimoto(spark, sf):
    tags = T.normalize_tags(V.tags(spark, sf))
    return T.tag_tanimoto(tags).select("a", "b", "n", rounded("score").alias("score"))


def similar_items_by_tags(spark, sf):
    return T.similar_by_tags(V.tags(spark, sf), 10).select(
        "item_id", "other_id", rounded("score").alias("score"), "rank"
    )


def tag_knn_predict(spark, sf):
    ratings = V.ratings(spark, sf)
    scores = T.tag_knn_scores(ratings, T.similar_by_tags(V.tags(spark, sf), 20), include_rated=True)
    return scores.select(*PAIR, rounded("score").alias("prediction"))


def similar_items_by_tags_hot(spark, sf):
    """The same lists over small blocks, so that bounds close some of them."""
    return T.similar_by_tags(V.tags(spark, sf), 10, block_rows=5_000).select(
        "item_id", "other_id", rounded("score").alias("score"), "rank"
    )


def tag_knn_targets(spark, sf):
    train, test = V.holdout(spark, sf)
    scores = T.tag_knn_predict(train, V.tags(spark, sf), test)
    return scores.select(*PAIR, rounded("score").alias("prediction"))


def tag_knn_recommend(spark, sf):
    recs = T.tag_knn_recommend(V.ratings(spark, sf), V.tags(spark, sf), 20)
    return recs.select(*PAIR, rounded("score").alias("score"), "rank")


QUERIES = {
    "tag_tf": tag_tf,
    "tag_df": tag_df,
    "normalize_tags": normalize_tags,
    "tag_tfidf": tag_tfidf,
    "user_profile_unweighted": user_profile_unweighted,
    "user_profile_weighted": user_profile_weighted,
    "content_topn": _content(False),
    "content_topn_weighted": _content(True),
    "content_topn_filled": content_topn_filled,
    "sim_tag_cosine": sim_tag_cosine,
    "sim_tag_tanimoto": sim_tag_tanimoto,
    "similar_items_by_tags": similar_items_by_tags,
    "similar_items_by_tags_hot": similar_items_by_tags_hot,
    "tag_knn_predict": tag_knn_predict,
    "tag_knn_targets": tag_knn_targets,
    "tag_knn_recommend": tag_knn_recommend,
}

# ---------------------------------------------------------------- oracle

define(
    "tags",
    """
    SELECT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS tag FROM part
    UNION ALL SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey, p_type FROM part
    UNION ALL SELECT l_partkey, 'supp_' || l_suppkey FROM lineitem""",
)
define("tf_all", "SELECT item_id, tag, count(*) AS n FROM tags GROUP BY 1, 2", "tags")
define(
    "tf_norm",
    "SELECT item_id, lower(replace(trim(tag), ' ', '_')) AS tag, count(*) AS n FROM tags GROUP BY 1, 2", "tags",
)
define("tf_rated", "SELECT * FROM tf_all WHERE item_id IN (SELECT item_id FROM ratings)", "tf_all", "ratings")
define(
    "tag_weights",
    """
    SELECT item_id, tag, n * ln(total / CAST(df AS DOUBLE)) AS w FROM tf_rated
    JOIN (SELECT tag, count(*) AS df FROM tf_rated GROUP BY 1) USING (tag),
         (SELECT count(DISTINCT item_id) AS total FROM ratings)
    WHERE df < total""",
    "tf_rated", "ratings",
)
define(
    "tag_rows",
    """
    SELECT item_id, tag, w / norm AS weight FROM tag_weights
    JOIN (SELECT item_id, sqrt(sum(w * w)) AS norm FROM tag_weights GROUP BY 1) USING (item_id) WHERE norm > 0""",
    "tag_weights",
)
define(
    "profile_plain",
    "SELECT user_id, tag, sum(weight) AS weight FROM ratings JOIN tag_rows USING (item_id) "
    "WHERE rating >= 35e-1 GROUP BY 1, 2", "ratings", "tag_rows",
)
define(
    "profile_weighted",
    "SELECT user_id, tag, sum(cr * weight) AS weight FROM centred JOIN tag_rows USING (item_id) GROUP BY 1, 2",
    "centred", "tag_rows",
)


def _content_sql(profile):
    scores = f"""(
      SELECT d.user_id, d.item_id, dot / norm AS score FROM (
        SELECT p.user_id, t.item_id, sum(p.weight * t.weight) AS dot
        FROM {profile} p JOIN tag_rows t USING (tag) GROUP BY 1, 2) d
      JOIN (SELECT user_id, sqrt(sum(weight * weight)) AS norm FROM {profile} GROUP BY 1) USING (user_id)
      LEFT JOIN ratings r ON r.user_id = d.user_id AND r.item_id = d.item_id
      WHERE r.user_id IS NULL AND norm > 1e-9)"""
    ranked = top(scores, "user_id", "score", "item_id", 5, "user_id, item_id, score")
    return with_([profile, "tag_rows", "ratings"],
                 f"SELECT user_id, item_id, {r6('score', 'score')}, rank FROM ({ranked})")


define(
    "tag_idf",
    "SELECT tag, count(*) AS df, 1e0 + ln((SELECT count(DISTINCT item_id) FROM tags) / CAST(count(*) + 1 AS DOUBLE)) "
    "AS idf FROM tf_norm GROUP BY 1", "tf_norm", "tags",
)
define(
    "search_terms",
    top("(SELECT item_id, tag, n * idf AS s FROM tf_norm JOIN tag_idf USING (tag))", "item_id", "s", "tag", 25,
        "item_id, tag"), "tf_norm", "tag_idf",
)
define(
    "postings",
    """
    SELECT item_id AS other_id, tag, sqrt(n) * idf * idf / sqrt(length) AS impact FROM tf_norm
    JOIN tag_idf USING (tag) JOIN (SELECT item_id, CAST(sum(n) AS DOUBLE) AS length FROM tf_norm GROUP BY 1)
    USING (item_id)""",
    "tf_norm", "tag_idf",
)
define(
    "tag_hits",
    "SELECT item_id, other_id, sum(impact) AS score FROM search_terms JOIN postings USING (tag) "
    "WHERE item_id <> other_id GROUP BY 1, 2", "search_terms", "postings",
)
define("top20", top("tag_hits", "item_id", "score", "other_id", 20, "item_id, other_id, score"), "tag_hits")
define(
    "tag_scores",
    """
    SELECT g.user_id, g.item_id, num / den AS score FROM (
      SELECT r.user_id, t.item_id, sum(t.score * r.rating) AS num, sum(t.score) AS den
      FROM ratings r JOIN top20 t ON t.other_id = r.item_id GROUP BY 1, 2) g
    LEFT JOIN ratings x ON x.user_id = g.user_id AND x.item_id = g.item_id
    WHERE x.user_id IS NULL AND den > 1e-9""",
    "ratings", "top20",
)
_PAIRS = """
    SELECT a.item_id AS a, b.item_id AS b, count(*) AS n, sum(a.n * b.n) AS dot
    FROM tf_norm a JOIN tf_norm b ON a.tag = b.tag AND a.item_id < b.item_id GROUP BY 1, 2"""
_TAG_NORMS = "SELECT item_id AS id, sqrt(sum(n * n)) AS norm, count(*) AS k FROM tf_norm GROUP BY 1"

ORACLE = {
    "tag_tf": with_(["tf_all"], "SELECT * FROM tf_all"),
    "tag_df": with_(["tf_all"], "SELECT tag, count(*) AS df FROM tf_all GROUP BY 1"),
    "normalize_tags": with_(["tf_norm"], "SELECT * FROM tf_norm"),
    "tag_tfidf": with_(["tag_rows"], f"SELECT item_id, tag, {r6('weight', 'weight')} FROM tag_rows"),
    "user_profile_unweighted": with_(
        ["profile_plain"], f"SELECT user_id, tag, {r6('weight', 'weight')} FROM profile_plain"
    ),
    "user_profile_weighted": with_(
        ["profile_weighted"], f"SELECT user_id, tag, {r6('weight', 'weight')} FROM profile_weighted"
    ),
    "content_topn": _content_sql("profile_plain"),
    "content_topn_weighted": _content_sql("profile_weighted"),
    "content_topn_filled": with_(
        ["profile_plain", "tag_rows", "ratings"],
        f"SELECT user_id, item_id, {r6('score', 'score')}, rank FROM ("
        + top("every", "user_id", "score", "item_id", 5, "user_id, item_id, score") + ")",
        {
            "dots": "SELECT p.user_id, t.item_id, sum(p.weight * t.weight) AS dot FROM profile_plain p "
                    "JOIN tag_rows t USING (tag) GROUP BY 1, 2",
            "norms": "SELECT user_id, sqrt(sum(weight * weight)) AS norm FROM profile_plain GROUP BY 1",
            "every": """
              SELECT u.user_id, i.item_id, coalesce(dot / norm, 0e0) AS score
              FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN (SELECT DISTINCT item_id FROM tag_rows) i
              LEFT JOIN dots d ON d.user_id = u.user_id AND d.item_id = i.item_id
              LEFT JOIN norms n ON n.user_id = u.user_id
              LEFT JOIN ratings r ON r.user_id = u.user_id AND r.item_id = i.item_id WHERE r.user_id IS NULL""",
        },
    ),
    "sim_tag_cosine": with_(
        ["tf_norm"],
        f"SELECT a, b, n, {r6('dot / (x.norm * y.norm)', 'score')} FROM p JOIN m x ON x.id = a JOIN m y ON y.id = b",
        {"p": _PAIRS, "m": _TAG_NORMS},
    ),
    "sim_tag_tanimoto": with_(
        ["tf_norm"],
        f"SELECT a, b, n, {r6('n / CAST(x.k + y.k - n AS DOUBLE)', 'score')} "
        "FROM p JOIN m x ON x.id = a JOIN m y ON y.id = b",
        {"p": _PAIRS, "m": _TAG_NORMS},
    ),
    **{name: with_(
        ["tag_hits"],
        f"SELECT item_id, other_id, {r6('score', 'score')}, rank FROM "
        f"({top('tag_hits', 'item_id', 'score', 'other_id', 10, 'item_id, other_id, score')})",
    ) for name in ("similar_items_by_tags", "similar_items_by_tags_hot")},
    "tag_knn_targets": with_(
        ["train", "heldout", "top20"],
        f"""
        SELECT user_id, item_id, {r6('num / den', 'prediction')} FROM (
          SELECT h.user_id, h.item_id, sum(t.score * r.rating) AS num, sum(t.score) AS den
          FROM heldout h JOIN top20 t ON t.item_id = h.item_id JOIN train r ON r.user_id = h.user_id AND r.item_id = t.other_id
          WHERE t.score > 0 GROUP BY 1, 2) WHERE den > 1e-9""",
    ),
    "tag_knn_predict": with_(
        ["tag_scores"],
        f"SELECT user_id, item_id, {r6('score', 'prediction')} FROM tag_scores UNION ALL "
        f"SELECT user_id, item_id, {r6('rating', 'prediction')} FROM ratings",
    ),
    "tag_knn_recommend": with_(
        ["tag_scores"],
        f"SELECT user_id, item_id, {r6('score', 'score')}, rank FROM ("
        + top("(SELECT * FROM tag_scores WHERE score > 0 AND item_id IN (SELECT item_id FROM ratings))",
              "user_id", "score", "item_id", 20, "user_id, item_id, score") + ")",
    ),
}
