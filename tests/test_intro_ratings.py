"""Values worked out by hand for the small ratings table."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from affinis.operators import evaluate as E
from affinis.operators import pairs as P
from affinis.operators import recommend as R
from affinis.sources import ratings as src
from tests.conftest import as_dict

APPROX = {"abs": 1e-5}


def near(expected):
    return pytest.approx(expected, **APPROX)


def from_user_1(df):
    return as_dict(df.filter("a = 1"), ["b"], "score")


def test_user_means(intro):
    means = as_dict(P.user_means(intro), ["user_id"], "mean_rating")
    assert means == near({1: 3.5, 2: 2.875, 3: 4.0, 4: 4.125, 5: 3.416667})


def test_pearson_null_with_one_common_item(intro):
    assert from_user_1(P.similarity_table(intro, "user", "pearson", True)) == near(
        {2: -0.764265, 4: 1.0, 5: 0.944911}
    )


def test_tanimoto(intro):
    assert from_user_1(P.similarity_table(intro, "user", "tanimoto", True)) == near(
        {2: 0.75, 3: 0.166667, 4: 0.4, 5: 0.5}
    )


def test_centred_cosine_users(intro):
    assert from_user_1(P.centred_cosine(P.centred(intro), "user")) == near(
        {2: -0.698380, 3: -0.642857, 4: 0.880920, 5: 0.746047}
    )


def test_centred_cosine_items(intro):
    sims = P.centred_cosine(P.centred(intro, True), "item").filter("a = 101")
    assert as_dict(sims, ["b"], "score") == near({
        102: -0.350691, 103: -0.690924, 104: 0.508844, 105: -0.548173, 106: 0.153335, 107: -0.594250,
    })


def test_basic_association_and_tie_break(intro):
    top = R.similar_items(intro, 6).filter("item_id = 101").orderBy("rank").collect()
    assert [r["other_id"] for r in top] == [103, 104, 102, 105, 106, 107]
    assert [r["score"] for r in top] == near([0.8, 0.8, 0.6, 0.4, 0.4, 0.2])


def test_advanced_association(intro):
    top = R.similar_items(intro, 6, "assoc_advanced").filter("item_id = 102")
    # 107 shares no user with 102, so it is no pair of the table.
    assert as_dict(top, ["other_id"], "score") == near(
        {101: 1.0, 103: 2.0, 104: 2 / 3, 105: 2 / 3, 106: 2 / 3}
    )


def test_advanced_association_infinite_and_undefined(spark):
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0), (3, 3, 1.0), (1, 9, 1.0), (2, 9, 1.0), (3, 9, 1.0)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    scores = as_dict(P.similarity_table(df, "item", "assoc_advanced", True), ["a", "b"], "score")
    assert scores[(1, 2)] == math.inf  # 2 is only seen with 1
    assert (9, 1) not in scores  # every user has 9


def test_fill_with_unrelated(intro):
    sims = P.similarity_table(intro, "item", "assoc_basic", True)
    top = R.top_items(sims, 6)
    filled = R.fill_with_unrelated(top, sims, intro.select("item_id").distinct(), [102], 6)
    row = filled.filter("item_id = 102").orderBy("rank").collect()
    assert [r["other_id"] for r in row][-1] == 107 and row[-1]["score"] == 0.0
    assert filled.filter("item_id = 101").count() == 6


def test_user_based_nearest_two(intro):
    sims = P.similarity_table(intro, "user", "pearson", True)
    near_users = R.user_neighbours(sims, nearest=2)
    assert sorted(r["other"] for r in near_users.filter("user_id = 1").collect()) == [4, 5]
    scores = R.user_based_scores(intro, near_users).filter("user_id = 1")
    assert as_dict(scores, ["item_id"], "score") == near({104: 4.257081, 106: 4.0})
    top = R.recommend(scores, 1).collect()
    assert [r["item_id"] for r in top] == [104]


@pytest.mark.parametrize("block_rows", [1, 4, 100])
def test_user_user_prediction(spark, intro, block_rows):
    targets = spark.createDataFrame([(1, i) for i in (104, 105, 106, 107)], "user_id bigint, item_id bigint")
    got = as_dict(R.user_user_predict(intro, targets, 30, block_rows), ["item_id"], "prediction")
    assert got == near({104: 3.963789, 105: 3.313336, 106: 3.699807, 107: 2.5})


@pytest.mark.parametrize("block_rows", [1, 4, 100])
def test_item_item_prediction(spark, intro, block_rows):
    targets = spark.createDataFrame([(1, i) for i in (104, 105, 106, 107)], "user_id bigint, item_id bigint")
    got = as_dict(R.item_item_predict(intro, targets, 20, block_rows), ["item_id"], "prediction")
    assert got == near({104: 4.566013, 105: 2.527618, 106: 4.320462, 107: 2.0})


def test_slope_one(spark, intro):
    got = as_dict(R.slope_one(intro).filter("user_id = 1"), ["item_id"], "score")
    assert got == near({104: 3.944444, 105: 4.75, 106: 4.2, 107: 7.5})
    plain = as_dict(R.slope_one(intro, False).filter("user_id = 1"), ["item_id"], "score")
    assert plain == near({104: 3.722222, 105: 4.416667, 106: 4.166667, 107: 7.5})
    targets = spark.createDataFrame([(1, 104), (1, 107)], "user_id bigint, item_id bigint")
    some = as_dict(R.slope_one(intro, True, targets), ["item_id"], "score")
    assert some == near({104: 3.944444, 107: 7.5})


def test_item_based_batch_equals_estimate(intro):
    sims = P.similarity_table(intro, "item", "pearson", True)
    batch = R.item_based_scores(intro, sims)
    wanted = batch.select("user_id", "item_id")
    single = R.item_based_estimate(intro, sims, wanted)
    keys = ["user_id", "item_id"]
    assert as_dict(batch, keys, "score") == near(as_dict(single, keys, "score"))


def test_rescore_and_filter(intro):
    recs = R.item_based_recommend(intro, 3, "euclidean", rescore=lambda s: -s, keep=F.col("item_id") != 106)
    rows = recs.filter("user_id = 1").orderBy("rank").collect()
    assert 106 not in [r["item_id"] for r in rows]
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)


def test_own_measure(intro):
    mine = P.similarity_table(intro, "item", lambda total: F.col("n") / total)
    assert as_dict(mine.filter("a = 101 and b = 104"), ["a"], "score") == near({101: 0.8})


def test_clamped_error(spark, intro):
    predictions = spark.createDataFrame([(1, 101, 9.0), (1, 102, 2.0)], "user_id bigint, item_id bigint, score double")
    holdout = intro.filter("user_id = 1")
    row = E.mean_abs_error(predictions, holdout, intro).first()
    assert (row["mae"], row["evaluated"], row["skipped"]) == (0.5, 2, 1)


def test_relevant_items_need_enough_ratings(intro):
    # Users with 4 and more ratings; best 2 that reach mean plus deviation.
    got = {(r["user_id"], r["item_id"]) for r in E.relevant_items(intro, 2).collect()}
    assert {u for u, _ in got} <= {2, 3, 4, 5} and (2, 103) in got and (4, 101) in got


def test_precision_recall_in_range(intro):
    row = E.precision_recall_at(lambda t: R.item_based_recommend(t, 2, "euclidean"), intro, 2).first()
    assert 0.0 <= row["precision"] <= 1.0 and 0.0 <= row["recall"] <= 1.0


def test_grid_has_24_cells(intro):
    grid = E.evaluation_grid(intro, 2, R.neighbourhood_size(intro))
    assert grid.count() == 24 and grid.select("type", "neighbourhood", "measure").distinct().count() == 24


def test_neighbourhood_size(intro):
    assert R.neighbourhood_size(intro) == 5


def test_user_with_equal_ratings_has_no_pearson(spark):
    rows = [(1, 1, 3.0), (1, 2, 3.0), (2, 1, 1.0), (2, 2, 5.0)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    assert P.similarity_table(df, "user", "pearson").count() == 0
    zero = P.centred_cosine(P.centred(df), "user").collect()
    assert {r["score"] for r in zero} == {0.0}


def test_zero_rating_is_missing_for_items(spark):
    rows = [(1, 1, 0.0), (1, 2, 4.0), (1, 3, 2.0)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    assert as_dict(P.centred(df, True), ["item_id"], "centred") == {2: 1.0, 3: -1.0}
    assert P.centred(df).count() == 3


def test_boolean_scores(intro):
    prefs = src.to_boolean(intro)
    sims = P.similarity_table(prefs, "user", "tanimoto", True)
    got = R.user_based_boolean_scores(prefs, R.user_neighbours(sims, threshold=0.4)).filter("user_id = 1")
    assert as_dict(got, ["item_id"], "score") == near({104: 0.75 + 0.4 + 0.5, 105: 0.5, 106: 0.9})


def test_als_takes_long_ids(intro):
    far = intro.withColumn("user_id", F.col("user_id") + 2**40)
    assert R.als_predict(far, far, rank=2, steps=2).filter("user_id > 1099511627776").count() == 21


def test_als_predicts_in_sample(intro):
    pred = R.als_predict(intro, intro, rank=2, steps=3)
    assert pred.count() == 21 and pred.filter("isnan(prediction)").count() == 0


def test_item_knn(intro):
    pred = R.item_knn_predict(intro, 2).filter("user_id = 1")
    assert 0 < pred.count() <= 4
    assert pred.filter("score < 1 or score > 5").count() == 0
