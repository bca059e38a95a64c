"""Hot keys, samples and exactness of the pruned paths."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from affinis.functions.measures import MEASURES
from affinis.operators import neighbours as N
from affinis.operators import pairs as P
from affinis.operators import recommend as R
from affinis.operators import sampling as S
from affinis.operators import search as X
from affinis.operators import tags as T
from affinis.operators.joins import grid_join
from affinis.operators.set_join import set_candidates, set_neighbours
from affinis.operators.topk import top_k
from tests.conftest import as_dict


def skewed(spark, n, seed):
    """A third of all rows carries key 0."""
    rng = random.Random(seed)
    rows = [(0 if rng.random() < 0.34 else rng.randrange(1, 40), i, float(rng.randrange(1, 11)) / 2) for i in range(n)]
    return spark.createDataFrame(rows, "k bigint, id bigint, v double")


@pytest.mark.parametrize("block", [1, 7, 50, 10_000])
def test_grid_join_equals_plain_join(spark, block):
    left = skewed(spark, 400, 1).toDF("k", "l", "x")
    right = skewed(spark, 300, 2).filter("k <> 5").toDF("k", "r", "y")
    plain = sorted(map(tuple, left.join(right, "k").select("k", "l", "x", "r", "y").collect()))
    grid = grid_join(left, right, ["k"], "l", "r", block).select("k", "l", "x", "r", "y")
    assert sorted(map(tuple, grid.collect())) == plain


@pytest.mark.parametrize("block", [5, 10_000])
def test_pair_stats_do_not_depend_on_blocks(spark, block):
    rows = spark.createDataFrame(
        [(u, i, float((u * i) % 10 + 1) / 2) for u in range(30) for i in range(40) if u == 0 or (u + i) % 5 == 0],
        "user_id bigint, item_id bigint, rating double",
    )
    got = P.pair_stats(rows, "user_id", "item_id", "rating", rows_per_block=block)
    a = rows.toDF("u", "a", "x")
    b = rows.toDF("u", "b", "y")
    plain = a.join(b, "u").filter("a < b").groupBy("a", "b").agg(
        F.count("*").alias("n"), F.sum("x").alias("sum_a"), F.sum(F.col("x") * F.col("y")).alias("sum_ab")
    )
    keys = ["a", "b"]
    for column in ("n", "sum_a", "sum_ab"):
        assert as_dict(got, keys, column) == pytest.approx(as_dict(plain, keys, column))


def test_directed_is_symmetric(intro):
    both = P.directed(P.pair_stats(intro, "user_id", "item_id", "rating"))
    rows = {(r["a"], r["b"]): r for r in both.collect()}
    for (a, b), r in rows.items():
        s = rows[(b, a)]
        assert (r["n"], r["sum_a"], r["sum_aa"], r["n_a"], r["ss_a"]) == (s["n"], s["sum_b"], s["sum_bb"], s["n_b"], s["ss_b"])


def test_left_ids_cut_the_left_side(spark, intro):
    ids = spark.createDataFrame([(1,)], "id bigint")
    some = as_dict(P.similarity_table(intro, "user", "pearson", left_ids=ids), ["a", "b"], "score")
    full = as_dict(P.similarity_table(intro, "user", "pearson", True).filter("a = 1"), ["a", "b"], "score")
    assert some == pytest.approx(full)


def tag_rows(spark):
    rng = random.Random(5)
    names = [f"t{i}" for i in range(60)]
    rows = []
    for item in range(150):
        rows += [(item, "Common Tag")] * rng.randrange(0, 3)
        rows += [(item, "wide") for _ in range(rng.random() < 0.5)]
        rows += [(item, names[min(int(rng.expovariate(0.08)), 59)]) for _ in range(rng.randrange(1, 9))]
    return spark.createDataFrame(rows, "item_id bigint, tag string")


@pytest.mark.parametrize(("block_rows", "n"), [(3, 5), (40, 2)])
def test_tag_search_without_hot_tags_is_exact(spark, block_rows, n):
    tags = tag_rows(spark)
    keys = ["item_id", "rank"]
    plain = T.similar_by_tags(tags, n, block_rows=10**9)
    pruned = T.similar_by_tags(tags, n, block_rows=block_rows)
    assert as_dict(pruned, keys, "other_id") == as_dict(plain, keys, "other_id")
    assert as_dict(pruned, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


@pytest.mark.parametrize(("hot", "n"), [(2, 4), (15, 1)])
def test_association_without_hot_users_is_exact(spark, hot, n):
    rng = random.Random(9)
    rows = {(u, min(int(rng.expovariate(0.05)), 79)) for u in range(60) for _ in range(60 if u < 3 else rng.randrange(1, 8))}
    ratings = spark.createDataFrame([(u, i, 3.0) for u, i in rows], "user_id bigint, item_id bigint, rating double")
    keys = ["item_id", "rank"]
    plain = R.similar_items(ratings, n, "assoc_basic")
    pruned = R.associated_items(ratings, n, block_rows=hot)
    assert as_dict(pruned, keys, "other_id") == as_dict(plain, keys, "other_id")
    assert as_dict(pruned, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


@pytest.mark.parametrize("n", [1, 3])
def test_association_with_one_huge_user_and_sparse_rest(spark, n):
    rng = random.Random(2)
    rows = {(0, i) for i in range(0, 120, 2)} | {(rng.randrange(1, 90), rng.randrange(120)) for _ in range(180)}
    ratings = spark.createDataFrame([(u, i, 3.0) for u, i in rows], "user_id bigint, item_id bigint, rating double")
    keys = ["item_id", "rank"]
    plain = R.similar_items(ratings, n, "assoc_basic")
    pruned = R.associated_items(ratings, n, block_rows=20)
    assert as_dict(pruned, keys, "other_id") == as_dict(plain, keys, "other_id")
    assert as_dict(pruned, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


@pytest.mark.parametrize(("weighted", "block_rows"), [(False, 25), (True, 5)])
def test_content_lists_without_hot_tags_are_exact(spark, weighted, block_rows):
    tags = tag_rows(spark)
    ratings = spark.createDataFrame(
        [(u, (u * 7 + i * 11) % 150, float((u + i) % 10 + 1) / 2) for u in range(40) for i in range(9)],
        "user_id bigint, item_id bigint, rating double",
    )
    rows = T.tag_tfidf(tags, ratings)
    profile = T.user_profile(ratings, rows, weighted)
    keys = ["user_id", "rank"]
    plain = T.content_recommend(profile, rows, ratings, 3, block_rows=10**9)
    pruned = T.content_recommend(profile, rows, ratings, 3, block_rows=block_rows)
    assert as_dict(pruned, keys, "item_id") == as_dict(plain, keys, "item_id")
    assert as_dict(pruned, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


def test_tags_in_two_runs_are_one_item(spark):
    rows = [(1, "Big Cat"), (2, "dog"), (1, "big cat"), (1, "dog")]
    tags = T.normalize_tags(spark.createDataFrame(rows, "item_id bigint, tag string"))
    assert sorted(map(tuple, tags.collect())) == [(1, "big_cat"), (1, "big_cat"), (1, "dog"), (2, "dog")]


def test_tag_on_every_item_has_no_weight(spark):
    ratings = spark.createDataFrame([(1, 1, 4.0), (1, 2, 4.0)], "user_id bigint, item_id bigint, rating double")
    rows = [(1, "all"), (2, "all"), (1, "rare"), (3, "unrated")]
    tags = spark.createDataFrame(rows, "item_id bigint, tag string")
    assert as_dict(T.tag_tfidf(tags, ratings), ["item_id", "tag"], "weight") == {(1, "rare"): 1.0}
    assert T.dropped_tags(tags, ratings).first()["dropped"] == 1


def test_top_k_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(1, 3, 0.5), (1, 2, 0.5 + 1e-12), (1, 1, 0.4), (1, 4, None)], "k bigint, id bigint, s double")
    rows = top_k(df, ["k"], "s", ["id"], 2).orderBy("rank").collect()
    assert [r["id"] for r in rows] == [2, 3]


def test_large_k_equals_small_steps(spark):
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(limit, "5")
    df = skewed(spark, 500, 4)
    got = as_dict(top_k(df, ["k"], "v", ["id"], 20), ["k", "rank"], "id")
    spark.conf.unset(limit)
    assert got == as_dict(top_k(df, ["k"], "v", ["id"], 20), ["k", "rank"], "id")


@pytest.mark.parametrize("pct", [0.0001, 1, 37, 100])
def test_sample_is_exact_and_seeded(spark, pct):
    df = spark.range(1000).repartition(5)
    got = sorted(r["id"] for r in S.sample_rows(df, pct, ["id"], "s").collect())
    assert len(got) == max(1, -(-1000 * pct // 100)) and len(set(got)) == len(got)
    again = sorted(r["id"] for r in S.sample_rows(df.coalesce(1), pct, ["id"], "s").collect())
    assert got == again


def test_sample_within_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(S, "_BUCKET_DIGITS", 1)
    df = spark.range(500)
    expected = sorted(r["id"] for r in df.orderBy(S.key_hash(["id"], "s"), "id").limit(50).collect())
    assert sorted(r["id"] for r in S.sample_rows(df, 10, ["id"], "s").collect()) == expected


def test_split_is_stable_and_complete(intro):
    train, test = S.split_ratings(intro, 0.7)
    assert train.count() + test.count() == 21
    again, _ = S.split_ratings(intro.repartition(3), 0.7)
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, again.collect()))
    some, rest = S.split_ratings(intro, 0.7, 0.5)
    users = {r["user_id"] for r in some.union(rest).select("user_id").distinct().collect()}
    assert len(users) < 5


def rated(spark, seed, users=50, items=60):
    """Ratings with a huge user, an item that a third of the users have, and items that nobody shares."""
    rng = random.Random(seed)
    pairs = {(0, i) for i in range(0, items, 2)} | {(u, 7) for u in range(users) if u % 3 == 0}
    pairs |= {(rng.randrange(users), min(int(rng.expovariate(0.08)), items - 1)) for _ in range(300)}
    pairs |= {(users + k, 900 + k) for k in range(3)}
    rows = [(u, i, float(rng.randrange(1, 11)) / 2) for u, i in sorted(pairs)]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")


@pytest.mark.parametrize("measure", sorted(MEASURES))
def test_neighbour_lists_equal_the_pair_table(spark, measure):
    ratings = rated(spark, 3)
    table = P.similarity_table(ratings, "item", measure, both_directions=True)
    keys = ["a", "rank"]
    plain = top_k(table, ["a"], "score", ["b"], 4)
    for block_rows in (25, 10**6):
        found = top_k(N.neighbours(ratings, "item", measure, n=4, block_rows=block_rows), ["a"], "score", ["b"], 4)
        assert as_dict(found, keys, "b") == as_dict(plain, keys, "b")
        assert as_dict(found, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))
        assert as_dict(found, keys, "n") == as_dict(plain, keys, "n")


@pytest.mark.parametrize(("measure", "threshold"), [("pearson", 0.2), ("tanimoto", 0.3), ("manhattan", 0.1), ("assoc_advanced", 2.0)])
def test_neighbours_above_a_threshold(spark, measure, threshold):
    ratings = rated(spark, 4)
    plain = P.similarity_table(ratings, "user", measure, both_directions=True).filter(F.col("score") >= threshold)
    found = N.neighbours(ratings, "user", measure, threshold=threshold, block_rows=20)
    assert as_dict(found, ["a", "b"], "score") == pytest.approx(as_dict(plain, ["a", "b"], "score"))


def test_bounds_close_blocks(spark):
    """Groups of items with users of their own: only blocks of the own group are met."""
    rows = [(g * 100 + u, g * 1000 + i, 3.0) for g in range(12) for u in range(8) for i in range(15) if (u * i) % 4 != 3]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    queries = ratings.select(F.col("item_id").alias("query"), F.col("user_id").alias("key"), F.lit(1.0).alias("q"))
    postings = queries.select(F.col("query").alias("other"), "key", F.lit(1.0).alias("impact"))
    placed = postings.join(X.block_of(postings, 60), "other")
    blocks = placed.select("block").distinct().count()
    met = X.block_bounds(queries, placed)
    assert blocks > 12 and met.count() < 0.35 * 180 * blocks
    assert met.filter("bound <= 0").count() == 0


@pytest.mark.parametrize("threshold", [0.3, 0.5, 1.0])
def test_set_join_equals_the_pair_table(spark, threshold):
    ratings = rated(spark, 5)
    rows = ratings.select(F.col("user_id").alias("id"), F.col("item_id").alias("key"))
    plain = P.similarity_table(ratings, "user", "tanimoto").filter(F.col("score") >= threshold)
    assert as_dict(set_neighbours(rows.unionByName(rows), threshold), ["a", "b"], "score") == as_dict(plain, ["a", "b"], "score")
    spark.conf.set("affinis.join.rowsPerBlock", "4")
    again = as_dict(set_neighbours(rows, threshold), ["a", "b"], "n")
    spark.conf.unset("affinis.join.rowsPerBlock")
    assert again == as_dict(plain, ["a", "b"], "n")


def test_prefixes_leave_few_candidates(spark):
    rng = random.Random(8)
    rows = [(i, k) for i in range(200) for k in {0, 1, *(rng.randrange(2, 400) for _ in range(12))}]
    rows += [(200 + i, k) for i in range(20) for j, k in rows if j == i]  # twenty copies
    sets = spark.createDataFrame(rows, "id bigint, key bigint")
    everyone = 220 * 219 // 2  # all sets share keys 0 and 1
    assert set_candidates(sets, 0.8).count() < 0.02 * everyone
    assert set_neighbours(sets, 0.8).count() >= 20


def test_fill_lists(spark):
    ids = spark.createDataFrame([(i,) for i in (2, 3, 5, 7, 11, 13)], "id bigint")
    lists = spark.createDataFrame([(2, 11, 0.5), (2, 3, 0.4), (5, 2, 0.1), (13, 2, 0.3), (13, 3, 0.2), (13, 5, 0.1)],
                                  "item_id bigint, other_id bigint, score double")
    taken = spark.createDataFrame([(i, i) for i in (2, 5, 7, 11, 13)] + [(5, 3), (7, 2), (7, 3), (7, 5), (7, 11), (7, 13)],
                                  "item_id bigint, other_id bigint")
    found = {}
    for r in R.fill_lists(lists, taken, ids, 3).orderBy("item_id", "rank").collect():
        found.setdefault(r["item_id"], []).append((r["other_id"], r["score"]))
    assert found == {
        2: [(11, 0.5), (3, 0.4), (5, 0.0)], 5: [(2, 0.1), (7, 0.0), (11, 0.0)], 13: [(2, 0.3), (3, 0.2), (5, 0.1)],
        11: [(2, 0.0), (3, 0.0), (5, 0.0)],
    }


def test_fill_equals_brute_force(spark):
    rng = random.Random(1)
    ids = sorted(rng.sample(range(100), 40))
    taken = {(o, rng.choice(ids)) for o in range(15) for _ in range(rng.choice((0, 1, 9, 60)))}
    lists = {(o, i): round(rng.random() + 0.01, 3) for o, i in taken if rng.random() < 0.15}
    found = R.fill_lists(
        spark.createDataFrame([(*k, v) for k, v in lists.items()], "item_id bigint, other_id bigint, score double"),
        spark.createDataFrame(sorted(taken), "item_id bigint, other_id bigint"),
        spark.createDataFrame([(i,) for i in ids], "id bigint"), 8,
    )
    for owner in {o for o, _ in taken}:
        own = sorted(((-v, i) for (o, i), v in lists.items() if o == owner))[:8]
        free = [i for i in ids if (owner, i) not in taken][:8 - len(own)]
        got = [(r["other_id"], r["score"]) for r in found.filter(F.col("item_id") == owner).orderBy("rank").collect()]
        assert got == [(i, -v) for v, i in own] + [(i, 0.0) for i in free]
