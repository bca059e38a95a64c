"""Searches by shelves of many blocks, and the pair sums of few ids."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from affinis.operators import neighbours as N
from affinis.operators import recommend as R
from affinis.operators import search as X
from affinis.operators import tags as T
from affinis.operators.topk import top_k
from affinis.plans import tag_queries
from tests.conftest import as_dict


def shelved(spark, ids=80, keys=30):
    rng = random.Random(11)
    rows = [(i, f"k{(i // 20) * keys + rng.randrange(keys)}", rng.randrange(-3, 9) / 4) for i in range(ids) for _ in range(9)]
    rows += [(i, "all", 0.125) for i in range(0, ids, 3)]
    unique = {(i, k): v for i, k, v in rows}
    postings = spark.createDataFrame([(*p, v) for p, v in unique.items()], "other bigint, key string, impact double")
    return postings.select(F.col("other").alias("query"), "key", F.col("impact").alias("q")), postings


@pytest.mark.parametrize("barred", [False, True])
@pytest.mark.parametrize(("block_rows", "shelf_rows", "asked_rows"), [(30, 10**6, 10**6), (40, 200, 90), (10**5, 10**6, 10**6)])
def test_search_does_not_depend_on_blocks_and_shelves(spark, block_rows, shelf_rows, asked_rows, barred):
    queries, postings = shelved(spark)
    exclude = spark.createDataFrame([(i, (i * 7) % 80) for i in range(80)], "query bigint, other bigint") if barred else None
    plain = top_k(X._answers(X._direct(queries, postings), exclude), ["query"], "score", ["other"], 4)
    found = X.search_top(queries, postings, 4, exclude, block_rows, shelf_rows, asked_rows)
    keys = ["query", "rank"]
    assert as_dict(found, keys, "other") == as_dict(plain, keys, "other")
    assert as_dict(found, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


def test_a_query_travels_once_whatever_the_number_of_blocks(spark, monkeypatch):
    asked = []
    whole = X.in_blocks
    monkeypatch.setattr(X, "in_blocks", lambda pairs, *others: (asked.append(pairs.count()), whole(pairs, *others))[1])
    queries, postings = shelved(spark)
    assert X.search_top(queries, postings, 4, block_rows=30).count() > 0
    assert asked == [80]


@pytest.mark.parametrize("block_rows", [20, 10**5])
@pytest.mark.parametrize("positive", [False, True])
def test_shelves_and_queries_are_packed_once(spark, monkeypatch, block_rows, positive):
    """Rows of queries and postings are not copied for every shelf and every part of the queries."""
    def fail(*_, **__):
        raise AssertionError("rows were sent to cells")

    queries, postings = shelved(spark, ids=400, keys=25)
    if positive:
        postings = postings.withColumn("impact", F.abs("impact") + 0.5)
        queries = queries.filter("q > 0")
    plain = top_k(X._answers(X._direct(queries, postings), None), ["query"], "score", ["other"], 3)
    monkeypatch.setattr(X, "in_blocks", fail)
    monkeypatch.setattr(X, "_GROUP_BYTES", 3_000)  # groups of some shelves
    found = X.search_top(queries, postings, 3, None, block_rows, shelf_rows=300, asked_rows=500)
    keys = ["query", "rank"]
    assert as_dict(found, keys, "other") == as_dict(plain, keys, "other")
    assert as_dict(found, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


def test_names_as_ids_on_shelves(spark):
    queries, postings = shelved(spark)
    named = lambda df, id: df.withColumn(id, F.concat(F.lit("id"), F.col(id)))
    exclude = spark.createDataFrame([(f"id{i}", f"id{(i * 7) % 80}") for i in range(0, 80, 2)], "query string, other string")
    queries, postings = named(queries, "query"), named(postings, "other")
    plain = top_k(X._answers(X._direct(queries, postings), exclude), ["query"], "score", ["other"], 4)
    found = X.search_top(queries, postings, 4, exclude, 40, 200, 90)
    assert as_dict(found, ["query", "rank"], "other") == as_dict(plain, ["query", "rank"], "other")


@pytest.mark.parametrize("include_rated", [False, True])
def test_few_neighbours_are_summed_by_user(spark, monkeypatch, include_rated):
    """A user's rows are shuffled once, not once per neighbour of what the user rated."""
    def fail(*_, **__):
        raise AssertionError("ratings were joined with neighbours by item")

    rng = random.Random(3)
    ratings = [(u, i, rng.randrange(1, 11) / 2) for u in [None, *range(12)] for i in range(20) if rng.random() < 0.4]
    ratings = spark.createDataFrame([*ratings, (3, None, 2.0), (4, 19, None)], "user_id bigint, item_id bigint, rating double")
    ratings = ratings.dropDuplicates(["user_id", "item_id"])
    near = [(i, (i * 3 + k) % 30, k / 4 - 0.25) for i in range(30) for k in range(5)]
    near = spark.createDataFrame(near, "item_id bigint, other_id bigint, score double")
    rows = lambda df: sorted((r["user_id"] or -1, r["item_id"] or -1, round(r["score"] or -1.0, 9)) for r in df.collect())
    monkeypatch.setattr(T, "BROADCAST_ROWS", 0)
    plain = rows(T.tag_knn_scores(ratings, near, include_rated))
    monkeypatch.setattr(T, "BROADCAST_ROWS", 10**6)
    monkeypatch.setattr(T, "grid_join", fail)
    assert rows(T.tag_knn_scores(ratings, near, include_rated)) == plain and len(plain) > 100


def test_few_ids_are_summed_by_joins(spark, monkeypatch):
    """Pairs of few ids with many rows need no copy of the rows for every block."""
    def fail(*_, **__):
        raise AssertionError("rows were sent to blocks")

    monkeypatch.setattr(X, "in_blocks", fail)
    monkeypatch.setattr(N, "in_blocks", fail)
    rows = [(u, i, 3.0 + (u * i) % 3) for u in range(60) for i in range(9) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    n_rows = len(rows) // 4  # more rows than a block, fewer pairs
    assert R.associated_items(ratings, 3, block_rows=n_rows).count() == 27
    assert N.neighbours(ratings, "item", "assoc_advanced", n=3, block_rows=n_rows).count() == 27


def content_tables(spark):
    rng = random.Random(5)
    ratings = [(u, i, rng.randrange(1, 11) / 2) for u in range(60) for i in range(0, 40, 1 + u % 4) if rng.random() < 0.6]
    ratings += [(None, 3, 4.0), (None, 8, 1.0), (7, None, 5.0), (90, 3, None), (91, 200, 4.5), (5, 4, 4.0), (5, 4, 4.0)]
    rows = {(i, f"t{rng.randrange(30)}"): rng.randrange(-2, 9) / 8 for i in range(50) for _ in range(6)}
    rows |= {(i, "all"): 0.25 for i in range(0, 50, 2)}
    return (
        spark.createDataFrame(ratings, "user_id bigint, item_id bigint, rating double"),
        spark.createDataFrame([(*key, w) for key, w in rows.items()], "item_id bigint, tag string, weight double"),
    )


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("asked_rows", [70, 10**6])
def test_content_lists_equal_those_of_a_profile_table(spark, weighted, asked_rows):
    ratings, rows = content_tables(spark)
    plain = T.content_recommend(T.user_profile(ratings, rows, weighted), rows, ratings, 4)
    found = T.content_lists(ratings, rows, 4, weighted, asked_rows=asked_rows)
    keys = ["user_id", "rank"]
    assert found.schema.names == plain.schema.names and found.count() == plain.count() > 200
    assert as_dict(found, keys, "item_id") == as_dict(plain, keys, "item_id")
    assert as_dict(found, keys, "score") == pytest.approx(as_dict(plain, keys, "score"))


def test_content_lists_make_no_table_of_profiles(spark, monkeypatch):
    """A table of profiles has the tags of all items that a user rated: many times the rows of the ratings."""
    def fail(*_, **__):
        raise AssertionError("profiles were made a table")

    monkeypatch.setattr(T, "user_profile", fail)
    for query in ("content_topn", "content_topn_weighted", "content_topn_filled"):
        assert tag_queries.QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0


def test_content_lists_of_many_item_rows_are_searched(spark):
    ratings, rows = content_tables(spark)
    found, plain = (T.content_lists(ratings, rows, 4, block_rows=size) for size in (20, 10**6))
    users = lambda df: df.filter("user_id is not null")
    assert as_dict(users(found), ["user_id", "rank"], "item_id") == as_dict(users(plain), ["user_id", "rank"], "item_id")
