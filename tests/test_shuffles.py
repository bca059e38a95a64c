"""What travels and what is computed twice: texts by id, labels with their rows, words once, itemsets once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from affinis.operators import classify as C
from affinis.operators import rules as U
from affinis.operators import text as X
from affinis.session import by_id
from affinis.sources import vectors as S
from tests.conftest import as_dict


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def docs(spark):
    rows = [(1, "red red green", "x"), (2, "green blue", "y"), (3, "blue", None), (4, "", "x"), (5, None, "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


def test_a_larger_table_gets_more_partitions(spark):
    assert by_id(spark.range(1000), "id", 100).rdd.getNumPartitions() == 10
    assert by_id(spark.range(10), "id", 100).rdd.getNumPartitions() == 4


def test_texts_travel_once_and_words_do_not(docs):
    units = S.unit_rows(X.analyzed_tokens(docs).withColumnRenamed("n", "weight"), "doc_id", "weight")
    assert plan(units).count("Exchange hashpartitioning") == 1


def test_lines_of_a_message_are_split_once(docs):
    words = X.message_words(docs)
    assert plan(words, "optimizedPlan").count(r"\z") == 1
    assert as_dict(words, ["word"], "n") == {}  # no header and no body


def test_units_with_labels_give_the_same_centroids(docs):
    labels = docs.select("doc_id", "label")
    labels = labels.unionByName(labels.filter("doc_id = 2"))  # a repeated row
    vectors = X.analyzed_tokens(docs).select("doc_id", F.col("token").alias("key"), F.col("n").cast("double").alias("weight"))
    plain = C.label_centroids(C.unit_vectors(vectors, "doc_id"), labels, "doc_id")
    units = C.unit_vectors(vectors, "doc_id", labels)
    own = C.label_centroids(units, labels, "doc_id")
    assert as_dict(own, ["label", "key"], "weight") == pytest.approx(as_dict(plain, ["label", "key"], "weight"))
    assert plan(own).count("Join") < plan(plain).count("Join")


def test_few_centroids_leave_an_ids_rows_where_they_are(docs, monkeypatch):
    vectors = X.analyzed_tokens(docs).select("doc_id", F.col("token").alias("key"), F.col("n").cast("double").alias("weight"))
    units = C.unit_vectors(vectors, "doc_id")
    centroids = C.label_centroids(units, docs.select("doc_id", "label"), "doc_id")
    few = C.label_scores(units, centroids, "doc_id")
    assert plan(few).count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    keys = ["doc_id", "label"]
    many = as_dict(C.label_scores(units, centroids, "doc_id"), keys, "score")
    assert as_dict(few, keys, "score") == pytest.approx(many) and many


def test_entries_of_a_very_wide_vector(spark):
    rows = spark.createDataFrame([(1, [3, 1_000_000_000], [0.5, 2.0])], "id bigint, indices array<int>, values array<double>")
    assert S.with_vector(rows, 1_100_000_000).select(S.stored_values("features")).first()[0] == [0.5, 2.0]


def test_itemsets_are_found_once(spark):
    items = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a")], "basket_id bigint, item string")
    rules = U.rules_for(items, 0.5, "antecedent")
    assert "ExistingRDD" not in plan(rules)
    assert {(r["rest"][0], r["item"]): round(r["confidence"], 3) for r in rules.collect()} == {("a", "b"): 66.667, ("b", "a"): 100.0}


def test_hashed_rows_shuffle_features_once(spark, monkeypatch):
    rows = [(d, f"w{k}", 1.0 + d) for d in range(9) for k in range(d, 20)]
    features = spark.createDataFrame(rows, "doc_id bigint, feature string, value double")
    labels = spark.createDataFrame([(d, f"l{d % 2}") for d in [*range(8), 3]], "doc_id bigint, label string")
    plain = C.hashed_rows(features, "doc_id", 40).join(labels, "doc_id")
    made = []
    monkeypatch.setattr(C, "with_vector", lambda rows, size: made.append(plan(rows)) or S.with_vector(rows, size))
    found = C.hashed_rows(features, "doc_id", 40, labels=labels)
    assert made[0].count("Exchange hashpartitioning(doc_id") <= 2  # of the features, and of the labels
    got = lambda df: sorted((r["doc_id"], r["label"], r["indices"], r["values"], r["features"].size) for r in df.collect())
    assert got(found) == got(plain) and len(got(found)) == 9
