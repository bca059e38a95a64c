from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.functions.html import page_parts
from affinis.operators import block_cluster as B
from affinis.operators import cluster as K
from affinis.operators import text as X
from tests.conftest import as_dict

NINE = [(1, 1), (2, 1), (1, 2), (2, 2), (3, 3), (8, 8), (9, 8), (8, 9), (9, 9)]


@pytest.fixture(scope="module")
def nine(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate(NINE)]
    return spark.createDataFrame(rows, "id bigint, vector array<double>")


def test_kmeans_two_groups(nine):
    start = [(0, np.array([1.0, 1.0])), (1, np.array([9.0, 9.0]))]
    centres = K.kmeans(nine, start, "euclidean", 0.001, 10)
    assert [list(c) for _, c in centres] == [pytest.approx([1.8, 1.8]), pytest.approx([8.5, 8.5])]
    got = as_dict(K.assign(nine, centres), ["id"], "cluster_id")
    assert [got[i] for i in range(9)] == [0] * 5 + [1] * 4


@pytest.mark.parametrize("run", [K.kmeans, K.fuzzy_kmeans])
def test_partitions_without_points_move_no_centre(nine, run):
    """A large file's splits may hold no row group, and so no point."""
    start = K.seed_centres(nine, 3)
    want = dict(run(nine.coalesce(1), start, max_iter=2))
    got = dict(run(nine.coalesce(1).union(nine.filter("id < 0")), start, max_iter=2))
    for name, centre in want.items():
        assert list(got[name]) == pytest.approx(list(centre))


def test_kmeans_honours_k_and_keeps_empty_clusters(nine):
    centres = K.seed_centres(nine, 3)
    assert len(centres) == 3
    far = [(0, np.array([1.0, 1.0])), (1, np.array([500.0, 500.0]))]
    moved = dict(K.kmeans(nine, far, max_iter=2))
    assert list(moved[1]) == [500.0, 500.0]


def test_sparse_points_equal_dense(spark, nine):
    sparse = nine.select("id", F.array(F.lit(0), F.lit(1)).alias("indices"), F.col("vector").alias("values"))
    start = [(0, np.array([1.0, 1.0])), (1, np.array([9.0, 9.0]))]
    for measure in ("euclidean", "cosine", "tanimoto"):
        a = as_dict(K.assign(nine, start, measure), ["id"], "distance")
        b = as_dict(K.assign(sparse, start, measure, dim=2), ["id"], "distance")
        assert a == pytest.approx(b)


def test_points_without_a_vector(spark, nine):
    odd = [[None, 1.0], [float("nan"), 1.0], [1.0], None]
    rows = nine.unionByName(spark.createDataFrame([(90 + i, v) for i, v in enumerate(odd)], nine.schema)).repartition(2)
    start = [(0, np.array([1.0, 1.0])), (1, np.array([9.0, 9.0]))]
    for run in (K.kmeans, K.fuzzy_kmeans):
        for (_, a), (_, b) in zip(run(rows, start), run(nine, start), strict=True):
            assert list(a) == pytest.approx(list(b))
    got = {r["id"]: (r["cluster_id"], r["distance"]) for r in K.assign(rows, start).collect()}
    assert all(got[90 + i] == (0, None) for i in range(4)) and got[8] == (1, 0.0) and len(got) == 13
    assert [list(c) for _, c in K.seed_centres(rows, 20)] == [list(c) for _, c in K.seed_centres(nine, 20)]
    assert K.memberships(rows, start).count() == 18
    assert {r["id"] for r in B.dense_points(rows).collect()} == {*range(9), 92}
    found = as_dict(K.ml_kmeans(rows.filter("id <> 92"), 2), ["id"], "cluster_id")
    assert len(found) == 12 and all((found[i] is None) == (i >= 90) for i in found)


def test_memberships_sum_to_one(nine):
    start = [(0, np.array([1.0, 1.0])), (1, np.array([9.0, 9.0]))]
    rows = K.memberships(nine, start)
    sums = as_dict(rows.groupBy("id").agg(F.sum("weight").alias("s")), ["id"], "s")
    assert sums == pytest.approx({i: 1.0 for i in range(9)})
    assert rows.filter("id = 0 and cluster_id = 0").first()["weight"] == 1.0


def test_fuzzy_converges(nine):
    start = [(0, np.array([1.0, 1.0])), (1, np.array([9.0, 9.0]))]
    centres = dict(K.fuzzy_kmeans(nine, start))
    assert centres[0].max() < 3 and centres[1].min() > 7


@pytest.mark.parametrize(("t2", "batch"), [(1.5, 4), (1.5, 256), (0.01, 8), (50.0, 8)])
def test_canopies(spark, monkeypatch, t2, batch):
    monkeypatch.setattr(B, "BLOCK", 40)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.uniform(0, 10, 2)]) for i in range(120)]
    points = B.dense_points(spark.createDataFrame(rows, "id bigint, vector array<double>").repartition(3))
    centres = B.canopy_centres(points, t2, first_batch=batch)
    chosen = [r["id"] for r in centres.select("id").collect()]
    at = {i: np.array(v) for i, v in rows}
    gaps = {i: [np.linalg.norm(at[i] - at[c]) for c in chosen if c != i] for i in at}
    assert len(set(chosen)) == len(chosen)
    assert all(min(gaps[c], default=t2) >= t2 for c in chosen)
    assert all(i in chosen or min(gaps[i]) < t2 for i in at)
    assert B.canopy_means(points, centres, 2 * t2).count() == len(chosen)


def long_rows(spark, vectors):
    rows = [(i, k, float(v)) for i, x in enumerate(vectors) for k, v in enumerate(x)]
    return B.sparse_points(spark.createDataFrame(rows, "id bigint, k bigint, v double"), "id", "k", "v")


@pytest.mark.parametrize("measure", ["euclidean", "cosine", "tanimoto"])
def test_blocks_equal_one_matrix(spark, monkeypatch, measure):
    monkeypatch.setattr(B, "BLOCK", 7)
    monkeypatch.setattr(B, "_COLUMNS", 5)
    rng = np.random.default_rng(1)
    x = rng.random((30, 12)) * (rng.random((30, 12)) < 0.4)
    x[:, 0] += 0.1
    c = x[:9]
    want = K.distance_matrix(x, c, measure)
    got = as_dict(B.close_pairs(long_rows(spark, x), long_rows(spark, c), 9.0, measure), ["id", "centre_id"], "distance")
    assert len(got) == 270 and all(abs(d - want[i, k]) < 1e-7 for (i, k), d in got.items())
    best = as_dict(B.nearest(long_rows(spark, x), long_rows(spark, c), measure), ["id"], "cluster_id")
    assert best == dict(enumerate(np.argmin(np.round(want, 9), axis=1)))


def test_block_kmeans_equals_matrix_kmeans(spark, nine):
    start = [(0, np.array([1.0, 1.0])), (1, np.array([9.0, 9.0]))]
    points = B.dense_points(nine)
    centres = long_rows(spark, [v for _, v in start])
    want = dict(K.kmeans(nine, start))
    got = {r["id"]: r["values"] for r in B.kmeans(points, centres).collect()}
    assert all(np.allclose(got[i], want[i]) for i in want)
    want = dict(K.fuzzy_kmeans(nine, start, max_iter=2, delta=-1.0))
    got = {r["id"]: r["values"] for r in B.fuzzy_kmeans(points, centres, max_iter=2, delta=-1.0).collect()}
    assert all(np.allclose(got[i], want[i]) for i in want)


def test_intercluster_distance(spark):
    rows = [(0, 0, 1.0), (0, 1, 0.0), (1, 0, 0.0), (1, 1, 1.0), (2, 0, 1.0), (2, 1, 1.0)]
    row = K.intercluster_distance(spark.createDataFrame(rows, "c bigint, pos bigint, value double"), "c").first()
    d = 1 - 2**-0.5
    assert row["max_distance"] == pytest.approx(1.0) and row["min_distance"] == pytest.approx(d)
    assert row["scaled_mean"] == pytest.approx(((1 + 2 * d) / 3 - d) / (1 - d))


def test_intercluster_distance_without_a_common_dimension(spark):
    schema = "c bigint, pos bigint, value double"
    three = spark.createDataFrame([(0, 0, 1.0), (1, 1, 1.0), (2, 0, 1.0), (2, 1, 1.0)], schema)
    assert K.intercluster_distance(three, "c").first()["max_distance"] == pytest.approx(1.0)
    two = K.intercluster_distance(spark.createDataFrame([(0, 0, 1.0), (1, 1, 1.0)], schema), "c").first()
    assert two["max_distance"] == two["min_distance"] == 1.0 and two["scaled_mean"] is None
    one = K.intercluster_distance(spark.createDataFrame([(0, 0, 1.0)], schema), "c").first()
    assert one["max_distance"] is None


def test_stop_words_of_a_file(spark, tmp_path):
    (tmp_path / "stops").write_text("# words\nThe\n\n zoo \n")
    stops = X.read_stop_words(spark, str(tmp_path / "stops"))
    terms = spark.createDataFrame([("the", 1), ("zoo", 2), ("ox", 3)], "term string, n int")
    assert [r["term"] for r in X.without_listed(terms, "term", stops, "word").collect()] == ["ox"]


def words_of(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    return as_dict(X.message_words(df), ["word"], "n")


def test_message_words(spark):
    text = "From: ann bob\nOther: skip me\nSubject: re: zoo\n\nnot yet\n\n\nbody zoo 42\n"
    assert words_of(spark, text) == {"ann": 1, "bob": 1, "zoo": 2, "body": 1, "42": 1}
    assert words_of(spark, "\nall body") == {"all": 1, "body": 1}
    assert words_of(spark, "no blank pair\n\nhere") == {}
    # A header line inside the body counts twice, once as a value.
    assert words_of(spark, "\nKeywords: x1") == {"keywords": 1, "x1": 2}


def test_message_features(spark):
    text = "\n".join(["", *["zoo"] * 64])
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = as_dict(X.message_features(df), ["feature"], "value")
    assert got["intercept"] == 1.0 and got["line"] == 2.0
    assert got["log(line)"] == pytest.approx(np.log(66)) and got["body=zoo"] == pytest.approx(np.log(65))


def test_analyze(spark):
    df = spark.createDataFrame([(1, "The Zoo_x zoo, ZOO2 an ox it's été theory ABC")], "doc_id bigint, text string")
    assert as_dict(X.analyzed_tokens(df), ["token"], "n") == {"zoo": 1, "theory": 1, "abc": 1}


def test_sentence_terms_with_own_list(spark):
    df = spark.createDataFrame([(1, "Don't stop, the (69) Zoo a")], "id bigint, text string")
    got = as_dict(X.sentence_term_counts(df, ["id"], ["zoo"]), ["term"], "n")
    assert got == {"dont": 1, "stop": 1, "the": 1}
    assert as_dict(X.sentence_term_counts(df, ["id"], []), ["term"], "n")["zoo"] == 1


def test_bigrams_keep_only_collocations(spark):
    rows = [(i, "alpha beta " + " ".join(f"w{chr(97 + (i * 7 + j) % 26)}x" for j in range(6))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = X.bigrams(df)
    assert kept.filter("first = 'alpha' and second = 'beta'").first()["n"] == 60
    terms = X.term_table(df, kept)
    assert terms.filter("token = 'alpha beta'").count() == 60


def test_pages(spark):
    rows = [
        (1, "<html><head><title> A &amp; B </title><meta name='Author' content='Ann'></head><body><p>x</p> y"
            "<script>z</script></body></html>"),
        (2, "<p>no title"), (3, None), (4, "plain text"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, html string")
    got = {r["page_id"]: r for r in X.extract_pages(df).collect()}
    assert (got[1]["title"], got[1]["author"], got[1]["body"], got[1]["error"]) == ("A & B", "Ann", "x y", None)
    assert got[2]["title"] is None and got[2]["body"] == "no title"
    assert got[3]["error"] is not None and got[4]["body"] == "plain text"
    assert df.select(page_parts("html").alias("p")).count() == 4


def test_sentence_words(spark):
    df = spark.createDataFrame([(1, "Hello there. Good day!")], "doc_id bigint, text string")
    rows = [(r["sentence"], r["position"], r["word"]) for r in X.sentence_words(df).orderBy("sentence", "position").collect()]
    assert rows == [(0, 0, "Hello"), (0, 1, "there"), (1, 0, "Good"), (1, 1, "day")]


def test_words_of_a_text_are_not_shuffled_again(spark):
    rows = spark.createDataFrame([(i, "One two. Three four five.") for i in range(20)], "doc_id bigint, text string")
    said = X.sentence_words(rows).groupBy("doc_id", "sentence").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    assert said._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["n"] for r in said.collect()} == {3}
