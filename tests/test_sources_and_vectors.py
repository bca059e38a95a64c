from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from affinis.functions import vectors as M
from affinis.operators import classify as C
from affinis.operators import dictionary as D
from affinis.operators import hashing as H
from affinis.operators import rules as U
from affinis.sources import documents as docs
from affinis.sources import ratings as src
from affinis.sources import vectors as S
from tests.conftest import as_dict

LINE = "5351617$2.35 8002744$1.10 5354318$2.12"
A = {"1193": 5.0, "661": 3.0, "914": 3.0}
B = {"1357": 4.0, "647": 4.0, "661": 4.0}


@pytest.fixture(scope="module")
def maps(spark):
    return spark.createDataFrame([(A, B)], "a map<string,double>, b map<string,double>")


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_parse_map(spark):
    df = spark.createDataFrame([(LINE,)], "v string")
    m = S.parse_map("v")
    assert one(df, F.size(m)) == 3
    assert one(df, M.element(m, "5351617")) == 2.35
    assert one(df, M.element(M.unit(m), "5351617")) == pytest.approx(0.701, abs=0.01)


def test_repeated_key_keeps_the_last_weight(spark):
    df = spark.createDataFrame([(1, "x$1 y$2 x$3"), (2, "x$9 x$1")], "id bigint, v string")
    assert as_dict(S.parse_weighted(df, "id", "v"), ["id", "key"], "weight") == {
        (1, "x"): 3.0, (1, "y"): 2.0, (2, "x"): 1.0,
    }
    assert one(df.filter("id = 1"), S.parse_map("v")) == {"x": 3.0, "y": 2.0}


def test_parse_weighted_normalised(spark):
    df = spark.createDataFrame([(1, LINE)], "id bigint, v string")
    rows = as_dict(S.parse_weighted(df, "id", "v", normalize=True), ["key"], "weight")
    assert rows["5351617"] == pytest.approx(0.701, abs=0.01) and len(rows) == 3


def test_map_functions(maps):
    a, b = F.col("a"), F.col("b")
    assert one(maps, M.element(a, "41")) == 0.0
    assert one(maps, M.element(a, "1193")) == 5.0
    assert one(maps, F.size(a)) == 3
    assert one(maps, M.map_norm(a)) == pytest.approx(6.557, abs=0.01)
    assert one(maps, M.map_dot(a, b)) == 12.0
    assert one(maps, M.map_cosine(a, b)) == pytest.approx(0.264, abs=0.01)
    assert one(maps, M.element(M.times(a, 2.0), "661")) == 6.0
    assert one(maps, M.element(M.divide(a, 2.0), "661")) == 1.5


def test_equal_products_all_count(spark):
    df = spark.createDataFrame([({"x": 2.0, "y": 2.0}, {"x": 3.0, "y": 3.0})], "a map<string,double>, b map<string,double>")
    assert one(df, M.map_dot(F.col("a"), F.col("b"))) == 12.0


def test_centroid(spark):
    total = {"3421": 2.0, "164": 4.0, "914": 2.0}
    df = spark.createDataFrame([(A, B, total)], "a map<string,double>, b map<string,double>, c map<string,double>")
    mean = M.divide(M.add(M.add(F.col("a"), F.col("b")), F.col("c")), 3.0)
    assert one(df, F.size(mean)) == 7
    assert one(df, M.element(mean, "1193")) == pytest.approx(1.667, abs=0.01)


def test_label_centroids_and_tags(spark):
    vectors = spark.createDataFrame(
        [(1, "x", 3.0), (1, "y", 4.0), (2, "x", 1.0), (3, "z", 2.0)], "id bigint, key string, weight double"
    )
    labels = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q"), (4, "q")], "id bigint, label string")
    vectors = C.unit_vectors(vectors, "id")
    cents = C.label_centroids(vectors, labels, "id")
    assert as_dict(cents, ["label", "key"], "weight") == pytest.approx(
        {("p", "x"): 0.8, ("p", "y"): 0.4, ("q", "z"): 1.0}
    )
    tagged = C.autotag(vectors, cents, "id")
    assert as_dict(tagged, ["id", "label"], "pct") == pytest.approx({(1, "p"): 100.0, (2, "p"): 100.0, (3, "q"): 100.0})
    row = C.hit_rate(tagged, labels, "id").first()
    assert (row["correct"], row["total"], row["accuracy"]) == (3, 4, 75.0)


def test_centroid_files(spark, tmp_path):
    cents = spark.createDataFrame([("p", "x", 3.0), ("p", "y", 4.0)], "label string, key string, weight double")
    S.save_centroids(cents, str(tmp_path / "c"))
    assert as_dict(S.load_centroids(spark, str(tmp_path / "c")), ["key"], "weight") == pytest.approx({"x": 0.6, "y": 0.8})


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return str(path)


def test_load_ratings_skips_bad_lines(spark, tmp_path):
    path = write(str(tmp_path / "r.csv"), "1,101,5.0\n\n2,102,3.5\nx,1,2\n3,104\n")
    assert sorted(tuple(r) for r in src.load_ratings(spark, path).collect()) == [(1, 101, 5.0), (2, 102, 3.5)]
    assert src.rejected_ratings(spark, path).first()["rejected"] == 2


def test_tags_and_titles_keep_commas(spark, tmp_path):
    path = write(str(tmp_path / "t.csv"), "1,Dark City, part two\n2,plain\n\n")
    assert as_dict(src.load_titles(spark, path), ["item_id"], "title") == {1: "Dark City, part two", 2: "plain"}
    assert src.load_tags(spark, path).count() == 2
    results = spark.createDataFrame([(2, 0.5)], "item_id bigint, score double")
    assert src.with_titles(results, src.load_titles(spark, path)).first()["title"] == "plain"


def test_artist_tags(spark, tmp_path):
    text = "u1<sep>a<sep>rock<sep>3\nu2<sep>a<sep>rock<sep>4\nu3<sep>b<sep>rock\nu4<sep>b<sep>pop<sep>1<sep>9\n"
    rows, counts = src.load_artist_tags(spark, write(str(tmp_path / "l.txt"), text))
    assert rows.count() == 2
    assert tuple(counts.first()) == (4, 2)


def test_overlay(spark, intro):
    changes = spark.createDataFrame(
        [(1, "set", 1, 101, 1.0), (2, "remove", 1, 102, None), (3, "set", 9, 101, 2.0), (4, "set", 1, 101, 4.5),
         (5, "remove", 8, 8, None)],
        "seq bigint, op string, user_id bigint, item_id bigint, rating double",
    )
    got = as_dict(src.apply_overlay(intro, changes), ["user_id", "item_id"], "rating")
    assert got[(1, 101)] == 4.5 and (1, 102) not in got and got[(9, 101)] == 2.0 and len(got) == 21


def test_labelled_docs(spark, tmp_path):
    write(str(tmp_path / "d" / "sport" / "1"), "one\ntwo\n")
    write(str(tmp_path / "d" / "sport" / "2"), "three")
    write(str(tmp_path / "d" / "news" / "1"), "four")
    df = docs.load_labelled_docs(spark, str(tmp_path / "d"))
    assert sorted((r["label"], r["text"]) for r in df.collect()) == [
        ("news", "four"), ("sport", "one two"), ("sport", "three"),
    ]
    assert as_dict(docs.docs_per_label(df), ["label"], "docs") == {"news": 1, "sport": 2}


def test_raw_files(spark, tmp_path):
    write(str(tmp_path / "f" / "a.HTML"), "x")
    write(str(tmp_path / "f" / "deep" / "b.docx"), "x")
    write(str(tmp_path / "f" / "deep" / "c.unknown"), "x")
    df = docs.load_raw_files(spark, str(tmp_path / "f"))
    assert sorted(r["type"] for r in df.collect()) == ["html", "msword", "undef"]
    assert docs.load_raw_files(spark, str(tmp_path / "f"), "*.docx").count() == 1


def test_header_table_and_hashing(spark, tmp_path):
    path = write(str(tmp_path / "p.csv"), '"x","y","shape"\n0.5,1,"21"\n0.25,2,"22"\n')
    df = docs.read_table(spark, path, "x double, y double, shape string").withColumn("id", F.monotonically_increasing_id())
    rows = df.select("id", F.inline(F.array(H.continuous("x", "x"), H.categorical("shape", "shape"))))
    hashed = H.hash_features(rows, "id", 40, 2)
    assert hashed.filter("slot < 0 or slot >= 40").count() == 0
    assert hashed.agg(F.sum("value")).first()[0] == pytest.approx(2 * (0.75 + 2))


def test_vector_files(spark, tmp_path):
    named = spark.createDataFrame(
        [("small round green apple", [0.11, 510.0, 1.0]), ("large oval red apple", [0.23, 650.0, 3.0])],
        "name string, vector array<double>",
    )
    S.write_vectors(named, str(tmp_path / "v"))
    assert sorted(map(tuple, S.read_vectors(spark, str(tmp_path / "v")).collect())) == sorted(map(tuple, named.collect()))


def test_dictionary_is_dense_and_sorted(spark):
    df = spark.range(1000).select(F.format_string("v%03d", F.col("id") % 300).alias("v")).repartition(7)
    got = as_dict(D.dictionary(df, "v"), ["v"], "id")
    assert [v for v, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(got) and sorted(got.values()) == list(range(300))


def test_number_lines(spark, tmp_path):
    path = write(str(tmp_path / "n.txt"), "".join(f"line {i}\n" for i in range(50)))
    got = as_dict(S.number_lines(spark, path), ["line_no"], "value")
    assert got == {i: f"line {i}" for i in range(50)}


def test_sparse_export(spark, tmp_path):
    vectors = spark.createDataFrame([(1, "b", 3.0), (1, "a", 4.0), (2, "c", 1.0)], "id bigint, key string, weight double")
    labels = spark.createDataFrame([(1, "y"), (2, "x")], "id bigint, label string")
    rows, label_ids, feature_ids = S.export_sparse(labels, vectors, "id")
    assert as_dict(label_ids, ["label"], "label_id") == {"x": 0, "y": 1}
    assert as_dict(rows, ["id", "index"], "value") == {(1, 0): 0.8, (1, 1): 0.6, (2, 2): 1.0}
    S.write_sparse(rows, feature_ids.count(), str(tmp_path / "s"), "id")
    back = spark.read.format("libsvm").option("numFeatures", 3).load(str(tmp_path / "s"))
    assert sorted((r["label"], tuple(r["features"].toArray())) for r in back.collect()) == [
        (0.0, (0.0, 0.0, 1.0)), (1.0, (0.8, 0.6, 0.0)),
    ]


def test_transactions(spark):
    df = spark.createDataFrame([(1, LINE), (2, None)], "id bigint, v string")
    rows = S.keys_only(df, "id", "v").collect()
    assert [(r["id"], r["items"]) for r in rows] == [(1, ["5351617", "8002744", "5354318"])]


def test_rules(spark, tmp_path):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "c")]
    items = spark.createDataFrame(rows, "basket_id bigint, item string")
    rules = U.rules_for(items, 0.5).collect()
    got = {(tuple(r["rest"]), r["item"]): (r["support"], r["confidence"]) for r in rules}
    assert got[(("b",), "a")] == pytest.approx((50.0, 200 / 3)) and got[(("a",), "b")] == pytest.approx((50.0, 100.0))
    other = U.rules_for(items, 0.5, "antecedent").collect()
    got = {(tuple(r["rest"]), r["item"]): r["confidence"] for r in other}
    assert got[(("b",), "a")] == pytest.approx(100.0)
    U.write_rules(U.rules_for(items, 0.5), str(tmp_path / "rules"))
    text = sorted(r["value"] for r in spark.read.text(str(tmp_path / "rules")).collect())
    assert text[0] == '50.000,100.000,a => b'


def test_logistic_model_files(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, f"w{i % 2}", 1.0) for i in range(40)], "id bigint, feature string, value double"
    )
    hashed = C.hashed_rows(rows, "id", 16).withColumn("label", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    indexer, model = C.train_logistic(hashed, (0.001,), 10)
    C.save_classifier(indexer, model, str(tmp_path / "m"))
    again = C.apply_logistic(hashed, *C.load_classifier(str(tmp_path / "m")))
    assert again.filter("label = predicted").count() == 40


def test_labelled_folders_are_listed_not_their_files(spark, tmp_path):
    for label in ("x", "y"):
        (tmp_path / label).mkdir()
        for i in range(5):
            (tmp_path / label / f"{i}.txt").write_text(f"{label}{i}\n")
    (tmp_path / "beside.txt").write_text("in no folder")
    df = docs.load_labelled_docs(spark, str(tmp_path))
    assert "InMemoryFileIndex(2 paths)" in df._jdf.queryExecution().executedPlan().toString()
    assert {(r["label"], r["text"]) for r in df.collect()} == {(x, f"{x}{i}") for x in "xy" for i in range(5)}
