"""Queries and oracles over vectors, clusters, classifiers and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions import vectors as M
from affinis.functions.numbers import rounded
from affinis.operators import block_cluster as B
from affinis.operators import classify as C
from affinis.operators import cluster as K
from affinis.operators import evaluate as E
from affinis.operators import hashing as H
from affinis.operators import rules as U
from affinis.operators import text as X
from affinis.operators.dictionary import dictionary, encode
from affinis.operators.joins import grid_join
from affinis.operators.sampling import hash_below
from affinis.plans import text_queries  # noqa: F401  (defines token views of the oracle)
from affinis.plans import views as V
from affinis.plans.sql import define, r6, top, with_
from affinis.session import by_id, cut_lineage, scratch_path
from affinis.sources import ratings as src
from affinis.sources import vectors as S

K_CENTRES = 5
T2 = 1.4
MIN_SUPPORT = 0.01
TRAIN_SHARE = 0.7


def vector_lines(spark, sf):
    """Text lines ``token$count ...`` of the documents that have a token."""
    counts = X.analyzed_tokens(V.docs(spark, sf))
    piece = F.concat("token", F.lit("$"), F.col("n").cast("string"))
    return counts.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(piece)), " ").alias("value"))


def doc_vectors(spark, sf):
    """``(doc_id, key, weight)`` token counts."""
    counts = X.analyzed_tokens(V.docs(spark, sf))
    return counts.select("doc_id", F.col("token").alias("key"), F.col("n").cast("double").alias("weight"))


def doc_labels(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))


def sparse_vectors(spark, sf):
    return S.parse_weighted(vector_lines(spark, sf), "doc_id", "value")


def labelled_vectors(spark, sf):
    rows = S.parse_weighted(vector_lines(spark, sf), "doc_id", "value", normalize=True)
    return rows.join(doc_labels(spark, sf), "doc_id").select("doc_id", "label", "key", rounded("weight").alias("weight"))


def map_vector_ops(spark, sf):
    """Each document's map vector against that of the document with the next id."""
    maps = cut_lineage(vector_lines(spark, sf).select("doc_id", S.parse_map("value").alias("m")))
    after = maps.select((F.col("doc_id") - 1).alias("doc_id"), F.col("m").alias("o"))
    m, o = F.col("m"), F.col("o")
    return maps.join(after, "doc_id").select(
        "doc_id",
        F.size(m).cast("bigint").alias("n_keys"),
        M.element(m, "ing").alias("element"),
        rounded(M.map_norm(m)).alias("norm"),
        rounded(M.element(M.unit(m), "ing")).alias("unit_element"),
        F.size(M.add(m, o)).cast("bigint").alias("n_union"),
        M.element(M.add(m, M.times(o, 2.0)), "ing").alias("sum_element"),
        M.map_dot(m, o).alias("dot"),
        rounded(M.map_cosine(m, o)).alias("cosine"),
    )


def vector_roundtrip(spark, sf):
    path = scratch_path(spark, "vectors")
    S.write_vectors(V.points(spark, sf).select(F.col("id").cast("string").alias("name"), "vector"), path)
    return S.read_vectors(spark, path).select("name", F.posexplode("vector").alias("pos", "value")).select(
        "name", F.col("pos").cast("bigint").alias("pos"), rounded("value").alias("value")
    )


def sparse_export(spark, sf):
    rows, _, _ = S.export_sparse(doc_labels(spark, sf), doc_vectors(spark, sf), "doc_id")
    return rows.withColumn("value", rounded("value"))


def delimited_rejects(spark, sf):
    return src.count_lines(V.artist_lines(spark, sf))


def artist_dictionary(spark, sf):
    return dictionary(src.artist_tags(V.artist_lines(spark, sf)), "artist")


def artist_vectors(spark, sf):
    """``(tag, artist_id, weight)``: the summed counts of each tag's artists."""
    rows = cut_lineage(src.artist_tags(V.artist_lines(spark, sf)))
    sums = rows.groupBy("tag", "artist").agg(F.sum("weight").alias("weight"))
    return encode(sums, dictionary(rows, "artist", "artist_id"), "artist").select("tag", "artist_id", "weight")


def vector_distances(spark, sf):
    points = V.points(spark, sf)
    means = K.group_means(points, "label").groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("p")
    ).select("label", F.col("p.value").alias("mean"))
    joined = points.join(means, "label")
    return joined.select("id", *[
        rounded(distance(F.col("vector"), F.col("mean"))).alias(name) for name, distance in M.DISTANCES.items()
    ])


def canopy_centers(spark, sf):
    """For every point: is a canopy centre nearer than T2, and if it is one itself, is no other that near?"""
    every = V.points(spark, sf)
    points = cut_lineage(B.dense_points(every))
    centres = B.canopy_centres(points, T2)
    near = B.close_pairs(points, centres, T2, "euclidean").groupBy("id").agg(
        F.count("*").alias("near"), F.count_if(F.col("id") == F.col("centre_id")).alias("own")
    )
    apart = (F.col("own") == 0) | (F.col("near") == 1)
    return every.join(near, "id", "left").select(
        "id", (F.coalesce("near", F.lit(0)) > 0).alias("covered"), F.coalesce(apart, F.lit(True)).alias("apart")
    )


def kmeans_fixed_iters(spark, sf):
    points = V.points(spark, sf).select("id", "vector")
    centres = K.kmeans(points, K.seed_centres(points, K_CENTRES), "euclidean", delta=-1.0, max_iter=2)
    return K.assign(points, centres).withColumn("distance", rounded("distance"))


def fuzzy_kmeans_step(spark, sf):
    points = V.points(spark, sf).select("id", "vector")
    centres = K.fuzzy_kmeans(points, K.seed_centres(points, K_CENTRES), max_iter=1)
    return K.centre_table(points, centres).select("cluster_id", F.posexplode("vector").alias("pos", "value")).select(
        "cluster_id", F.col("pos").cast("bigint").alias("pos"), rounded("value").alias("value")
    )


def intercluster_distance(spark, sf):
    stats = K.intercluster_distance(K.group_means(V.points(spark, sf), "label"), "label")
    return stats.select(*[rounded(c).alias(c) for c in stats.columns])


def intercluster_distance_sparse(spark, sf):
    """Centroids of the documents' sources and languages; not all of them share a word."""
    labels = V.table(spark, sf, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("label"))
    units = C.unit_vectors(doc_vectors(spark, sf), "doc_id", labels)
    rows = C.label_centroids(units, labels, "doc_id")
    stats = K.intercluster_distance(rows.select("label", F.col("key").alias("pos"), F.col("weight").alias("value")), "label")
    return stats.select(*[rounded(c).alias(c) for c in stats.columns])


def kmeans_ml(spark, sf):
    """Every point once, in one of the k clusters."""
    found = K.ml_kmeans(V.points(spark, sf), 10)
    return found.select("id", F.coalesce(F.col("cluster_id").between(0, 9), F.lit(False)).alias("valid"))


def _text_points(spark, sf):
    """Documents as unit TF-IDF rows over all words and collocations."""
    docs = V.docs(spark, sf)
    counts = cut_lineage(X.term_table(docs, X.bigrams(docs)))
    weights = cut_lineage(X.doc_tfidf(counts, docs))
    ids = dictionary(weights, "token", "index")
    return cut_lineage(B.sparse_points(encode(weights, ids, "token"), "doc_id", "index", "weight"))


def _clustered(points, centres):
    """Per point: is its centre as near as the nearest of them?

    Found by the cells, checked by a join on the words and sums: a centre without a common word is at distance 1.
    """
    found = cut_lineage(B.nearest(points, centres, "tanimoto"))
    words = points.select("id", "norm2", F.inline(F.arrays_zip("indices", "values"))).toDF("id", "pp", "key", "x")
    theirs = centres.select("id", "norm2", F.inline(F.arrays_zip("indices", "values"))).toDF("centre", "cc", "key", "y")
    dots = grid_join(words, theirs, ["key"], "id", "centre").groupBy("id", "centre").agg(
        F.sum(F.col("x") * F.col("y")).alias("dot"), F.max("pp").alias("pp"), F.max("cc").alias("cc")
    )
    distance = 1 - F.col("dot") / (F.col("pp") + F.col("cc") - F.col("dot"))
    least = dots.groupBy("id").agg(F.least(F.min(distance), F.lit(1.0)).alias("least"))
    checked = found.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(1.0)))
    return checked.select("id", (F.abs(F.col("distance") - F.col("least")) < 1e-6).alias("nearest"))


def text_clusters(spark, sf):
    """Words and collocations, TF-IDF, canopies by Tanimoto distance, k-means from the canopies' means."""
    points = _text_points(spark, sf)
    start = B.canopy_means(points, B.canopy_centres(points, 0.9, "tanimoto"), 0.9, "tanimoto")
    return _clustered(points, B.kmeans(points, start, "tanimoto", 0.01, 20))


def text_clusters_fuzzy(spark, sf):
    """As ``text_clusters``, with fuzzy k-means and Euclidean canopies."""
    points = _text_points(spark, sf)
    start = B.canopy_means(points, B.canopy_centres(points, 1.38, "euclidean"), 1.38, "euclidean")
    return _clustered(points, B.fuzzy_kmeans(points, start, "tanimoto", 2.0, 0.01, 20))


def label_centroids(spark, sf):
    labels = doc_labels(spark, sf)
    units = C.unit_vectors(doc_vectors(spark, sf), "doc_id", labels)
    rows = C.label_centroids(units, labels, "doc_id")
    return rows.withColumn("weight", rounded("weight"))


def _tagged(spark, sf):
    labels = doc_labels(spark, sf)
    units = C.unit_vectors(doc_vectors(spark, sf), "doc_id", labels)
    return C.autotag(units, C.label_centroids(units, labels, "doc_id"), "doc_id")


def autotag_top3(spark, sf):
    return _tagged(spark, sf).withColumn("pct", rounded("pct"))


def autotag_accuracy(spark, sf):
    rate = C.hit_rate(_tagged(spark, sf), doc_labels(spark, sf), "doc_id")
    return rate.withColumn("accuracy", rounded("accuracy"))


def classifier_accuracy(spark, sf):
    rows = V.table(spark, sf, "labels").select("quality", (1 - F.col("toxic")).alias("predicted"))
    return E.accuracy(rows, "quality", "predicted").withColumn("accuracy", rounded("accuracy"))


def feature_hash(spark, sf):
    """Numbers, categories and name words of the parts in 40 slots with 2 probes."""
    part = V.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", "p_size", "p_brand", "p_type")
    part = by_id(part, "p_partkey", 50_000)
    named = F.transform(F.split("p_name", " "), lambda w: H.categorical("word", w))
    fixed = F.array(
        H.continuous("price", "p_retailprice"), H.continuous("size", "p_size"),
        H.categorical("brand", "p_brand"), H.categorical("type", "p_type"),
    )
    rows = part.select(F.col("p_partkey").alias("id"), F.inline(F.concat(fixed, named)))
    return H.hash_features(rows, "id", 40, 2).withColumn("value", rounded("value"))


def logreg_accuracy(spark, sf):
    messages = V.messages(spark, sf)
    labelled = C.hashed_rows(X.message_features(messages), "doc_id", 10_000, labels=doc_labels(spark, sf))
    train, test = _parts(labelled)
    indexer, model = C.train_logistic(train)
    return _beats_majority(C.apply_logistic(test, indexer, model), "label", "predicted")


def _parts(labelled):
    """Training and held-out rows by a hash of the id."""
    train = hash_below(["doc_id"], TRAIN_SHARE)
    return labelled.filter(train), labelled.filter(~train)


def _beats_majority(scored, label, predicted):
    """Held-out rows, and whether as many are right as always saying the most frequent label would get."""
    scored = cut_lineage(scored.select(label, predicted))
    most = scored.groupBy(label).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).scalar()
    report = E.accuracy(scored, label, predicted)
    return report.select("total", (F.col("correct") >= most).alias("beats_majority"))


def _labelled_terms(spark, sf):
    labels = V.table(spark, sf, "labels").select("doc_id", "quality")
    docs = V.docs(spark, sf).join(labels, "doc_id")
    return labels, cut_lineage(X.sentence_term_counts(docs, ["doc_id"]))


def sentence_vectors(spark, sf):
    """Conversation turns as vectors over the vocabulary of the labelled documents."""
    _, terms = _labelled_terms(spark, sf)
    turns = X.sentence_term_counts(V.table(spark, sf, "conversations"), ["conv_id", "turn"])
    vocabulary = terms.select("term").distinct()
    return C.sentence_vectors(turns, vocabulary, ["conv_id", "turn"]).withColumn("value", rounded("value"))


def svm_accuracy(spark, sf):
    labels, terms = _labelled_terms(spark, sf)
    rows, size = C.linear_features(terms, "doc_id")
    quality = labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    labelled = S.with_vector(rows.join(quality, "doc_id"), size)
    train, test = _parts(labelled)
    scored = cut_lineage(C.train_svm(train, size=size).transform(test))
    auc = E.area_under_curve(scored, "label", "rawPrediction")
    return _beats_majority(scored, "label", "prediction").withColumn("auc_above_half", F.lit(auc > 0.5))


def baskets(spark, sf):
    return U.baskets(V.basket_items(spark, sf)).select("basket_id", F.array_join("items", ";").alias("items"))


def item_frequency(spark, sf):
    return U.item_frequency(V.basket_items(spark, sf))


def frequent_itemsets(spark, sf):
    sets = U.frequent_itemsets(V.basket_items(spark, sf), MIN_SUPPORT)
    return sets.select(F.array_join("items", ";").alias("items"), "freq")


def _rules(confidence):
    def query(spark, sf):
        rules = U.rules_for(V.basket_items(spark, sf), MIN_SUPPORT, confidence)
        return rules.select(
            F.array_join("rest", "; ").alias("rest"), "item", rounded("support").alias("support"),
            rounded("confidence").alias("confidence"),
        )

    return query


QUERIES = {
    "sparse_vectors": sparse_vectors,
    "labelled_vectors": labelled_vectors,
    "map_vector_ops": map_vector_ops,
    "vector_roundtrip": vector_roundtrip,
    "sparse_export": sparse_export,
    "delimited_rejects": delimited_rejects,
    "artist_dictionary": artist_dictionary,
    "artist_vectors": artist_vectors,
    "vector_distances": vector_distances,
    "canopy_centers": canopy_centers,
    "kmeans_fixed_iters": kmeans_fixed_iters,
    "fuzzy_kmeans_step": fuzzy_kmeans_step,
    "intercluster_distance": intercluster_distance,
    "intercluster_distance_sparse": intercluster_distance_sparse,
    "kmeans_ml": kmeans_ml,
    "text_clusters": text_clusters,
    "text_clusters_fuzzy": text_clusters_fuzzy,
    "label_centroids": label_centroids,
    "autotag_top3": autotag_top3,
    "autotag_accuracy": autotag_accuracy,
    "classifier_accuracy": classifier_accuracy,
    "feature_hash": feature_hash,
    "logreg_accuracy": logreg_accuracy,
    "sentence_vectors": sentence_vectors,
    "svm_accuracy": svm_accuracy,
    "baskets": baskets,
    "item_frequency": item_frequency,
    "frequent_itemsets": frequent_itemsets,
    "association_rules": _rules("consequent"),
    "association_rules_antecedent": _rules("antecedent"),
}

# ---------------------------------------------------------------- oracle

define(
    "unit_tokens",
    """
    SELECT t.doc_id, lang AS label, token AS key, n / norm AS w FROM doc_tokens t
    JOIN (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM doc_tokens GROUP BY 1) x ON x.doc_id = t.doc_id
    JOIN documents d ON d.doc_id = t.doc_id""",
    "doc_tokens",
)
define(
    "centroids",
    """
    SELECT label, key, sum(w) / k AS weight FROM unit_tokens
    JOIN (SELECT label, count(DISTINCT doc_id) AS k FROM unit_tokens GROUP BY 1) USING (label)
    GROUP BY label, key, k""",
    "unit_tokens",
)
define(
    "tagged",
    top(
        """(SELECT doc_id, label, score * 100 / total AS pct FROM scores
            JOIN (SELECT doc_id, sum(score) AS total FROM scores GROUP BY 1) USING (doc_id)
            WHERE total > 0 AND score * 100 / total > 5)""",
        "doc_id", "pct", "label", 3, "doc_id, label, pct",
    ),
    "scores",
)
define(
    "scores",
    """
    SELECT u.doc_id, c.label, sum(u.w * c.weight / norm) AS score FROM unit_tokens u
    JOIN centroids c ON c.key = u.key
    JOIN (SELECT label, sqrt(sum(weight * weight)) AS norm FROM centroids GROUP BY 1) n ON n.label = c.label
    GROUP BY 1, 2""",
    "unit_tokens", "centroids",
)
define(
    "quads",
    """
    SELECT p_brand AS artist, o_orderpriority AS tag, l_quantity AS weight, l_linenumber <> 7 AS good
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)
define("points", "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings")
define(
    "c0",
    f"""
    SELECT row_number() OVER (ORDER BY h, id) - 1 AS cid, v FROM (
      SELECT id, v, md5('0:' || id) AS h FROM points ORDER BY h, id LIMIT {K_CENTRES})""",
    "points",
)


def _assigned(centres):
    return f"""
      SELECT id, v, cid, d FROM (
        SELECT p.id, p.v, c.cid, list_distance(p.v, c.v) AS d,
               row_number() OVER (PARTITION BY p.id ORDER BY round(list_distance(p.v, c.v), 9), c.cid) AS rn
        FROM points p, {centres} c) WHERE rn = 1"""


_MEANS = """
    SELECT cid, list(m ORDER BY pos) AS v FROM (
      SELECT cid, pos, avg(x) AS m FROM (
        SELECT cid, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {source}) GROUP BY 1, 2) GROUP BY 1"""
define(
    "label_means",
    """
    SELECT label, list(m ORDER BY pos) AS v FROM (
      SELECT label, pos, avg(x) AS m FROM (
        SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM points) GROUP BY 1, 2) GROUP BY 1""",
    "points",
)
define("basket_rows", "SELECT DISTINCT l_orderkey AS basket_id, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey")
define("basket_count", "SELECT count(DISTINCT basket_id) AS n FROM basket_rows", "basket_rows")
define("item_freq", "SELECT item, count(*) AS freq FROM basket_rows GROUP BY 1", "basket_rows")
define(
    "two_sets",
    f"""
    SELECT a.item AS x, b.item AS y, count(*) AS freq FROM basket_rows a
    JOIN basket_rows b ON a.basket_id = b.basket_id AND a.item < b.item GROUP BY 1, 2
    HAVING count(*) >= {MIN_SUPPORT} * (SELECT n FROM basket_count)""",
    "basket_rows", "basket_count",
)
define(
    "three_sets",
    f"""
    SELECT a.item AS x, b.item AS y, c.item AS z, count(*) AS freq FROM basket_rows a
    JOIN basket_rows b ON a.basket_id = b.basket_id AND a.item < b.item
    JOIN basket_rows c ON a.basket_id = c.basket_id AND b.item < c.item GROUP BY 1, 2, 3
    HAVING count(*) >= {MIN_SUPPORT} * (SELECT n FROM basket_count)""",
    "basket_rows", "basket_count",
)


define(
    "all_sets",
    """
    SELECT item AS items, freq FROM item_freq
    UNION ALL SELECT x || '; ' || y, freq FROM two_sets
    UNION ALL SELECT x || '; ' || y || '; ' || z, freq FROM three_sets""",
    "item_freq", "two_sets", "three_sets",
)
define(
    "split_sets",
    """
    SELECT x AS rest, y AS item, freq FROM two_sets UNION ALL SELECT y, x, freq FROM two_sets
    UNION ALL SELECT x || '; ' || y, z, freq FROM three_sets
    UNION ALL SELECT x || '; ' || z, y, freq FROM three_sets
    UNION ALL SELECT y || '; ' || z, x, freq FROM three_sets""",
    "two_sets", "three_sets",
)


def _rules_sql(base):
    return with_(
        ["all_sets", "split_sets", "basket_count"],
        f"""
        SELECT rest, r.item, {r6('100e0 * r.freq / n', 'support')}, {r6('100e0 * r.freq / f.freq', 'confidence')}
        FROM split_sets r JOIN all_sets f ON f.items = r.{base}, basket_count""",
    )


_SLOT = "CAST('0x' || substr(md5(probe || ':' || feature), 1, 8) AS BIGINT) % 40"

ORACLE = {
    "sparse_vectors": with_(
        ["doc_tokens"], "SELECT doc_id, token AS key, CAST(n AS DOUBLE) AS weight FROM doc_tokens"
    ),
    "labelled_vectors": with_(["unit_tokens"], f"SELECT doc_id, label, key, {r6('w', 'weight')} FROM unit_tokens"),
    "map_vector_ops": with_(
        ["doc_tokens"],
        f"""
        SELECT a.doc_id, a.k AS n_keys, a.e AS element, {r6('sqrt(a.ss)', 'norm')}, {r6('a.e / sqrt(a.ss)', 'unit_element')},
               a.k + b.k - coalesce(p.k, 0) AS n_union, a.e + 2 * b.e AS sum_element, coalesce(p.dot, 0e0) AS dot,
               {r6('coalesce(p.dot, 0e0) / (sqrt(a.ss) * sqrt(b.ss))', 'cosine')}
        FROM s a JOIN s b ON b.doc_id = a.doc_id + 1 LEFT JOIN p ON p.doc_id = a.doc_id""",
        {
            "s": "SELECT doc_id, count(*) AS k, CAST(sum(n * n) AS DOUBLE) AS ss, "
                 "CAST(coalesce(sum(n) FILTER (token = 'ing'), 0) AS DOUBLE) AS e FROM doc_tokens GROUP BY 1",
            "p": "SELECT a.doc_id, count(*) AS k, CAST(sum(a.n * b.n) AS DOUBLE) AS dot FROM doc_tokens a "
                 "JOIN doc_tokens b ON b.doc_id = a.doc_id + 1 AND a.token = b.token GROUP BY 1",
        },
    ),
    "vector_roundtrip": f"""
        SELECT name, pos, {r6('x', 'value')} FROM (
          SELECT CAST(vec_id AS VARCHAR) AS name, unnest(embedding) AS x,
                 CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos FROM embeddings)""",
    "sparse_export": with_(
        ["unit_tokens"],
        f"""
        SELECT doc_id, label_id, idx AS index, {r6('w', 'value')} FROM unit_tokens
        JOIN (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx FROM (SELECT DISTINCT key FROM unit_tokens)) USING (key)
        JOIN (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM
              (SELECT DISTINCT lang AS label FROM documents)) USING (label)""",
    ),
    "delimited_rejects": with_(
        ["quads"], "SELECT count(*) AS lines, count(*) FILTER (NOT good) AS rejected FROM quads"
    ),
    "artist_dictionary": with_(
        ["quads"],
        "SELECT artist, row_number() OVER (ORDER BY artist) - 1 AS id FROM (SELECT DISTINCT artist FROM quads WHERE good)",
    ),
    "artist_vectors": with_(
        ["quads"],
        """
        SELECT tag, artist_id, sum(weight) AS weight FROM quads
        JOIN (SELECT artist, row_number() OVER (ORDER BY artist) - 1 AS artist_id FROM
              (SELECT DISTINCT artist FROM quads WHERE good)) USING (artist) WHERE good GROUP BY 1, 2""",
    ),
    "vector_distances": with_(
        ["points", "label_means"],
        f"""
        SELECT id, {r6('list_distance(p.v, m.v)', 'euclidean')},
               {r6('1e0 - list_dot_product(p.v, m.v) / (sqrt(list_dot_product(p.v, p.v)) * sqrt(list_dot_product(m.v, m.v)))', 'cosine')},
               {r6('1e0 - list_dot_product(p.v, m.v) / (list_dot_product(p.v, p.v) + list_dot_product(m.v, m.v) - list_dot_product(p.v, m.v))', 'tanimoto')}
        FROM points p JOIN label_means m USING (label)""",
    ),
    "canopy_centers": "SELECT vec_id AS id, true AS covered, true AS apart FROM embeddings",
    **{
        name: with_(["doc_weights"], "SELECT DISTINCT doc_id AS id, true AS nearest FROM doc_weights WHERE w > 0")
        for name in ("text_clusters", "text_clusters_fuzzy")
    },
    "kmeans_fixed_iters": with_(
        ["points", "c0"],
        f"SELECT id, cid AS cluster_id, {r6('d', 'distance')} FROM a2",
        {
            "a0": _assigned("c0"), "c1": _MEANS.format(source="a0"),
            "a1": _assigned("c1"), "c2": _MEANS.format(source="a1"), "a2": _assigned("c2"),
        },
    ),
    "fuzzy_kmeans_step": with_(
        ["points", "c0"],
        f"""
        SELECT cid AS cluster_id, CAST(pos - 1 AS BIGINT) AS pos, {r6('sum(u * u * x) / sum(u * u)', 'value')} FROM (
          SELECT cid, u, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM u) GROUP BY 1, 2""",
        {
            "d": "SELECT p.id, p.v, c.cid, list_distance(p.v, c.v) AS d FROM points p, c0 c",
            "u": """
              SELECT id, v, cid, CASE WHEN min(d) OVER w < 1e-6
                THEN (CASE WHEN d < 1e-6 THEN 1e0 ELSE 0e0 END) / count(*) FILTER (d < 1e-6) OVER w
                ELSE 1e0 / (d * d) / sum(CASE WHEN d < 1e-6 THEN 0e0 ELSE 1e0 / (d * d) END) OVER w END AS u
              FROM d WINDOW w AS (PARTITION BY id)""",
        },
    ),
    "intercluster_distance": with_(
        ["label_means"],
        f"""
        SELECT {r6('max(d)', 'max_distance')}, {r6('min(d)', 'min_distance')},
               {r6('(avg(d) - min(d)) / nullif(max(d) - min(d), 0)', 'scaled_mean')} FROM (
          SELECT 1e0 - list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS d
          FROM label_means a JOIN label_means b ON a.label < b.label)""",
    ),
    "intercluster_distance_sparse": with_(
        ["unit_tokens"],
        f"""
        SELECT {r6('max(d)', 'max_distance')}, {r6('min(d)', 'min_distance')},
               {r6('(avg(d) - min(d)) / nullif(max(d) - min(d), 0)', 'scaled_mean')} FROM (
          SELECT a.label, b.label, 1e0 - coalesce(dot / (a.norm * b.norm), 0e0) AS d
          FROM norms a JOIN norms b ON a.label < b.label
          LEFT JOIN (
            SELECT x.label AS p, y.label AS q, sum(x.weight * y.weight) AS dot FROM means x
            JOIN means y ON x.key = y.key AND x.label < y.label GROUP BY 1, 2) ON p = a.label AND q = b.label)""",
        {
            "named": "SELECT u.doc_id, source || '/' || lang AS label, key, w FROM unit_tokens u "
                     "JOIN documents d ON d.doc_id = u.doc_id",
            "means": "SELECT label, key, sum(w) / k AS weight FROM named JOIN (SELECT label, count(DISTINCT doc_id) AS k "
                     "FROM named GROUP BY 1) USING (label) GROUP BY label, key, k",
            "norms": "SELECT label, sqrt(sum(weight * weight)) AS norm FROM means GROUP BY 1",
        },
    ),
    "kmeans_ml": "SELECT vec_id AS id, true AS valid FROM embeddings",
    "logreg_accuracy": f"""
        SELECT count(*) AS total, true AS beats_majority FROM documents
        WHERE NOT substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) < '{int(TRAIN_SHARE * 16**8):08x}'""",
    "svm_accuracy": f"""
        SELECT count(DISTINCT doc_id) AS total, true AS beats_majority, true AS auc_above_half FROM (
          SELECT doc_id, unnest(string_split(regexp_replace(lower(text), '[^\\p{{L}} ]', '', 'g'), ' ')) AS term
          FROM documents JOIN labels USING (doc_id))
        WHERE length(term) > 1 AND term NOT IN ({text_queries.STOPS})
          AND NOT substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) < '{int(TRAIN_SHARE * 16**8):08x}'""",
    "label_centroids": with_(["centroids"], f"SELECT label, key, {r6('weight', 'weight')} FROM centroids"),
    "autotag_top3": with_(["tagged"], f"SELECT doc_id, label, {r6('pct', 'pct')}, rank FROM tagged"),
    "autotag_accuracy": with_(
        ["tagged"],
        f"""
        SELECT count(t.doc_id) AS correct, count(*) AS total, {r6('count(t.doc_id) * 100e0 / count(*)', 'accuracy')}
        FROM documents d LEFT JOIN tagged t ON t.doc_id = d.doc_id AND t.label = d.lang""",
    ),
    "classifier_accuracy": f"""
        SELECT count(*) FILTER (quality = 1 - toxic) AS correct, count(*) AS total,
               {r6('100e0 * count(*) FILTER (quality = 1 - toxic) / count(*)', 'accuracy')} FROM labels""",
    "feature_hash": f"""
        SELECT id, {_SLOT} AS slot, {r6('sum(value)', 'value')} FROM (
          SELECT p_partkey AS id, 'price' AS feature, p_retailprice AS value FROM part
          UNION ALL SELECT p_partkey, 'size', CAST(p_size AS DOUBLE) FROM part
          UNION ALL SELECT p_partkey, 'brand=' || p_brand, 1e0 FROM part
          UNION ALL SELECT p_partkey, 'type=' || p_type, 1e0 FROM part
          UNION ALL SELECT p_partkey, 'word=' || unnest(string_split(p_name, ' ')), 1e0 FROM part),
          (VALUES (0), (1)) t(probe) GROUP BY 1, 2""",
    "sentence_vectors": with_(
        ["turn_terms"],
        f"""
        SELECT conv_id, turn, term, {r6('n / norm', 'value')} FROM known
        JOIN (SELECT conv_id, turn, sqrt(sum(n * n)) AS norm FROM known GROUP BY 1, 2) USING (conv_id, turn)""",
        {
            "vocabulary": r"""
              SELECT DISTINCT unnest(string_split(regexp_replace(lower(text), '[^\p{L} ]', '', 'g'), ' ')) AS term
              FROM documents JOIN labels USING (doc_id)""",
            "known": "SELECT * FROM turn_terms WHERE term IN (SELECT term FROM vocabulary)",
        },
    ),
    "baskets": with_(
        ["basket_rows"],
        "SELECT basket_id, string_agg(item, ';' ORDER BY item) AS items FROM basket_rows GROUP BY 1",
    ),
    "item_frequency": with_(["item_freq"], "SELECT * FROM item_freq"),
    "frequent_itemsets": with_(
        ["two_sets", "three_sets", "item_freq", "basket_count"],
        f"""
        SELECT item AS items, freq FROM item_freq, basket_count WHERE freq >= {MIN_SUPPORT} * n
        UNION ALL SELECT x || ';' || y, freq FROM two_sets
        UNION ALL SELECT x || ';' || y || ';' || z, freq FROM three_sets""",
    ),
    "association_rules": _rules_sql("item"),
    "association_rules_antecedent": _rules_sql("rest"),
}
