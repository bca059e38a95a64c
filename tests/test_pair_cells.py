from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from affinis.functions.measures import MEASURES
from affinis.operators import neighbours as N
from affinis.operators import pair_cells as C
from affinis.operators import pairs as P
from affinis.operators import tags as T


@pytest.fixture(scope="module")
def odd_ratings(spark):
    """Rows that repeat, null ids, keys and values, hot keys and rare ones."""
    rng = random.Random(1)
    rows = [
        (
            rng.choice([None, *range(30)]),
            rng.choice([None, *range(20)]) if rng.random() < 0.9 else 1_000 + rng.randrange(200),
            rng.choice([None, 1.0, 2.5, 3.0, -1.5]),
        )
        for _ in range(700)
    ]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double").cache()


def found(df):
    rows = df.collect()
    pairs = {(r["a"], r["b"]): (r["n"], pytest.approx(r["score"], abs=1e-9)) for r in rows}
    assert len(pairs) == len(rows)
    return pairs


@pytest.mark.parametrize("measure", MEASURES)
@pytest.mark.parametrize("block_rows", [400_000, 40])
def test_cells_equal_the_join(odd_ratings, measure, block_rows):
    # repeated rows may bring the Manhattan distance to -1, where its score has no value
    rows = odd_ratings.dropDuplicates(["user_id", "item_id"]).cache() if measure == "manhattan" else odd_ratings
    want = found(P.similarity_table(rows, "user", measure))
    got = C.scored_pairs(rows, "item_id", "user_id", "rating", measure, block_ids=7, block_rows=block_rows)
    assert found(got) == want and want


@pytest.mark.parametrize("dense", [1e9, 1e-9])
def test_products_equal_sums_of_pairs(odd_ratings, monkeypatch, dense):
    monkeypatch.setattr(C, "_TILE", 16)
    want = found(P.similarity_table(odd_ratings, "user", "pearson", True))
    rows = odd_ratings.collect()
    left = [(r["user_id"], r["item_id"], r["rating"]) for r in rows if r["user_id"] is not None]
    import pyarrow as pa

    monkeypatch.setattr(C, "_DENSE", dense)
    monkeypatch.setattr(C, "_SPREAD", 50)
    n = len(left)
    batch = pa.record_batch({
        "row": [0] * n, "col": [0] * n, "side": [0] * n, "key": pa.array([x[1] for x in left], pa.int64()),
        "id": pa.array([x[0] for x in left], pa.int64()), "v": pa.array([x[2] for x in left], pa.float64()),
    })
    got = {}
    for a, b, shared, scores in C._scores_in_cell([batch], "pearson", 0, 2, None, None):
        got |= {(int(x), int(y)): (int(k), pytest.approx(s, abs=1e-9)) for x, y, k, s in zip(a, b, shared, scores, strict=True)}
    # a block's own cell gives the pairs one way with the left id, the other way with the right one
    assert got == want


def test_many_ids_go_through_cells(odd_ratings, monkeypatch):
    named = odd_ratings.select("item_id", F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("tag")).filter("item_id < 20")
    centred = P.centred(odd_ratings.filter("rating is not null"))
    queries = [
        lambda: P.similarity_table(odd_ratings, "user", "llr", True), lambda: P.centred_cosine(centred, "user"),
        lambda: P.centred_cosine(centred, "item", both_directions=False), lambda: T.tag_cosine(named),
        lambda: T.tag_tanimoto(named), lambda: P.similarity_table(odd_ratings, "user", "assoc_advanced"),
    ]
    want = [found(q()) for q in queries]
    monkeypatch.setattr(C, "FEW_IDS", 1)
    for query, pairs in zip(queries, want, strict=True):
        df = query()
        assert "SortMergeJoin" not in df._jdf.queryExecution().toString()
        assert found(df) == pairs and pairs


def test_threshold_without_a_table_of_pairs(odd_ratings):
    want = found(P.similarity_table(odd_ratings, "user", "pearson", True).filter("score >= 0.2"))
    assert found(N.neighbours(odd_ratings, "user", "pearson", threshold=0.2, block_rows=100)) == want and want
