"""Vector codes against k-means in plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, codes int, parts string, error double, _label int"


def vectors(n=300, dim=32):
    rng = random.Random(6)
    centres = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(9)]
    rows = []
    for i in range(n):
        own = [float(np.float32(c + rng.gauss(0, 0.02))) for c in centres[i % 9]]
        rows.append((i, own, i % 5 if i % 7 else None))
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]  # copies: entries and distances tie
    rows += [rows[5], rows[5], (2000, None, 1), (2001, [], 2), (2002, [0.5] * 16, 2), (2003, [0.5] * 31, 3)]
    rows += [(2004, [float("nan")] * dim, 1), (2005, [float("inf")] + [0.0] * (dim - 1), 1), (2006, [None] + [0.0] * (dim - 1), 1)]
    rows += [(None, rows[8][1], 4), (2007, [3e38] + [-3e38] * (dim - 1), 4), (2008, [0.0] * dim, None)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, "p", 0.5, 9) for r in rows], SCHEMA).repartition(3)


def whole(x):
    return max(-V.LIMIT, min(V.LIMIT, math.floor(256 * x)))


def brute(rows, entries, rounds, dim=32):
    kept = []
    for i, v, label in rows:
        if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [whole(x) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    d = dim // 16
    books = [[v[p * d:p * d + d] for _, v, _ in kept[:entries]] for p in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for step in range(rounds + 1):
        found = [[nearest(v[p * d:p * d + d], books[p]) for p in range(16)] for _, v, _ in kept]
        if step == rounds:
            break
        for p in range(16):
            for e in range(len(books[p])):
                own = [v[p * d:p * d + d] for (_, v, _), f in zip(kept, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    sums = {}
    for (_, _, label), f in zip(kept, found):
        sums[label] = sums.get(label, 0) + sum(x for x, _ in f)
    out = [
        (i, "".join(f"{e:02x}" for _, e in f), sum(x for x, _ in f), sums[label])
        for (i, _, label), f in zip(kept, found)
    ]
    return sorted(out, key=str), ",".join(str(x) for book in books for entry in book for x in entry)


@pytest.mark.parametrize("entries", [64, 5, 1])
def test_codes_equal_brute_force(spark, entries):
    rows = vectors()
    coded, books = V.vector_codes(table(spark, rows), entries=entries)
    found = V.with_label_error(coded).select("row.vec_id", F.lower(F.hex("codes")), "error", "label_error").collect()
    wanted, text = brute(rows, entries, V.ROUNDS)
    assert sorted(map(tuple, found), key=str) == wanted
    assert V.codebooks_text(books) == text
    assert V.codebooks_digest(books) == hashlib.sha256(text.encode()).hexdigest()


def test_fewer_vectors_than_entries_and_none(spark):
    rows = vectors(4)[:4]
    coded, books = V.vector_codes(table(spark, rows))
    assert books.shape == (16, 4, 2) and coded.count() == 4
    coded, books = V.vector_codes(table(spark, [(1, None, 1)]))
    assert books is None and V.with_label_error(coded).collect() == []
    assert V.codebooks_digest(None) == hashlib.sha256().hexdigest()


def test_balls_find_the_nearest_and_skip_work():
    rng = np.random.default_rng(3)
    entries = rng.integers(-300, 300, (64, 4))
    points = entries[rng.integers(0, 64, 5000)] + rng.integers(-9, 10, (5000, 4))
    far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    index, best, computed = V.ball_assign(points, V.starting_entries(points, entries), entries)
    assert (index == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    assert computed < 0.9 * far.size
    again, _, computed = V.ball_assign(points, index, entries)
    assert (again == index).all() and computed < 0.1 * far.size


def test_ties_go_to_the_lower_index():
    entries = np.array([[4], [0], [4], [0], [2]])
    points = np.array([[2], [1], [3], [4], [0]])
    for start in range(5):
        index, _, _ = V.ball_assign(points, np.full(5, start), entries)
        assert index.tolist() == [4, 1, 0, 0, 1]


def test_decode_gives_the_entries(spark):
    rows = [r for r in vectors(80) if r[0] is not None and r[0] < 80]
    coded, books = V.vector_codes(table(spark, rows))
    found = {r["row"]["vec_id"]: r["vector"] for r in V.decode(coded, books).collect()}
    errors = {r["row"]["vec_id"]: r["error"] for r in coded.collect()}
    for i, v, _ in rows:
        assert sum((math.floor(256 * x) - round(256 * y)) ** 2 for x, y in zip(v, found[i])) == errors[i]
