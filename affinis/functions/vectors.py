"""Vector functions on ``map<string,double>`` and on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element(m: Column, key: str | Column) -> Column:
    """The weight of a key; 0 where it is absent."""
    return F.coalesce(F.try_element_at(m, F.lit(key) if isinstance(key, str) else key), F.lit(0.0))


def divide(m: Column, scalar: Column | float) -> Column:
    by = F.lit(scalar) if isinstance(scalar, (int, float)) else scalar
    return F.transform_values(m, lambda k, v: v / F.nullif(by, F.lit(0.0)))


def times(m: Column, scalar: Column | float) -> Column:
    return F.transform_values(m, lambda k, v: v * scalar)


def add(a: Column, b: Column) -> Column:
    """Sum over the union of keys."""
    return F.map_zip_with(
        a, b, lambda k, x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))
    )


def map_dot(a: Column, b: Column) -> Column:
    """Dot product over shared keys; equal products all count."""
    products = F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(F.map_values(products), F.lit(0.0), lambda acc, x: acc + x)


def map_norm(m: Column) -> Column:
    return F.sqrt(F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, x: acc + x * x))


def unit(m: Column) -> Column:
    return divide(m, map_norm(m))


def map_cosine(a: Column, b: Column) -> Column:
    return map_dot(a, b) / F.nullif(map_norm(a) * map_norm(b), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def squared_euclidean(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x
    )


def euclidean_distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def tanimoto_distance(a: Column, b: Column) -> Column:
    return 1.0 - dot(a, b) / F.nullif(dot(a, a) + dot(b, b) - dot(a, b), F.lit(0.0))


DISTANCES = {
    "euclidean": euclidean_distance, "cosine": cosine_distance, "tanimoto": tanimoto_distance,
}
