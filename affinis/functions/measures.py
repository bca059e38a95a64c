"""Similarity measures as column expressions over pair statistics.

A pair row ``(a, b)`` carries ``n`` (shared keys), ``sum_a sum_b sum_aa sum_bb sum_ab`` over
the shared keys, ``n_a n_b`` (all keys of a and of b) and ``ss_a ss_b`` (sum of squares over
all keys). ``total`` is the number of distinct keys in the whole table. An undefined ratio
is null. A caller may pass a function of the same shape in place of a measure name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def c(name: str) -> Column:
    return F.col(name)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null where the denominator is 0."""
    return numerator / F.when(denominator != 0, denominator)


def x_log_x(x: Column) -> Column:
    return F.when(x > 0, x * F.ln(x)).otherwise(F.lit(0.0))


def log_likelihood_ratio(k11: Column, k12: Column, k21: Column, k22: Column) -> Column:
    """Dunning's G2 of a 2x2 table; never below 0."""
    cells = [k.cast("double") for k in (k11, k12, k21, k22)]
    a, b, d, e = cells
    total = x_log_x(a + b + d + e)
    rows = x_log_x(a + b) + x_log_x(d + e)
    columns = x_log_x(a + d) + x_log_x(b + e)
    matrix = x_log_x(a) + x_log_x(b) + x_log_x(d) + x_log_x(e)
    return F.greatest(F.lit(0.0), 2.0 * (matrix + total - rows - columns))


def _basic_association(total: Column) -> Column:
    return ratio(c("n").cast("double"), c("n_a"))


def _advanced_association(total: Column) -> Column:
    others = (total - c("n_a")).cast("double")
    without_a = (c("n_b") - c("n")).cast("double")
    return (
        F.when(others == 0, F.lit(None).cast("double"))
        .when(without_a == 0, F.lit(float("inf")))
        .otherwise(ratio(c("n") / c("n_a") * others, without_a))
    )


def _pearson(total: Column) -> Column:
    covariance = c("n") * c("sum_ab") - c("sum_a") * c("sum_b")
    var_a = c("n") * c("sum_aa") - c("sum_a") * c("sum_a")
    var_b = c("n") * c("sum_bb") - c("sum_b") * c("sum_b")
    defined = (var_a > 0) & (var_b > 0)
    return F.when(defined, covariance / (F.sqrt(var_a) * F.sqrt(var_b)))


def _euclidean(total: Column) -> Column:
    squared = F.greatest(F.lit(0.0), c("sum_aa") - 2 * c("sum_ab") + c("sum_bb"))
    return 1.0 / (1.0 + F.sqrt(squared) / F.sqrt(c("n").cast("double")))


def _cosine(total: Column) -> Column:
    return ratio(c("sum_ab"), F.sqrt(c("sum_aa")) * F.sqrt(c("sum_bb")))


def _full_cosine(total: Column) -> Column:
    return ratio(c("sum_ab"), F.sqrt(c("ss_a")) * F.sqrt(c("ss_b")))


def _cityblock(total: Column) -> Column:
    return 1.0 / (1.0 + (c("n_a") + c("n_b") - 2 * c("n")).cast("double"))


def _tanimoto(total: Column) -> Column:
    return ratio(c("n").cast("double"), (c("n_a") + c("n_b") - c("n")).cast("double"))


def _llr(total: Column) -> Column:
    g2 = log_likelihood_ratio(
        c("n"), c("n_a") - c("n"), c("n_b") - c("n"), total - c("n_a") - c("n_b") + c("n")
    )
    return 1.0 - 1.0 / (1.0 + g2)


def weighted(plain: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Pull a score towards its sign by the share of keys that the pair has in common."""

    def score(total: Column) -> Column:
        s = plain(total)
        w = 1.0 - c("n") / (total + 1).cast("double")
        return F.when(s < 0, -1.0 + w * (1.0 + s)).otherwise(1.0 - w * (1.0 - s))

    return score


@dataclass(frozen=True)
class Measure:
    """``score`` maps the total to a column; the flags say which inputs it reads."""

    score: Callable[[Column], Column]
    needs_marginals: bool = False
    needs_total: bool = False
    directed: bool = False


MEASURES: dict[str, Measure] = {
    "assoc_basic": Measure(_basic_association, needs_marginals=True, directed=True),
    "assoc_advanced": Measure(_advanced_association, True, True, directed=True),
    "pearson": Measure(_pearson),
    "pearson_w": Measure(weighted(_pearson), needs_total=True),
    "euclidean": Measure(_euclidean),
    "cosine": Measure(_cosine),
    "cosine_w": Measure(weighted(_cosine), needs_total=True),
    "full_cosine": Measure(_full_cosine, needs_marginals=True),
    "manhattan": Measure(_cityblock, needs_marginals=True),
    "tanimoto": Measure(_tanimoto, needs_marginals=True),
    "llr": Measure(_llr, needs_marginals=True, needs_total=True),
}

# The eight measures of the evaluation grid, in its order.
GRID_MEASURES = (
    "euclidean", "pearson", "pearson_w", "cosine", "cosine_w", "manhattan", "llr", "tanimoto",
)


def as_measure(measure: str | Measure | Callable[[Column], Column]) -> Measure:
    """A measure by name, or a caller's own column function, which may read every input."""
    if isinstance(measure, str):
        return MEASURES[measure]
    if isinstance(measure, Measure):
        return measure
    return Measure(measure, needs_marginals=True, needs_total=True)


def _part(numerator, denominator):
    """Division of arrays that gives nan where the denominator is 0."""
    numerator, denominator = np.broadcast_arrays(np.asarray(numerator, float), np.asarray(denominator, float))
    return np.divide(numerator, denominator, out=np.full(numerator.shape, np.nan), where=denominator != 0)


def _x_log_x(x):
    x = np.asarray(x, float)
    return np.where(x > 0, x * np.log(np.where(x > 0, x, 1.0)), 0.0)


def _array_pearson(s):
    n, a, b = s("n"), s("sum_a"), s("sum_b")
    var_a, var_b = n * s("sum_aa") - a * a, n * s("sum_bb") - b * b
    root = np.sqrt(np.maximum(var_a, 0)) * np.sqrt(np.maximum(var_b, 0))
    return np.where((var_a > 0) & (var_b > 0), _part(n * s("sum_ab") - a * b, root), np.nan)


def _array_advanced(s):
    n, others = s("n"), s("total") - s("n_a")
    without_a = s("n_b") - n
    score = np.where(without_a == 0, np.inf, _part(n / s("n_a") * others, without_a))
    return np.where(np.asarray(others) == 0, np.nan, score)


def _array_llr(s):
    n, n_a, n_b, total = s("n"), s("n_a"), s("n_b"), s("total")
    a, b, d, e = n, n_a - n, n_b - n, total - n_a - n_b + n
    rows, columns = _x_log_x(a + b) + _x_log_x(d + e), _x_log_x(a + d) + _x_log_x(b + e)
    matrix = _x_log_x(a) + _x_log_x(b) + _x_log_x(d) + _x_log_x(e)
    g2 = np.maximum(0.0, 2.0 * (matrix + _x_log_x(a + b + d + e) - rows - columns))
    return 1.0 - 1.0 / (1.0 + g2)


def _array_weighted(plain):
    def score(s):
        found, w = plain(s), 1.0 - s("n") / (s("total") + 1)
        return np.where(found < 0, -1.0 + w * (1.0 + found), 1.0 - w * (1.0 - found))

    return score


def _array_cosine(s):
    return _part(s("sum_ab"), np.sqrt(s("sum_aa")) * np.sqrt(s("sum_bb")))


#: The measures of ``MEASURES`` over arrays: a function of the named statistic, nan where undefined.
_ARRAYS = {
    "assoc_basic": lambda s: s("n") / s("n_a"),
    "assoc_advanced": _array_advanced,
    "pearson": _array_pearson,
    "pearson_w": _array_weighted(_array_pearson),
    "euclidean": lambda s: 1.0 / (1.0 + np.sqrt(np.maximum(0.0, s("sum_aa") - 2 * s("sum_ab") + s("sum_bb"))) / np.sqrt(s("n"))),
    "cosine": _array_cosine,
    "cosine_w": _array_weighted(_array_cosine),
    "full_cosine": lambda s: _part(s("sum_ab"), np.sqrt(s("ss_a")) * np.sqrt(s("ss_b"))),
    "manhattan": lambda s: 1.0 / (1.0 + (s("n_a") + s("n_b") - 2 * s("n"))),
    "tanimoto": lambda s: _part(s("n"), s("n_a") + s("n_b") - s("n")),
    "llr": _array_llr,
}


def array_measure(name: str, statistic: Callable[[str], np.ndarray]) -> np.ndarray:
    """A named measure of many pairs at once; only the statistics it reads are asked for."""
    return _ARRAYS[name](statistic)
