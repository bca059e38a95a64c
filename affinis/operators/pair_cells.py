"""Scores of all pairs of ids that share a key, from cells of blocks: no row per pair and key, and no shuffle of pairs.

Ids stand in blocks by a hash, and every two blocks are a cell. In a cell the statistics of a tile of pairs are arrays:
matrix products over the keys that many of its ids have, and sums over the few pairs of every other key. Scored pairs
leave a cell in batches, so a cell's memory depends on the block, and what is written is the result alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from affinis.functions.measures import array_measure, as_measure
from affinis.operators.pairs import pair_stats, score_pairs, turned
from affinis.operators.search import heavy_ids
from affinis.session import cut_lineage

FEW_IDS = 2_048  # the pairs of so many ids are a small table, however they are summed
BLOCK_IDS, BLOCK_ROWS = 4_096, 400_000  # of a block, on average
_LEAST_IDS = 256  # of a block where there are more cores than cells
_TILE = 1 << 20  # pairs scored at once
_SPREAD = 1 << 22  # entries of rarer keys summed at once
_DENSE = 8  # a key that a pair in so many has is summed by matrix products


class _Side:
    """A block: ids in order, their sizes, and one entry per id and key with count, sum and sum of squares."""

    def __init__(self, rows: pa.Table, n_keys: int):
        values = pc.fill_null(rows.column("v"), 0.0).to_numpy()
        self.ids, at = np.unique(rows.column("id").to_numpy(), return_inverse=True)
        self.sizes = np.bincount(at, minlength=len(self.ids)).astype(float)
        self.squares = np.bincount(at, values * values, minlength=len(self.ids))
        keys = rows.column("code").to_numpy()
        held = keys >= 0  # a null key is counted in an id's size, but shared with nobody
        cells, place = np.unique(at[held] * n_keys + keys[held], return_inverse=True)
        self.at, self.key = np.divmod(cells, max(n_keys, 1))
        sums = lambda weights=None: np.bincount(place, weights, minlength=len(cells)).astype(float)
        self.parts = {"c": sums(), "s": sums(values[held]), "q": sums(values[held] ** 2)}
        self.holders = np.bincount(self.key, minlength=n_keys)
        self.whole = np.bincount(self.key[~np.isfinite(self.parts["q"])], minlength=n_keys) == 0

    def matrix(self, part: str, column: np.ndarray, n_columns: int) -> np.ndarray:
        out = np.zeros((len(self.ids), n_columns))
        own = column[self.key] >= 0
        out[self.at[own], column[self.key[own]]] = self.parts[part][own]
        return out

    def sparse(self, column: np.ndarray, shared: np.ndarray) -> dict[str, np.ndarray]:
        own = (column[self.key] < 0) & shared[self.key]
        return {"at": self.at[own], "key": self.key[own], **{k: v[own] for k, v in self.parts.items()}}


# A statistic is a product of a part of the left entry and one of the right entry.
_PRODUCTS = {
    "n": ("c", "c"), "sum_a": ("s", "c"), "sum_b": ("c", "s"), "sum_aa": ("q", "c"), "sum_bb": ("c", "q"), "sum_ab": ("s", "s"),
}
_SWAPPED = {"sum_a": "sum_b", "sum_aa": "sum_bb", "n_a": "n_b", "ss_a": "ss_b"}
_SWAPPED |= {b: a for a, b in _SWAPPED.items()}


class _Tiles:
    """Pairs of two blocks, some ids of the left one at a time."""

    def __init__(self, left: _Side, right: _Side):
        self.left, self.right = left, right
        shared = (left.holders > 0) & (right.holders > 0)
        pairs = left.holders.astype(float) * right.holders
        dense = shared & (pairs * _DENSE >= len(left.ids) * len(right.ids)) & left.whole & right.whole
        self._column = np.where(dense, np.cumsum(dense) - 1, -1)
        self._n_dense = int(dense.sum())
        self._matrices: dict[tuple[int, str], np.ndarray] = {}
        self._l = left.sparse(self._column, shared)
        self._r = right.sparse(self._column, shared)
        order = np.argsort(self._r["key"], kind="stable")
        self._r = {k: v[order] for k, v in self._r.items()}
        self._bounds = np.concatenate(([0], np.cumsum(np.bincount(self._r["key"], minlength=len(shared)))))

    def _matrix(self, side: int, part: str) -> np.ndarray:
        if (side, part) not in self._matrices:
            self._matrices[side, part] = (self.left, self.right)[side].matrix(part, self._column, self._n_dense)
        return self._matrices[side, part]

    def _sparse(self, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Left entries, right entries and the pair's place in the tile, for the keys that few have."""
        own = np.arange(*np.searchsorted(self._l["at"], [first, last]))
        start = self._bounds[self._l["key"][own]]
        length = self._bounds[self._l["key"][own] + 1] - start
        ends = np.cumsum(length)
        begin = 0
        while begin < len(own):
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + _SPREAD, "right")))
            n = length[begin:end]
            shift = np.concatenate(([0], np.cumsum(n)))
            theirs = np.repeat(start[begin:end] - shift[:-1], n) + np.arange(shift[-1])
            mine = np.repeat(own[begin:end], n)
            yield mine, theirs, (self._l["at"][mine] - first) * len(self.right.ids) + self._r["at"][theirs]
            begin = end

    def statistics(self, first: int, last: int):
        """A function of a statistic's name: its array over all pairs of the left ids ``first`` to ``last``."""
        n_right = len(self.right.ids)
        spread = list(self._sparse(first, last)) if len(self._l["at"]) and len(self._r["at"]) else []
        known: dict[str, np.ndarray] = {}

        def of(name: str) -> np.ndarray:
            if name not in known:
                mine, theirs = _PRODUCTS[name]
                total = (self._matrix(0, mine)[first:last] @ self._matrix(1, theirs).T).ravel()
                for x, y, pair in spread:
                    total += np.bincount(pair, self._l[mine][x] * self._r[theirs][y], minlength=(last - first) * n_right)
                known[name] = total
            return known[name]

        return of


def _scores_in_cell(
    batches: list[pa.RecordBatch], measure: str, total: int, ways: int, threshold: float | None, undefined: float | None
) -> Iterator[tuple[np.ndarray, ...]]:
    table = pa.Table.from_batches(batches).combine_chunks()
    names = table.column("key").combine_chunks().dictionary_encode()
    table = table.append_column("code", pc.fill_null(names.indices.cast(pa.int64()), -1))
    sides = table.column("side").to_numpy()
    left, right = (_Side(table.filter(pa.array(sides == k)), len(names.dictionary)) for k in (0, 1))
    itself = table.column("row")[0] == table.column("col")[0]
    right = left if itself else right
    if not len(left.ids) or not len(right.ids):
        return
    tiles, width = _Tiles(left, right), len(right.ids)
    step = max(1, _TILE // width)
    for first in range(0, len(left.ids), step):
        last = min(first + step, len(left.ids))
        of = tiles.statistics(first, last)
        met = of("n").reshape(-1, width) > 0
        rising = left.ids[first:last, None] < right.ids[None, :]
        if itself:
            met &= rising
        for swapped in (False, True):
            # a is the left id, or the right one; in a table of one way the smaller of the two
            if itself and swapped and ways == 1:
                continue
            here = met if ways == 2 or itself else met & (~rising if swapped else rising)
            if swapped:
                y, x = np.nonzero(here.T)
            else:
                x, y = np.nonzero(here)
            if not len(x):
                continue
            pair = x * width + y
            alone = {
                "n_a": lambda x=x: left.sizes[first + x], "n_b": lambda y=y: right.sizes[y], "total": lambda: float(total),
                "ss_a": lambda x=x: left.squares[first + x], "ss_b": lambda y=y: right.squares[y],
            }

            def statistic(name, pair=pair, alone=alone, swapped=swapped):
                name = _SWAPPED.get(name, name) if swapped else name
                return alone[name]() if name in alone else of(name)[pair]

            scores = array_measure(measure, statistic)
            if undefined is not None:
                scores = np.where(np.isnan(scores), undefined, scores)
            kept = ~np.isnan(scores) if threshold is None else scores >= threshold
            a, b = left.ids[first + x[kept]], right.ids[y[kept]]
            yield (*((b, a) if swapped else (a, b)), of("n")[pair[kept]].astype(np.int64), scores[kept])


def scored_pairs(
    rows: DataFrame, key: str, id: str, value: str, measure: str, both_directions: bool = False,
    threshold: float | None = None, undefined: float | None = None, block_ids: int = BLOCK_IDS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(a, b, n, score)`` of all pairs that share a key, ``a < b`` or both ways; equals ``score_pairs`` of ``pair_stats``.

    ``threshold`` keeps scores of at least that; ``undefined`` stands for an undefined score. Ids with more than
    ``block_rows`` rows, at most rows / ``block_rows`` many, are scored by joins. The table is as large as there are pairs.
    """
    m = as_measure(measure)
    both_directions = both_directions or m.directed
    rows = cut_lineage(rows.select(F.col(key).alias("key"), F.col(id).alias("id"), F.col(value).cast("double").alias("v")))
    total = rows.agg(F.count_distinct("key")).first()[0] if m.needs_total else 0
    rows = rows.filter(F.col("id").isNotNull())
    heavy = heavy_ids(rows, "id", block_rows)
    light, parts = rows, []
    if heavy.head(1):
        stats = cut_lineage(pair_stats(rows, "key", "id", "v", left_ids=heavy))
        back = turned(stats).join(heavy.withColumnRenamed("id", "a"), "a", "left_anti")
        stats = stats.unionByName(back)
        scored = stats if both_directions else stats.filter("a < b")
        scored = scored.select("a", "b", "n", m.score(F.lit(total)).alias("score"))
        scored = scored if undefined is None else scored.withColumn("score", F.coalesce("score", F.lit(undefined)))
        parts.append(scored.filter(F.col("score").isNotNull() if threshold is None else F.col("score") >= threshold))
        light = cut_lineage(rows.join(heavy, "id", "left_anti"))
    n_rows, n_ids = light.agg(F.count("*"), F.count_distinct("id")).first()
    enough = isqrt(8 * rows.sparkSession.sparkContext.defaultParallelism) + 1  # blocks that make cells for all cores
    n = max(1, -(-n_ids // block_ids), -(-n_rows // block_rows), min(enough, n_ids // _LEAST_IDS))
    own, other = F.col("own"), F.col("other")
    blocks = light.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    )
    cells = blocks.select(
        F.least(own, other).alias("row"), F.greatest(own, other).alias("col"), (own > other).cast("int").alias("side"),
        "key", "id", "v",
    ).repartition(min(n * (n + 1) // 2, 4_096), "row", "col")
    kind = light.schema["id"].dataType
    schema = StructType([
        StructField("a", kind), StructField("b", kind), StructField("n", LongType()), StructField("score", DoubleType())
    ])
    work = partial(
        _scores_in_cell, measure=measure, total=total, ways=2 if both_directions else 1, threshold=threshold, undefined=undefined
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        ids = batches[0].schema.field("id").type
        for a, b, shared, scores in work(batches):
            yield pa.record_batch([pa.array(a, ids), pa.array(b, ids), pa.array(shared), pa.array(scores)], names=schema.names)

    parts.append(cells.groupBy("row", "col").applyInArrow(found, schema))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def many_ids(rows: DataFrame, id: str) -> bool:
    """Are there so many ids that a table of their pair sums is larger than one task should hold?"""
    return rows.agg(F.count_distinct(id)).first()[0] > FEW_IDS
