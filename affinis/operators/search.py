"""Exact top-n by shared keys over a block-max index, without a table of pairs.

A query and an answer score the sum of ``q * impact`` over the keys they share: items that share
users, items that share tags, user profiles and item tags.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from affinis.operators.joins import grid_join
from affinis.operators.topk import RANK_DIGITS, top_k
from affinis.session import cut_lineage

# Posting rows of one block, and query rows that meet it in one task. A session of small executors may take less.
BLOCK_ROWS = 400_000
# Posting rows of one cell of a search, which may hold many blocks, and query rows that meet them in one task.
SHELF_ROWS, ASKED_ROWS = 2_000_000, 250_000
_GROUP_BYTES = 192 << 20  # packed shelves that one task searches together
_BATCH = 1 << 16  # result rows that leave a task at once
_MARGIN = 1e-6  # bounds are compared with room for rounding
_RUNS = 512  # so many runs of postings are copied one by one
_SEGMENT = 64  # answers of which the best one is looked up at once
_LEAST_PRODUCT = 1e-9  # sums of larger products are told from 0 by their value


def _answers(found: DataFrame, exclude: DataFrame | None) -> DataFrame:
    if exclude is None:
        return found.filter(F.col("query") != F.col("other"))
    return found.join(exclude, ["query", "other"], "left_anti")


def _direct(queries: DataFrame, postings: DataFrame) -> DataFrame:
    joined = grid_join(queries, postings, ["key"], "query", "other")
    return joined.groupBy("query", "other").agg(F.sum(F.col("q") * F.col("impact")).alias("score"))


def block_of(postings: DataFrame, block_rows: int) -> DataFrame:
    """``(other, block)``: answers in blocks of about ``block_rows`` postings.

    An answer goes with the smallest hash of its keys, so answers that share keys tend to share a block and other
    blocks' bounds for these keys stay low. Larger clusters are split by a hash of the answer.
    """
    own = postings.groupBy("other").agg(F.min(F.xxhash64("key")).alias("cluster"), F.count("*").alias("n"))
    own = cut_lineage(own)
    clusters = own.groupBy("cluster").agg(F.sum("n").alias("rows"))
    small = clusters.filter(F.col("rows") <= block_rows).agg(F.sum("rows")).first()[0] or 0
    n_small = max(1, -(-small // block_rows))
    place = F.when(
        F.col("rows") > block_rows,
        F.xxhash64("cluster", F.pmod(F.xxhash64("other"), F.ceil(F.col("rows") / block_rows))),
    ).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(n_small)))
    return own.join(clusters, "cluster").select("other", place.alias("block"))


def block_bounds(queries: DataFrame, placed: DataFrame) -> DataFrame:
    """``(query, block, bound)``: the most that an answer of the block can score, from each key's extremes there."""
    heads = cut_lineage(placed.groupBy("block", "key").agg(
        F.max("impact").alias("most"), F.min("impact").alias("least")
    ))
    best = F.greatest(F.col("q") * F.col("most"), F.col("q") * F.col("least"), F.lit(0.0))
    joined = grid_join(queries, heads, ["key"], "query", "block")
    return joined.groupBy("query", "block").agg(F.sum(best).alias("bound"))


def _runs(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of runs, one run after the other, and how long each is."""
    shift = np.concatenate(([0], np.cumsum(length)))
    return np.repeat(first - shift[:-1], length) + np.arange(shift[-1]), length


@dataclass
class Meeting:
    """A query of a cell and what it shares with the cell's answers: one entry per shared key.

    ``others`` are all answers in order, ``found`` the places of those it may have; ``met`` is an entry's answer by
    place, ``q`` and ``impact`` are the two values. ``n_keys`` and ``squares`` count all keys of the query.
    """

    query: object
    others: np.ndarray
    found: np.ndarray
    met: np.ndarray
    q: np.ndarray
    impact: np.ndarray
    n_keys: int
    squares: float


class Postings:
    """Postings as arrays, by key and answer.

    ``others`` are the answers in order; entries ``bounds[c]`` to ``bounds[c + 1]`` of ``other_at`` (places in
    ``others``) and ``impact`` are the postings of key number ``c``, ``names[c]``.
    """

    def __init__(self, rows: pa.Table):
        self.others, other_at = np.unique(rows.column("other").to_numpy(), return_inverse=True)
        names = rows.column("key").combine_chunks().dictionary_encode()
        codes = names.indices.to_numpy()
        order = np.lexsort((other_at, codes))
        self.names = names.dictionary
        self.other_at, self.impact = other_at[order], rows.column("value").to_numpy()[order]
        self.bounds = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=len(self.names)))))

    def entries(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Postings of key numbers, one key after the other, and how many each has."""
        return _runs(self.bounds[keys], self.bounds[keys + 1] - self.bounds[keys])

    def places(self, ids: list | np.ndarray) -> np.ndarray:
        """Places in ``others`` of those ids that are there."""
        if not len(ids) or not len(self.others):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.others, ids), len(self.others) - 1)
        return at[self.others[at] == np.array(ids, dtype=self.others.dtype)]


class Cell(Postings):
    """The rows of a cell as arrays: postings by key and answer, and its queries."""

    def __init__(self, table: pa.Table):
        kinds = table.column("kind").to_numpy()
        postings, self._asked, self._barred = (table.filter(pa.array(kinds == k)) for k in range(3))
        super().__init__(postings)

    def key_codes(self, rows: pa.Table) -> np.ndarray:
        """Key numbers of rows, -1 for a key that no answer has."""
        return pc.fill_null(pc.index_in(rows.column("key").combine_chunks(), value_set=self.names), -1).to_numpy()

    def asked_values(self) -> np.ndarray:
        return self._asked.column("value").to_numpy()

    def queries(self) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        """Every query with the key numbers and values of all its rows."""
        yield from by_query(self._asked, self.key_codes(self._asked), self.asked_values())

    def bars(self) -> dict:
        out: dict = {}
        for query, other in zip(self._barred.column("query").to_pylist(), self._barred.column("other").to_pylist(), strict=True):
            out.setdefault(query, []).append(other)
        return out


def by_query(rows: pa.Table, *columns: np.ndarray) -> Iterator[tuple]:
    """The parts of columns that belong to each query of a cell."""
    ids, at = np.unique(rows.column("query").to_numpy(), return_inverse=True)
    order = np.argsort(at, kind="stable")
    ends = np.cumsum(np.bincount(at, minlength=len(ids)))
    for number, end in enumerate(ends):
        own = order[ends[number - 1] if number else 0:end]
        yield ids[number], *(column[own] for column in columns)


def meetings(table: pa.Table, itself: bool) -> Iterator[Meeting]:
    """Every query of a cell that shares a key with an answer; an id is no answer to itself if ``itself``."""
    cell = Cell(table)
    bars = cell.bars()
    for query, keys, values in cell.queries():
        known = keys >= 0
        rows, length = cell.entries(keys[known])
        met = cell.other_at[rows]
        is_met = np.bincount(met, minlength=len(cell.others)) > 0
        for bar in [query] if itself else bars.get(query.item() if hasattr(query, "item") else query, ()):
            place = np.searchsorted(cell.others, bar)
            if place < len(cell.others) and cell.others[place] == bar:
                is_met[place] = False
        found = np.flatnonzero(is_met)
        if len(found):
            yield Meeting(
                query, cell.others, found, met, np.repeat(values[known], length), cell.impact[rows],
                len(keys), float((values ** 2).sum()),
            )


def best_places(found: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` best of the places ``found`` by falling rounded score, then place."""
    ranked = np.round(scores, RANK_DIGITS)
    if len(found) > n:
        least = np.partition(ranked, len(ranked) - n)[len(ranked) - n]
        found, ranked = found[ranked >= least], ranked[ranked >= least]
    return found[np.lexsort((found, -ranked))[:n]]


class _Heads:
    """A cell's answers in blocks of about ``block_rows`` postings, runs of their order, and each key's part of a block.

    Part ``h`` is the postings ``first[h]`` to ``first[h] + length[h]``, in ``block[h]``, with extremes ``most`` and
    ``least``; parts ``bounds[c]`` to ``bounds[c + 1]`` are those of key number ``c``.
    """

    def __init__(self, cell: Postings, block_rows: int, positive: bool):
        self.cell, self.block_rows = cell, block_rows
        before = np.cumsum(np.bincount(cell.other_at, minlength=len(cell.others)))
        place = (before - 1) // block_rows
        self.n_blocks = int(place[-1]) + 1 if len(place) else 0
        own, start = place[cell.other_at], np.zeros(len(cell.other_at), bool)
        start[1:] = own[1:] != own[:-1]
        start[cell.bounds[:-1]] = True
        self.first = np.flatnonzero(start)
        self.length = np.diff(np.append(self.first, len(own)))
        self.block = own[self.first]
        self.most = np.maximum.reduceat(cell.impact, self.first) if len(own) else cell.impact
        self.least = np.minimum.reduceat(cell.impact, self.first) if len(own) else cell.impact
        self.bounds = np.searchsorted(self.first, cell.bounds)
        self.positive = positive

    def _scores(self, first: np.ndarray, length: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Answers met in runs of postings, one after the other, and the scores of all answers there."""
        cell = self.cell
        if len(first) > _RUNS:
            rows, _ = _runs(first, length)
            met, impact = cell.other_at[rows], cell.impact[rows]
        else:
            runs = [slice(a, b) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
            met, impact = (np.concatenate([c[r] for r in runs] or [c[:0]]) for c in (cell.other_at, cell.impact))
        weights = impact if (q == 1.0).all() else impact * np.repeat(q, length)
        return met, np.bincount(met, weights, minlength=-(-len(cell.others) // _SEGMENT) * _SEGMENT)

    def _best_of(self, met: np.ndarray, scores: np.ndarray, barred: np.ndarray, n: int, least: float) -> np.ndarray:
        """Places of the best ``n`` answers met; those below ``least`` may be left out."""
        if self.positive:  # no answer met has a score of 0, and no other answer has another one
            scores[barred] = 0.0
            lines = scores.reshape(_SEGMENT, -1)
            most = lines.max(axis=0)
            if least == -np.inf and len(most) > n:  # n answers are no worse than the n-th best of segments
                least = np.partition(most, len(most) - n)[len(most) - n]
            if least > _MARGIN:
                near = np.flatnonzero(most >= least - _MARGIN)
                row, column = np.nonzero(lines[:, near] >= least - _MARGIN)
                found = row * len(most) + near[column]
            else:
                found = np.flatnonzero(scores)
        else:
            is_met = np.bincount(met, minlength=len(scores)) > 0
            is_met[barred] = False
            found = np.flatnonzero(is_met)
        return best_places(found, scores[found], n)

    def best(
        self, keys: np.ndarray, values: np.ndarray, barred: np.ndarray, n: int, least: float = -np.inf
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of a query's best ``n`` answers; those below ``least`` may be left out.

        A query that meets more postings than a block has meets the block of its highest bound first; the n-th best score
        there closes all blocks with a lower bound.
        """
        cell = self.cell
        first, length, q = cell.bounds[keys], cell.bounds[keys + 1] - cell.bounds[keys], values
        if self.n_blocks > 1 and length.sum() > self.block_rows:
            parts, n_parts = _runs(self.bounds[keys], self.bounds[keys + 1] - self.bounds[keys])
            of_part, block = np.repeat(values, n_parts), self.block[parts]
            most = np.maximum(np.maximum(of_part * self.most[parts], of_part * self.least[parts]), 0.0)
            bound = np.bincount(block, most, minlength=self.n_blocks)
            if least == -np.inf:
                own = block == np.argmax(bound)
                met, scores = self._scores(self.first[parts[own]], self.length[parts[own]], of_part[own])
                best = self._best_of(met, scores, barred, n, least)
                least = scores[best[-1]] if len(best) == n else least
            near = bound[block] >= least - _MARGIN
            if not near.all():
                parts = parts[near]
                first, length, q = self.first[parts], self.length[parts], of_part[near]
        met, scores = self._scores(first, length, q)
        best = self._best_of(met, scores, barred, n, least)
        return best, scores[best]


def _best_in_cell(table: pa.Table, n: int, itself: bool, block_rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Queries, answers and scores: the best ``n`` answers of every query of a cell."""
    cell = Cell(table)
    bars, heads = cell.bars(), _Heads(cell, block_rows, _positive(cell.impact, cell.asked_values()))
    for query, keys, values in cell.queries():
        known = keys >= 0
        bar = [query] if itself else bars.get(query.item() if hasattr(query, "item") else query, [])
        best, scores = heads.best(keys[known], values[known], cell.places(bar), n)
        if len(best):
            yield np.full(len(best), query), cell.others[best], scores


def _positive(impact: np.ndarray, q: np.ndarray) -> bool:
    """Are all products well above 0?"""
    return bool(len(impact) and len(q) and impact.min() > 0 and q.min() > 0 and impact.min() * q.min() > _LEAST_PRODUCT)


def _packed(arrays: dict[str, pa.Array]) -> bytes:
    """Arrays of any lengths as one compressed message."""
    lists = [pa.LargeListArray.from_arrays(pa.array([0, len(a)], pa.int64()), a) for a in arrays.values()]
    batch, sink = pa.record_batch(lists, names=list(arrays)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(message: pa.Buffer) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(message).read_next_batch()
    return {name: batch.column(name).flatten() for name in batch.schema.names}


class _Shelf(Postings):
    """The postings of a packed shelf."""

    def __init__(self, message: pa.Buffer):
        arrays = {name: a.to_numpy(zero_copy_only=False) for name, a in _unpacked(message).items()}
        self.others, self.impact, self.bounds = arrays["others"], arrays["impact"], arrays["bounds"]
        self.other_at = arrays["other_at"].astype(np.int64)


def _pack_shelf(rows: pa.Table) -> tuple[bytes, bytes]:
    """A shelf's keys with their largest and smallest impact, and its postings."""
    shelf, first = Postings(rows), rows.schema.field("other").type
    head = {"names": shelf.names} | {
        name: pa.array(extreme.reduceat(shelf.impact, shelf.bounds[:-1]))
        for name, extreme in (("most", np.maximum), ("least", np.minimum))
    }
    body = {
        "others": pa.array(shelf.others, first), "other_at": pa.array(shelf.other_at.astype(np.int32)),
        "impact": pa.array(shelf.impact), "bounds": pa.array(shelf.bounds),
    }
    return _packed(head), _packed(body)


def _pack_queries(rows: pa.Table) -> bytes:
    """Queries in order with their keys and values, and the answers that each may not have."""
    asked, barred = rows.filter(pc.is_valid(rows.column("key"))), rows.filter(pc.is_null(rows.column("key")))
    ids, at = np.unique(asked.column("query").to_numpy(), return_inverse=True)
    order = np.argsort(at, kind="stable")
    names = asked.column("key").combine_chunks().dictionary_encode()
    theirs = barred.column("query").to_numpy()
    bar_at = np.minimum(np.searchsorted(ids, theirs), max(len(ids) - 1, 0))
    known = np.flatnonzero(ids[bar_at] == theirs) if len(ids) else np.zeros(0, np.int64)
    known = known[np.argsort(bar_at[known], kind="stable")]
    return _packed({
        "query": pa.array(ids, rows.schema.field("query").type), "length": pa.array(np.bincount(at, minlength=len(ids))),
        "names": names.dictionary, "code": names.indices.take(pa.array(order)), "q": asked.column("value").combine_chunks().take(pa.array(order)),
        "n_barred": pa.array(np.bincount(bar_at[known], minlength=len(ids))),
        "barred": barred.column("other").combine_chunks().take(pa.array(known)),
    })


def _bounds_of(code: np.ndarray, at: np.ndarray, q: np.ndarray, head: dict[str, pa.Array], n: int) -> np.ndarray:
    """The most that each of ``n`` queries can get from a shelf, -1 where it shares no key with it."""
    known = code >= 0
    most, least = (head[name].to_numpy()[code[known]] for name in ("most", "least"))
    best = np.maximum(np.maximum(q[known] * most, q[known] * least), 0.0)
    return np.where(np.bincount(at[known], minlength=n) > 0, np.bincount(at[known], best, minlength=n), -1.0)


def _best_on_shelves(
    queries: pa.Buffer, shelves: list[tuple[pa.Buffer, pa.Buffer]], n: int, itself: bool, block_rows: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """Queries, answers and scores: the best ``n`` answers that packed queries have on packed shelves.

    Every query first searches the shelf of its highest bound; its n-th best score closes all shelves with a lower one.
    """
    asked = _unpacked(queries)
    ids, length, q = (asked[c].to_numpy(zero_copy_only=False) for c in ("query", "length", "q"))
    at, ends = np.repeat(np.arange(len(ids)), length), np.cumsum(length)
    barred, bar_ends = asked["barred"].to_numpy(zero_copy_only=False), np.cumsum(asked["n_barred"].to_numpy())
    bounds, codes = np.zeros((len(shelves), len(ids))), []
    for number, (head, _) in enumerate(shelves):
        keys = _unpacked(head)
        place = pc.fill_null(pc.index_in(asked["names"], value_set=keys["names"]), -1).to_numpy(zero_copy_only=False)
        codes.append(place[asked["code"].to_numpy()])
        bounds[number] = _bounds_of(codes[-1], at, q, keys, len(ids))
    own_shelf, least = np.argmax(bounds, axis=0), np.full(len(ids), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(ids)
    for is_first in (True, False):
        for number, (_, body) in enumerate(shelves):
            bound = bounds[number]
            open_ = np.flatnonzero(((own_shelf == number) == is_first) & (bound >= 0) & (bound >= least - _MARGIN))
            if not len(open_):
                continue
            shelf = _Shelf(body)
            heads = _Heads(shelf, block_rows, _positive(shelf.impact, q))
            for i in open_.tolist():
                own = slice(ends[i] - length[i], ends[i])
                keys = codes[number][own]
                bar = ids[i:i + 1] if itself else barred[bar_ends[i - 1] if i else 0:bar_ends[i]]
                best, scores = heads.best(keys[keys >= 0], q[own][keys >= 0], shelf.places(bar), n, least[i])
                others = shelf.others[best]
                if found[i] is not None:
                    others, scores = np.concatenate([found[i][0], others]), np.concatenate([found[i][1], scores])
                    order = np.argsort(others, kind="stable")
                    order = order[np.argsort(-np.round(scores[order], RANK_DIGITS), kind="stable")][:n]
                    others, scores = others[order], scores[order]
                found[i] = others, scores
                if len(others) == n:
                    least[i] = scores[-1]
    for i, best in enumerate(found):
        if best is not None and len(best[0]):
            yield np.full(len(best[0]), ids[i]), *best


def _in_batches(found: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
    """Columns of about ``_BATCH`` rows each, so that a cell's results are never held together."""
    parts: list[tuple[np.ndarray, ...]] = []
    n_rows = 0
    for part in found:
        parts.append(part)
        n_rows += len(part[0])
        if n_rows >= _BATCH:
            yield [np.concatenate(columns) for columns in zip(*parts, strict=True)]
            parts, n_rows = [], 0
    if n_rows:
        yield [np.concatenate(columns) for columns in zip(*parts, strict=True)]


def in_blocks(
    pairs: DataFrame, queries: DataFrame, placed: DataFrame,
    work: Callable[[pa.Table], Iterator[tuple[np.ndarray, ...]]],
    exclude: DataFrame | None, block_rows: int, counts: tuple[str, ...] = (), asks: DataFrame | None = None,
) -> DataFrame:
    """``(query, other, score, *counts)``: the columns that ``work`` yields from the cells of ``pairs(query, block)``.

    A cell holds one block and as many queries as have about ``block_rows`` keys. With ``asks(query, key)`` the cells hold
    these too, and the result has columns ``key`` and ``value`` instead of ``counts``.
    """
    asked = pairs.join(queries, "query")
    sizes = asked.groupBy("block").agg(F.ceil(F.count("*") / block_rows).alias("chunks"))
    sizes = cut_lineage(sizes)
    chunk = F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int").alias("chunk")
    query_type, other_type = queries.schema["query"].dataType, placed.schema["other"].dataType
    key_type = placed.schema["key"].dataType
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = placed.join(sizes, "block").select(
        "block", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))).alias("chunk"),
        F.lit(0).alias("kind"), none(query_type, "query"), "other", "key", F.col("impact").cast("double").alias("value"),
    ).unionByName(asked.join(sizes, "block").select(
        "block", chunk, F.lit(1).alias("kind"), "query", none(other_type, "other"), "key",
        F.col("q").cast("double").alias("value"),
    ))
    if exclude is not None:
        barred = exclude.select("query", "other").join(placed.select("other", "block").distinct(), "other")
        rows = rows.unionByName(barred.join(pairs, ["query", "block"]).join(sizes, "block").select(
            "block", chunk, F.lit(2).alias("kind"), "query", "other", none(key_type, "key"), none("double", "value"),
        ))
    more = [StructField(c, LongType()) for c in counts]
    if asks is not None:
        rows = rows.unionByName(asks.join(pairs, "query").join(sizes, "block").select(
            "block", chunk, F.lit(3).alias("kind"), "query", none(other_type, "other"), "key", none("double", "value"),
        ))
        more = [StructField("key", key_type), StructField("value", DoubleType())]
    schema = StructType([
        StructField("query", query_type), StructField("other", other_type), StructField("score", DoubleType()), *more,
    ])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pa.Table.from_batches(list(batches))
        own = {"score": pa.float64()} | {c: pa.int64() for c in counts}
        types = [own[name] if name in own else cell.schema.field(name).type for name in schema.names]
        for columns in _in_batches(work(cell)):
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    return rows.groupBy("block", "chunk").applyInArrow(found, schema)


def heavy_ids(df: DataFrame, id: str, block_rows: int) -> DataFrame:
    """``(id)`` of more rows than a block has, at most rows / ``block_rows`` many."""
    return cut_lineage(df.groupBy(id).agg(F.count("*").alias("_n")).filter(F.col("_n") > block_rows).select(id))


def _whole(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    batches = [batch for batch in batches if batch.num_rows]
    return pa.Table.from_batches(batches).combine_chunks() if batches else None


def _on_shelves(
    queries: DataFrame, postings: DataFrame, n: int, exclude: DataFrame | None, block_rows: int, n_shelves: int, asked_rows: int
) -> DataFrame:
    """``(query, other, score)``: each query's best ``n`` answers of every group of shelves.

    Shelves and parts of the queries are packed, one row each, and every part meets every group of shelves in a nested
    loop over the two tables. What is shuffled is the postings once and the queries once, whatever the number of shelves.
    """
    query, other = queries.schema["query"], postings.schema["other"]
    cores = queries.sparkSession.sparkContext.defaultParallelism
    asked = queries.select("query", "key", F.lit(None).cast(other.dataType).alias("other"), F.col("q").cast("double").alias("value"))
    n_parts = max(2 * cores, -(-queries.count() // asked_rows))
    if exclude is not None:
        asked = asked.unionByName(exclude.select(
            F.col("query").cast(query.dataType).alias("query"), F.lit(None).cast(queries.schema["key"].dataType).alias("key"),
            F.col("other").cast(other.dataType).alias("other"), F.lit(None).cast("double").alias("value"),
        ))

    def shelf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _whole(batches)
        if rows is not None:
            yield pa.record_batch([[packed] for packed in _pack_shelf(rows)], names=["head", "body"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = _whole(batches)
        if rows is not None:
            number = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.record_batch([number, pa.array([_pack_queries(rows)], pa.binary())], names=["part", "queries"])

    shelves = cut_lineage(postings.select("other", "key", F.col("impact").cast("double").alias("value")).repartitionByRange(
        n_shelves, "other"
    ).mapInArrow(shelf, StructType([StructField("head", BinaryType()), StructField("body", BinaryType())])))
    packed = cut_lineage(asked.repartition(n_parts, "query").mapInArrow(
        part, StructType([StructField("part", IntegerType()), StructField("queries", BinaryType())])
    ))
    size = shelves.agg(F.sum(F.length("head") + F.length("body"))).first()[0] or 0
    groups = shelves.coalesce(max(1, -(-size // _GROUP_BYTES)))
    schema = StructType([StructField("query", query.dataType), StructField("other", other.dataType), StructField("score", DoubleType())])
    itself = exclude is None

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        number, own, met = None, None, []
        for batch in batches:
            numbers, queries, heads, bodies = (batch.column(c) for c in ("part", "queries", "head", "body"))
            for i, next_ in enumerate(numbers.to_pylist()):
                if next_ != number and met:
                    yield from _best_on_shelves(own, met, n, itself, block_rows)
                    met = []
                number, own = next_, queries[i].as_buffer()
                met.append((heads[i].as_buffer(), bodies[i].as_buffer()))
        if met:
            yield from _best_on_shelves(own, met, n, itself, block_rows)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _in_batches(lists(batches)):
            types = [types_of[name] for name in schema.names]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    types_of = {field.name: to_arrow_type(field.dataType) for field in schema}
    return cut_lineage(packed.crossJoin(groups.hint("shuffle_replicate_nl")).mapInArrow(found, schema))


def search_top(
    queries: DataFrame,
    postings: DataFrame,
    n: int,
    exclude: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    shelf_rows: int = SHELF_ROWS,
    asked_rows: int = ASKED_ROWS,
) -> DataFrame:
    """``(query, other, score, rank)``, the best ``n`` answers of every query.

    ``queries(query, key, q)`` and ``postings(other, key, impact)`` hold one row per id and key; neither is null. Both are
    read several times and should be tables. ``exclude(query, other)`` names pairs that are no answer; without it, an
    id is no answer to itself. Products may be negative.

    Postings stand on shelves of about ``SHELF_ROWS``, ranges of the answers' ids, and shelves and queries are packed:
    neither is copied for the other, whatever their number (``_on_shelves``). What a query can get from a shelf at most is
    the sum of each key's best product there. A query first searches the shelf of its highest bound; its n-th best
    score there closes all shelves with a lower bound, and the others are searched too. Inside a shelf blocks of about
    ``block_rows`` postings are closed in the same way. A query adds its keys' postings into one array of scores and keeps the best n, so pairs
    never leave a task. An id with more rows than a block, at most rows / ``block_rows`` many, meets all others by joins
    on the key, and scores are summed in the shuffle. So are those of few ids, whose pairs are no more than a block's rows.
    """
    queries, postings = queries.select("query", "key", "q"), postings.select("other", "key", "impact")
    if queries.select("query").distinct().count() * postings.select("other").distinct().count() <= block_rows:
        return top_k(_answers(_direct(queries, postings), exclude), ["query"], "score", ["other"], n)
    large, long = heavy_ids(postings, "other", block_rows), heavy_ids(queries, "query", block_rows)
    work = partial(_best_in_cell, n=n, itself=exclude is None, block_rows=block_rows)
    parts = []
    if large.head(1):
        parts.append(_answers(_direct(queries, postings.join(large, "other", "left_semi")), exclude))
        postings = postings.join(large, "other", "left_anti")
    if long.head(1):
        parts.append(_answers(_direct(queries.join(long, "query", "left_semi"), postings), exclude))
        queries = queries.join(long, "query", "left_anti")
    n_shelves = max(1, -(-postings.count() // shelf_rows))
    if n_shelves == 1:
        placed = postings.withColumn("block", F.lit(0))
        pairs = queries.select("query").distinct().withColumn("block", F.lit(0))
        parts.append(in_blocks(pairs, queries, placed, work, exclude, asked_rows))
    else:
        parts.append(_on_shelves(queries, postings, n, exclude, block_rows, n_shelves, asked_rows))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return top_k(whole, ["query"], "score", ["other"], n)
