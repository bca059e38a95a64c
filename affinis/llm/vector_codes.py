"""Vector codes by product codebooks, each learned and applied by ball k-means.

A vector becomes whole numbers, ``floor(256 * x)``, and is cut into 16 equal consecutive parts. Every part position has
a codebook of at most 64 entries, and a part's code is its nearest entry (squared distance in whole numbers, ties to
the lower index). All sums are exact, so codes and codebooks do not depend on how rows are dealt to tasks.

Ball k-means finds the nearest entry without meeting all of them. Parts that start from one entry are a ball around
it, whose radius is the farthest of them. Half the way to another entry is where that one begins to be nearer, so

- entries over twice the radius away are no neighbours of the ball and meet none of its parts;
- parts nearer than half the way to the closest neighbour are its stable core and stay without a comparison;
- the rest lie in rings between the half ways to one neighbour and the next: a part in ring i meets the i closest
  neighbours alone.

A part starts from its entry of the round before, in the first round from the entry whose components have the nearest
sum. Balls are formed per Arrow batch, which gives smaller radii than balls over all rows and the same result.

Every pass reads a table in the shared folder and writes the next. Only sums per part, entry and component, at most
codebook size, leave a task and reach the driver; codebooks go back with the tasks.

Defined results: rows whose vector is null or holds null or non-finite components are dropped. So are vectors that do
not split into 16 parts (the empty one among them) or differ in length from the first vector that does, by id.
Components beyond +-65536 count as that. Null ids come last when the first entries are chosen; of equal ids the vector
decides. Repeated rows are coded each. Fewer vectors than entries give fewer entries; none give no rows. Other columns
of the input pass through under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, LongType, StructField, StructType

from affinis.session import cut_lineage

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: Components saturate here, so that squared distances stay exact in 64 bits for parts of up to 2,048 components.
LIMIT = 1 << 24


def whole_components(vectors: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Which vectors are kept, and the kept ones as little-endian 32-bit whole numbers."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vectors)
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    keep = (lengths > 0) & (lengths % PARTS == 0) & (bad[ends] == bad[ends - lengths])
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.clip(np.floor(values * SCALE), -LIMIT, LIMIT)
    whole = np.where(np.isfinite(values), whole, 0).astype("<i4")
    return keep, [whole[e - n:e].tobytes() for e, n in zip(ends[keep], lengths[keep], strict=True)]


def _matrix(parts: pa.Array, dim: int) -> np.ndarray:
    """(rows, part, component) of equally long vectors."""
    return np.frombuffer(b"".join(parts.to_pylist()), "<i4").reshape(len(parts), PARTS, dim).astype(np.int64)


def starting_entries(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entry with the nearest sum of components, as a first guess."""
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    between = (sums[order][1:] + sums[order][:-1]) / 2
    return order[np.searchsorted(between, points.sum(axis=1))]


def ball_assign(points: np.ndarray, start: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry and squared distance of each point, and how many distances were computed.

    ``start`` is any entry per point; a good one makes small balls.
    """
    squares = (entries * entries).sum(axis=1)
    between = squares[:, None] - 2 * (entries @ entries.T) + squares[None, :]
    index = start.copy()
    best = ((points - entries[start]) ** 2).sum(axis=1)
    computed = len(points)
    order = np.argsort(start, kind="stable")
    bounds = np.searchsorted(start[order], np.arange(len(entries) + 1))
    for ball in np.flatnonzero(np.diff(bounds)):
        members = order[bounds[ball]:bounds[ball + 1]]
        reach = 4 * best[members]  # (2 d)^2: an entry at that distance or less may be nearer, or as near
        near = np.argsort(between[ball], kind="stable")
        near = near[(near != ball) & (between[ball][near] <= reach.max())]
        if not len(near):
            continue
        ring = np.searchsorted(between[ball][near], reach, side="right")
        outside = ring > 0
        rows, ring = members[outside], ring[outside]
        if not len(rows):
            continue
        near = near[:ring.max()]
        own = points[rows]
        far = (own * own).sum(axis=1)[:, None] - 2 * (own @ entries[near].T) + squares[near][None, :]
        meets = np.arange(len(near))[None, :] < ring[:, None]
        computed += int(ring.sum())
        far = np.where(meets, far, np.iinfo(np.int64).max)
        low = far.min(axis=1)
        name = np.where(far == low[:, None], near[None, :], len(entries)).min(axis=1)
        better = (low < best[rows]) | ((low == best[rows]) & (name < ball))
        index[rows[better]] = name[better]
        best[rows[better]] = low[better]
    return index, best, computed


def whole_vectors(rows: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """(row, parts): the columns to keep as one struct, the vector as whole numbers; unusable vectors drop out."""
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{vector}`").alias("vector"))
    schema = StructType([packed.schema["row"], StructField("parts", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, parts = whole_components(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(kept)), pa.array(parts, pa.binary())], names=["row", "parts"]
            )

    return packed.mapInArrow(run, schema)


def assign(points: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``points`` (row, parts, perhaps codes of an earlier round) with new ``codes`` and their ``error``."""
    started = "codes" in points.columns
    wanted = points.select("row", "parts", *(["codes"] if started else []))
    schema = StructType([
        points.schema["row"], points.schema["parts"], StructField("codes", BinaryType()), StructField("error", LongType()),
    ])
    dim = codebooks.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(1), dim)
            before = started and np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, PARTS)
            codes = np.empty((len(values), PARTS), np.uint8)
            error = np.zeros(len(values), np.int64)
            for part in range(PARTS):
                own = np.ascontiguousarray(values[:, part])
                start = before[:, part].astype(np.int64) if started else starting_entries(own, codebooks[part])
                codes[:, part], far, _ = ball_assign(own, start, codebooks[part])
                error += far
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
            ], names=["row", "parts", "codes", "error"])

    return wanted.mapInArrow(run, schema)


def moved_codebooks(assigned: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Every entry at the floored mean of its parts; unused entries stay."""
    _, k, dim = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, k, dim + 1), np.int64)
        for batch in batches:
            values = _matrix(batch.column(0), dim)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, PARTS)
            for part in range(PARTS):
                np.add.at(sums[part, :, :dim], codes[:, part], values[:, part])
                sums[part, :, dim] += np.bincount(codes[:, part], minlength=k)
        part, entry = np.nonzero(sums[:, :, dim])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(part * k + entry, dim + 1).astype(np.int32)),
            pa.array(np.tile(np.arange(dim + 1, dtype=np.int32), len(part))), pa.array(sums[part, entry].reshape(-1)),
        ], names=["entry", "place", "total"])

    partial = assigned.select("parts", "codes").mapInArrow(run, "entry int, place int, total long")
    totals = np.zeros((PARTS * k, dim + 1), object)
    for r in partial.groupBy("entry", "place").agg(F.sum("total").alias("total")).collect():
        totals[r["entry"], r["place"]] = r["total"]
    moved = codebooks.copy().reshape(PARTS * k, dim)
    for entry in np.flatnonzero(totals[:, dim]):
        moved[entry] = [int(t) // int(totals[entry, dim]) for t in totals[entry, :dim]]
    return moved.reshape(codebooks.shape)


def fit(points: DataFrame, id: str, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame] | None:
    """Codebooks (part, entry, component) and the points with the codes of the last round; None without points."""
    order = [F.col(f"row.{id}").asc_nulls_last(), "parts"]
    first = points.select("row", "parts").orderBy(*order).limit(1).collect()
    if not first:
        return None
    size = len(first[0]["parts"])
    points = points.where(F.octet_length("parts") == size)
    seeds = [r["parts"] for r in points.select("row", "parts").orderBy(*order).limit(entries).collect()]
    dim = size // 4 // PARTS
    codebooks = np.ascontiguousarray(_matrix(pa.array(seeds, pa.binary()), dim).transpose(1, 0, 2))
    for _ in range(rounds):
        points = cut_lineage(assign(points, codebooks))
        codebooks = moved_codebooks(points, codebooks)
    return codebooks, points


def codebooks_text(codebooks: np.ndarray) -> str:
    """All components by part, entry and place, comma-joined."""
    return ",".join(map(str, codebooks.reshape(-1).tolist()))


def vector_codes(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """The columns of ``rows`` but the vector as struct ``row``, with ``codes`` (a byte a part) and ``error``; codebooks."""
    points = cut_lineage(whole_vectors(rows, vector, [c for c in rows.columns if c != vector]))
    fitted = fit(points, id, entries, rounds)
    if fitted is None:
        empty = points.select("row", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
        return empty.where(F.lit(False)), None
    codebooks, points = fitted
    return cut_lineage(assign(points, codebooks).select("row", "codes", "error")), codebooks


def decode(coded: DataFrame, codebooks: np.ndarray, out: str = "vector") -> DataFrame:
    """``coded`` (a column ``codes`` among others) with the vector its codes stand for."""
    books = (codebooks / SCALE).astype(np.float32)
    schema = StructType([*coded.schema.fields]).add(out, ArrayType(FloatType()))
    at = coded.columns.index("codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint8).reshape(-1, PARTS)
            found = books[np.arange(PARTS)[None, :], codes].reshape(len(codes), -1)
            vectors = pa.array(list(found), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors], schema=batch.schema.append(
                pa.field(out, pa.list_(pa.float32()))
            ))

    return coded.mapInArrow(run, schema)


def codebooks_digest(codebooks: np.ndarray | None) -> str:
    return hashlib.sha256(b"" if codebooks is None else codebooks_text(codebooks).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the error summed over equal labels, null ones together."""
    own = coded.withColumn("_label", F.col(f"row.{label}"))
    sums = own.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return own.join(sums, F.col("_label").eqNullSafe(F.col("_of"))).drop("_label", "_of")
