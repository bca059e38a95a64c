"""Best-fit packing of documents into bins, with conflicts.

Documents are placed by falling size. Bins stand in order of their free space; the search starts at the successor
of the size, the fullest bin that still takes it, and goes on to roomier bins until one has no conflict. A bin
carries a bitmap of the duplicate clusters in it (a cluster enters once) and, in planes, bitmaps of the sources
(a source enters at most ``per_source`` times: plane p has the sources that are there more than p times).

Documents are dealt to packing groups of about ``group_rows`` by a hash of the row, whatever their source or
cluster, so a hot source or a large group of copies is spread evenly, and each group packs by itself with bounded
memory. Ids, sizes, sources and cluster hashes travel; texts don't.

A document over the capacity is cut into full pieces and a remainder, losslessly: pieces are numbered and know
where they start. Documents of size 0 (null or empty texts) take no place in a bin: one row, bin null. A null
source is a source like others. Copies without words share no cluster. Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import cut_lineage

PLACED = "row long, piece int, piece_start long, length int, bin long, bin_offset int"


class Bins:
    """Open bins in order of free space."""

    def __init__(self, capacity: int, per_source: int | None):
        self.capacity, self.per_source = capacity, per_source
        self.levels: dict[int, list[int]] = {}
        self.free_sizes = 0  # bit r is set if a bin has free space r
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []
        self.free: list[int] = []

    def fits(self, number: int, cluster: int, source: int) -> bool:
        return not (self.clusters[number] & cluster or self.per_source and self.sources[number][-1] & source)

    def find(self, size: int, cluster: int, source: int, after: tuple[int, int] = (0, 0)) -> tuple[int, int] | None:
        """Free space and position of the tightest bin without a conflict, from ``after`` on."""
        low, skip = (size, 0) if after[0] < size else after
        rest = self.free_sizes >> low
        while rest:
            gap = (rest & -rest).bit_length() - 1
            low, rest, skip = low + gap, rest >> gap, 0 if gap else skip
            bins = self.levels[low]
            for at in range(skip, len(bins)):
                if self.fits(bins[at], cluster, source):
                    return low, at
            low, rest, skip = low + 1, rest >> 1, 0
        return None

    def open(self) -> int:
        self.clusters.append(0)
        self.sources.append([0] * (self.per_source or 0))
        self.free.append(self.capacity)
        return len(self.free) - 1

    def take(self, place: tuple[int, int]) -> int:
        """The bin at a place, out of the order."""
        bins = self.levels[place[0]]
        number = bins.pop(place[1])
        if not bins:
            del self.levels[place[0]]
            self.free_sizes &= ~(1 << place[0])
        return number

    def fill(self, number: int, size: int, cluster: int, source: int) -> int:
        """Puts a document into a bin and the bin back in order; the document's offset."""
        offset = self.capacity - self.free[number]
        self.clusters[number] |= cluster
        carry, planes = source, self.sources[number]
        for p in range(len(planes)):
            planes[p], carry = planes[p] | carry, planes[p] & carry
        self.free[number] -= size
        left = self.free[number]
        if left:
            self.levels.setdefault(left, []).append(number)
            self.free_sizes |= 1 << left
        return offset


def best_fit(
    items: Iterable[tuple[int, object, object]], capacity: int, per_source: int | None = None
) -> list[tuple[int, int]]:
    """Bin and offset of each (size, source, cluster), 0 < size <= capacity, in the order given.

    A cluster of None conflicts with nothing. Pass items by falling size.
    """
    bins, out = Bins(capacity, per_source), []
    source_bits: dict[object, int] = {}
    cluster_bits: dict[object, int] = {}
    last, place = None, (0, 0)
    for size, source, cluster in items:
        source_bit = 1 << source_bits.setdefault(source, len(source_bits))
        cluster_bit = 0 if cluster is None else 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
        # the next copy of the same size goes on where this one ended: every bin before has the cluster
        same = cluster is not None and last == (size, source, cluster)
        found = bins.find(size, cluster_bit, source_bit, place if same else (0, 0))
        last, place = (size, source, cluster), found or (capacity, 0)
        number = bins.take(found) if found else bins.open()
        out.append((number, bins.fill(number, size, cluster_bit, source_bit)))
    return out


def pack(
    docs: DataFrame, doc_id: str = "doc_id", size: str = "size", source: str = "source", cluster: str = "cluster",
    capacity: int = 2048, per_source: int | None = 2, group_rows: int = 20_000,
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, piece_start, length, bin, bin_offset.

    ``size`` is a whole number (null: 0); ``cluster`` any value, null for a document that is no copy.
    """
    measured = cut_lineage(docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"),
        F.xxhash64(F.col(source)).alias("source"),
        F.when(F.col(cluster).isNotNull(), F.xxhash64(F.col(cluster))).alias("cluster"),
    ).withColumn("row", F.monotonically_increasing_id()))
    n_groups = max(1, -(-measured.count() // group_rows))
    grouped = measured.where("size > 0").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_groups)))

    def place(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        pieces = []
        rows = zip(*(group.column(c).to_pylist() for c in ("row", "size", "source", "cluster")), strict=True)
        for row, length, of, copy in rows:
            for piece, start in enumerate(range(0, length, capacity)):
                pieces.append((min(capacity, length - start), copy, of, row, piece, start))
        pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], p[3], p[4]))
        # only clusters with more than one member here need a bit
        seen: dict[int, int] = {}
        for p in pieces:
            if p[1] is not None:
                seen[p[1]] = seen.get(p[1], 0) + 1
        placed = best_fit(
            ((p[0], p[2], p[1] if seen.get(p[1], 0) > 1 else None) for p in pieces), capacity, per_source
        )
        base = key[0].as_py() << 32
        return pa.table([
            pa.array([p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int32()),
            pa.array([p[5] for p in pieces], pa.int64()), pa.array([p[0] for p in pieces], pa.int32()),
            pa.array([base + number for number, _ in placed], pa.int64()),
            pa.array([offset for _, offset in placed], pa.int32()),
        ], names=["row", "piece", "piece_start", "length", "bin", "bin_offset"])

    placed = grouped.select("part", "row", "size", "source", "cluster").groupBy("part").applyInArrow(place, PLACED)
    found = measured.select("row", "doc_id").join(placed, "row", "left")
    return found.select(
        "doc_id", F.coalesce("piece", F.lit(0)).alias("piece"), F.coalesce("piece_start", F.lit(0)).alias("piece_start"),
        F.coalesce("length", F.lit(0)).alias("length"), "bin", "bin_offset",
    )


def measured_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size in words, source and cluster: a hash of the words without case, null where there are none."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t-\r]+"), "")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words.alias("words")).select(
        "doc_id", "source", F.size("words").cast("long").alias("size"),
        F.when(F.size("words") > 0, F.xxhash64("words")).alias("cluster"),
    )
