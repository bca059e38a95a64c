"""Near-duplicate classes of texts, by DartMinHash signatures and banded joining.

A text is the multiset of its five-word shingles: a shingle that occurs x times has weight x. Whole weights are the
reduction made here: the weight axis of a shingle is cut into x unit intervals, each a region of its own (the c-th
occurrence of a shingle is the same region in every text), so the number of regions is the number of shingle
occurrences. Darts fall on every region at unit rate along the rank axis, by a hash of the region alone, so two texts
see the same darts where their regions agree. Of all darts that fall on a text, the earliest of each coordinate makes
the signature. Two signatures agree in a coordinate with the probability of the weighted Jaccard similarity. Only about
k (ln k + 3) darts of lowest rank are thrown at a text, however long it is; if a coordinate stays empty, the rank limit
doubles.

Signatures are cut into bands. Texts that share a band are compared exactly:

1. texts of equal words (by a 128-bit hash) collapse to one node;
2. in every bucket (band, key), each node meets the smallest one, and pairs of the wanted similarity are links;
3. a bucket whose nodes are now in several components holds pairs that step 2 did not meet. Rounds settle it: the
   component of one of its nodes is its home, the smallest nodes outside of it are leads and meet all nodes of the
   bucket, ``LEADS`` of them in the first round and eight times as many in each later one, until no node outside the home
   is left that has not been a lead. Two nodes that never met are then both in the home, so linked already;
4. components of all links are the classes.

Nodes meet in cells of at most ``LEADS`` leads and about ``CELL_NODES`` nodes of one bucket. A cell emits a spanning forest
of its links, at most as many as it has nodes, so no bucket emits its pairs, and no link between nodes of a bucket is
lost. With 24 bands of 5 coordinates a pair at 0.8 shares a band with probability 0.99993.

Texts without words (null, empty) are equal to nothing: each row is a class of its own. A text of fewer than five
words is one shingle. Rows of equal id and text, repeated rows included, are copies of each other. Rows of null
id are classed like others; a class is named by its smallest id that is not null.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from affinis.llm.columns import with_text_column
from affinis.llm.components import connected_components
from affinis.llm.words import WordHashes, folded_words, mixed, window_hashes
from affinis.session import cut_lineage

SHINGLE_WORDS = 5
BANDS, BAND_ROWS = 24, 5
#: Leads of one cell, and the other nodes that it holds on average: what one task has in memory at a time.
LEADS, CELL_NODES = 128, 512
#: How many times more leads a bucket has in each round than in the one before.
MORE_LEADS = 8

_COPY = np.uint64(0xA0761D6478BD642F)
_ARRIVAL = np.uint64(0xE7037ED1A0B428DB)
_PLACE = np.uint64(0x8EBC6AF09C88C6E3)

SKETCH = StructType([
    StructField("words", BinaryType()), StructField("n_cells", IntegerType()), StructField("bands", ArrayType(LongType())),
])


def unit_cells(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Distinct numbers, one per shingle occurrence: the c-th occurrence of a shingle is the same in every text."""
    if not words:
        return np.empty(0, np.uint64)
    shingles = np.sort(window_hashes(hashes.of(words), min(SHINGLE_WORDS, len(words))))
    same = shingles[1:] == shingles[:-1]
    if same.any():
        at = np.arange(len(shingles))
        first = np.maximum.accumulate(np.where(np.concatenate(([False], same)), 0, at))
        shingles = mixed(shingles + (at - first).astype(np.uint64) * _COPY)
    return shingles


def throw_darts(cells: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and names of all darts of rank up to ``limit`` on cells of unit weight.

    The ranks on one cell are the arrivals of a Poisson process, one unit apart on average.
    """
    ranks, names = [], []
    rank, n = np.zeros(len(cells)), 0
    while len(cells):
        count = 1 if limit < 4 else int(limit / 2)
        number = np.arange(n + 1, n + 1 + count, dtype=np.uint64)
        dart = mixed(cells[:, None] + number[None, :] * _ARRIVAL)
        gaps = -np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        arrival = rank[:, None] + np.cumsum(gaps, axis=1)
        counts = arrival <= limit
        ranks.append(arrival[counts])
        names.append(dart[counts])
        alive = counts[:, -1]
        cells, rank, n = cells[alive], arrival[alive, -1], n + count
    return np.concatenate(ranks), np.concatenate(names)


def signature(cells: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates."""
    limit = k * (log(k) + 3) / len(cells)
    while True:
        ranks, names = throw_darts(cells, limit)
        late_first = np.argsort(-ranks, kind="stable")
        names = names[late_first]
        out = np.zeros(k, np.uint64)
        place = (mixed(names ^ _PLACE) % np.uint64(k)).astype(np.int64)
        out[place] = names  # of several darts on one coordinate the last in this order, the earliest, stays
        seen = np.zeros(k, bool)
        seen[place] = True
        if seen.all():
            return out
        limit *= 2


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    parts = sketch.reshape(bands, rows)
    for r in range(rows):
        key = mixed(key ^ parts[:, r])
    return key.view(np.int64)


def words_digest(words: list[bytes]) -> bytes:
    """The same 128 bits for the same words."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def _sketch_of(bands: int, rows: int):
    hashes = WordHashes()

    def of(text: bytes | None) -> dict | None:
        words = folded_words(text)
        if not words:
            return None
        cells = unit_cells(words, hashes)
        return {
            "words": words_digest(words), "n_cells": len(cells),
            "bands": band_keys(signature(cells, bands * rows), bands, rows),
        }

    return of


def _row_key(doc_id: str, text: str) -> list:
    """Columns (no_id, id, text_hash) that tell rows apart; none is null, so one exchange serves joins and groups."""
    kind = F.col(f"`{doc_id}`")
    return [
        kind.isNull().alias("no_id"), F.coalesce(kind.cast("string"), F.lit("")).alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
    ]


KEY = ["no_id", "id", "text_hash"]


def near_duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8,
    bands: int = BANDS, band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``no_id``, ``id``, ``text_hash`` (the row's key), ``class_id``.

    ``class_id`` is the smallest id of the class, null for a class of null ids only. ``first_row`` marks the rows
    that stand for their class (identical rows all do). ``n_rows`` counts the class.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *_row_key(doc_id, text), F.col(f"`{text}`").alias("text"))
    sketched = with_text_column(rows, "text", "sketch", SKETCH, lambda: _sketch_of(bands, band_rows))
    sketched = cut_lineage(sketched.select("doc_id", *KEY, "sketch.*"))
    place = F.struct("no_id", "doc_id", "id", "text_hash")
    nodes = cut_lineage(sketched.where("words is not null").groupBy("words").agg(
        F.first("bands").alias("bands"), F.first("n_cells").alias("n_cells"), F.min(place).alias("at"),
    ).withColumn("node", F.monotonically_increasing_id()))
    members = nodes.select("node", "n_cells", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(
        F.min(F.struct("node", "n_cells")).alias("lead"), F.count("*").alias("n")
    ).where("n > 1").select("bucket", F.col("lead.node").alias("lead"), F.col("lead.n_cells").alias("lead_cells"), "n")
    members = cut_lineage(members.join(buckets, "bucket"))
    texts = cut_lineage(_texts_of(members.select("node"), nodes, rows))
    parts = components_in_buckets(members, texts, threshold)

    part_of = nodes.select("words", "node").join(parts, "node", "left").select(
        "words", F.coalesce("component", "node").alias("part")
    )
    owned = cut_lineage(sketched.select("doc_id", *KEY, "words").join(part_of, "words", "left").drop("words"))
    # combined in the tasks that read the rows, then a table of its own: the join below may split a large class
    classes = cut_lineage(owned.where("part is not null").groupBy("part").agg(
        F.min("doc_id").alias("class_id"), F.min(place).alias("first"), F.count("*").alias("n_rows")
    ))
    return owned.join(classes, "part", "left").select(
        "doc_id", *KEY,
        F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("part").isNull() | F.col("first").eqNullSafe(place)).alias("first_row"),
        F.coalesce("n_rows", F.lit(1)).alias("n_rows"),
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without all but one row of every class: that of the smallest id.

    Of repeated rows of that id and text that differ in other columns, the one of the least values stays, compared
    column by column.
    """
    classes = near_duplicate_classes(docs, doc_id, text, **options)
    first = classes.where("first_row").select(*KEY).distinct()
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *_row_key(doc_id, text))
    # repeated rows collapse in the tasks that read them; the join finds the rest where the grouping put it
    found = packed.groupBy(*KEY).agg(F.min("row").alias("row")).join(first, KEY, "left_semi")
    return found.select(*[F.col("row").getField(c).alias(c) for c in names])


def _texts_of(wanted: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, text) of the nodes that share a bucket; one text per node, though many rows may have it."""
    places = nodes.join(wanted.distinct(), "node", "left_semi").select("node", "at.no_id", "at.id", "at.text_hash")
    found = rows.select(*KEY, F.col("text").cast("binary").alias("text")).join(places, KEY)
    return found.groupBy(*KEY).agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text")


def components_in_buckets(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, component) of the nodes that are linked, from members (bucket, node, n_cells, lead, lead_cells, n)."""
    parts = connected_components(links_to_leads(members, texts, threshold))
    wide = members.where("n > 2")
    placed = _with_part(wide, parts, "node", "part").select("bucket", "node", "n_cells", "part")
    # the home of a bucket: the component of most of its nodes, known by one of them
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"), F.min("node").alias("anchor"))
    homes = sizes.groupBy("bucket").agg(
        F.max_by("anchor", F.struct("n", "part")).alias("anchor"), F.count("*").alias("n_parts")
    ).where("n_parts > 1").select("bucket", "anchor", F.lit(-1).cast("long").alias("after"))
    homes, n_leads = cut_lineage(homes), LEADS
    while True:
        placed = _with_part(wide.join(homes, "bucket"), parts, "node", "part")
        placed = cut_lineage(_with_part(placed, parts, "anchor", "home").select(
            "bucket", "node", "n_cells", "part", "n", "anchor", "after",
            ((F.col("part") != F.col("home")) & (F.col("node") > F.col("after"))).alias("outside"),
        ))
        rank = Window.partitionBy("bucket").orderBy("node")
        leads = cut_lineage(placed.where("outside").withColumn("rank", F.row_number().over(rank)).where(
            F.col("rank") <= n_leads
        ).select("bucket", "node", ((F.col("rank") - 1) / LEADS).cast("int").alias("row")))
        if not leads.head(1):
            return parts
        links = cut_lineage(_met(_bucket_cells(placed, leads), texts, threshold))
        ends = _with_part(_with_part(links, parts, "a", "pa"), parts, "b", "pb")
        merged = connected_components(ends.select(F.col("pa").alias("a"), F.col("pb").alias("b")))
        moved = _with_part(parts.unionByName(_new_nodes(links, parts)), merged, "component", "now")
        parts = cut_lineage(moved.select("node", F.col("now").alias("component")))
        last = leads.groupBy("bucket").agg(F.max("node").alias("last"), F.count("*").alias("n"))
        # a bucket that had fewer leads than it could have has none left
        homes = cut_lineage(homes.join(last.where(F.col("n") == n_leads), "bucket").select(
            "bucket", "anchor", F.col("last").alias("after")
        ))
        if not homes.head(1):
            return parts
        n_leads *= MORE_LEADS


def _with_part(df: DataFrame, parts: DataFrame, node: str, out: str) -> DataFrame:
    """``df`` with the component of a node column; a node without links is its own."""
    named = parts.select(F.col("node").alias("_of"), F.col("component").alias("_part"))
    return df.join(named, F.col(node) == F.col("_of"), "left").withColumn(
        out, F.coalesce("_part", F.col(node))
    ).drop("_of", "_part")


def _new_nodes(links: DataFrame, parts: DataFrame) -> DataFrame:
    """Nodes of links that had none before, as components of their own."""
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    return nodes.join(parts, "node", "left_anti").select("node", F.col("node").alias("component"))


def links_to_leads(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b) for nodes as similar as wanted to the smallest node of one of their buckets.

    A lead's text goes once to every cell of about ``CELL_NODES`` nodes, however many buckets the pairs share.
    """
    near = F.least("n_cells", "lead_cells") >= F.greatest("n_cells", "lead_cells") * threshold
    pairs = cut_lineage(members.where("node <> lead").where(near).select("node", "lead").distinct())
    sizes = pairs.groupBy("lead").agg(F.ceil(F.count("*") / CELL_NODES).alias("cols"))
    nodes = pairs.join(sizes, "lead").select(
        F.col("lead").alias("bucket"), F.lit(0).alias("row"), _place("cols").alias("col"), "node",
        F.col("node").alias("part"), F.lit(False).alias("leads"),
    )
    leads = sizes.select(
        F.col("lead").alias("bucket"), F.lit(0).alias("row"), _every("cols").alias("col"), F.col("lead").alias("node"),
        F.col("lead").alias("part"), F.lit(True).alias("leads"),
    )
    return cut_lineage(_met(nodes.unionByName(leads), texts, threshold))


def _place(count: str):
    return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")


def _every(count: str):
    return F.explode(F.sequence(F.lit(0), (F.col(count) - 1).cast("int")))


def _bucket_cells(placed: DataFrame, leads: DataFrame) -> DataFrame:
    """Rows of cells (bucket, row, col): nodes once per block of leads, leads once per block of nodes.

    A lead meets the nodes of its own block as well, and other leads there or in their cells.
    """
    rows = leads.groupBy("bucket").agg((F.max("row") + 1).alias("rows"))
    sized = placed.join(rows, "bucket").withColumn("cols", F.ceil(F.col("n") / CELL_NODES))
    own = _place("cols")
    nodes = sized.select("bucket", _every("rows").alias("row"), own.alias("col"), "node", "part", F.lit(False).alias("leads"))
    named = leads.join(sized.select("bucket", "node", "part", "cols"), ["bucket", "node"])
    leading = named.select("bucket", "row", _every("cols").alias("col"), "node", "part", F.lit(True).alias("leads"))
    both = nodes.unionByName(leading)
    # a lead in its own block of nodes is one row, not two
    return both.groupBy("bucket", "row", "col", "node", "part").agg(F.max("leads").alias("leads"))


def _met(cells: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """A spanning forest of the links that leads and nodes of a cell have, beyond those of equal ``part``.

    Cells have columns bucket, row, col, node, part, leads.
    """

    def compare(cell: pa.Table) -> pa.Table:
        hashes = WordHashes()
        nodes, parts, leads = (cell.column(c).to_pylist() for c in ("node", "part", "leads"))
        bags = [unit_cells(folded_words(t), hashes) for t in cell.column("text").to_pylist()]
        top = {p: p for p in parts}

        def part(at: int) -> int:
            p = parts[at]
            while top[p] != p:
                top[p] = p = top[top[p]]
            return p

        first = [at for at, is_lead in enumerate(leads) if is_lead]
        everything = np.concatenate([bags[k] for k in first]) if first else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(first)), [len(bags[k]) for k in first])
        order = np.argsort(everything, kind="stable")
        everything, owner = everything[order], owner[order]
        sizes = np.array([len(bags[k]) for k in first])
        a, b = [], []
        for at, bag in enumerate(bags):
            low, high = np.searchsorted(everything, bag, "left"), np.searchsorted(everything, bag, "right")
            spread = high - low
            places = np.repeat(low - np.concatenate(([0], np.cumsum(spread)[:-1])), spread) + np.arange(spread.sum())
            shared = np.bincount(owner[places], minlength=len(first))
            for k in np.flatnonzero(shared / (len(bag) + sizes - shared) >= threshold).tolist():
                own, other = part(at), part(first[k])
                if own != other:
                    top[max(own, other)] = min(own, other)
                    a.append(nodes[at])
                    b.append(nodes[first[k]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    whole = cells.join(texts, "node").select("bucket", "row", "col", "node", "part", "leads", "text")
    return whole.groupBy("bucket", "row", "col").applyInArrow(compare, "a long, b long")
