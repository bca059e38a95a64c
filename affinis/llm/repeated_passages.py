"""Removal of passages that occur more than once in a corpus, by difference-cover anchors.

A window is ``width`` consecutive words. Anchors are shorter windows, hashed only at positions that fall into a
difference cover of ``PERIOD`` (position modulo the period). For any two positions there is a shift below the
period that brings both onto cover positions, so two equal windows, wherever they stand, share an anchor at the
same place inside. Five of 21 positions are hashed.

1. Texts are stored once in units of about ``UNIT_BYTES``, bucketed by unit.
2. Each unit sends its distinct anchors, as sorted blocks, to hash ranges; a range answers every unit with the
   anchors that other units have too. What repeats inside a unit the unit knows itself.
3. Every window around a repeated anchor is a candidate. Anchors extend to windows: the whole windows are hashed,
   by another hash, and go the same way.
4. Words covered by a window that occurs again are removed.

A hash that fills a third of the corpus is sent once per unit, so ranges stay even, and no pairs are made. Windows
are judged on the input. The first occurrence is removed as well; the contract of the query asks for it.
Null and empty texts have no words. A text shorter than a window loses nothing. Repeated rows are repetitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.words import NO_HASHES, WordHashes, mixed, plain_words, window_hashes
from affinis.session import cut_lineage, scratch_path, scratch_table

WIDTH = 35
#: A perfect difference set. Every number below 21 is a difference of two of its members, modulo 21.
PERIOD, COVER = 21, (0, 1, 6, 8, 18)
UNIT_BYTES = 1_000_000

_ANCHOR, _WINDOW = np.uint64(0x8BB84B93962EACC9), np.uint64(0x2D358DCCAA6C78A5)


def anchors(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a text's anchors."""
    found = window_hashes(hashes, width - PERIOD + 1)
    at = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(len(found)) % PERIOD])
    return at, mixed(found[at] ^ _ANCHOR)


def candidate_starts(at: np.ndarray, repeated: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """Starts of all windows that hold a repeated anchor."""
    n = n_words - width + 1
    if n <= 0 or not repeated.any():
        return np.empty(0, np.int64)
    change = np.zeros(n + 1, np.int64)
    last = np.minimum(at[repeated], n - 1)
    first = np.maximum(at[repeated] - (PERIOD - 1), 0)
    first = np.minimum(first, n)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return np.flatnonzero(np.cumsum(change[:n]) > 0)


def covered(starts: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """Flags of the words of windows."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:n_words]) > 0


def _unit_rows(batches: Iterator[pa.RecordBatch], unit_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (unit, docs): documents in the order of the input, in lists of about ``unit_bytes``."""
    base = TaskContext.get().partitionId() << 32
    number = 0
    for batch in batches:
        start = size = 0
        texts = batch.column(0).field("text")
        for at in range(len(texts)):
            size += len(texts[at].as_buffer() or b"") if texts[at].is_valid else 0
            if size >= unit_bytes or at == len(texts) - 1:
                rows = batch.column(0).slice(start, at + 1 - start)
                lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([pa.array([base + number]), lists], names=["unit", "docs"])
                number, start, size = number + 1, at + 1, 0


def _sent(unit: int, hashes: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Distinct hashes of a unit, one block per hash range."""
    part = (hashes >> np.uint64(32)) % np.uint64(ranges)
    order = np.argsort(part, kind="stable")
    part, hashes = part[order], hashes[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    blocks = [b.tobytes() for b in np.split(hashes, cuts)] if len(hashes) else []
    firsts = part[np.concatenate(([0], cuts))].astype(np.int32) if len(hashes) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(firsts, pa.int32()), pa.array([unit] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())],
        names=["range", "unit", "hashes"],
    )


def _shared(table: pa.Table) -> pa.Table:
    """Of the blocks of one range, for each unit the hashes that another unit has, too."""
    units = table.column("unit").to_pylist()
    blocks = [np.frombuffer(b, np.uint64) for b in table.column("hashes").to_pylist()]
    every = np.sort(np.concatenate(blocks))
    several = np.unique(every[1:][every[1:] == every[:-1]])
    out_units, out = [], []
    for unit, block in zip(units, blocks, strict=True):
        found = block[_in(block, several)]
        if len(found):
            out_units.append(unit)
            out.append(found.tobytes())
    return pa.table({"unit": pa.array(out_units, pa.int64()), "hashes": pa.array(out, pa.binary())})


def _answers(sent: DataFrame) -> DataFrame:
    """(unit, blocks): the hashes of a unit that other units have."""
    shared = sent.groupBy("range").applyInArrow(_shared, "unit long, hashes binary")
    return shared.groupBy("unit").agg(F.collect_list("hashes").alias("blocks"))


def _known(own: np.ndarray, blocks: list[bytes] | None) -> np.ndarray:
    """Sorted hashes that occur again: inside the unit, or by the answer."""
    ordered = np.sort(own)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return np.unique(np.concatenate([again, *(np.frombuffer(b, np.uint64) for b in blocks or ())]))


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered) or not len(values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _together(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else NO_HASHES


def _windows(texts: list[bytes | None], blocks: list[bytes] | None, width: int, hashes: WordHashes):
    """Per text: its words, the starts of candidate windows and their hashes."""
    split = [plain_words(t) for t in texts]
    numbers = [hashes.of(w) for w in split]
    own = [anchors(h, width) for h in numbers]
    known = _known(_together([h for _, h in own]), blocks)
    out = []
    for words, number, (at, found) in zip(split, numbers, own, strict=True):
        starts = candidate_starts(at, _in(found, known), len(words), width)
        full = mixed(window_hashes(number, width)[starts] ^ _WINDOW) if len(starts) else NO_HASHES
        out.append((words, starts, full))
    return out


def remove_repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, with_text: bool = False,
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 of the kept words joined by one space, and with
    ``with_text`` the kept words themselves as ``kept_text``.

    ``width`` is at least the period of the cover.
    """
    if width < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = _stored_units(docs, doc_id, text, ranges, unit_bytes)

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for unit, texts, *_ in _each(batches):
            found = [anchors(hashes.of(plain_words(t)), width)[1] for t in texts]
            yield _sent(unit, np.unique(_together(found)), ranges)

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for unit, texts, blocks, *_ in _each(batches):
            found = [full for _, _, full in _windows(texts, blocks, width, hashes)]
            yield _sent(unit, np.unique(_together(found)), ranges)

    fields = "range int, unit long, hashes binary"
    texts = F.transform("docs", lambda d: d["text"]).alias("texts")
    first = _answers(units.select("unit", texts).mapInArrow(send_anchors, fields))
    first = cut_lineage(first.withColumnRenamed("blocks", "anchors"))
    joined = units.join(first, "unit", "left")
    second = _answers(joined.select("unit", texts, "anchors").mapInArrow(send_windows, fields))
    final = joined.join(second, "unit", "left")

    schema = f"doc_id {units.schema['docs'].dataType.elementType['doc_id'].dataType.simpleString()}, " \
        "n_words long, n_removed long, kept_sha256 string, kept_text string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for row in range(batch.num_rows):
                stored = batch.column("docs")[row].values
                first_blocks, blocks = batch.column("anchors")[row].as_py(), batch.column("blocks")[row].as_py()
                found = _windows(stored.field("text").to_pylist(), first_blocks, width, hashes)
                known = _known(_together([full for _, _, full in found]), blocks)
                counts, removed, digests, kept_texts = [], [], [], []
                for words, starts, full in found:
                    starts = starts[_in(full, known)]
                    kept = words
                    if len(starts):
                        gone = covered(starts, len(words), width).tolist()
                        kept = [w for w, g in zip(words, gone, strict=True) if not g]
                    body = b" ".join(kept)
                    counts.append(len(words))
                    removed.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(body).hexdigest())
                    kept_texts.append(body.decode("utf-8", "replace") if with_text else None)
                yield pa.RecordBatch.from_arrays([
                    stored.field("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()), pa.array(kept_texts, pa.string()),
                ], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    done = final.select("unit", "docs", "anchors", "blocks").mapInArrow(remove, schema)
    return done if with_text else done.drop("kept_text")


def _each(batches: Iterator[pa.RecordBatch]):
    """Unit, texts and, where there is one, answer of every row."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield tuple(column[row].as_py() for column in batch.columns)


def _stored_units(docs: DataFrame, doc_id: str, text: str, buckets: int, unit_bytes: int) -> DataFrame:
    """Units in the shared folder, bucketed, so that joins with answers move the answers alone."""
    spark = docs.sparkSession
    packed = docs.select(F.struct(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")
    ).alias("doc"))
    item = packed.schema["doc"].dataType.simpleString()
    units = packed.mapInArrow(lambda batches: _unit_rows(batches, unit_bytes), f"unit long, docs array<{item}>")
    name = scratch_table(spark, "units")
    (
        units.repartition(buckets, "unit").write.option("path", scratch_path(spark, "units"))
        .option("compression", "zstd").bucketBy(buckets, "unit").sortBy("unit").saveAsTable(name)
    )
    return spark.table(name)
