"""Token ids of documents, packed into matrices of fixed width.

Documents are tokenised and packed in one pass over the input, without a shuffle: each task gathers documents until
their ids reach ``chunk_tokens``, then packs that chunk by best-fit decreasing. Longest pieces go first, each into
the row with the least room that still takes it, found in a segment tree over rooms (``RoomTree``). A document over
the width is cut into full pieces and a remainder, losslessly.

A matrix is stored as one table row: ids in row order as little-endian unsigned 16 or 32 bit numbers, padded with
``pad``; the cumulative lengths of its segments in flat order, which start anew with every row of the matrix; the flat
places at which positions restart at 0; and for each segment its document, piece and place.

Null and empty texts have no ids: they are listed as one segment of length 0 that takes no place. Repeated rows
are packed as often as they occur. Vocabulary files are read by the driver and sent to the tasks; a vocabulary
has a fixed size of a few MB.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pretokeniser pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_TOKENS = 2_000_000
MATRIX_ROWS = 256


class RoomTree:
    """A segment tree over the possible rooms 0 to ``width``: each leaf counts the open rows of that room.

    The least room of at least ``size`` that some row has is found by one walk up and down, in log(width) steps.
    """

    def __init__(self, width: int):
        self.leaves = 1
        while self.leaves < width + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Room and row of the tightest fit, which leaves the tree; None if no row fits."""
        node = self.leaves + size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: Iterable[int], width: int) -> list[tuple[int, int]]:
    """Row and offset of each length (1 to ``width``, falling)."""
    tree, out, n = RoomTree(width), [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, n = (width, n), n + 1
        room, row = found
        out.append((row, width - room))
        if room > length:
            tree.add(room - length, row)
    return out


MATRIX = (
    "width int, n_rows int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "segments array<struct<doc_id:{id},piece:int,start:long,length:int,row:int,offset:int>>"
)


def pack_chunk(ids: list[np.ndarray], docs: list[int], width: int, pad: int) -> Iterator[tuple]:
    """Matrices of one chunk: (ids, cumulative lengths, position resets, segments), segments as
    (index into ``docs``, piece, start, length, row, offset)."""
    pieces = [
        (min(width, len(own) - start), at, piece, start)
        for at, own in enumerate(ids) for piece, start in enumerate(range(0, len(own), width))
    ]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    by_row: dict[int, list[tuple]] = {}
    for (length, at, piece, start), (row, offset) in zip(
        pieces, best_fit_decreasing([p[0] for p in pieces], width), strict=True
    ):
        by_row.setdefault(row, []).append((offset, length, at, piece, start))
    for first in range(0, len(by_row), MATRIX_ROWS):
        rows = range(first, min(first + MATRIX_ROWS, len(by_row)))
        matrix = np.full((len(rows), width), pad, ids[0].dtype)
        cumulative, resets, segments = [], [], []
        for line, row in enumerate(rows):
            cumulative.append(line * width)
            for offset, length, at, piece, start in by_row[row]:
                matrix[line, offset:offset + length] = ids[at][start:start + length]
                resets.append(line * width + offset)
                cumulative.append(line * width + offset + length)
                segments.append((at, piece, start, length, line, offset))
        yield matrix, cumulative, resets, segments


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines ``base64 id``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(number) for token, number in (line.split() for line in lines if line.strip())}


def token_matrices(
    docs: DataFrame, ranks: dict[bytes, int], doc_id: str = "doc_id", text: str = "text", width: int = 2048,
    pad: int | None = None, chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """Packed matrices (``MATRIX``) of all documents.

    ``pad`` is an id that the vocabulary leaves free; by default the first one after it.
    """
    spark = docs.sparkSession
    pad = max(ranks.values()) + 1 if pad is None else pad
    kind = np.uint16 if pad < 1 << 16 else np.uint32
    sent = spark.sparkContext.broadcast(ranks)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = MATRIX.format(id=narrow.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding(
            "given", pat_str=PATTERN, mergeable_ranks=sent.value, special_tokens={}
        ).encode_to_numpy
        names: list[pa.Scalar] = []
        ids: list[np.ndarray] = []
        n = 0
        for batch in batches:
            own = batch.column(0)
            for at, value in enumerate(batch.column(1)):
                body = value.as_py()
                found = encode(body, disallowed_special=()).astype(kind) if body else np.empty(0, kind)
                names.append(own[at])
                ids.append(found)
                n += len(found)
                if n >= chunk_tokens:
                    yield from _chunk(names, ids, own.type, width, pad)
                    names, ids, n = [], [], 0
            id_type = own.type
        if names:
            yield from _chunk(names, ids, id_type, width, pad)

    return narrow.mapInArrow(run, schema)


def _chunk(names: list, ids: list[np.ndarray], id_type: pa.DataType, width: int, pad: int) -> Iterator[pa.RecordBatch]:
    parts = [(m.shape[0], m.astype(m.dtype.newbyteorder("<")).tobytes(), c, p, s)
             for m, c, p, s in pack_chunk(ids, names, width, pad)]
    empty = [(at, 0, 0, 0, None, None) for at, own in enumerate(ids) if not len(own)]
    if not parts:
        parts = [(0, b"", [], [], [])]
    parts[-1] = (*parts[-1][:4], parts[-1][4] + empty)
    segment = pa.struct([
        ("doc_id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
        ("row", pa.int32()), ("offset", pa.int32()),
    ])
    keys = ("piece", "start", "length", "row", "offset")
    for rows, matrix, cumulative, resets, segments in parts:
        listed = [{"doc_id": names[s[0]].as_py()} | dict(zip(keys, s[1:], strict=True)) for s in segments]
        yield pa.RecordBatch.from_arrays([
            pa.array([width], pa.int32()), pa.array([rows], pa.int32()), pa.array([matrix], pa.binary()),
            pa.array([cumulative], pa.list_(pa.int32())), pa.array([resets], pa.list_(pa.int32())),
            pa.array([listed], pa.list_(segment)),
        ], names=["width", "n_rows", "ids", "cu_seqlens", "position_resets", "segments"])


SEGMENT = "doc_id {id}, piece int, start long, length int, row int, offset int, ids_crc32 long"


def read_segments(matrices: DataFrame) -> DataFrame:
    """Segments of stored matrices, taken from the binary columns again (``SEGMENT``).

    ``ids_crc32`` is that of the segment's little-endian ids. A segment that does not begin at a position reset
    and end at a cumulative length is an error.
    """
    id_type = matrices.schema["segments"].dataType.elementType["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                width, n_rows, ids, cumulative, resets = (
                    batch.column(c)[at].as_py() for c in ("width", "n_rows", "ids", "cu_seqlens", "position_resets")
                )
                size = len(ids) // (width * n_rows) if n_rows else 0
                starts, ends = set(resets), set(cumulative)
                segments = batch.column("segments")[at].values
                checks = []
                for length, row, offset in zip(
                    *(segments.field(c).to_pylist() for c in ("length", "row", "offset")), strict=True
                ):
                    start = row * width + offset if length else 0
                    if length and (start not in starts or start + length not in ends):
                        raise ValueError(f"row {row} of a matrix has a broken segment at {offset}")
                    checks.append(zlib.crc32(ids[start * size:(start + length) * size]))
                yield pa.RecordBatch.from_arrays(
                    [segments.field(c) for c in ("doc_id", "piece", "start", "length", "row", "offset")]
                    + [pa.array(checks, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "row", "offset", "ids_crc32"],
                )

    return matrices.mapInArrow(run, SEGMENT.format(id=id_type))
