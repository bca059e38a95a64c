"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?`` role initials, found by parallel Viterbi.

Rows of a conversation stand by turn (nulls first), then by role and text hash, so identical rows are neighbours. A row's
first fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated. Edits are Keep (0),
Rerole to user or assistant (1), Delete (2, required for blank and duplicate rows) and Insert of an empty user or
assistant row anywhere (5); a truncated row that is not deleted adds 5. The audit is the string of edit initials of the
cheapest edits, the ASCII-least of equally cheap ones.

Four states are enough: nothing yet, after system, after user, after assistant. The cost of the cheapest way from a
state to the end of the conversation, for all four, is a vector; a row maps the vector after it to the vector before it.
Long conversations are cut into chunks of at most ``chunk_rows`` rows, which start together:

1. *Speculation.* Every chunk runs backward from the vector of a conversation's end.
2. *Fix-up passes.* A chunk whose successor begins with a vector that differs from the assumed one by more than a
   constant runs again from that. Passes go on until vectors differ only by constants. Rows mostly force all ways
   through one state, so one pass is the rule. After ``passes`` passes, chunks that still depend on what follows are
   settled by their 4 x 4 cost matrices in log2(chunks) joins instead, so no input needs a pass per chunk.
3. *Stitching.* The constants of a conversation's chunks add up to its cost.
4. *Tracing.* With its vectors known, a chunk traces the least audit forward from each of the four states. Joins of
   these maps, again log2(chunks), say from which state each chunk really starts.

Rows are dealt to chunks by range of (conversation, turn, role, hash), whatever the size of a conversation; identical
rows are counted before they move, and texts stay behind. Only the last step, which returns the repaired rows or their
digest, brings a conversation together, as a sorted stream: a digest of the whole is sequential by definition. It keeps
the conversation's audit in memory, a byte an edit, which is a value of the result.

Defined results: null roles and texts count as one space, null turns come first and make no gap, rows of a null
conversation id are a conversation. A role counts by its first character; an empty one is like an unknown one. Other
columns are not read, whatever their names. Texts are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from affinis.session import cut_lineage

CHUNK_ROWS = 4096
PASSES = 3
#: Costs and signs of the repair, and the white space of the fault rules; fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ENDS = (".", "!", "?")
SPACES = " \t\n\x0b\x0c\r"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row that is inserted or given its role: always the one that may come next.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Edits one row can have: up to two insertions before it, then its own.
EDITS = np.array([b"I" * n + own for n in range(3) for own in (b"D", b"K", b"R")], object)
_FAR = 1 << 20


def _kept_states() -> np.ndarray:
    """The state after a kept row, by row code and state before; -1 where it may not be kept.

    A code is the initial (s, u, a, other) plus 4 if truncated, 8 if the row must go.
    """
    kept = np.full((12, 4), -1)
    for truncated in (0, 4):
        kept[truncated + 0, NOTHING] = SYSTEM
        kept[truncated + 1, [NOTHING, SYSTEM, ASSISTANT]] = USER
        kept[truncated + 2, USER] = ASSISTANT
    return kept


def _row_costs(kept: np.ndarray) -> np.ndarray:
    """Cheapest change from state to state by one row and what is inserted before it, per row code."""
    inserted = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for state in range(4):
        one = NEXT[state]
        inserted[state, one] = min(inserted[state, one], INSERT)
        inserted[state, NEXT[one]] = min(inserted[state, NEXT[one]], 2 * INSERT)
    costs = np.full((12, 4, 4), _FAR)
    for code in range(12):
        stays = TRUNCATED if 4 <= code < 8 else 0
        own = np.where(np.eye(4, dtype=bool), DELETE, _FAR)
        for state in range(4):
            if code < 8:
                own[state, NEXT[state]] = min(own[state, NEXT[state]], REROLE + stays)
            if kept[code, state] >= 0:
                own[state, kept[code, state]] = min(own[state, kept[code, state]], stays)
        costs[code] = (inserted[:, :, None] + own[None, :, :]).min(axis=1)
    return np.minimum(costs, _FAR).astype(np.int32)


KEPT = _kept_states()
ROW_COSTS = _row_costs(KEPT)
#: Cost from each state at the end of a conversation: insertions that complete it.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], np.int32)
TAIL = [b"", b"II", b"I", b""]


def _slices(symbols: list[bytes], lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(indices, right-aligned codes, lengths) of chunks of similar length, longest first, in bounded slices."""
    lengths = np.array([len(s) for s in symbols])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = max(1, int(lengths[order[at]]))
        own = order[at:at + max(1, (1 << 20) // (longest * lanes))]
        codes = np.full((len(own), longest), 8, np.uint8)
        for line, k in enumerate(own):
            codes[line, longest - lengths[k]:] = np.frombuffer(symbols[k], np.uint8)
        yield own, codes, lengths[own]
        at += len(own)


def backward(codes: np.ndarray, lengths: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost vectors (position, chunk, ..., state) of chunks in step; the last position holds ``after``.

    ``after`` may have axes between chunk and state; all of them run.
    """
    width = codes.shape[1]
    history = np.zeros((width + 1, *after.shape), np.int32)
    history[width] = after
    for col in range(width - 1, -1, -1):
        active = int(np.searchsorted(-lengths, -(width - col), side="right"))
        history[col] = history[col + 1]
        costs = ROW_COSTS[codes[:active, col]]
        costs = costs.reshape(active, *[1] * (after.ndim - 2), 4, 4)
        history[col, :active] = (costs + history[col + 1, :active, ..., None, :]).min(axis=-1)
    return history


def trace(
    codes: np.ndarray, lengths: np.ndarray, history: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ``EDITS`` (chunk, start, position) of the least audits, and the states they end in."""
    n, width = codes.shape
    state = np.tile(starts, (n, 1))
    out = np.zeros((n, len(starts), width), np.uint8)
    for col in range(width):
        active = int(np.searchsorted(-lengths, -(width - col), side="right"))
        own, code = state[:active], codes[:active, col][:, None]
        before, after = history[col, :active], history[col + 1, :active]
        cost = lambda vectors, states: np.take_along_axis(vectors, states, axis=1)
        inserted = np.zeros(own.shape, np.uint8)
        for _ in range(2):
            insert = (cost(after, own) + DELETE != cost(before, own)) & (
                cost(before, NEXT[own]) + INSERT == cost(before, own)
            )
            own = np.where(insert, NEXT[own], own)
            inserted += insert
        delete = cost(after, own) + DELETE == cost(before, own)
        target = KEPT[code, own]
        stays = np.where((code >= 4) & (code < 8), TRUNCATED, 0)
        keep = ~delete & (target >= 0) & (cost(after, np.maximum(target, 0)) + stays == cost(before, own))
        state[:active] = np.where(delete, own, np.where(keep, target, NEXT[own]))
        out[:active, :, col] = inserted * 3 + np.where(delete, 0, np.where(keep, 1, 2))
    return out, state


def spoken_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest, blank, truncated), with nulls of role and text as one space."""
    space = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    named = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), space(role).alias("role"), space(text).alias("text")
    )
    said = F.rtrim("text", F.lit(SPACES))
    return named.select(
        "*", F.unhex(F.md5("text")).alias("digest"), (said == "").alias("blank"),
        (~F.right(said, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )


def judged_rows(spoken: DataFrame) -> DataFrame:
    """One row per distinct (conv, turn, role, digest) with its number ``n``, ``first`` if none of its kind is earlier."""
    counted = cut_lineage(spoken.groupBy("conv", "turn", "role", "digest").agg(
        F.count("*").alias("n"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated")
    ))
    kinds = counted.groupBy(F.col("conv").alias("k_conv"), F.col("role").alias("k_role"), F.col("digest").alias("k_digest")).agg(
        F.min("turn").alias("k_turn"), F.max(F.col("turn").isNull()).alias("k_null")
    )
    same = F.col("conv").eqNullSafe(F.col("k_conv")) & (F.col("role") == F.col("k_role")) & (F.col("digest") == F.col("k_digest"))
    first = F.when(F.col("k_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("k_turn"))
    return cut_lineage(counted.join(kinds, same).select(*counted.columns, first.alias("first")))


def fault_counts(judged: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated) of every conversation."""
    later = F.when(F.col("first"), F.col("n") - 1).otherwise(F.col("n"))
    alone = F.col("first") & ~F.col("blank")
    return judged.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(later)).alias("duplicate"),
        F.count_if(alone & F.col("truncated")).alias("truncated"),
    )


def chunk_table(judged: DataFrame, chunk_rows: int) -> DataFrame:
    """(conv, at, n_chunks, symbols): a code per row, in chunks numbered from 0 in every conversation."""
    order = ["conv", "turn", "role", "digest"]
    initial = F.substring("role", 1, 1)
    known = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    code = known + F.when(F.col("blank") | ~F.col("first"), 8).when(F.col("truncated"), 4).otherwise(0)
    ranged = judged.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", code.alias("code"), "n")
    kind = ranged.schema["conv"].dataType
    schema = StructType([
        StructField("conv", kind), StructField("part", IntegerType()), StructField("own", LongType()),
        StructField("symbols", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, own, held, begun, out, conv_type = None, 0, bytearray(), False, [], None

        def full(final: bool) -> bool:
            return len(out) >= 1000 or final and out

        def table() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = (conv_type, pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv", "part", "own", "symbols"]
            )

        for batch in batches:
            conv_type = batch.column(0).type
            for conv, code, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and conv != last:
                    out.append((last, part, own, bytes(held)))
                    own, held = 0, bytearray()
                last, begun = conv, True
                again = code if code >= 8 else code % 4 + 8
                while n:
                    if len(held) == chunk_rows:
                        out.append((last, part, own, bytes(held)))
                        own, held = own + 1, bytearray()
                        if full(False):
                            yield table()
                    taken = min(n, chunk_rows - len(held))
                    held.append(code)
                    held += bytes([again]) * (taken - 1)
                    code, n = again, n - taken
                if full(False):
                    yield table()
        if begun:
            out.append((last, part, own, bytes(held)))
        if full(True):
            yield table()

    pieces = cut_lineage(ranged.mapInArrow(run, schema))
    # a row per conversation and range: a conversation has at most as many as there are ranges
    spans = pieces.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("conv").alias("s_conv"), F.col("part").alias("s_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"),
        F.sum("n").over(Window.partitionBy("conv")).alias("n_chunks"),
    ).where("n_chunks > 1")
    placed = pieces.join(spans, F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("part") == F.col("s_part")), "left")
    return placed.select(
        "conv", (F.col("own") + F.coalesce("skip", F.lit(0))).alias("at"),
        F.coalesce("n_chunks", F.lit(1)).alias("n_chunks"), "symbols",
    )


def _on_chunks(chunks: DataFrame, work: Callable, fields: list[StructField], lanes: int) -> DataFrame:
    """``chunks`` with more columns, from slices of chunks that run in step.

    ``work(codes, lengths, end_vectors)`` returns a list of values per new column. Chunks without ``after`` begin from
    the end of a conversation.
    """
    schema = StructType([*chunks.schema.fields, *fields])
    at, known = chunks.columns.index("symbols"), "after" in chunks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = batch.column(at).to_pylist()
            ends = batch.column("after").to_pylist() if known else [AT_END] * len(symbols)
            columns: list[list] = [[None] * len(symbols) for _ in fields]
            for own, codes, lengths in _slices(symbols, lanes):
                after = np.array([ends[k] for k in own], np.int32).reshape(-1, 4)
                for column, values in zip(columns, work(codes, lengths, after), strict=True):
                    for k, value in zip(own, values, strict=True):
                        column[k] = value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, _ARROW[f.name]) for c, f in zip(columns, fields, strict=True)]],
                names=[*batch.schema.names, *[f.name for f in fields]],
            )

    return chunks.mapInArrow(run, schema)


_INTS = ArrayType(IntegerType())
_ARROW = {
    "before": pa.list_(pa.int32()), "constant": pa.int64(), "matrix": pa.list_(pa.int32()),
    "audits": pa.list_(pa.binary()), "ends": pa.list_(pa.int32()),
}
_VECTOR = [StructField("before", _INTS), StructField("constant", LongType())]


def _run_back(codes, lengths, after):
    """The vector before a chunk, 0 after an assistant, and the constant taken off."""
    found = backward(codes, lengths, after)[0]
    constant = found[:, ASSISTANT]
    return (found - constant[:, None]).tolist(), constant.tolist()


def _matrices(codes, lengths, after):
    units = np.where(np.eye(4, dtype=bool), 0, _FAR).astype(np.int32)
    found = backward(codes, lengths, np.broadcast_to(units, (len(codes), 4, 4)).copy())[0]
    return [np.minimum(found.transpose(0, 2, 1), _FAR).reshape(len(codes), 16).tolist()]


def _chained(table: DataFrame, value: str, join: Callable[[Column, Column], Column], step: int) -> DataFrame:
    """(conv, at, value) with the values of all chunks before (step -1) or after (1) joined in, in log2 steps."""
    table = cut_lineage(table.select("conv", "at", "n_chunks", value))
    longest = table.agg(F.max("n_chunks")).first()[0] or 1
    reach = 1
    while reach < longest:
        other = table.select(F.col("conv").alias("o_conv"), (F.col("at") - step * reach).alias("o_at"), F.col(value).alias("other"))
        met = table.join(other, F.col("conv").eqNullSafe(F.col("o_conv")) & (F.col("at") == F.col("o_at")), "left")
        table = cut_lineage(met.select(
            "conv", "at", "n_chunks",
            F.when(F.col("other").isNull(), F.col(value)).otherwise(join(F.col(value), F.col("other"))).alias(value),
        ))
        reach *= 2
    return table


def _product(left: Column, right: Column) -> Column:
    """The cheapest sums of two 4 x 4 cost matrices, by rows."""
    cell = lambda ij: F.array_min(F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda k: F.get(left, ij - ij % 4 + k) + F.get(right, k * 4 + ij % 4),
    ))
    cheap = F.transform(F.sequence(F.lit(0), F.lit(15)), cell)
    # only differences within a row set matter, and they are small: costs stay small numbers
    low = F.array_min(cheap)
    return F.transform(cheap, lambda c: F.least(c - low, F.lit(_FAR)).cast("int"))


def _next_of(table: DataFrame, value: str) -> DataFrame:
    return table.select(F.col("conv").alias("o_conv"), (F.col("at") - 1).alias("o_at"), F.col(value).alias("assumed"))


def _with_next(table: DataFrame, other: DataFrame) -> DataFrame:
    return table.join(other, F.col("conv").eqNullSafe(F.col("o_conv")) & (F.col("at") == F.col("o_at")), "left").drop("o_conv", "o_at")


def end_vectors(chunks: DataFrame, passes: int = PASSES) -> DataFrame:
    """Chunks of long conversations with the vector ``after`` each, up to a constant, by speculation and fix-up passes."""
    at_end = F.array(*[F.lit(int(c)) for c in AT_END])
    state = cut_lineage(_on_chunks(chunks, _run_back, _VECTOR, 1).withColumn("after", at_end))
    base = ["conv", "at", "n_chunks", "symbols"]
    for _ in range(passes):
        met = cut_lineage(_with_next(state, _next_of(state, "before")))
        wrong = F.col("assumed").isNotNull() & (F.col("assumed") != F.col("after"))
        if not met.where(wrong).head(1):
            return state.select(*base, "after")
        again = met.where(wrong).select(*base, F.col("assumed").alias("after"))
        again = _on_chunks(again, _run_back, _VECTOR, 1)
        state = cut_lineage(met.where(~wrong).select(*again.columns).unionByName(again))
    matrices = _on_chunks(chunks, _matrices, [StructField("matrix", _INTS)], 4)
    suffix = _chained(matrices, "matrix", _product, 1)
    end = [int(c) for c in AT_END]
    costs = [F.array_min(F.array(*[F.col("matrix")[4 * q + r] + end[r] for r in range(4)])) for q in range(4)]
    known = suffix.select("conv", "at", F.array(*[(c - costs[ASSISTANT]).cast("int") for c in costs]).alias("before"))
    return _with_next(chunks, _next_of(known, "before")).select(*base, F.coalesce("assumed", at_end).alias("after"))


def _audits_of(starts: tuple[int, ...]):
    def work(codes, lengths, after):
        history = backward(codes, lengths, after)
        edits, states = trace(codes, lengths, history, np.array(starts))
        width = codes.shape[1]
        audits = [
            [b"".join(EDITS[own[lane, width - n:]].tolist()) for lane in range(len(starts))]
            for own, n in zip(edits, lengths, strict=True)
        ]
        return audits, states.tolist(), *_split(history[0])

    return work


def _split(found: np.ndarray) -> tuple[list, list]:
    constant = found[:, ASSISTANT]
    return (found - constant[:, None]).tolist(), constant.tolist()


_TRACED = [StructField("audits", ArrayType(BinaryType())), StructField("ends", _INTS), *_VECTOR]


def chunk_audits(chunks: DataFrame, passes: int = PASSES) -> DataFrame:
    """(conv, at, audit, cost): the audit of every chunk, and costs that add up to that of the conversation."""
    chunks = cut_lineage(chunks)
    short = _on_chunks(chunks.where("n_chunks = 1"), _audits_of((NOTHING,)), _TRACED, 1).select(
        "conv", "at", F.col("audits")[0].alias("audit"), F.col("ends")[0].alias("end"), F.lit(True).alias("last"),
        (F.col("constant") + F.col("before")[NOTHING]).alias("cost"),
    )
    parts = short
    long = chunks.where("n_chunks > 1")
    if long.head(1):
        traced = cut_lineage(_on_chunks(end_vectors(long, passes), _audits_of((0, 1, 2, 3)), _TRACED, 4))
        # the state after all chunks up to this one, from each first state
        reached = _chained(traced, "ends", lambda own, before: F.transform(before, lambda q: F.get(own, q)), -1)
        from_start = reached.select(
            F.col("conv").alias("o_conv"), (F.col("at") + 1).alias("o_at"), F.col("ends")[NOTHING].alias("state")
        )
        own = _with_next(traced, from_start).withColumn("state", F.coalesce("state", F.lit(NOTHING)))
        parts = short.unionByName(own.select(
            "conv", "at", F.get("audits", F.col("state")).alias("audit"), F.get("ends", F.col("state")).alias("end"),
            (F.col("at") == F.col("n_chunks") - 1).alias("last"),
            (F.col("constant") + F.when(F.col("at") == 0, F.col("before")[NOTHING]).otherwise(0)).alias("cost"),
        ))
    tail = F.element_at(F.array(*[F.lit(bytes(t)) for t in TAIL]), F.col("end") + 1)
    return parts.select(
        "conv", "at", F.when(F.col("last"), F.concat("audit", tail)).otherwise(F.col("audit")).alias("audit"), "cost"
    )


class _Speaker:
    """One conversation as its sorted rows come by: applies the audit."""

    def __init__(self, conv):
        self.conv, self.audit, self.cost, self.n_illegal = conv, bytearray(), 0, 0
        self.at, self.place, self.before, self.odd = 0, 0, None, None

    def _role(self) -> str:
        return "assistant" if (self.place - self.odd) % 2 else "user"

    def insertions(self) -> Iterator[tuple[int, str, str]]:
        if self.odd is None:
            self.odd = (len(self.audit) - self.audit.count(b"D")) % 2
        while self.at < len(self.audit) and self.audit[self.at:self.at + 1] == b"I":
            yield self.place, self._role(), ""
            self.at, self.place = self.at + 1, self.place + 1

    def row(self, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.n_illegal += 1
        self.before = role[:1]
        yield from self.insertions()
        edit = self.audit[self.at:self.at + 1]
        self.at += 1
        if edit != b"D":
            yield self.place, role if edit == b"K" else self._role(), text
            self.place += 1


def _streamed(spoken: DataFrame, audits: DataFrame) -> DataFrame:
    """Audit chunks, then rows, of every conversation in order, each conversation in one task."""
    rows = spoken.select(
        "conv", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("at"), "turn", "role", "digest", "text",
        F.lit(None).cast("binary").alias("audit"), F.lit(0).cast("long").alias("cost"),
    )
    chunks = audits.select(
        "conv", F.lit(0).alias("kind"), "at", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("role", "string"), ("digest", "binary"), ("text", "string"))],
        "audit", F.col("cost").cast("long").alias("cost"),
    )
    both = chunks.unionByName(rows).repartition("conv")
    return both.sortWithinPartitions("conv", "kind", "at", "turn", "role", "digest").select(
        "conv", "kind", "role", "text", "audit", "cost"
    )


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Speaker, tuple[int, str, str] | None]]:
    """Repaired rows with their conversation; None at its end."""
    own = None
    for batch in batches:
        for conv, kind, role, text, audit, cost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own is None or conv != own.conv:
                if own is not None:
                    yield from ((own, row) for row in own.insertions())
                    yield own, None
                own = _Speaker(conv)
            if kind == 0:
                own.audit += audit
                own.cost += cost
            else:
                yield from ((own, row) for row in own.row(role, text))
    if own is not None:
        yield from ((own, row) for row in own.insertions())
        yield own, None


def _batched(rows: Iterator[tuple], types: list[pa.DataType], names: list[str], size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _record(held, types, names)
            held = []
    if held:
        yield _record(held, types, names)


def _record(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def audited(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    chunk_rows: int = CHUNK_ROWS, passes: int = PASSES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spoken rows, fault counts per conversation, audits per chunk: what the two results below are made of."""
    spoken = cut_lineage(spoken_rows(rows, conv, turn, role, text))
    judged = judged_rows(spoken)
    return spoken, fault_counts(judged), cut_lineage(chunk_audits(chunk_table(judged, chunk_rows), passes))


def repaired_rows(spoken: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, role, text): the rows of repaired conversations, numbered from 0."""
    kind = spoken.schema["conv"].dataType
    types, names = [_arrow(kind), pa.int64(), pa.string(), pa.string()], ["conv", "place", "role", "text"]
    schema = StructType([
        StructField("conv", kind), StructField("place", LongType()), StructField("role", StringType()),
        StructField("text", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((own.conv, *row) for own, row in _applied(batches) if row is not None)
        yield from _batched(found, types, names)

    return _streamed(spoken, audits).mapInArrow(run, schema)


def repair_report(rows: DataFrame, conv: str = "conv_id", ids: DataFrame | None = None, **options) -> DataFrame:
    """Per conversation: faults, cost, audit and the digest of the repaired rows, ``role:text`` joined by newlines.

    ``ids`` adds conversations that have no rows; they have no faults and an empty audit.
    """
    spoken, faults, audits = audited(rows, conv, **options)
    kind = spoken.schema["conv"].dataType
    types = [_arrow(kind), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["d_conv", "illegal", "cost", "audit", "repaired_sha256"]
    schema = StructType([
        StructField("d_conv", kind), StructField("illegal", LongType()), StructField("cost", LongType()),
        StructField("audit", StringType()), StructField("repaired_sha256", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            digest, first = hashlib.sha256(), True
            for own, row in _applied(batches):
                if row is None:
                    yield own.conv, own.n_illegal, own.cost, own.audit.decode(), digest.hexdigest()
                    digest, first = hashlib.sha256(), True
                    continue
                digest.update(f"{'' if first else chr(10)}{row[1]}:{row[2]}".encode())
                first = False

        yield from _batched(found(), types, names)

    digests = _streamed(spoken, audits).mapInArrow(run, schema)
    known = rows.select(F.col(f"`{conv}`").alias("conv"))
    known = (known if ids is None else known.unionByName(ids.select(F.col(f"`{conv}`").alias("conv")))).distinct()
    faults = faults.withColumnRenamed("conv", "f_conv")
    whole = known.join(faults, F.col("conv").eqNullSafe(F.col("f_conv")), "left").join(
        digests, F.col("conv").eqNullSafe(F.col("d_conv")), "left"
    )
    return whole.select(
        F.col("conv").alias(conv),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``rows`` with faults planted by a checksum of conversation and turn.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the
    user's. Nulls of role and text become one space, those of the other two count as one in the checksum.
    """
    space = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    narrow = rows.select(
        F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").alias(turn), space(role).alias(role), space(text).alias(text),
        fault.alias("_fault"),
    ).where("_fault <> 0")
    text_after = F.when(F.col("_fault") == 1, "").when(
        F.col("_fault") == 2, F.translate(text, "".join(ENDS), "")
    ).otherwise(F.col(text))
    return narrow.select(
        conv, turn, F.when(F.col("_fault") == 4, "user").otherwise(F.col(role)).alias(role), text_after.alias(text),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("_fault") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
