"""Shards by jump consistent hashing, in SQL expressions.

A key's 64-bit hash seeds a generator; the key jumps from shard to shard until the next jump would leave the
table. There is no ring and no state: key and shard count decide. With one more shard a key either stays or moves
into the new one, and about 1 of n keys does.

The generator multiplies modulo 2^64, which SQL's checked arithmetic refuses, so its state is kept as two halves
of 32 bits. Null keys hash like any value. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.session import cut_lineage

#: Fixed value: the multiplier of the generator.
MULTIPLIER = 2862933555777941757
_LOW = 0xFFFFFFFF


def _low_product(a: Column, b: int) -> Column:
    """a * b modulo 2^32, for 32-bit a and b."""
    high = F.shiftleft((F.shiftright(a, 16) * b).bitwiseAND(F.lit(0xFFFF)), 16)
    return (a.bitwiseAND(F.lit(0xFFFF)) * b + high).bitwiseAND(F.lit(_LOW))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2^64."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW
    part0, part1 = low.bitwiseAND(F.lit(0xFFFF)) * m_low, F.shiftright(low, 16) * m_low
    bottom = part0.bitwiseAND(F.lit(_LOW)) + F.shiftleft(part1.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    top = (
        F.shiftright(part0, 32) + F.shiftright(part1, 16) + F.shiftright(bottom, 32)
        + _low_product(high, m_low) + _low_product(low, m_high)
    )
    return top.bitwiseAND(F.lit(_LOW)), bottom.bitwiseAND(F.lit(_LOW))


def jump_shard(hashed: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a 64-bit hash. A key jumps at most ``shards`` times."""
    long = lambda c: c.cast("long")
    state = lambda shard, jump, high, low: F.struct(
        shard.alias("shard"), jump.alias("jump"), high.alias("high"), low.alias("low")
    )
    start = state(
        long(F.lit(-1)), long(F.lit(0)), long(F.shiftrightunsigned(hashed, 32)), long(hashed.bitwiseAND(F.lit(_LOW)))
    )

    def step(s: Column, _) -> Column:
        high, low = _next(s["high"], s["low"])
        ratio = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
        moved = state(s["jump"], long(F.floor((s["jump"] + 1).cast("double") * ratio)), high, low)
        return F.when(s["jump"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["shard"].cast("int"))


def assign_shards(docs: DataFrame, key: str, shards: int, grown: int | None = None) -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard`` (with ``grown`` shards, one more by default); both replace
    input columns of these names."""
    hashed = F.xxhash64(F.col(f"`{key}`"))
    return docs.withColumns({"shard": jump_shard(hashed, shards), "grown_shard": jump_shard(hashed, grown or shards + 1)})


def number_slots(rows: DataFrame, block_rows: int = 100_000) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 within each ``shard``.

    Shards are numbered in parts: rows get a part by hash, parts are counted, and a part's rows are numbered from
    the number of rows before it. No task sees more than a part (about ``block_rows``) or the table of counts.
    A column ``slot`` is replaced, all others are kept whatever their names.
    """
    row, part, start, within = (_free(name, rows) for name in ("slot_row", "slot_part", "slot_start", "slot_within"))
    rows = cut_lineage(rows.drop("slot").withColumn(row, F.monotonically_increasing_id()))
    parts = max(1, -(-rows.count() // block_rows))
    rows = rows.withColumn(part, F.pmod(F.xxhash64(row), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", part).agg(F.count("*").alias("n"))
    before = F.expr(f"sum(n) over (partition by shard order by {part} rows between unbounded preceding and 1 preceding)")
    starts = counts.select("shard", part, F.coalesce(before, F.lit(0)).alias(start))
    place = F.expr(f"row_number() over (partition by shard, {part} order by {row})")
    numbered = rows.withColumn(within, place).join(starts, ["shard", part])
    return numbered.withColumn("slot", F.col(start) + F.col(within) - 1).drop(row, part, start, within)


def _free(name: str, rows: DataFrame) -> str:
    """The name, lengthened until no column has it."""
    while name in rows.columns:
        name += "_"
    return name
