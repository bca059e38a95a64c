"""Equi-joins that stay balanced when one key holds a large share of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is cut into blocks of about this many rows, so that one
# cell of the grid makes at most about the square of it in row pairs. A session may set its own
# number as ``affinis.join.rowsPerBlock``.
ROWS_PER_BLOCK = 20_000


def block_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("affinis.join.rowsPerBlock", str(ROWS_PER_BLOCK)))


def _hot_keys(left: DataFrame, right: DataFrame | None, on: list[str], rows_per_block: int) -> DataFrame:
    """``(on, _nl, _nr)``: block counts of the keys with more than one block on a side."""
    count = F.count("*")
    if right is None:
        sizes = left.groupBy(*on).agg(count.alias("_l")).withColumn("_r", F.col("_l"))
    else:
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        sides = left.groupBy(*on).agg(count.alias("_l")).withColumn("_r", none).unionByName(
            right.groupBy(*on).agg(count.alias("_r")).withColumn("_l", none)
        )
        sizes = sides.groupBy(*on).agg(F.greatest(one, F.sum("_l")).alias("_l"), F.greatest(one, F.sum("_r")).alias("_r"))
    return sizes.filter((F.col("_l") > rows_per_block) | (F.col("_r") > rows_per_block)).select(
        *on,
        F.ceil(F.col("_l") / rows_per_block).cast("int").alias("_nl"),
        F.ceil(F.col("_r") / rows_per_block).cast("int").alias("_nr"),
    )


def _own_block(column: str, blocks: str):
    return F.pmod(F.xxhash64(column), F.coalesce(F.col(blocks), F.lit(1))).cast("int")


def _every_block(blocks: str):
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(blocks), F.lit(1)) - 1))


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: str,
    right_id: str,
    rows_per_block: int | None = None,
    self_rows: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``on`` for many rows per key on both sides.

    The rows of a hot key are split by ``left_id`` and ``right_id`` into blocks, and each
    pair of blocks becomes a join key of its own. Every row pair meets in exactly one
    cell, so the result equals the plain join, and one cell reads at most about
    ``2 * rows_per_block`` rows. Keys that are not hot keep a single cell.

    ``self_rows`` says that both sides are the rows of one table, whose keys are then
    counted once. The hot-key table has at most ``rows / rows_per_block`` rows; Spark picks
    its join by the measured size. The left side gets all shuffle partitions, because a small
    input may still make a large join; the right side moves only if Spark's join needs it to.
    """
    rows_per_block = rows_per_block or block_rows(left)
    hot = _hot_keys(self_rows, None, on, rows_per_block) if self_rows is not None else _hot_keys(
        left, right, on, rows_per_block
    )
    cell = [*on, "_bl", "_br"]
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells_left = (
        left.join(hot, on, "left")
        .withColumn("_bl", _own_block(left_id, "_nl"))
        .withColumn("_br", _every_block("_nr"))
        .drop("_nl", "_nr")
        .repartition(partitions, *cell)
    )
    cells_right = (
        right.join(hot, on, "left")
        .withColumn("_br", _own_block(right_id, "_nr"))
        .withColumn("_bl", _every_block("_nl"))
        .drop("_nl", "_nr")
    )
    return cells_left.join(cells_right, cell).drop("_bl", "_br")
