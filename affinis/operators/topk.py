"""Ranking: best k rows per key with a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Scores are ranked after rounding, so the order does not depend on floating-point sum order.
RANK_DIGITS = 9
_PARTS = 64


def rank_order(score: str, tie: list[str]) -> list[Column]:
    return [F.round(F.col(score), RANK_DIGITS).desc(), *[F.col(t).asc() for t in tie]]


def top_k(
    df: DataFrame, by: list[str], score: str, tie: list[str], k: int, rank: str = "rank"
) -> DataFrame:
    """Best ``k`` rows per ``by``: score descending, then ``tie`` ascending; null scores drop out.

    ``row_number() <= k`` lets Spark cut to k rows per key before the shuffle, so a hot key
    sends at most k rows per task.
    """
    order = rank_order(score, tie)
    window = Window.partitionBy(*by).orderBy(*order)
    rows = df.filter(F.col(score).isNotNull())
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        # The planner makes no early cut for a large k: cut each of some parts of a key first.
        part = F.pmod(F.xxhash64(*tie), F.lit(_PARTS))
        rows = rows.withColumn("_part", part)
        parts = Window.partitionBy(*by, "_part").orderBy(*order)
        rows = rows.withColumn("_place", F.row_number().over(parts)).filter(F.col("_place") <= k)
        rows = rows.drop("_part", "_place")
    return (
        rows.withColumn(rank, F.row_number().over(window))
        .filter(F.col(rank) <= k)
        .withColumn(rank, F.col(rank).cast("bigint"))
    )


def above(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Threshold neighbourhood: rows with a score of at least ``threshold``."""
    return df.filter(F.col(score) >= threshold)
