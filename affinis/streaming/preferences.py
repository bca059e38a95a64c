"""Preference changes that arrive as a stream.

The stream only appends to a change log (the file sink writes each change exactly once); the
current ratings are the overlay of the log on the base table, computed on read. Nothing
rewrites the base table per batch, and no state grows in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from affinis.sources.ratings import apply_overlay

CHANGES = "seq bigint, op string, user_id bigint, item_id bigint, rating double"


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Changes as JSON lines that arrive in a folder."""
    return spark.readStream.schema(CHANGES).json(path)


def log_changes(changes: DataFrame, log_path: str, checkpoint_path: str) -> StreamingQuery:
    """Appends set and remove changes to the log until the input is used up."""
    valid = changes.filter("op in ('set', 'remove') and user_id is not null and item_id is not null")
    return (
        valid.writeStream.format("parquet")
        .option("path", log_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def current_ratings(spark: SparkSession, base: DataFrame, log_path: str) -> DataFrame:
    """The base table with all logged changes applied."""
    return apply_overlay(base, spark.read.schema(CHANGES).parquet(log_path))
