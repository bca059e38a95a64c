"""Readers and changes for ratings, tags, titles and weighted text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
])


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,value`` text without a header; blank and malformed lines are skipped."""
    rows = spark.read.schema(RATINGS).option("mode", "DROPMALFORMED").csv(path)
    return rows.filter(
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("rating").isNotNull()
    )


def rejected_ratings(spark: SparkSession, path: str) -> DataFrame:
    """One row: how many non-blank lines do not hold a rating."""
    fields = F.split("value", ",")

    def part(i: int, kind: str) -> Column:
        return F.get(fields, F.lit(i)).try_cast(kind).isNull()

    bad = part(0, "bigint") | part(1, "bigint") | part(2, "double")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.agg(F.count_if(bad).alias("rejected"))


def to_boolean(ratings: DataFrame) -> DataFrame:
    """Presence only: each (user, item) once, with rating 1."""
    return ratings.select("user_id", "item_id").distinct().withColumn("rating", F.lit(1.0))


def latest(rows: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """The value of the last row per key. An aggregate, so it is combined before the shuffle."""
    newest = F.max_by(value, F.struct(*order)).alias(value)
    return rows.groupBy(*by).agg(newest)


def apply_overlay(ratings: DataFrame, changes: DataFrame) -> DataFrame:
    """Ratings after changes ``(seq, op, user_id, item_id, rating)``; op is ``set`` or ``remove``.

    The last change of a pair wins over the base and over earlier changes.
    """
    base = ratings.select(
        F.lit(None).cast("bigint").alias("seq"), F.lit("set").alias("op"), "user_id", "item_id", "rating"
    )
    order = F.struct(F.coalesce("seq", F.lit(-(2**63)).cast("bigint")))
    last = (
        base.unionByName(changes.select("seq", "op", "user_id", "item_id", "rating"))
        .groupBy("user_id", "item_id")
        .agg(F.max_by(F.struct("op", "rating"), order).alias("last"))
    )
    return last.filter(F.col("last.op") == "set").select("user_id", "item_id", F.col("last.rating").alias("rating"))


def _id_and_text(spark: SparkSession, path: str, text: str) -> DataFrame:
    parts = F.split("value", ",", 2)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(
        F.get(parts, F.lit(0)).try_cast("bigint").alias("item_id"), F.get(parts, F.lit(1)).alias(text)
    ).filter(F.col("item_id").isNotNull() & F.col(text).isNotNull())


def load_tags(spark: SparkSession, path: str) -> DataFrame:
    """``item,tag`` lines; the tag keeps later commas, repeats count."""
    return _id_and_text(spark, path, "tag")


def load_titles(spark: SparkSession, path: str) -> DataFrame:
    """``item,title`` lines; the title keeps later commas."""
    return _id_and_text(spark, path, "title")


def with_titles(results: DataFrame, titles: DataFrame, item: str = "item_id") -> DataFrame:
    """Titles for result rows. Spark broadcasts the titles where their size allows it."""
    names = titles.select(F.col(titles.columns[0]).alias(item), F.col(titles.columns[1]).alias("title"))
    return results.join(names, item)


def split_delimited(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines of four fields joined by ``<sep>``; ``fields`` is the split line."""
    return lines.withColumn("fields", F.split(value, "<sep>"))


def artist_tags(lines: DataFrame) -> DataFrame:
    """``(uuid, artist, tag, weight)`` of the lines with exactly four fields."""
    good = split_delimited(lines).filter(F.size("fields") == 4)
    f = [F.get("fields", F.lit(i)) for i in range(4)]
    return good.select(
        f[0].alias("uuid"), f[1].alias("artist"), f[2].alias("tag"), f[3].cast("double").alias("weight")
    )


def count_lines(lines: DataFrame) -> DataFrame:
    """One row: lines, and lines without exactly four fields."""
    return split_delimited(lines).agg(
        F.count("*").alias("lines"), F.count_if(F.size("fields") != 4).alias("rejected")
    )


def load_artist_tags(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of an artist tag file, and the count of its lines and rejected lines."""
    lines = spark.read.text(path)
    return artist_tags(lines), count_lines(lines)
