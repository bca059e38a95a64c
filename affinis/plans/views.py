"""Input views of the operators, derived from the benchmark's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.session import cut_lineage, spread
from affinis.sources.ratings import latest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def preference_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a preference: user, item (``$.k``), half-star rating, time."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        (F.lit(0.5) * (1 + F.col("event_id") % 10)).alias("rating"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ratings as a table: derived once, then read by every part of a query."""
    return cut_lineage(latest_ratings(spark, sf_dir))


def latest_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ratings: the latest event per (user, item)."""
    rows = preference_events(spark, sf_dir)
    return latest(rows, ["user_id", "item_id"], "rating", ["ts", "event_id"])


def ratings_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse ratings: customers and parts of the order lines."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        (F.lit(0.5) * F.ceil(F.col("l_quantity") / 5).cast("double")).alias("rating"),
        "o_orderdate", "l_orderkey", "l_linenumber",
    )
    return latest(rows, ["user_id", "item_id"], "rating", ["o_orderdate", "l_orderkey", "l_linenumber", "rating"])


def holdout(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The fixed 70/30 split of the dense ratings."""
    from affinis.operators.sampling import split_ratings

    return split_ratings(ratings(spark, sf_dir), 0.7)


def preference_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes in event order: an ``error`` removes the preference, all else but a click sets it."""
    rows = preference_events(spark, sf_dir).filter(F.col("event_type") != "click")
    op = F.when(F.col("event_type") == "error", "remove").otherwise("set")
    return rows.select(F.col("event_id").alias("seq"), op.alias("op"), "user_id", "item_id", "rating")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from click events alone, the base that the changes apply to."""
    rows = preference_events(spark, sf_dir).filter(F.col("event_type") == "click")
    return latest(rows, ["user_id", "item_id"], "rating", ["ts", "event_id"])


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item tags, repeats count: name words, brand, type, and a tag per supplying line."""
    part = table(spark, sf_dir, "part")
    fixed = part.select(
        F.col("p_partkey").alias("item_id"),
        F.explode(F.concat(F.split("p_name", " "), F.array("p_brand", "p_type"))).alias("tag"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"), F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string")).alias("tag")
    )
    return fixed.unionByName(lines)


def artist_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ``uuid<sep>artist<sep>tag<sep>count``; the 7th line of an order lacks its count."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    count = F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint").cast("string"))
    return joined.select(
        F.concat_ws(
            "<sep>", F.col("l_orderkey").cast("string"), "p_brand", "o_orderpriority", count
        ).alias("value")
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages: two header lines, two blank lines, the text."""
    head = F.concat(F.lit("From: "), "source", F.lit("\nSubject: "), "lang", F.lit(" text\n\n\n"))
    return docs(spark, sf_dir).select("doc_id", "lang", F.concat(head, "text").alias("text"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


def basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``(basket_id, item)``: the brands of an order, dealt out by basket."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("l_orderkey").alias("basket_id"), F.col("p_brand").alias("item")
    ).repartition("basket_id").distinct()
