"""Weighted text lines ``key$weight key$weight``, named vectors, centroids and sparse exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinis.session import cut_lineage, scratch_path


def parse_map(line: str | Column) -> Column:
    """A weighted line as ``map<string,double>``; a repeated key keeps its last weight.

    A piece without a weight is dropped.
    """
    column = F.col(line) if isinstance(line, str) else line
    pieces = F.filter(F.split(F.trim(column), " +"), lambda p: p.contains("$"))
    entries = F.transform(
        pieces,
        lambda p, i: F.struct(
            F.split_part(p, F.lit("$"), F.lit(1)).alias("key"),
            i.alias("pos"),
            F.split_part(p, F.lit("$"), F.lit(2)).try_cast("double").alias("weight"),
        ),
    )
    # Sorted by key and position, the last entry of a key is the one whose successor differs.
    # The outer transform binds the sorted array once.
    last = F.transform(
        F.array(F.array_sort(entries)),
        lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i + 1)["key"] != e["key"], F.lit(True))),
    )
    kept = F.transform(F.get(last, F.lit(0)), lambda e: F.struct(e["key"], e["weight"]))
    return F.map_from_entries(kept)


def parse_weighted(lines: DataFrame, id: str, value: str, normalize: bool = False) -> DataFrame:
    """Long rows ``(id, key, weight)`` of weighted lines, L2-normalised per line on request.

    The last weight of a repeated key wins, by position.
    """
    pieces = lines.select(F.col(id), F.posexplode(F.split(F.trim(F.col(value)), " +")).alias("pos", "piece"))
    parsed = pieces.filter(F.col("piece").contains("$")).select(
        id, "pos",
        F.split_part("piece", F.lit("$"), F.lit(1)).alias("key"),
        F.split_part("piece", F.lit("$"), F.lit(2)).try_cast("double").alias("weight"),
    ).filter(F.col("weight").isNotNull())
    rows = parsed.groupBy(id, "key").agg(F.max_by("weight", "pos").alias("weight"))
    return unit_rows(rows, id, "weight") if normalize else rows


def unit_rows(rows: DataFrame, id: str, value: str, many_rows: bool = False) -> DataFrame:
    """Long rows divided by the L2 norm of their id; ids with norm 0 drop out.

    One shuffle and a window over the rows of an id, which are at most as many as the terms
    of a document. ``many_rows=True`` is for ids that may hold a large part of the table: norms are
    then combined before the shuffle and joined back.
    """
    squares = F.col(value) * F.col(value)
    if not many_rows:
        norm = F.sqrt(F.sum(squares).over(Window.partitionBy(id)))
        scaled = rows.withColumn("_norm", norm).filter(F.col("_norm") > 0)
        return scaled.withColumn(value, F.col(value) / F.col("_norm")).drop("_norm")
    norms = rows.groupBy(id).agg(F.sqrt(F.sum(squares)).alias("_norm"))
    scaled = rows.join(norms.filter(F.col("_norm") > 0), id)
    return scaled.withColumn(value, F.col(value) / F.col("_norm")).drop("_norm")


def keys_only(lines: DataFrame, id: str, value: str) -> DataFrame:
    """Transactions ``(id, items)`` of weighted lines: the keys without weights, null lines skipped."""
    items = F.transform(
        F.split(F.trim(F.col(value)), " +"), lambda p: F.split_part(p, F.lit("$"), F.lit(1))
    )
    return lines.filter(F.col(value).isNotNull()).select(id, F.filter(items, lambda x: x != "").alias("items"))


def write_vectors(points: DataFrame, path: str) -> None:
    """Named vectors ``(name, vector array<double>)`` as Parquet."""
    points.write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_centroids(centroids: DataFrame, path: str) -> None:
    """Centroids ``(label, key, weight)`` as Parquet, weights to 5 decimals."""
    centroids.select("label", "key", F.round("weight", 5).alias("weight")).write.mode("overwrite").parquet(path)


def load_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Centroids of a saved model, unit length again."""
    return unit_rows(spark.read.parquet(path), "label", "weight", many_rows=True)


def number_lines(spark: SparkSession, path: str, value: str = "value") -> DataFrame:
    """Lines of one text file with their number, for files that are paired line by line.

    Reads the file with its name and offset order: the number is the rank of the line's
    partition and place, made dense by partition counts.
    """
    from affinis.operators.dictionary import dense_positions

    lines = spark.read.text(path)
    return dense_positions(lines, "line_no").select("line_no", F.col("value").alias(value))


def sparse_rows(encoded: DataFrame, id: str, index: str, value: str) -> DataFrame:
    """``(id, indices, values)``: one sparse row per id, sorted by index."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(index).cast("int").alias("i"), F.col(value).alias("v"))))
    return encoded.groupBy(id).agg(pairs.alias("_p")).select(
        id, F.col("_p.i").alias("indices"), F.col("_p.v").alias("values")
    )


def with_vector(rows: DataFrame, size: int, name: str = "features") -> DataFrame:
    """Sparse rows with an ML vector column, as a table in the shared folder.

    A vector's stored form is a struct of kind, size, indices and values: rows are written with that and read
    back as vectors, without a step per row in between.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    spark = rows.sparkSession
    path = scratch_path(spark, "vectors")
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.col("indices").cast("array<int>").alias("indices"), F.col("values").cast("array<double>").alias("values"),
    )
    rows.withColumn(name, stored).write.parquet(path)
    others = [field for field in rows.schema.fields if field.name != name]
    return spark.read.schema(T.StructType([*others, T.StructField(name, VectorUDT())])).parquet(path)


def stored_values(vector: str) -> Column:
    """The entries that a sparse vector stores, whatever its size: those of all dimensions are never laid out."""
    return F.unwrap_udt(vector)["values"]


def export_sparse(
    labels: DataFrame, vectors: DataFrame, id: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Encoded rows ``(id, label_id, index, value)``, unit length, with both dictionaries.

    ``labels(id, label)`` and ``vectors(id, key, weight)``.
    """
    from affinis.operators.dictionary import dictionary, encode

    label_ids = dictionary(labels, "label", "label_id")
    named = encode(labels.select(id, "label"), label_ids, "label")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id)))
    # Norms and labels join the rows where an id's rows are together; then they travel by key alone.
    rows = cut_lineage(vectors.select(id, "key", "weight").withColumn("_norm", norm).join(
        named.groupBy(id).agg(F.collect_list("label_id").alias("_labels")), id, "left"
    ))
    feature_ids = dictionary(rows, "key", "index")
    encoded = encode(rows.filter((F.col("_norm") > 0) & F.col("_labels").isNotNull()), feature_ids, "key").select(
        id, F.explode("_labels").alias("label_id"), "index", (F.col("weight") / F.col("_norm")).alias("value")
    )
    return encoded, label_ids, feature_ids


def write_sparse(encoded: DataFrame, size: int, path: str, id: str) -> None:
    """Encoded rows as libsvm text, one line per id."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("index").cast("int").alias("i"), F.col("value").alias("v"))))
    rows = encoded.groupBy(id).agg(pairs.alias("_p"), F.collect_set("label_id").alias("_labels")).select(
        id, F.col("_p.i").alias("indices"), F.col("_p.v").alias("values"), F.explode("_labels").alias("label_id")
    )
    with_vector(rows, size).select(F.col("label_id").cast("double").alias("label"), "features").write.mode(
        "overwrite"
    ).format("libsvm").save(path)
