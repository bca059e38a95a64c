"""Labelled documents and raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.text import file_type


def one_line(text: Column) -> Column:
    """Newlines become blanks; one at the end goes away."""
    return F.regexp_replace(F.regexp_replace(text, "\r?\n\\z", ""), "\r?\n", " ")


def _folders(spark: SparkSession, root: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [str(status.getPath()) for status in found if status.isDirectory()]


def load_labelled_docs(spark: SparkSession, root: str) -> DataFrame:
    """``(label, path, text)`` of ``root/label/file``.

    The folders are named, not their files: Spark would open a listing task for every file of a pattern.
    """
    folders = _folders(spark, root) or [f"{root.rstrip('/')}/*/*"]
    files = spark.read.option("recursiveFileLookup", "true").text(folders, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(
        F.regexp_extract(path, "([^/]+)/[^/]+$", 1).alias("label"), path.alias("path"),
        one_line(F.col("value")).alias("text"),
    )


def docs_per_label(docs: DataFrame) -> DataFrame:
    return docs.groupBy("label").agg(F.count("*").alias("docs"))


def load_raw_files(spark: SparkSession, root: str, pattern: str = "*.*") -> DataFrame:
    """``(path, type, content)`` of all files below ``root`` whose name fits the pattern."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select("path", file_type(F.col("path")).alias("type"), "content")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and a given schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
