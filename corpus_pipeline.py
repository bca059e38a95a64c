"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and
reads it again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import decontamination, near_duplicates, packing, quality_rules, secrets
from affinis.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor a learned rule rejects."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class, that of the smallest id."""
    return near_duplicates.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = "hits"
    while out in docs.columns:
        out += "_"
    found = decontamination.benchmark_hits(docs, benchmark, out=out)
    return found.where(F.size(F.col(out)["spans"]) == 0).drop(out)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets replaced."""
    done = secrets.redact(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every document's pieces lie in bins of 2048 words."""
    return packing.pack(packing.measured_documents(docs))


STAGES = [
    ("quality rules", quality), ("near-dedup", near_dedup), ("decontamination", decontaminate),
    ("secret scans", redact_secrets), ("best-fit packing", pack),
]

#: MinHash classes and conflict packing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
