"""Term counts and TF-IDF over long rows ``(id, term)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.sources.vectors import unit_rows


def term_counts(rows: DataFrame, id: str, term: str) -> DataFrame:
    """Term frequency per (id, term)."""
    return rows.groupBy(id, term).agg(F.count("*").alias("n"))


def document_frequency(counts: DataFrame, term: str) -> DataFrame:
    """Number of ids per term; each id counts once."""
    return counts.groupBy(term).agg(F.count("*").alias("df"))


def tfidf(
    counts: DataFrame,
    id: str,
    term: str,
    n_docs: Column | int,
    min_df: int = 1,
    max_df_pct: float = 100.0,
    log_tf: bool = False,
) -> DataFrame:
    """Unit-length rows ``(id, term, weight)`` of ``tf * ln(N / df)``.

    Terms with a document frequency outside the limits, and terms that every document has
    (weight 0), drop out; so do documents without any weight left.
    """
    total = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    limits = (F.col("df") >= min_df) & (F.col("df") * 100 <= F.col("_n_docs") * max_df_pct)
    idf = (
        document_frequency(counts, term)
        .withColumn("_n_docs", total)
        .filter(limits & (F.col("df") < F.col("_n_docs")))
        .select(term, F.ln(F.col("_n_docs") / F.col("df")).alias("_idf"))
    )
    tf = F.log1p(F.col("n")) if log_tf else F.col("n").cast("double")
    weighted = counts.join(idf, term).select(id, term, (tf * F.col("_idf")).alias("weight"))
    return unit_rows(weighted, id, "weight")
