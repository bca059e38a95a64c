"""Per-text functions as a new column, in Arrow batches, without touching the other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def with_text_column(
    docs: DataFrame, text: str, out: str, kind: DataType, make: Callable[[], Callable[[bytes | None], object]]
) -> DataFrame:
    """``docs`` with a column ``out``, computed from the UTF-8 bytes of ``text`` (None for null).

    ``make`` runs once per task and returns the function of a text. Every input column is kept as it is,
    whatever its name; an input column named ``out`` is replaced. One row in, one row out, no shuffle.
    """
    names = [c for c in docs.columns if c != out]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    schema = StructType([packed.schema["row"], StructField("value", kind)])
    arrow = _arrow(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            texts = batch.column(1)
            values = pa.array((of(t.as_py()) for t in texts), type=arrow, size=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["row", "value"])

    done = packed.mapInArrow(run, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in names], F.col("value").alias(out))


def _arrow(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
