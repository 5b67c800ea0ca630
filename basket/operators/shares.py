"""Share of a total over an already-aggregated result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_share(df: DataFrame, value_col: str, out_col: str, scale: float = 100.0) -> DataFrame:
    """Add ``value * scale / sum(value)`` as a double.

    The total is a scalar subquery over the same aggregated input (a distributed
    aggregate, no single-task window); AQE reuses the input's shuffle for it, so
    the fact below is still scanned once.
    """
    total = df.agg(F.sum(value_col)).scalar()
    return df.withColumn(out_col, F.col(value_col).cast("double") * F.lit(float(scale)) / total)
